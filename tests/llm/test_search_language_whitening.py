"""Ranked search, language identification and whitening."""

import itertools
import math
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterfold.llm import language_id, ranked_search, whitening
from clusterfold.llm.queries import fold, op11_whitening, op12_language_id, op13_ranked_search

from .conftest import LOWER, prose

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---- ranked search -----------------------------------------------------------------


def terms_of(text):
    return [t.translate(LOWER) for t in TERMS.findall(text or "")]


def brute_search(docs, items, k=10, b=75):
    """Every document's score by the definition."""
    bags = [(i, terms_of(t)) for i, t in docs]
    bags = [(i, w, Counter(w)) for i, w in bags if w]
    n_docs, n_terms = len(bags), sum(len(w) for _, w, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, w, c in bags:
            m = 100 - b + (b * len(w) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms_of(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def searched(docs, items, spark, **options):
    index = ranked_search.build(docs, **options)
    found = ranked_search.search(index, items, 10).collect()
    index.remove()
    return sorted(((r["item"], r["rank"], r["doc_id"], r["score"]) for r in found), key=str)


@pytest.fixture(scope="module")
def items(spark, edge_rows):
    texts = [edge_rows[7][1], "the the THE of élan", None, "", "...", "nowhere held", "日本 naïve x1", "stone river cold water a b tin ed", "license version 2"]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(1, "the the THE of élan", "x"), (None, "cold tin", "y")]
    return spark.createDataFrame(rows, "item_id long, text string, score string")


@pytest.mark.parametrize("table", ["edge_docs", "sf_docs"])
@pytest.mark.parametrize("shard_bytes", [1, 3000, 8 << 20])
def test_search_equals_brute_force(request, spark, items, table, shard_bytes, monkeypatch):
    docs = request.getfixturevalue(table)
    if table == "sf_docs":
        items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert searched(docs, items, spark, shard_bytes=shard_bytes) == want


def test_search_ties_null_ids_and_no_rows(spark, items, no_docs):
    rows = [(9, "alpha beta"), (3, "alpha beta"), (None, "alpha beta"), (3, "alpha beta"), (4, None), (5, "")] + [(100 + k, "alpha gamma") for k in range(30)] + [(200 + k, "delta") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame([(1, "beta"), (2, "alpha"), (3, "zeta")], "item_id long, text string")
    want = brute_search(rows, [(1, "beta"), (2, "alpha"), (3, "zeta")])
    assert searched(docs, asked, spark) == want
    assert [r[2] for r in want if r[0] == 1] == [3, 3, 9, None]
    assert searched(no_docs, items, spark) == []
    assert searched(docs, items.limit(0), spark) == []


def test_search_over_query_blocks(spark, edge_docs, items):
    want = brute_search([(r["doc_id"], r["text"]) for r in edge_docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    index = ranked_search.build(edge_docs)
    found = ranked_search.search(index, items, 10, most_terms=3).collect()
    assert sorted(((r["item"], r["rank"], r["doc_id"], r["score"]) for r in found), key=str) == want


def shard_of(texts, n_docs, n_terms, b=75):
    raw = [t.encode() for t in texts]
    part = (np.arange(len(raw)), np.zeros(len(raw), bool), np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]))
    row = ranked_search._shard([part], 0, n_docs, n_terms, b)
    names = row["terms"].to_pylist()
    return ranked_search._Lists(dict(row, terms={t: k for k, t in enumerate(names)}))


def test_maxscore_rejects_blocks_before_unpacking():
    rng = np.random.default_rng(5)
    texts = ["common " * int(rng.integers(1, 4)) + ("rare " * 3 if k < 12 else "") + "filler " * int(rng.integers(1, 30)) for k in range(6000)]
    bags = [t.split() for t in texts]
    n_terms = sum(map(len, bags))
    shard = shard_of(texts, 6000, n_terms)
    df = Counter(t for w in bags for t in set(w))
    weights = {t.encode(): ranked_search.weight(n, 6000) for t, n in df.items()}
    weights[b"common"] = weights[b"filler"] = 40  # lists with a say in the result
    queries = ranked_search._Queries([(0, [b"rare", b"common", b"filler"])], weights)
    heaps = {0: ranked_search._Heap(10)}
    ranked_search._search_shard(shard, queries, heaps)
    # the whole ranking, by the same integers
    scores = []
    for k, w in enumerate(bags):
        c, m = Counter(w), 25 + (75 * len(w) * 6000) // n_terms
        scores.append((-sum(weights[t.encode()] * ((10**9 * n) // (1000 * n + 8 * m)) for t, n in c.items()), False, k))
    assert heaps[0].rows == sorted(scores)[:10]
    assert shard.unpacked < len(shard.low) / 2  # later windows: "common" and "filler" stay packed


def test_search_of_a_very_long_text(spark):
    long = prose(__import__("random").Random(1), 4000)
    rows = [(1, long * 1000 + " needle"), (2, "needle"), (3, "cold tin")]
    assert len(rows[0][1].encode()) > 20 << 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "needle tin")], "item_id long, text string")
    assert searched(docs, asked, spark) == brute_search(rows, [(1, "needle tin")])


def test_search_norms_stay_exact():
    sizes = np.array([1, 10**9], np.int64)
    assert ranked_search.norms(sizes, 10**12, 10**15, 75).tolist() == [25 + 75 * 10**12 // 10**15, 25 + 75 * 10**21 // 10**15]


# ---- language identification ---------------------------------------------------------


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    for piece in (1, 2, 3, 100):
        scores = rng.normal(0, 5, (6, 3))
        sizes = [0, 1, 5, 7, 2]
        first = np.concatenate([[0], np.cumsum(sizes)])
        code = rng.integers(0, 6, first[-1])
        got = language_id.viterbi(scores, code, first, switch=4.0, piece=piece)
        for a, b in zip(first[:-1], first[1:]):
            def value(path):
                return sum(scores[code[a + k], x] for k, x in enumerate(path)) - 4.0 * sum(x != y for x, y in zip(path, path[1:]))
            best = max((value(p) for p in itertools.product(range(3), repeat=b - a)), default=0)
            assert value(got[a:b]) == pytest.approx(best)


LANGS = {"en": "the of and with water stone river this that", "de": "der die und mit wasser stein fluss dieser über", "el": "το και νερό πέτρα ποτάμι αυτό", "xx": "κτλ"}


@pytest.fixture(scope="module")
def told(spark):
    rng = __import__("random").Random(3)
    rows = []
    for k in range(400):
        lang = "en" if k % 3 else rng.choice(["de", "el"])
        rows.append((k, " ".join(rng.choice(LANGS[lang].split()) for _ in range(rng.randint(3, 40))), lang))
    rows += [(1000, None, "en"), (1001, "nobody says", None), (1002, "", "de"), (None, "the water", "en"), (1003, "123", "zz")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_language_spans(spark, told):
    model = language_id.train(told, F.lit(True))
    assert model.languages[0] == "en" and sorted(model.languages) == ["de", "el", "en"]  # by their letters; zz has none
    text = "this water and the river, und der stein mit wasser über der fluss; το νερό και 12 πέτρα"
    rows = [(1, text), (2, None), (3, ""), (4, "12 !!"), (5, "汉字"), (6, "the stone 汉字"), (7, "the stone"), (7, "the stone"), (None, "der fluss"), (8, "́́")]
    got = language_id.identify(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang_pred string"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert [(s["lang"], text[s["start"]:s["end"]]) for s in by[1]["spans"]] == [
        ("en", "this water and the river"), ("de", "und der stein mit wasser über der fluss"), ("el", "το νερό και 12 πέτρα")]
    for k in (2, 3, 4, 8):
        assert (by[k]["lang_pred"], by[k]["score"], by[k]["spans"]) == ("und", 0.0, [])
    assert by[5]["score"] == 0.0 and by[5]["lang_pred"] == "en"  # says nothing: the first language
    assert by[6]["lang_pred"] == "en" and 0 < by[6]["score"] < 1
    assert by[7]["score"] == 1.0 and by[None]["lang_pred"] == "de"


def test_language_candidates_follow_scripts(spark, told):
    model = language_id.train(told, F.lit(True))
    data = "το the αβγ".encode()
    block = language_id.Block(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    scores = model.scores(block)[block.code]
    greek = model.languages.index("el")
    assert (scores[[0, 2]].argmax(axis=1) == greek).all() and scores[1].argmin() == greek


def test_language_without_training(spark, told, edge_docs, no_docs):
    assert language_id.train(told, F.lit(False)) is None
    assert language_id.train(no_docs, F.lit(True)) is None
    got = language_id.identify(edge_docs, None).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)} and len(got) == edge_docs.count()
    assert language_id.identify(no_docs, language_id.train(told, F.lit(True))).count() == 0
    one = language_id.train(told.where("lang = 'en'"), F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(edge_docs, one).collect()} == {"en", "und"}


def test_language_sample_bound_and_partitions(told):
    whole, again = language_id.train(told, F.lit(True)), language_id.train(told.repartition(9), F.lit(True))
    assert (whole.log == again.log).all() and (whole.uses == again.uses).all()
    part = language_id.train(told, F.lit(True), sample_docs=20)
    assert part.languages and not np.array_equal(part.log, whole.log)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = op12_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_a_very_long_text(spark, told):
    text = "the water of this river und der stein über " * 500_000
    assert len(text.encode()) > 20 << 20
    got = language_id.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), language_id.train(told, F.lit(True))).selectExpr("lang_pred", "size(spans) n").first()
    assert got["lang_pred"] == "en" and got["n"] == 1_000_000


def test_letters_and_scripts():
    kind, low = language_id.tables()
    for c in map(chr, range(0x3000)):
        assert (kind[ord(c)] < language_id._MARK) == c.isalpha()
    names = list(language_id.SCRIPTS)
    assert [names[kind[ord(c)]] for c in "aéбαשع한カ漢"] == ["latin", "latin", "cyrillic", "greek", "hebrew", "arabic", "hangul", "kana", "han"]
    assert low[ord("É")] == ord("é")


# ---- whitening -------------------------------------------------------------------------


def brute_whiten(vectors, components, one=False):
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for v in vectors], object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), object) if one else x
    n, s = len(fit), fit.sum(axis=0)
    deviation = [sum((n * v - t) ** 2 for v, t in zip(row, s)) for row in x.tolist()]
    centre = (np.array([[n * v - t for v, t in zip(row, s)] for row in fit.tolist()], float)) / n
    value, vector = np.linalg.eigh(centre.T @ centre / n)
    value, vector = value[::-1], vector[:, ::-1]
    good = min(components, int((value > 1e-10 * value[0]).sum()))
    z = np.array([[n * v - t for v, t in zip(row, s)] for row in x.tolist()], float) / n
    return n, deviation, z @ vector[:, :good] / np.sqrt(value[:good]), value[:good] / value.sum()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    base = (rng.normal(0, 1, (300, 6)) @ rng.normal(0, 0.3, (6, 6))).astype(np.float32)
    return np.concatenate([base, np.repeat(base[:1], 150, axis=0), base[5:9]])  # a vector of a third of all rows


@pytest.mark.parametrize("one", [False, True])
def test_whitening_equals_brute_force(spark, vectors, one):
    rows = [(k, [float(c) for c in v], "x") for k, v in enumerate(vectors)]
    bad = [(-1, None, "x"), (-2, [], "x"), (-3, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (-4, [float("nan")] * 6, "x"), (-5, [float("inf")] + [0.0] * 5, "x"), (None, rows[3][1], "x")]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, n string").repartition(7)
    got = whitening.whiten(table, 4, weights="one" if one else "counts").collect()
    fitted = [r[1] for r in rows] + [rows[3][1]]
    n, deviation, white, explained = brute_whiten(np.array(fitted, np.float32).astype(float).tolist(), 4, one)
    assert len(got) == len(fitted) and {r["n"] for r in got} == {n}
    by = {r["vec_id"]: r for r in got}
    own = np.array([by[k]["white"] for k in range(len(rows))])
    sign = np.sign((own * white[:-1]).sum(axis=0))
    assert np.allclose(own * sign, white[:-1], atol=1e-9)
    assert [by[k]["deviation"] for k in range(len(rows))] == [Decimal(d) for d in deviation[:-1]]
    assert by[None]["white"] == by[3]["white"]
    assert np.allclose(by[0]["explained"], explained, rtol=1e-9) and by[0]["identity_error"] < 1e-9


def test_whitening_without_directions(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)]):
        got = whitening.whiten(spark.createDataFrame(rows, schema), 4)
        assert got.count() == 0 and "white" in got.columns
    flat = spark.createDataFrame([(k, [float(k % 5), 7.0, 2.0 * (k % 5)]) for k in range(40)], schema)
    got = whitening.whiten(flat, 4).collect()
    assert len(got) == 40 and {len(r["white"]) for r in got} == {1} and got[0]["identity_error"] < 1e-4
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema), 2)
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(flat, 2, weights="rows")


def test_whitening_common_vectors_are_broadcast(spark, vectors):
    rows = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    points = whitening.points(rows)
    distinct = whitening.distinct_vectors(points)
    assert distinct.count() == len({tuple(np.floor(64 * v.astype(float))) for v in vectors})
    plan = whitening._joined(points, distinct)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "strategy=merge" in plan


def test_whitening_deviation_beyond_a_long():
    model = whitening.Fit(10**12, [10**12 * 5 + 7, 3], np.zeros((2, 0)), np.zeros(0))
    x = np.array([[10**6, 1], [5, 0]], np.int64)
    assert model.deviations(x) == [(10**18 - 5 * 10**12 - 7) ** 2 + (10**12 - 3) ** 2, 49 + 9]


def test_new_queries_run_on_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert op12_language_id(spark, sf).count() == docs.count()
    rows = op11_whitening(spark, sf).collect()
    assert {r["component"] for r in rows} == set(range(1, 33)) and rows[0]["identity_error"] < 1e-4
    assert {r["rank"] for r in op13_ranked_search(spark, sf).collect()} <= set(range(1, 11))
    held = op12_language_id(spark, sf).where("held_out").select("doc_id").collect()
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in docs.where(fold(5) == 0).collect()}
