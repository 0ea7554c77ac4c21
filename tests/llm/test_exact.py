"""Operators with exact results, against brute force."""

import base64
import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from clusterfold.llm import bpe, decontam, licenses, line_templates, quality_rules, simhash, substrings
from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared
from clusterfold.llm.oracles import ORACLES

from .conftest import LOWER

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TABLES = ["edge_docs", "sf_docs"]


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=TABLES)
def docs(request):
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(docs, encoding):
    done = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    got = sorted((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in done)
    want = []
    for i, t in rows_of(docs):
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert got == sorted(want)


def test_bpe_long_pieces_and_any_bytes(encoding):
    vocabulary = bpe.Vocabulary(bpe.read_ranks(RANKS))
    rng = np.random.default_rng(3)
    pieces = [bytes(rng.integers(97, 101, n, dtype=np.uint8)) for n in [1, 2, 3, 7, 60, 128, 129, 500, 3000]]
    pieces += ["é".encode() * 90, b"a" * 1000, b"ab" * 64]
    for piece, tokens in zip(pieces, vocabulary.encode_pieces(pieces)):
        assert vocabulary.rank[tokens].tolist() == encoding._core_bpe.encode_single_piece(piece)
        assert vocabulary.decode_tokens(tokens).tobytes() == piece
    assert vocabulary.encode_pieces([]) == []


def brute_fingerprint(text, shingle=4):
    words = SPACED.findall((text or "").translate(LOWER))
    parts = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    if not parts:
        return 0
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """Smallest id reachable, for each (id, fingerprint)."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_fingerprints_and_components(docs):
    prints = {i: brute_fingerprint(t) for i, t in rows_of(docs)}
    want = brute_components(prints, 4)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["fp"] % (1 << 64) == prints[r["doc_id"]]
        assert r["component_id"] == want[r["doc_id"]]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(set(want.values()))


def test_simhash_tiles_find_every_link(spark, monkeypatch):
    """A hot group of near copies, many tiles a cell, and random fingerprints."""
    monkeypatch.setattr(simhash, "TILE", 7)
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 63))
    prints = {i: base ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for i in range(300)}
    prints |= {300 + i: int(rng.integers(0, 1 << 63)) for i in range(300)}
    prints |= {600 + i: (1 << i) - 1 for i in range(64)}  # a chain
    nodes = {}
    for i, p in prints.items():
        nodes.setdefault(p, i)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)), i) for p, i in nodes.items()], "fp long, node long")
    links = simhash.links(frame, 4).collect()
    by_node = {i: p for p, i in nodes.items()}
    assert all((by_node[r["a"]] ^ by_node[r["b"]]).bit_count() <= 4 for r in links)
    assert len(links) < 12 * len(nodes)  # far fewer than all pairs of the hot group
    want = brute_components(by_node, 4)
    got = {r["node"]: r["component"] for r in simhash.components(simhash.links(frame, 4)).collect()}
    assert {i: got.get(i, i) for i in by_node} == want


def test_simhash_null_ids_do_not_join_unlike_groups(spark):
    """Two documents without an id, each near another document, and a pair of null ids only."""
    rng = np.random.default_rng(3)

    def near_pair():
        while True:
            words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
            a, b = " ".join(words), " ".join([*words[:-1], "changed"])
            if 1 <= (brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() <= 4:
                return a, b

    (a, a2), (b, b2), (c, c2) = near_pair(), near_pair(), near_pair()
    docs = spark.createDataFrame([(5, a), (None, a2), (7, b), (None, b2), (None, c), (None, c2)], "doc_id long, text string")
    prints = {t: brute_fingerprint(t) for t in (a, a2, b, b2, c, c2)}
    assert min((prints[x] ^ prints[y]).bit_count() for x, y in ((a, b), (a, c), (b, c))) > 12
    got = {r["fp"] % (1 << 64): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got == {prints[a]: 5, prints[a2]: 5, prints[b]: 7, prints[b2]: 7, prints[c]: None, prints[c2]: None}
    kept = rows_of(simhash.keep_first(docs))
    assert len(kept) == 3 and {(5, a), (7, b)} < set(kept) and {t for i, t in kept if i is None} < {c, c2}


def test_first_links_keep_components():
    rng = np.random.default_rng(11)
    for density in (0.01, 0.1, 0.6):
        near = rng.random((40, 55)) < density
        i, j = simhash._first_links(near)
        assert near[i, j].all()

        def groups(pairs):
            forest = simhash._Forest()
            for a, b in pairs:
                forest.join(int(a), 1000 + int(b))
            return {x: forest.root(x) for x in forest.parent}

        assert groups(zip(i, j)) == groups(zip(*np.nonzero(near)))


def test_decontamination(spark, docs):
    texts = rows_of(docs)
    long_text = next(t for _, t in texts if t and len(ALNUM.findall(t.translate(LOWER))) > 40)
    part = " ".join(ALNUM.findall(long_text.translate(LOWER))[5:25])
    items = [(1, part), (10, part + " further"), (2, "one"), (3, None), (4, ""), (5, "never, seen; anywhere else"), (None, "one"), (1, part)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_decontam(texts, [(i, t) for i, t in items if i is not None])
    got = decontam.scan(docs, bench)
    assert sorted_rows(got) == sorted(want, key=repr)
    clean = decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[2] for w in want)
    cut = decontam.remove_spans(docs, bench)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    left = {(i, len(ALNUM.findall((t or "").translate(LOWER)))) for i, t in rows_of(cut)}
    assert left <= {(i, n - sum(b - a for a, b in spans) + 0) for i, n, spans, _ in want} | {(i, n - sum(b - a for a, b in spans) - k) for i, n, spans, _ in want for k in range(1, 3)}


def test_decontamination_in_blocks(spark, sf_docs, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = sorted_rows(decontam.scan(sf_docs, bench))
    monkeypatch.setattr(decontam, "BLOCK_WINDOWS", 300)
    assert sorted_rows(decontam.scan(sf_docs, bench)) == want
    assert any(w[2] for w in want)


def sorted_rows(found):
    return sorted(((r["row"]["doc_id"], r["n_words"], tuple((s["start"], s["end"]) for s in r["spans"]), tuple(r["items"])) for r in found.collect()), key=repr)


def brute_decontam(texts, items, size=10):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    out = []
    for i, t in texts:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((i, len(w), ranges(hit), tuple(sorted(found))))
    return out


def ranges(places):
    out = []
    for k in sorted(places):
        if out and out[-1][1] == k:
            out[-1][1] = k + 1
        else:
            out.append([k, k + 1])
    return tuple(map(tuple, out))


def test_substrings(docs):
    texts = rows_of(docs)
    first = {}
    windows = {}
    for k, (i, t) in enumerate(texts):
        w = SPACED.findall(t or "")
        windows[k] = w
        for s in range(len(w) - 12):
            key = tuple(w[s : s + 13])
            first[key] = min(first.get(key, i), i)
    want = []
    for k, (i, _) in enumerate(texts):
        w = windows[k]
        gone = {x for s in range(len(w) - 12) if first[tuple(w[s : s + 13])] < i for x in range(s, s + 13)}
        want.append((i, len(w), len(gone), ranges(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], tuple((s["start"], s["end"]) for s in r["spans"]), r["kept_text"]) for r in substrings.dedup(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 0


def test_substrings_null_ids_and_buckets(spark, monkeypatch):
    from clusterfold.llm import chunks

    monkeypatch.setattr(chunks, "BUCKET_KEYS", 20)
    shared = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(None, "pre " + shared), (5, shared), (9, shared + " post"), (None, shared)], "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["kept_text"], r["n_removed"]) for r in substrings.dedup(docs).collect()}
    assert got == {(5, shared, 0), (9, "post", 30), (None, "pre", 30), (None, "", 30)}


def test_quality_counts(docs):
    got = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality_rules.metrics(docs).collect()}
    want = set()
    for i, t in rows_of(docs):
        w = SPACED.findall(t or "")
        at = defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k : k + 8])].append(k)
        cover = {x for v in at.values() if len(v) > 1 for k in v for x in range(k, k + 8)}
        lines = [x for x in (t or "").split("\n") if SPACED.search(x)]
        want.add((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w)))
    assert got == want


def test_quality_fences_follow_their_group(spark):
    rows = [(i, "word " * 5 + f"w{i} and some other plain words that are long enough for the rule to see here ok", "en", "a") for i in range(150)]
    rows += [(500 + i, f"q{i} | x | y | z | # $ % & a b c d e f g h i j k l m n o p", "en", "tables") for i in range(150)]
    rows += [(900, "plain words " + " ".join(f"#{k}#" for k in range(30)) + " and more plain words that follow the marks in the text here now", "en", "a"), (901, None, None, None)]
    found = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(found[i]["kept"] for i in range(150))
    assert all(found[500 + i]["kept"] for i in range(150))  # symbols are usual there
    assert not found[900]["base_failed"] and not found[900]["kept"]
    assert found[901]["base_failed"] and not found[901]["kept"]


def test_quality_judges_every_row(docs):
    found = quality_rules.judge(docs)
    assert found.count() == docs.count()
    assert found.where("kept is null or (base_failed and kept)").count() == 0


def test_license_base_places(docs):
    got = {(r["row"]["doc_id"], r["n_words"], tuple((p["start"], p["label"]) for p in r["places"])) for r in licenses.scan(docs).collect()}
    want = set()
    for i, t in rows_of(docs):
        w = ALNUM.findall((t or "").translate(LOWER))
        places = [(k, label) for k in range(len(w)) for p, label in licenses.BASE if w[k : k + len(p.split())] == p.split()]
        want.add((i, len(w), tuple(places)))
    assert got == want


LICENSE_CASES = [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0", "other-license"}),
    ("SPDX-License-Identifier: GPL-3.0-or-later", {"gpl-3.0"}),
    ("under the GNU Lesser General Public License version 2.1 only", {"lgpl-2.1"}),
    ("see https://creativecommons.org/licenses/by-nc/4.0/ for terms", {"cc-by-nc-4.0"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0", "other-license"}),
    ("All rights reserved.", {"proprietary"}),
    ("the 3-clause BSD license", {"bsd-3", "bsd"}),
    ("nothing to see", set()),
]


def test_license_rules(spark):
    assert 200 <= len(licenses.rules()) <= 600
    assert [r[2] for r in licenses.rules()] == sorted(r[2] for r in licenses.rules())
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LICENSE_CASES)], "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        assert {d["label"] for d in r["detections"]} == LICENSE_CASES[r["row"]["doc_id"]][1], r
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["detections"])


def test_license_rules_against_python_regexes(docs):
    """Every rule's matches, found by Python on every line, after the same suppression."""
    table = licenses.rules()
    compiled = [re.compile(p) for *_, p in table]
    for r in licenses.scan(docs).select("row.text", "detections").collect():
        found = []
        for at, line in enumerate((r["text"] or "").lower().split("\n")):
            for k, rule in enumerate(compiled):
                found += [(at, m.start(), m.end(), table[k][2], table[k][0], k) for m in rule.finditer(line)]

        def loses(d):
            return any(e[0] == d[0] and e[1] <= d[1] and e[2] >= d[2] and (e[3] < d[3] or e[3] == d[3] and (e[2] - e[1] > d[2] - d[1] or e[5] < d[5])) for e in found)

        assert {tuple(d) for d in r["detections"]} == {d for d in found if not loses(d)}


def test_license_lines_of_a_long_text(spark):
    """Each line of a text is judged by itself, as it would be alone."""
    line = "GNU General Public License version 2.0, or the MIT license; Apache License 2.0"
    docs = spark.createDataFrame([(1, line), (2, "\n".join([line] * 5000))], "doc_id long, text string")
    found = {r["row"]["doc_id"]: [tuple(d) for d in r["detections"]] for r in licenses.scan(docs).collect()}
    assert len(found[1]) >= 3
    assert found[2] == [(at, *d[1:]) for at in range(5000) for d in found[1]]


def brute_lines(texts, min_docs=3, share=0.7, rounds=3):
    parsed, leaves = {}, defaultdict(list)
    for k, (i, t) in enumerate(texts):
        for pos, line in enumerate(t.split("\n") if t is not None else []):
            line = re.sub(r"[ \t\x0b\f\r]+", " ", re.sub(r"[^ \t\x0b\f\r]*[0-9][^ \t\x0b\f\r]*", "<*>", line)).strip(" ")
            if line:
                tokens = line.split(" ")
                parsed[k, pos] = (len(tokens), *tokens[:3]), line
                leaves[len(tokens), *tokens[:3]].append((i, line))
    general = {}
    for leaf, own in leaves.items():
        rest = {line for _, line in own}
        if len({i for i, _ in own}) < min_docs or len(rest) < 2:
            continue
        for r in range(rounds):
            columns = list(zip(*(line.split(" ") for line in rest)))
            shape = [min(set(c), key=lambda token: (-c.count(token), token.encode())) for c in columns]
            agree = {line for line in rest if sum(a == b for a, b in zip(line.split(" "), shape)) >= share * leaf[0]}
            general.update((line, (r, leaf)) for line in agree)
            rest -= agree
    ids = defaultdict(set)
    name = {at: general.get(line, line) for at, (leaf, line) in parsed.items()}
    for (k, _), template in name.items():
        ids[template].add(texts[k][0])
    out = []
    for k, (i, t) in enumerate(texts):
        if t is None:
            out.append((i, 0, 0, None))
            continue
        lines = t.split("\n")
        gone = {pos for pos in range(len(lines)) if (k, pos) in name and len(ids[name[k, pos]]) >= min_docs and min(ids[name[k, pos]]) < i}
        out.append((i, len(lines), len(gone), "\n".join(x for pos, x in enumerate(lines) if pos not in gone)))
    return out


def test_line_templates(docs):
    got = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_templates.drop_recurring(docs).collect()]
    want = brute_lines(rows_of(docs))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 0
    cleaned = line_templates.cleaned(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()


def test_line_templates_generalise_variable_fields(spark):
    names = ["ann", "bob", "cid", "dee"]
    rows = [(i, f"the user named {n} has logged in from the main office today\nown text {n} of its own kind {n}{n}") for i, n in enumerate(names)]
    found = {r["row"]["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 1}


def brute_kept(rows):
    """Verdicts from sorted buckets, one document after the other."""
    def bucket(a, b):
        k = 1000 * a // b
        shift = max(0, k.bit_length() - 12)
        return k >> shift << shift

    def quartile(values, q):
        return sorted(values)[-(-len(values) * q // 4) - 1] / 1000.0

    good = [r for r in rows if not r["base_failed"]]
    names = {m: v for m, v in quality_rules.METRICS.items()}
    levels = [defaultdict(list), defaultdict(list), defaultdict(list)]
    for r in good:
        for m, (a, b, *_) in names.items():
            for level, key in zip(levels, ((r["lang"], r["source"]), r["lang"], 0)):
                level[key, m].append(bucket(r[a], r[b]))
    out = {}
    for r in rows:
        kept = not r["base_failed"]
        for m, (a, b, floor, below, above) in names.items():
            if not kept:
                break
            own, lang, every = levels[0][(r["lang"], r["source"]), m], levels[1][r["lang"], m], levels[2][0, m]
            values = own if len(own) >= quality_rules.MIN_GROUP else lang if len(lang) >= quality_rules.MIN_GROUP else every
            q1, q3 = quartile(values, 1), quartile(values, 3)
            spread, value = quality_rules.FENCE * max(q3 - q1, floor), r[a] / r[b]
            kept = kept and not (below and value < q1 - spread) and not (above and value > q3 + spread)
        out[r["doc_id"]] = kept
    return out


def test_quality_verdicts_in_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    # null groups, small groups, ties and repeated rows among them
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 9 != 0, F.col("lang"))).withColumn("source", F.when(F.col("doc_id") % 4 != 0, F.col("source")))
    docs = docs.unionAll(docs.where("doc_id < 30").withColumn("doc_id", F.col("doc_id") + 10_000)).persist()
    want = None
    for parts in (1, 3, 24):
        rows = quality_rules.judge(docs.repartition(parts)).collect()
        fences = {r["doc_id"]: tuple(r[c] for c in r.__fields__ if c.endswith(("_low", "_high"))) for r in rows}
        if want is None:
            want = brute_kept([r.asDict() for r in rows]), fences
        assert {r["doc_id"]: r["kept"] for r in rows} == want[0] and fences == want[1]
    assert 0 < sum(want[0].values()) < len(want[0])


def test_quality_buckets_are_exact_and_bounded(spark):
    counts = [(0, 7), (1, 3), (2, 3), (4095, 1000), (4097, 1000), (10**7, 3), (10**12, 1)]
    got = [r["k"] for r in spark.createDataFrame(counts, "a long, b long").select(quality_rules.bucket("a", "b").alias("k")).collect()]
    for (a, b), k in zip(counts, got):
        exact = 1000 * a // b
        assert k <= exact and exact - k <= exact >> 11 and (exact >= 4096 or k == exact)


def notices(n, words, start=0):
    """Near copies of one line, each with one word of its own."""
    return [(start + k, " ".join([*words[:5], f"word{chr(97 + k % 26)}{'x' * (k // 26)}", *words[6:]]) + f"\nown line {chr(97 + k % 26) * (3 + k)}") for k in range(n)]


def test_line_templates_judge_lines_by_their_own_template(spark):
    words = "please read the new terms of use before you go on to the page".split()
    rows = notices(60, words)
    drop = lambda r: {x["row"]["doc_id"]: x["n_dropped"] for x in line_templates.drop_recurring(spark.createDataFrame(r, "doc_id long, text string")).collect()}
    plain = drop(rows)
    assert sum(plain.values()) == 59 and plain[0] == 0
    # unrelated lines of the leaf change nothing for the notices
    other = "please read the " + " ".join(f"thing{c}" for c in "abcdefghijk")
    assert len(other.split()) == len(words)
    more = drop(rows + [(900, other)])
    assert {k: v for k, v in more.items() if k != 900} == plain and more[900] == 0
    # a second family of the leaf is a template of its own
    second = "please read the old rules about our small shop while it is still open".split()
    assert len(second) == len(words)
    both = drop(rows + notices(20, second, 300))
    assert sum(both.values()) == 59 + 19 and both[0] == both[300] == 0
    want = {i: n for i, _, n, _ in brute_lines(rows + notices(20, second, 300))}
    assert both == want


def test_line_templates_of_a_leaf_with_many_families(spark):
    """More families in one leaf than rounds of votes, of equal and of different sizes."""
    families = [["please", "read", "the", *(f"{'abcdefgh'[f]}{'qrstuvwxyz'[k]}" for k in range(10))] for f in range(8)]
    rows = [(i, text.split("\n")[0]) for f, words in enumerate(families) for i, text in notices(6 if f < 5 else 4 + f, words, 100 * f)]
    rows += [(2000 + k, "please read the " + " ".join(f"{c}{'xyz'[k]}" for c in "abcdefghij")) for k in range(3)]  # unrelated lines
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["row"]["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring(table).collect()}
    assert found == {i: int(i < 2000 and i % 100 > 0) for i, _ in rows}
    with duckdb.connect() as con:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        assert {i: dropped for i, _, dropped, _ in con.execute(ORACLES["op3_line_templates"]).fetchall()} == found


def test_line_templates_of_mixed_leaves_equal_the_sql(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join("go on to " + " ".join(rng.choice("ab" if k % 3 else "cdefgh") for k in range(rng.choice((7, 12)))) for _ in range(4))) for i in range(150)]
    own = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in line_templates.drop_recurring(own).collect()}
    with duckdb.connect() as con:
        con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
        assert set(con.execute(ORACLES["op3_line_templates"]).fetchall()) == found


def test_line_templates_of_a_long_text(spark):
    words = "please read the new terms of use before you go on to the page".split()
    long = "\n".join(f"line {'abcdefghij'[k % 10]} of {'xyz'[k % 3] * (1 + k % 50)} stands here for some reason" for k in range(420_000))
    assert len(long) > 20 << 20
    rows = notices(5, words) + [(77, long), (78, None), (79, "")]
    found = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("row.doc_id", "n_lines", "n_dropped").collect()}
    assert found[77] == (420_000, 0) and found[78] == (0, 0) and found[79] == (1, 0) and found[4] == (2, 1)


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert bpe.decode(bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0
    assert line_templates.drop_recurring(no_docs).count() == 0
    assert quality_rules.judge(no_docs).count() == 0
    assert decontam.scan(no_docs, bench).count() == 0
    assert licenses.scan(no_docs).count() == 0
    assert substrings.dedup(no_docs).count() == 0


def test_empty_benchmark_hits_nothing(spark, sf_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan(sf_docs, bench).where(F.size("spans") > 0).count() == 0


def test_bpe_workers_hold_little(spark, edge_docs, encoding):
    """Encoders and decoders never share a stage of the pipeline, the sent
    vocabulary is small, and results leave a worker in small batches."""
    stages = dict(corpus_pipeline.STAGES)
    plan = stages["byte-level BPE"](spark, edge_docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    vocabulary = bpe.Vocabulary(bpe.read_ranks(RANKS))
    assert "pairs" not in vars(vocabulary)
    shared = Shared(spark, vocabulary)
    assert len(shared._sent.value) < len(cloudpickle.dumps(vocabulary)) / 3
    assert shared.value.decode_tokens(np.arange(300)).tobytes() == vocabulary.decode_tokens(np.arange(300)).tobytes()
    texts = ["many words of a text " * 3000] * 50
    batch = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = list(bpe._encoder(shared, public_tokenizers.PATTERN)(iter([batch])))
    assert len(out) > 1 and [i for b in out for i in b.column(0).to_pylist()] == list(range(50))
    assert {x for b in out for x in b.column(2).to_pylist()} == {np.array(encoding.encode_ordinary(texts[0]), "<u4").tobytes()}


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    text = b"one two  three " + b"x" * 300 + b" one\ntwo " + b"word " * 100
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    words = W.scan(data, offsets, W.SPACED)
    whole = W.word_hashes(data, words)
    monkeypatch.setattr(W, "HASHED_BYTES", 7)
    assert W.word_hashes(data, words).tolist() == whole.tolist()
    assert whole[0] == whole[4] and whole[1] == whole[5] and len(set(whole.tolist())) == 5
    assert len(W.word_hashes(data[:0], W.scan(data[:0], offsets[:1], W.SPACED))) == 0
