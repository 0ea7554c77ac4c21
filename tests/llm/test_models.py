"""Fitted operators: held-out accuracy, probabilities that sum to one, and exact parts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterfold.llm import line_crf, suffix_lm, toxicity
from clusterfold.llm.labelled import sample
from clusterfold.llm import words as W
from clusterfold.llm.queries import QUERIES, fold

from .conftest import LOWER

SF = "/root/testdata/sf0.01"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def held(i, n, k):
    return i is not None and zlib.crc32(str(i).encode()) % n == k


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize("name, label, n, k, least", [("op6_line_crf", "quality", 3, 1, 0.95), ("op10_toxicity", "toxic", 5, 0, 0.9)])
def test_held_out_accuracy(spark, labels, name, label, n, k, least):
    found = QUERIES[name](spark, SF).collect()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = total = 0
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == held(r["doc_id"], n, k)
        if r["held_out"] and r["doc_id"] in labels:
            total += 1
            right += labels[r["doc_id"]][label] == r["predicted"]
    assert total > 50 and right / total >= least


def test_language_model_baseline_is_exact_and_beaten(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts, texts = Counter(), {}
    for r in docs.collect():
        texts[r["doc_id"]] = [*SPACED.findall((r["text"] or "").translate(LOWER)), None]
        if not held(r["doc_id"], 7, 2):
            counts.update(texts[r["doc_id"]])
    n, v = sum(counts.values()), len(counts)
    base = score = 0.0
    for r in QUERIES["op5_suffix_lm"](spark, SF).collect():
        own = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(w in counts for w in own), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r["score"] <= 0
        if r["held_out"]:
            base, score = base + r["base_score"], score + r["score"]
    assert score > base


def test_language_model_states_sum_to_one(spark):
    text = "a b c a b d a b c x y a b c " * 40
    docs = spark.createDataFrame([(i, text + f"w{i}") for i in range(20)] + [(99, None), (100, "")], "doc_id long, text string")
    trees = []
    keep = suffix_lm._grow

    def grow(*args):
        trees.append(keep(*args))
        return trees[-1]

    suffix_lm._grow = grow
    try:
        found = {r["doc_id"]: r for r in suffix_lm.fit_and_score(docs, F.col("doc_id") < 98).collect()}
    finally:
        suffix_lm._grow = keep
    tree = trees[0]
    assert len(tree.levels) >= 2  # "c" or "d" after "a b" needs two words
    words = sorted({w for i in range(20) for w in [*"abcdxy", f"w{i}"]})
    joined = np.frombuffer("\n".join(words).encode(), np.uint8)
    scanned = W.scan(joined, np.array([0, len(joined)]), W.SPACED)
    key = dict(zip(words, W.word_hashes(joined, scanned)))
    counts = Counter(w for i in range(20) for w in f"{text}w{i}".split())
    for context in (["a"], ["a", "b"], ["b", "c"], ["x", "y", "a"], ["w0"], []):
        after = [*(key[w] for w in words), suffix_lm.END, W.U64(12345)]
        n = [*(counts[w] for w in words), 20, 0]
        total = 0.0
        for x, c in zip(after, n):
            data = np.array([suffix_lm.START] * 3 + [key[w] for w in context] + [x], W.U64)
            total += tree.probability(data, np.array([len(data) - 1]), np.array([c]))[0]
        assert math.isclose(total, 1.0, rel_tol=1e-9)
    assert found[99]["score"] == found[100]["score"] and found[99]["n_tokens"] == 1


def brute_scores(texts, trained, depth=3, least=2):
    """Log10 scores of word lists by the same rules, in dictionaries over all n-grams."""
    padded = [["<s>"] * depth + t + ["</s>"] for t in texts]
    ones = Counter(w for t, ok in zip(padded, trained) if ok for w in t[depth:])
    n = sum(ones.values())
    once, twice = (sum(v == k for v in ones.values()) for k in (1, 2))
    d = once / (once + 2 * twice)
    states = [{} for _ in range(depth + 1)]  # context -> (followers, left, passed)
    total = {(w,): k for w, k in ones.items()} | {("<s>",): sum(trained)}

    def probability(context, x, retained=None):
        p = (ones[x] - d if x in ones else d * len(ones)) / n
        for k in range(1, len(context) + 1):
            c = tuple(context[len(context) - k :])
            if c not in states[k] or retained is not None and c not in retained:
                break
            own, _ = states[k][c]
            kept = sum(own.values())
            p = (own.get(x, 0) + len(own) * p) / (kept + len(own))
        return p

    passed = set()
    for k in range(1, depth + 1):
        seen = {}
        for t, ok in zip(padded, trained):
            for i in range(depth, len(t)) if ok else ():
                c = tuple(t[i - k : i])
                if total.get(c, 0) >= least:
                    seen.setdefault(c, Counter())[t[i]] += 1
        following = {}
        for c, every in seen.items():
            own = {x: v for x, v in every.items() if v >= least}
            following |= {(*c, x): v for x, v in own.items()}
            if not own:
                continue
            before = {x: probability(c[1:], x) for x in own}
            rest, free = total[c] - sum(own.values()), 1 - sum(before.values())
            gain = sum(v * math.log(v / total[c] / before[x]) for x, v in own.items()) + (rest * math.log(rest / total[c] / free) if rest > 0 and free > 0 else 0)
            states[k][c] = own, total[c]
            if gain > len(own) / 2 * math.log(total[c]):
                passed |= {c[j:] for j in range(k)}
        total = following
    return [sum(math.log10(probability(t[i - depth : i], t[i], passed)) for i in range(depth, len(t))) for t in padded], passed


def test_language_model_keeps_rare_contexts_of_a_large_corpus(spark, monkeypatch):
    """Scores of brute force, over several chunks and buckets; most contexts stand at under 1e-4 of the positions."""
    monkeypatch.setattr(suffix_lm.C, "BUCKET_KEYS", 3000)
    rng = np.random.default_rng(1)
    names = [f"w{k}" for k in range(3000)]
    phrases = [rng.choice(names, 6).tolist() for _ in range(1500)]
    texts = [sum((phrases[k] for k in rng.integers(0, 1500, 40)), []) + rng.choice(names, 20).tolist() for _ in range(300)] + [[], ["w1"]]
    trained = [i % 7 != 2 for i in range(len(texts))]
    want, passed = brute_scores(texts, trained)
    total = Counter(w for t, ok in zip(texts, trained) if ok for w in t)
    assert sum(len(c) == 1 and total[c[0]] < 1e-4 * total.total() * 3 for c in passed) > 100
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["score"] for r in suffix_lm.fit_and_score(docs, F.col("doc_id") % 7 != 2).collect()}
    assert np.allclose([found[i] for i in range(len(texts))], want, rtol=1e-9)


def test_language_model_without_training(spark, no_docs, edge_docs):
    assert suffix_lm.fit_and_score(no_docs, F.lit(True)).count() == 0
    found = suffix_lm.fit_and_score(edge_docs, F.lit(False)).collect()
    assert len(found) == edge_docs.count()
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["train_tokens"] == 0 for r in found)


def test_keys_that_differ_in_low_bits_only_are_ordered():
    keys = np.array([7, 3, 1 << 63, 3, 2, (1 << 63) + 1, 0], W.U64)
    order, ascending = suffix_lm._ordered(keys)
    assert ascending.tolist() == sorted(keys.tolist()) and keys[order].tolist() == ascending.tolist()
    distinct, place, of = suffix_lm._distinct(keys)
    assert distinct.tolist() == sorted(set(keys.tolist())) and (distinct[of] == keys).all() and (keys[place] == distinct).all()
    assert [len(x) for x in suffix_lm._distinct(keys[:0])] == [0, 0, 0]


def test_a_pass_derives_only_what_its_messages_need(spark):
    """The pass that sends suffixes sorts no pairs of the longest contexts."""
    def row(replies):
        none = np.zeros(0, np.int64).tobytes()
        return {"chunk": 0, "ids": none, "nulls": none, "marks": none, "counts": none, "replies": replies,
                "words": suffix_lm._squeezed(np.zeros(0, np.int64)), "places": suffix_lm._squeezed(np.zeros(0, np.int64))}

    root = suffix_lm.Root(0, 0, 0.5, 0)
    for done in range(1, suffix_lm.DEPTH + 4):
        own = suffix_lm.Positions(suffix_lm.Tokens(row([[] for _ in range(done)])), root, 1, 1)
        last = own.depths[-1]
        assert (last.pairs is None) == (done == suffix_lm.DEPTH + 2)
        assert (last.trained is not None) == (done <= suffix_lm.DEPTH)



def brute_marginals(emit, moves):
    """Sum over all labellings."""
    n = len(emit)
    good, whole = np.zeros(n), 0.0
    for code in range(1 << n):
        y = [code >> t & 1 for t in range(n)]
        weight = math.exp(sum(emit[t] * y[t] for t in range(n)) + sum(moves[y[t - 1], y[t]] for t in range(1, n)))
        whole += weight
        good += weight * np.array(y)
    return good / whole, math.log(whole)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    sizes = [3, 1, 7, 5]
    first = np.concatenate([[0], np.cumsum(sizes)])
    emit, moves = rng.normal(size=first[-1]), rng.normal(size=(2, 2))
    good, pairs, whole = line_crf.forward_backward(emit, first, moves)
    for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
        want, log_whole = brute_marginals(emit[a:b], moves)
        assert np.allclose(good[a:b], want) and math.isclose(whole[k], log_whole)
    assert math.isclose(pairs.sum(), sum(sizes) - len(sizes))


def test_line_features_do_not_depend_on_the_block():
    texts = ["", "a b a\n\na b a\nTHE END!!", "one", "", "x | y # z\n", "\n"]
    alone = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        features, weights, first = line_crf.line_features(data, np.array([0, len(data)]))
        assert len(features) == t.count("\n") + 1 and first.tolist() == [0, len(features)]
        alone.append(features)
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    assert np.allclose(line_crf.line_features(raw, offsets)[0], np.concatenate(alone))


def test_classifier_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(7, 1, 1), (8, 1, 1), (None, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    for labels, want in ((none, 0.5), (one, 1.0)):
        chain = line_crf.train(edge_docs, labels, F.lit(True))
        found = line_crf.score(edge_docs, chain)
        scores = [r["score"] for r in found.collect()]
        assert len(scores) == edge_docs.count() and np.allclose(scores, want)
        assert found.select("row.*").columns == edge_docs.columns
        index = toxicity.train(edge_docs, labels, F.lit(True))
        assert np.allclose([r["score"] for r in toxicity.score(edge_docs, index).collect()], want)
        assert line_crf.score(no_docs, chain).count() == 0 and toxicity.score(no_docs, index).count() == 0


def test_nearest_examples_are_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    rng = np.random.default_rng(9)
    n_terms, n = 30, 90
    idf = rng.uniform(1, 4, n_terms)
    index = toxicity.Index(np.arange(n_terms, dtype=np.uint64), idf, np.arange(n), rng.integers(0, 2, n), np.ones(2), 0.1)

    def draw():
        term = np.sort(rng.choice(n_terms, rng.integers(0, 6), replace=False))
        return term, index.vector(term, rng.integers(1, 4, len(term)))

    vectors = [draw() for _ in range(n)]
    index.build(vectors)
    dense = np.zeros((n, n_terms))
    for i, (t, v) in enumerate(vectors):
        dense[i, t] = v
    for _ in range(200):
        term, value = draw()
        if not len(term):
            continue
        query = np.zeros(n_terms)
        query[term] = value
        cosine = dense @ query
        want = sorted(cosine[cosine > 0], reverse=True)[: toxicity.K]
        examples, got = index.nearest(term, value)
        assert np.allclose(got, want) and np.allclose(cosine[examples], got)


def test_every_training_text_finds_itself(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    index = toxicity.train(docs, labels, F.lit(True))
    ids = set(index.ids.tolist())
    own = docs.where(F.col("doc_id").isin(list(ids)) & (F.length(F.trim("text")) > 0))
    again = own.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    found = toxicity.score(again, index).collect()
    copies = {}  # equal texts may stand for each other
    for r in own.collect():
        copies.setdefault(r["text"], set()).add(r["doc_id"])
    text = {r["doc_id"] + 1_000_000: r["text"] for r in own.collect()}
    assert len(found) > 100
    for r in found:
        best = [e for e in r["evidence"] if e["cosine"] > 1 - 1e-9]
        assert best and ({e["doc_id"] for e in best} & copies[text[r["doc_id"]]] or len(best) == toxicity.K)
    assert len({r["score"] for r in found}) > 20  # not one score for all that lack a telling term


def test_telling_terms_by_hand():
    gain = toxicity.tells(np.array([50, 0, 3, 100]), np.array([48, 40, 0, 0]), 100, 100)
    assert gain[0] == 0 and gain[2] == 0 and gain[1] > 30 and gain[3] > gain[1]
    data = "Añé ñandúes stupidity stupid".encode()
    raw = np.frombuffer(data, np.uint8)
    text, term, count = toxicity.term_counts(raw, np.array([0, len(raw)]))
    assert len(term) == 6 and sorted(count) == [1, 1, 1, 1, 1, 2]  # four words, two starts, one of them twice
    same = toxicity.term_counts(raw, np.array([0, len(raw)]), toxicity.Vocabulary(np.sort(term)))
    assert sorted(same[2]) == sorted(count)


def test_samples_are_bounded_by_bytes_not_by_length(spark):
    long = "a long line of text\n" * 60_000
    docs = spark.createDataFrame([(k, long if k == 3 else f"text {k} of it") for k in range(200)] + [(5, "again"), (5, "and again"), (7, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    whole = sample(docs, labels, "toxic", F.lit(True), 1000, 1 << 30).collect()
    assert len(whole) == 200 and {r["doc_id"]: r["text"] for r in whole}[5] == "again"
    assert {r["doc_id"]: r["text"] for r in whole}[3] == long
    few = sample(docs, labels, "toxic", F.lit(True), 1000, 2000).collect()
    assert 2 < len(few) < 30 and {r["y"] for r in few} == {0, 1}
    one = sample(docs, labels, "toxic", F.lit(True), 1000, 1).collect()
    assert len(one) == 2


def test_classifiers_on_a_very_long_text(spark):
    line = "the stone river " * 8
    docs = spark.createDataFrame([(k, f"{line} {'bad word here' if k % 2 else 'good text there'} {k}\n{line}") for k in range(60)] + [(60, f"{line}\n" * 165_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(60)], "doc_id long, quality int, toxic int")
    for found in (line_crf.score(docs, line_crf.train(docs, labels, F.lit(True))), toxicity.score(docs, toxicity.train(docs, labels, F.lit(True)))):
        scores = [r["score"] for r in found.collect()]
        assert len(scores) == 61 and all(0 <= s <= 1 for s in scores)


def test_toxicity_evidence(spark):
    found = QUERIES["op10_toxicity"](spark, SF).where("size(evidence) > 0").collect()
    assert found
    for r in found:
        cosines = [e["cosine"] for e in r["evidence"]]
        assert cosines == sorted(cosines, reverse=True) and all(0 < c <= 1 for c in cosines) and len(cosines) <= toxicity.K


def test_fold_is_the_text_crc(spark):
    rows = spark.range(50).select(F.col("id").alias("doc_id"), fold(7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 7 for r in rows)
