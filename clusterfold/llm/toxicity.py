"""Toxicity by nearest labelled examples.

Terms are words (ASCII letters lower-cased, digits, non-ASCII characters) and
the starts of longer words (``PREFIX`` characters).  The labelled examples
are a bounded sample (``SAMPLE_PER_CLASS`` rows and ``SAMPLE_BYTES`` of each
class at most); all of their terms form the vocabulary, whose document
frequencies are counted over all documents.  A text's vector is its TF-IDF,
where a term counts the more the better it tells the classes apart: its weight
is the IDF times one plus the excess of its likelihood-ratio statistic over
chance (``NO_GAIN``), so that no term is left out, and a text that has none of
the telling ones is still compared by its other words.  The examples' vectors,
ordered so that similar ones lie together, form an inverted index with the
largest weight of each term in each block of ``BLOCK`` examples; a query visits
blocks in the order of their upper bounds and stops when no block can hold a
nearer example, so the ``K`` nearest by cosine are exact.  Votes are weighted
by distance, corrected for the sample's class shares, and calibrated by
isotonic regression on the examples' own leave-one-out votes.

Defined results: a null or empty text, or one that shares no term with any
example, gets the calibrated share of toxic examples among those without a
term; repeated rows are scored each; with labels of one class only, or none,
every score is that class (or 0.5).  Ties of equal similarity go to the smaller
example number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared, texts
from clusterfold.llm.labelled import sample

SAMPLE_PER_CLASS = 800
SAMPLE_BYTES = 16 << 20  # of each class; a line counts as 256 more
MIN_DOCS, NO_GAIN, MIN_LIFT = 5, 16.0, 3.0  # a term of fewer examples, or that tells less, has its plain IDF
PREFIX = 5
K, BLOCK = 15, 64

EVIDENCE = "array<struct<doc_id:long,cosine:double,toxic:int>>"


def _heads(low: np.ndarray, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(which words are longer than ``PREFIX`` characters, their first ones' end)."""
    lead = np.flatnonzero((low & 0xC0) != 0x80)  # a character's first byte
    first = np.searchsorted(lead, words.starts)
    longer = np.searchsorted(lead, words.ends) - first > PREFIX
    return longer, lead[first[longer] + PREFIX]


def term_counts(data: np.ndarray, offsets: np.ndarray, vocabulary: "Vocabulary | None" = None):
    """(text, term, count) of a block, by text and term; of ``vocabulary`` only, as places in it."""
    low = W.LOWER[data]
    words = W.scan(low, offsets, W.ALNUM)
    text = words.text_of()
    longer, end = _heads(low, words)
    prefix = W.mix(W.word_hashes(low, W.Words(words.starts[longer], end, words.first)) + W.U64(1))  # a prefix is not a word
    text, term = np.concatenate([text, text[longer]]), np.concatenate([W.word_hashes(low, words), prefix])
    if vocabulary is None:
        order = np.lexsort((term, text))
        text, term = text[order], term[order]
        at = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (term[1:] != term[:-1]))[: len(text)])
        return text[at], term[at], np.diff(np.append(at, len(text)))
    near = np.flatnonzero(vocabulary.seen[term >> W.U64(64 - vocabulary.bits)])
    if not len(near):
        return text[:0], term[:0].astype(np.int64), text[:0]
    place = np.minimum(np.searchsorted(vocabulary.terms, term[near]), len(vocabulary.terms) - 1)
    known = vocabulary.terms[place] == term[near]
    key = np.sort(text[near[known]] * len(vocabulary.terms) + place[known])
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[at] // len(vocabulary.terms), key[at] % len(vocabulary.terms), np.diff(np.append(at, len(key)))


class Vocabulary:
    """Ascending term hashes, with a bitmap of their leading bits."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.bits = min(22, max(12, len(terms).bit_length() + 4))
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[terms >> W.U64(64 - self.bits)] = True


def tells(n0: np.ndarray, n1: np.ndarray, all0: int, all1: int) -> np.ndarray:
    """How much more than chance the terms tell the classes apart: the
    likelihood-ratio statistic of their counts of negative and positive
    examples beyond ``NO_GAIN``, for terms whose rates differ enough."""

    def part(k, n, p):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k / (n * p)), 0.0) + np.where(k < n, (n - k) * np.log((n - k) / (n * (1 - p))), 0.0)

    rate = (n0 + n1) / (all0 + all1)
    lift = ((n1 + 0.5) / (all1 + 1)) / ((n0 + 0.5) / (all0 + 1))
    gain = 2 * (part(n0, float(all0), rate) + part(n1, float(all1), rate))
    sure = (n0 + n1 >= MIN_DOCS) & (rate < 1) & ((lift >= MIN_LIFT) | (lift <= 1 / MIN_LIFT))
    return np.where(sure, np.maximum(np.nan_to_num(gain) - NO_GAIN, 0.0), 0.0)


def _document_counts(vocabulary):
    def run(batches):
        total, n = np.zeros(len(vocabulary.value.terms), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, data, offsets in W.blocks(batch.column(1)):
                _, term, _ = term_counts(data, offsets, vocabulary.value)
                total += np.bincount(term, minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, held)), pa.array(np.append(n, total[held]))], names=["term", "n"])

    return run


def _example_terms(batches):
    """Each example's terms (hashes) and their counts."""
    for batch in batches:
        out = []
        for lo, hi, data, offsets in W.blocks(batch.column(1)):
            text, term, count = term_counts(data, offsets)
            cut = np.searchsorted(text, np.arange(hi - lo + 1))
            out += [(term[a:b].tobytes(), count[a:b].astype("<i4").tobytes()) for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)]], names=["doc_id", "y", "terms", "counts"])


def _ranges(lo: np.ndarray, size: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all ranges ``lo .. lo + size``, each range's value for each)."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.arange(ends[-1]) + np.repeat(lo - (ends - size), size), np.repeat(value, size)


@dataclass
class Index:
    """Examples and their block-max inverted index."""

    vocabulary: np.ndarray
    idf: np.ndarray  # times what the term tells
    ids: np.ndarray
    y: np.ndarray
    weight: np.ndarray  # of an example's vote: undoes the sample's class shares
    empty: float  # share of toxic examples among those without a term

    def build(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> Index:
        n = len(vectors)
        example = np.repeat(np.arange(n), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors]) if n else np.zeros(0, np.int64)
        value = np.concatenate([v for _, v in vectors]) if n else np.zeros(0)
        order = np.lexsort((example, term))
        self.term_first = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        self.example, self.value = example[order], value[order]
        self.n_blocks = -(-n // BLOCK)
        key = term[order] * max(1, self.n_blocks) + self.example // BLOCK
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.block_key, self.block_first = key[first], np.append(first, len(key))
        self.block_max = np.maximum.reduceat(self.value, first) if len(first) else np.zeros(0)
        self.block_size = np.diff(self.block_first)
        self.block_of = (self.block_key % max(1, self.n_blocks)).astype(np.uint16 if self.n_blocks < 1 << 16 else np.int64)
        self.block_range = np.searchsorted(self.block_key, np.arange(len(self.vocabulary) + 1) * max(1, self.n_blocks))
        return self

    def vector(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Unit TF-IDF weights."""
        weight = (1 + np.log(count)) * self.idf[term]
        return weight / np.sqrt((weight**2).sum()) if len(weight) else weight

    def nearest(self, term: np.ndarray, value: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the ``K`` nearest with a common term."""
        pick, q = _ranges(self.block_range[term], self.block_range[term + 1] - self.block_range[term], value)
        block = self.block_of[pick]
        bound = np.bincount(block, weights=q * self.block_max[pick], minlength=self.n_blocks)
        near = np.argsort(-bound, kind="stable")
        near = near[bound[near] > 0]
        best_e, best_s, at, step = np.zeros(0, np.int64), np.zeros(0), 0, 4
        entries = begin = None
        while at < len(near) and (len(best_s) < K or bound[near[at]] + 1e-12 >= best_s[K - 1]):
            # the postings of the next blocks, added up by example
            if step >= len(near) - at and not at:
                rows = slice(None)
            else:
                if entries is None:  # by block: a radix sort of small numbers
                    entries = np.argsort(block, kind="stable")
                    begin = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=self.n_blocks))])
                rows = np.concatenate([entries[begin[b] : begin[b + 1]] for b in near[at : at + step].tolist()])
            chosen = pick[rows]
            post, weight = _ranges(self.block_first[chosen], self.block_size[chosen], q[rows])
            weight *= self.value[post]
            cosine = np.bincount(self.example[post], weights=weight, minlength=len(self.y))
            if without >= 0:
                cosine[without] = 0.0
            found = np.flatnonzero(cosine)
            if len(best_s) == K:
                found = found[cosine[found] >= best_s[K - 1]]
            elif len(found) > 4 * K:
                found = found[cosine[found] >= np.partition(cosine[found], len(found) - K)[len(found) - K]]
            best_e, best_s = np.concatenate([best_e, found]), np.concatenate([best_s, cosine[found]])
            order = np.lexsort((best_e, -best_s))[: K]
            best_e, best_s = best_e[order], best_s[order]
            at, step = at + step, step * 4
        return best_e, np.minimum(best_s, 1.0)

    def vote(self, examples: np.ndarray, cosine: np.ndarray) -> float:
        w = self.weight[self.y[examples]] * cosine / (1.05 - cosine)
        return float((w * self.y[examples]).sum() / w.sum())

    def calibrate(self, vectors) -> Index:
        """Isotonic regression of the examples' labels on their leave-one-out votes."""
        votes, own = [], []
        for i, (term, value) in enumerate(vectors):
            if len(term):
                examples, cosine = self.nearest(term, value, without=i)
                if len(examples):
                    votes.append(self.vote(examples, cosine))
                    own.append(i)
        order = np.argsort(votes, kind="stable")
        x, y = np.array(votes)[order], self.y[np.array(own, np.int64)[order]] if own else np.zeros(0, np.int64)
        merged: list[list[float]] = []  # mean, weight, last vote
        for vote, label in zip(x.tolist(), y.tolist()):
            merged.append([label, self.weight[label], vote])
            while len(merged) > 1 and merged[-2][0] >= merged[-1][0]:
                mean, weight, last = merged.pop()
                merged[-1] = [(merged[-1][0] * merged[-1][1] + mean * weight) / (merged[-1][1] + weight), merged[-1][1] + weight, last]
        self.steps = np.array([m[2] for m in merged] or [1.0])
        self.levels = np.array([(m[0] * m[1] + 0.5 * self.weight.min()) / (m[1] + self.weight.min()) for m in merged] or [0.5])
        return self

    def score(self, vote: float) -> float:
        """The calibrated vote; a thousandth of the plain vote keeps the order
        of votes that fall on one step."""
        return float(0.999 * np.interp(vote, self.steps, self.levels) + 0.001 * vote)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, *, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Index:
    spark = docs.sparkSession
    own = sample(docs, labels, label, allowed, SAMPLE_PER_CLASS, SAMPLE_BYTES, id_col=id_col, text_col=text_col)
    shares = {r["y"]: r["n"] for r in labels.where(F.col(label).isin(0, 1)).where(allowed).groupBy(F.col(label).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = own.select("doc_id", "text", "y").mapInArrow(_example_terms, "doc_id long, y int, terms binary, counts binary").collect()
    sizes = {k: sum(r["y"] == k for r in found) for k in (0, 1)}
    n0, n1 = sizes[0], sizes[1]
    hashes = [np.frombuffer(r["terms"], W.U64) for r in found] if n0 and n1 else []
    vocabulary, place = np.unique(np.concatenate(hashes), return_inverse=True) if hashes else (np.zeros(0, W.U64), np.zeros(0, np.int64))
    positive = np.repeat([r["y"] for r in found], [len(h) for h in hashes]) if hashes else np.zeros(0)
    with_y = [np.bincount(place[positive == k], minlength=len(vocabulary)) for k in (0, 1)]
    sent = Shared(spark, Vocabulary(vocabulary))
    counts = np.zeros(len(vocabulary) + 1, np.int64)
    for part in texts(docs, id_col, text_col).mapInArrow(_document_counts(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_batches():
        counts[part.column(0).to_numpy() + 1] = part.column(1).to_numpy()
    idf = np.log((1 + counts[0]) / (1 + counts[1:])) + 1
    if n0 and n1:
        idf = idf * (1.0 + tells(*with_y, n0, n1))
    cut = np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int64)
    examples = []
    for k, r in enumerate(found):
        own_terms = place[cut[k] : cut[k + 1]] if hashes else np.zeros(0, np.int64)
        examples.append((own_terms, np.frombuffer(r["counts"], "<i4")[: len(own_terms)].astype(np.int64), r["doc_id"], r["y"]))
    # near each other: by the term of the largest weight, then by all terms
    examples.sort(key=lambda e: (int(e[0][np.argmax(idf[e[0]])]) if len(e[0]) else -1, e[0].tobytes(), e[2], e[1].tobytes()))
    y = np.array([e[3] for e in examples], np.int64)
    weight = np.array([shares.get(k, 1) / max(1, sizes.get(k, 0)) for k in (0, 1)])
    bare = [e[3] for e in examples if not len(e[0])]
    if n0 and n1:
        positive, negative = sum(bare) * weight[1], (len(bare) - sum(bare)) * weight[0]
        empty = (positive + 0.5 * weight.min()) / (positive + negative + weight.min())
    else:
        empty = 1.0 if n1 else 0.0 if n0 else 0.5
    index = Index(vocabulary, idf, np.array([e[2] for e in examples], np.int64), y, weight, empty)
    vectors = [(e[0], index.vector(e[0], e[1])) for e in examples]
    return index.build(vectors).calibrate(vectors)


def _score_batches(index):
    def run(batches):
        own = index.value
        vocabulary = Vocabulary(own.vocabulary)
        for batch in batches:
            scores, evidence = [], []
            for lo, hi, data, offsets in W.blocks(batch.column(1)):
                text, term, count = term_counts(data, offsets, vocabulary)
                cut = np.searchsorted(text, np.arange(hi - lo + 1)).tolist()
                for a, b in zip(cut[:-1], cut[1:]):
                    score, near = own.empty, []
                    if b > a:
                        examples, cosine = own.nearest(term[a:b], own.vector(term[a:b], count[a:b]))
                        if len(examples):
                            score = own.score(own.vote(examples, cosine))
                            near = [{"doc_id": d, "cosine": c, "toxic": t} for d, c, t in zip(own.ids[examples].tolist(), cosine.tolist(), own.y[examples].tolist())]
                    scores.append(score)
                    evidence.append(near)
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=["doc_id", "score", "evidence"])

    return run


def score(docs: DataFrame, index: Index, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` in [0, 1] and ``evidence``: the nearest labelled examples."""
    sent = Shared(docs.sparkSession, index)
    return texts(docs, id_col, text_col).mapInArrow(_score_batches(sent), f"doc_id long, score double, evidence {EVIDENCE}")
