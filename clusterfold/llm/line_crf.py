"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a text is described by shape features (lengths, shares of
capitals, digits, symbols and exclamation marks, repeated words, repeated
lines) of itself and of the lines before and after it.  A two-state chain
labels each line bad or good; the weights maximise the regularised
conditional likelihood on a bounded sample of labelled documents (at most
``SAMPLE_PER_CLASS`` and ``SAMPLE_BYTES`` of each class; every
line carries its document's label).  Scores are forward-backward marginals,
averaged over a document's lines with their lengths as weights.

Defined results: a null or empty text is one empty line and scored as such;
repeated rows are scored each; with labels of one class only, or none, every
score is that class (or 0.5).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared, bounded_batches, lean
from clusterfold.llm.labelled import sample

SAMPLE_PER_CLASS = 2000
SAMPLE_BYTES = 24 << 20  # of each class; a line counts as 256 more
ROUNDS, RATE, RIDGE = 150, 0.1, 1e-3


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_KINDS = [_table(bytes(range(65, 91))), _table(b"0123456789"), _table(b"#*$%&|<>"), _table(b"!"), _table(b".,;:"), _table(b" \t")]
N_OWN = 14
N_FEATURES = 3 * N_OWN + 1


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, first line of each text) of a block's lines."""
    feed = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], feed + 1])) if len(offsets) > 1 else np.zeros(0, np.int64)
    # an empty text shares its place with the next text: lines are listed by text
    breaks = np.searchsorted(feed, offsets)
    n_lines = np.diff(breaks) + 1
    first = np.concatenate([[0], np.cumsum(n_lines)])
    begin = np.empty(first[-1], np.int64)
    end = np.empty(first[-1], np.int64)
    is_first, is_last = np.zeros(first[-1], bool), np.zeros(first[-1], bool)
    is_first[first[:-1]], is_last[first[1:] - 1] = True, True
    begin[is_first], end[is_last] = offsets[:-1], offsets[1:]
    begin[~is_first], end[~is_last] = feed + 1, feed
    length = end - begin
    sums = []
    for kind in _KINDS:
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(kind[data], out=total[1:])
        sums.append(total[end] - total[begin])
    words = W.scan(W.LOWER[data], offsets, W.SPACED)
    hashes = W.word_hashes(W.LOWER[data], words)
    # a word lies within one line: a line feed ends a word
    word_first = np.searchsorted(words.starts, begin)
    word_last = np.searchsorted(words.starts, end)
    n_words = word_last - word_first
    line_of = np.repeat(np.arange(len(begin)), n_words)
    again = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 1:
        again[2:] = np.cumsum((hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1]))
    repeats = again[word_last] - again[np.minimum(word_first + 1, word_last)]
    pair = np.unique(W.mix(hashes + W.mix(line_of.astype(W.U64))) if len(hashes) else hashes, return_index=True)[1]
    distinct = np.bincount(line_of[pair], minlength=len(begin)) if len(hashes) else np.zeros(len(begin), np.int64)
    word_bytes = W.per_text(W.Words(words.starts, words.ends, np.append(word_first, len(words.starts)) if len(begin) else np.zeros(1, np.int64)), words.ends - words.starts)
    # lines equal to an earlier line of the text
    total = np.zeros(len(hashes) + 1, W.U64)
    place = np.arange(len(hashes)) - word_first[line_of] if len(hashes) else np.zeros(0, np.int64)
    np.cumsum(W.mix(hashes + place.astype(W.U64) * W.U64(0x9E3779B97F4A7C15)), out=total[1:])
    text_of = np.repeat(np.arange(len(n_lines)), n_lines)
    key = W.mix(total[word_last] - total[word_first] + W.mix(text_of.astype(W.U64)))
    seen = np.ones(len(begin), dtype=bool)
    seen[np.unique(key, return_index=True)[1]] = False
    duplicate = seen & (n_words > 0)
    size, count = np.maximum(length, 1), np.maximum(n_words, 1)
    own = np.stack([
        np.log1p(length), np.log1p(n_words), word_bytes / count, n_words == 0,
        *[s / size for s in sums[:3]], sums[3] / count, sums[4] / count, sums[2] / count,
        repeats / count, distinct / count, duplicate, np.log1p(np.repeat(n_lines, n_lines)),
    ], axis=1).astype(np.float64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[~is_first], after[~is_last] = own[:-1][~is_last[:-1]], own[1:][~is_first[1:]]
    return np.concatenate([own, before, after, np.ones((len(own), 1))], axis=1), length + 1.0, first


class Chain:
    """Two-state chain: weights of the state "good", transitions, and the scaling of features."""

    def __init__(self, mean, scale, weights, moves):
        self.mean, self.scale, self.weights, self.moves = mean, scale, weights, moves

    def emissions(self, features):
        return np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights

    def marginals(self, features, first):
        return forward_backward(self.emissions(features), first, self.moves)[0]


def _steps(first: np.ndarray):
    """For step 0, 1, ...: the lines at that place of the texts that are so long."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = first[:-1][order], sizes[order]
    for t in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -t, "left"))  # sizes > t
        yield begins[:live] + t


def _log_add(a, b):
    return np.logaddexp(a, b)


def forward_backward(emit: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """(marginal of "good" per line, transition marginals summed [2, 2], log
    partition per text); a bad line's emission is 0."""
    n = len(emit)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    node = np.stack([np.zeros(n), emit], axis=1)
    steps = list(_steps(first))
    for t, at in enumerate(steps):
        if t == 0:
            ahead[at] = node[at]
        else:
            prior = ahead[at - 1]
            ahead[at] = node[at] + np.stack([_log_add(prior[:, 0] + moves[0, y], prior[:, 1] + moves[1, y]) for y in (0, 1)], axis=1)
    last = first[1:] - 1
    for t in range(len(steps) - 2, -1, -1):
        at = steps[t][: len(steps[t + 1])]
        later = back[at + 1] + node[at + 1]
        back[at] = np.stack([_log_add(later[:, 0] + moves[y, 0], later[:, 1] + moves[y, 1]) for y in (0, 1)], axis=1)
    whole = _log_add(ahead[last, 0], ahead[last, 1]) if n else np.zeros(0)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    good = np.exp(np.clip(ahead[:, 1] + back[:, 1] - whole[text], -700, 0))
    pairs = np.zeros((2, 2))
    inner = np.ones(n, dtype=bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    for x in (0, 1):
        for y in (0, 1):
            pairs[x, y] = np.exp(np.clip(ahead[at - 1, x] + moves[x, y] + node[at, y] + back[at, y] - whole[text[at]], -700, 0)).sum()
    return good, pairs, whole


def fit(features: np.ndarray, first: np.ndarray, y: np.ndarray) -> Chain:
    """Weights by Adam on the mean regularised conditional likelihood of the texts."""
    mean, scale = features.mean(axis=0), features.std(axis=0)
    mean[-1], scale = 0.0, np.where(scale > 1e-9, scale, 1.0)
    x = np.clip((features - mean) / scale, -8, 8)
    line_y = np.repeat(y, np.diff(first)).astype(np.float64)
    inner = np.ones(len(x), dtype=bool)
    inner[first[:-1]] = False
    kept = np.zeros((2, 2))  # a text's lines have one label, so its moves stay
    kept[0, 0], kept[1, 1] = (1 - line_y[inner]).sum(), line_y[inner].sum()
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        moves = theta[-4:].reshape(2, 2)
        good, pairs, _ = forward_backward(x @ theta[:-4], first, moves)
        slope = np.concatenate([(line_y - good) @ x, (kept - pairs).ravel()]) / len(y) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Chain(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def _constant(score: float) -> Chain:
    weights = np.zeros(N_FEATURES)
    weights[-1] = {0.0: -50.0, 1.0: 50.0}.get(score, 0.0)
    return Chain(np.zeros(N_FEATURES), np.ones(N_FEATURES), weights, np.zeros((2, 2)))


def _sample_features(batches):
    for batch in batches:
        out = []
        for _, _, data, offsets in W.blocks(batch.column(1)):
            features, _, first = line_features(data, offsets)
            out += [features[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), batch.column(2)], names=["doc_id", "features", "y"])


def train(docs: DataFrame, labels: DataFrame, allowed: Column, *, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The chain of a bounded sample of the labelled rows that ``allowed`` marks."""
    own = sample(docs, labels, label, allowed, SAMPLE_PER_CLASS, SAMPLE_BYTES, id_col=id_col, text_col=text_col)
    rows = own.select("doc_id", "text", "y").mapInArrow(_sample_features, "doc_id long, features binary, y int").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    classes = {r["y"] for r in rows}
    if len(classes) < 2:
        return _constant(float(classes.pop()) if classes else 0.5)
    parts = [np.frombuffer(r["features"], "<f4").reshape(-1, N_FEATURES) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit(np.concatenate(parts).astype(np.float64), first, np.array([r["y"] for r in rows]))


def _score_batches(chain, place: int):
    def run(batches):
        for batch in batches:
            scores, text = [], batch.column(0).field(place)
            for _, _, data, offsets in W.blocks(text if pa.types.is_string(text.type) else text.cast(pa.string())):
                features, weights, first = line_features(data, offsets)
                good = chain.value.marginals(features, first)
                scores.append(np.add.reduceat(good * weights, first[:-1]) / np.add.reduceat(weights, first[:-1]))
            score = np.clip(np.concatenate(scores), 0, 1) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

    return run


def score(docs: DataFrame, chain: Chain, *, text_col: str = "text") -> DataFrame:
    """``row`` (struct of the document's own columns) and ``score`` in [0, 1]."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # the text travels once
    from pyspark.sql import types as T

    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(lean(_score_batches(Shared(spark, chain), docs.columns.index(text_col))), schema)
