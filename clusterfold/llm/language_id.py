"""Language identification of words and spans of mixed-language text.

Training counts the character n-grams (1 to ``ORDERS``, with word edges) of
every word of the labelled texts, hashed into ``BUCKETS`` buckets per
language, and the letters of each script that a language's texts hold.  The
counts are summed by the executors; the model is ``languages * BUCKETS`` log
probabilities, whatever the corpus holds, and is broadcast.  It is fitted on a
sample: of each language the documents whose hash of the id lies below the
share that leaves about ``SAMPLE_DOCS`` of them (all, if it has fewer).

Scoring cuts every whole text into words (runs of letters and their marks).
The script of a word, read from code point ranges, narrows its candidates to
the languages that use the script; these get the mean log probability of
the word's n-grams, times its number of letters (``LONGEST`` at most), against
the mean of the candidates.  A Viterbi pass over the words of the text then
finds the labels of the highest total score, where each change of language
costs ``SWITCH``; equal labels in a row are a span.  All texts of a block
take each step together, long ones in pieces whose ends are chained.  The language of a text is that of
most of its letters; the score is the share of these letters among all.

Defined results: a null text and one without letters are ``und`` with score 0
and no spans, and so is every text where no labelled text with letters was
seen.  A word in a script that no learned language uses says nothing; it takes
the label of its neighbours.  Ties go to the language with more letters in
training, then to the smaller name.  A null language or a null text is not
learned from; a repeated row counts each time.  An empty table gives an empty
result; extra columns are ignored.  Texts are never cut: a text
longer than a block is a block of its own.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared, bounded_batches, texts

ORDERS = 4
BUCKETS = 1 << 17
SAMPLE_DOCS = 10_000  # of each language, about
SMOOTHING = 0.5
SWITCH = 12.0
LONGEST = 12
SCRIPT_SHARE = 0.001  # of a language's letters, for a script to be one of its own
BLOCK_BYTES = 4 << 20
PIECE = 512  # words of a text that are labelled one after another
_MATRICES = 1 << 21  # numbers in the pieces' matrices at a time
UNDECIDED = "und"

# Blocks of the Unicode code charts by script (first, last).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F), (0xFB13, 0xFB17)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS)  # letters of any other script
N_SCRIPTS = OTHER + 1
_MARK = 254  # stands inside words, is no letter
_NONE = 255

_tables: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """(script, lower case) of every code point; made once a process."""
    if not _tables:
        kind = np.full(0x110000, _NONE, np.uint8)
        low = np.arange(0x110000, dtype=np.uint32)
        for cp in range(0x323B0):
            c = chr(cp)
            group = unicodedata.category(c)[0]
            if group == "L":
                kind[cp] = OTHER
                small = c.lower()
                if len(small) == 1:
                    low[cp] = ord(small)
            elif group == "M":
                kind[cp] = _MARK
        for k, ranges in enumerate(SCRIPTS.values()):
            for a, b in ranges:
                part = kind[a : b + 1]
                part[part == OTHER] = k
        _tables.extend((kind, low))
    return _tables[0], _tables[1]


# ---- words of a block ---------------------------------------------------------------


class Block:
    """The words of some texts.  ``distinct`` are their lower-cased forms and
    ``code`` the place of each word among them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind, low = tables()
        points, self.text_ends = _points(data, offsets)
        script = kind[points]
        inside = script != _NONE
        edge = np.zeros(len(points) + 1, bool)
        edge[self.text_ends[:-1]] = True
        before = np.concatenate([[False], inside])
        inside = np.append(inside, False)
        starts = np.flatnonzero(inside & (~before | edge))
        ends = np.flatnonzero(before & (~inside | edge))
        letter = script < _MARK
        total = np.concatenate([[0], np.cumsum(letter)])
        letters = total[ends] - total[starts]
        some = letters > 0  # marks alone are no word
        self.starts, self.ends, self.letters = starts[some], ends[some], letters[some]
        self.first = np.searchsorted(self.starts, self.text_ends)
        small = low[points].astype(np.uint32)
        keep = np.zeros(len(points) + 1, np.int8)
        keep[self.starts] += 1
        keep[self.ends] -= 1
        body = small[np.cumsum(keep[:-1], dtype=np.int8) > 0]
        size = self.ends - self.starts
        raw = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(4 * np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(body)])
        coded = raw.dictionary_encode()
        self.code = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary
        at = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1] // 4 if len(distinct) else np.zeros(1, np.int64)
        self.points = np.frombuffer(distinct.buffers()[2], np.uint32)[: at[-1]] if len(distinct) else np.zeros(0, np.uint32)
        self.bounds = at

    def scripts(self) -> np.ndarray:
        """(distinct words, scripts) letters of each script."""
        kind, n = tables()[0][self.points], len(self.bounds) - 1
        word = np.repeat(np.arange(n), np.diff(self.bounds))
        some = kind < _MARK
        return np.bincount(word[some] * N_SCRIPTS + kind[some], minlength=n * N_SCRIPTS).reshape(n, N_SCRIPTS)


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, each text's first one and the end) of UTF-8 texts."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, lead[offsets]


def grams(points: np.ndarray, bounds: np.ndarray):
    """(word, bucket) of every n-gram of the words, edges included."""
    n = len(bounds) - 1
    size = np.diff(bounds) + 2
    ends = np.cumsum(size)
    text = np.zeros(int(ends[-1]) if n else 0, np.uint64)  # 0: a word's edge
    inner = np.ones(len(text), bool)
    inner[ends - 1] = False
    inner[ends - size] = False
    text[inner] = points
    word = np.repeat(np.arange(n), size)
    left = np.repeat(ends, size) - np.arange(len(text))  # code points to the word's end
    key = np.zeros(len(text), np.uint64)
    for order in range(1, ORDERS + 1):
        shifted = np.zeros(len(text), np.uint64)
        shifted[: len(text) - order + 1] = text[order - 1 :]
        key = W.mix(key * np.uint64(31) + shifted + np.uint64(order))
        good = left >= order if order > 1 else inner
        yield word[good], (key[good] >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), order


# ---- training -----------------------------------------------------------------------


class Model:
    """Per language: log probabilities of the buckets, and its scripts."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        order = sorted(range(len(languages)), key=lambda k: (-int(scripts[k].sum()), languages[k]))
        self.languages = [languages[k] for k in order]
        counts, scripts = counts[order] + SMOOTHING, scripts[order]
        self.log = np.ascontiguousarray(np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32))
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        self.uses = (share >= SCRIPT_SHARE).T  # (scripts, languages)

    def scores(self, block: Block) -> np.ndarray:
        """(distinct words, languages): 0 is the candidates' mean; languages
        that are no candidates lie below all others."""
        n, many = len(block.bounds) - 1, len(self.languages)
        total, count = np.zeros((n, many)), np.zeros(n)
        for word, bucket, _ in grams(block.points, block.bounds):
            first = np.searchsorted(word, np.arange(n))
            some = first < np.append(first[1:], len(word))
            if len(word):
                total[some] += np.add.reduceat(self.log[bucket], first[some], axis=0)
            count += np.bincount(word, minlength=n)
        total /= np.maximum(1, count)[:, None]
        main = block.scripts().argmax(axis=1) if n else np.zeros(0, np.int64)
        able = self.uses[main]
        n_able = able.sum(axis=1)
        mean = (total * able).sum(axis=1) / np.maximum(1, n_able)
        size = np.minimum(np.diff(block.bounds), LONGEST)
        out = (total - mean[:, None]) * size[:, None]
        floor = np.where(able, out, np.inf).min(axis=1, initial=np.inf) - SWITCH
        out = np.where(able, out, np.where(np.isfinite(floor), floor, 0.0)[:, None])
        out[n_able == 0] = 0.0
        return out


def _counted(names: list[str]):
    def run(batches):
        place = {name: k for k, name in enumerate(names)}
        counts = np.zeros((len(names), BUCKETS), np.int64)
        scripts = np.zeros((len(names), N_SCRIPTS), np.int64)
        for batch in batches:
            own = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, hi, data, offsets in W.blocks(batch.column(0), BLOCK_BYTES):
                block = Block(data, offsets)
                n = len(block.bounds) - 1
                lang = own[lo:hi][np.repeat(np.arange(hi - lo), np.diff(block.first))]
                held, times = np.unique(block.code * len(names) + lang, return_counts=True)
                code, lang = held // len(names), held % len(names)
                letters = block.scripts()
                for word, bucket, _ in grams(block.points, block.bounds):
                    first = np.searchsorted(word, np.arange(n + 1))
                    size = (first[1:] - first[:-1])[code]
                    at = np.repeat(first[code] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
                    spot = np.repeat(lang, size) * BUCKETS + bucket[at]
                    counts += np.bincount(spot, np.repeat(times, size), counts.size).astype(np.int64).reshape(counts.shape)
                for s in range(N_SCRIPTS):
                    scripts[:, s] += np.bincount(lang, times * letters[code, s], len(names)).astype(np.int64)
        flat = np.concatenate([counts, scripts], axis=1)
        lang, key = np.nonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(key, pa.int32()), pa.array(flat[lang, key], pa.int64())], names=["language", "key", "n"])

    return run


def train(docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Model of the labelled documents that ``learn`` (an expression of
    ``doc_id``) allows; None if there are none.  ``sample_docs`` bounds the
    documents of a language, about: which ones is a hash of their ids."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    own = own.where("text is not null and lang is not null").where(F.coalesce(learn, F.lit(False)))
    found = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not found:
        return None
    names = sorted(found)
    # hash below the language's share: the rows of a language never meet
    share = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(min(1.0, sample_docs / found[name])))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = own.where(draw < share[F.col("lang")]).select("text", "lang").mapInArrow(_counted(names), "language int, key int, n long")
    counts, scripts = np.zeros((len(names), BUCKETS)), np.zeros((len(names), N_SCRIPTS))
    for part in rows.groupBy("language", "key").agg(F.sum("n").alias("n")).toArrow().to_batches():
        lang, key, n = (part.column(k).to_numpy() for k in range(3))
        gram = key < BUCKETS
        counts[lang[gram], key[gram]] = n[gram]
        scripts[lang[~gram], key[~gram] - BUCKETS] = n[~gram]
    seen = scripts.sum(axis=1) > 0
    return Model([x for x, s in zip(names, seen) if s], counts[seen], scripts[seen]) if seen.any() else None


# ---- labelling ----------------------------------------------------------------------


def _forward(scores: np.ndarray, code: np.ndarray, start: np.ndarray, size: np.ndarray, value: np.ndarray, switch: float, trail=None) -> np.ndarray:
    """Best score of every last label, from ``value`` (pieces, ..., languages)
    after the first word; pieces by falling size, and those that have a word
    t take step t together.  ``trail`` gets the way into every label."""
    for t, n in enumerate(_active(size)):
        if not t:
            continue
        at, own = start[:n] + t, value[:n]
        other = own.max(axis=-1, keepdims=True) - switch
        if trail is not None:
            moved, source = trail
            moved[at], source[at] = other > own, own.argmax(axis=-1)
        new = scores[code[at]]
        value[:n] = np.maximum(own, other) + (new if own.ndim == 2 else new[:, None, :])
    return value


def _active(size: np.ndarray) -> np.ndarray:
    """Pieces that have a word t, for each t; sizes fall."""
    return np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")


def _ends(scores: np.ndarray, code: np.ndarray, start: np.ndarray, size: np.ndarray, text: np.ndarray, switch: float):
    """(label before, last label) of the pieces of texts with several.  A
    piece is one max-plus matrix from the label before it to its last one;
    these are chained along each text, and the best chain is followed back."""
    many = scores.shape[1]
    away = -switch * (1 - np.eye(many))
    order = np.argsort(-size, kind="stable")
    entry = np.concatenate([[True], text[1:] != text[:-1]])
    step = np.empty((len(start), many, many))
    for lo in range(0, len(start), max(1, _MATRICES // (many * many))):
        own = order[lo : lo + max(1, _MATRICES // (many * many))]
        value = scores[code[start[own]]][:, None, :] + np.where(entry[own][:, None, None], 0.0, away)
        step[own] = _forward(scores, code, start[own], size[own], value, switch)
    heads = np.flatnonzero(entry)
    length = np.diff(np.append(heads, len(start)))
    by = np.argsort(-length, kind="stable")
    heads, length = heads[by], length[by]
    back = np.zeros((len(start), many), np.int64)
    value = step[heads, 0].copy()
    active = _active(length)
    for r in range(1, len(active)):
        at = heads[: active[r]] + r
        ways = value[: active[r], :, None] + step[at]
        back[at] = ways.argmax(axis=1)
        value[: active[r]] = ways.max(axis=1)
    now = value.argmax(axis=1)
    before, last = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    for r in range(len(active) - 1, -1, -1):
        at = heads[: active[r]] + r
        last[at] = now[: active[r]]
        before[at] = now[: active[r]] = back[at, now[: active[r]]]
    return before, last


def viterbi(scores: np.ndarray, code: np.ndarray, first: np.ndarray, switch: float = SWITCH, piece: int = PIECE) -> np.ndarray:
    """Best label of every word.  ``scores[code]`` are the words' scores in
    text order, ``first`` each text's first word and the end.  Texts of more
    than ``piece`` words are cut into pieces that advance together; the labels
    at the cuts come from the chained pieces, so the path is that of the whole
    text."""
    sizes = np.diff(first)
    many = scores.shape[1]
    label = np.zeros(len(code), np.int64)
    if not len(code):
        return label
    n_pieces = -(-sizes // piece)
    text = np.repeat(np.arange(len(sizes)), n_pieces)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    start = first[:-1][text] + rank * piece
    size = np.minimum(piece, first[1:][text] - start)
    before, last = np.full(len(text), -1), np.full(len(text), -1)
    cut = n_pieces[text] > 1
    if cut.any():
        before[cut], last[cut] = _ends(scores, code, start[cut], size[cut], text[cut], switch)
    order = np.argsort(-size, kind="stable")
    start, size, before, last, rank = (v[order] for v in (start, size, before, last, rank))
    moved = np.zeros((len(code), many), bool)  # the best way into this label is from `source`
    source = np.zeros(len(code), np.int32)
    away = np.where((rank > 0)[:, None] & (before[:, None] != np.arange(many)), -switch, 0.0)
    value = _forward(scores, code, start, size, scores[code[start]] + away, switch, (moved, source))
    now = np.where(last >= 0, last, value.argmax(axis=1))
    active = _active(size)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        label[at] = now[:n]
        now[:n] = np.where(moved[at, now[:n]], source[at], now[:n])
    return label


def _labelled(shared: Shared | None):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def run(batches):
        model = shared.value if shared else None
        names = pa.array([*(model.languages if model else []), UNDECIDED], pa.string())
        many = len(names) - 1
        for batch in batches:
            for lo, hi, data, offsets in W.blocks(batch.column(1), BLOCK_BYTES):
                block, n = Block(data, offsets), hi - lo
                if not many:
                    block.first[:] = 0  # no word has a label
                    label = told = np.zeros(0, np.int64)
                else:
                    scores = model.scores(block)
                    label = viterbi(scores, block.code, block.first)
                    told = np.where((scores != 0).any(axis=1)[block.code], block.letters, 0) if many > 1 else block.letters
                text = np.repeat(np.arange(n), np.diff(block.first))
                votes = np.bincount(text * max(1, many) + label, block.letters[: len(label)], n * max(1, many)).reshape(n, -1)
                sure = np.bincount(text * max(1, many) + label, told, n * max(1, many)).reshape(n, -1)
                best = votes.argmax(axis=1)
                every = votes.sum(axis=1)
                score = sure[np.arange(n), best] / np.maximum(1, every)
                change = np.ones(len(label), bool)
                change[1:] = (label[1:] != label[:-1]) | (text[1:] != text[:-1])
                head = np.flatnonzero(change)
                tail = np.append(head[1:], len(label))[: len(head)] - 1
                base = block.text_ends[text[head]]
                pieces = pa.StructArray.from_arrays([pa.array(block.starts[head] - base), pa.array(block.ends[tail] - base), names.take(pa.array(label[head]))], fields=list(span))
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(head, block.first).astype(np.int32)), pieces)
                lang = names.take(pa.array(np.where(every > 0, best, many)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), lang, pa.array(score), spans], names=["doc_id", "lang_pred", "score", "spans"])

    return run


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every document; ``spans`` are
    ``start, end`` (code points) and ``lang`` of the text's stretches of one
    language, in order."""
    shared = Shared(docs.sparkSession, model) if model else None
    return texts(docs, id_col, text_col).mapInArrow(_labelled(shared), "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>")
