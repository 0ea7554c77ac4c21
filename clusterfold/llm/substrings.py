"""Substring dedup by fixed-block anchors.

Removed is every word covered by a window of ``window`` words whose word
sequence also starts in a document with a smaller id.

1. Anchors.  Every text is cut into non-overlapping reference blocks of
   ``(window + 1) // 2`` words; a repeated window always holds one whole
   block of its earlier occurrence.  All rolling windows of that block length
   probe the block index: per bucket of the key space, a key is a hit if some
   text has it as a block and more than one text has it at all.
2. Extension.  Around each hit the ``window``-word sequences that hold the
   anchor are compared by a 64-bit key (and a bucket of a second hash) with
   those of all other hits; a sequence that starts in a smaller id is a
   repeat, and overlapping repeats run together to maximal exact repeats.

Each chunk of texts sends a key once; only keys and bits are exchanged, and
texts are joined with the answers chunk by chunk.

Defined results: null and empty texts have no words; texts shorter than a
window keep all; a null id counts as the largest; equal ids are not smaller
than each other, so repeated rows do not remove each other's words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clusterfold.llm import chunks as C
from clusterfold.llm import words as W

WINDOW = 13
KEY_BYTES = 6.5  # of text for each word, about

OUT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"


def _words(chunk: C.Chunk) -> tuple[W.Words, np.ndarray]:
    words = W.scan(chunk.data, chunk.offsets, W.SPACED)
    return words, W.word_hashes(chunk.data, words)


def _anchors(words: W.Words, hashes: np.ndarray, size: int):
    """Rolling block-long windows: starts, distinct keys, place of each start's key."""
    starts = W.window_starts(words, size)
    keys, place = np.unique(W.window_hashes(hashes, starts, size), return_inverse=True)
    return starts, keys, place


def _send_anchors(size: int, n_buckets: int):
    def send(chunk: C.Chunk):
        words, hashes = _words(chunk)
        starts, keys, place = _anchors(words, hashes, size)
        text = words.text_of()[starts]
        block = np.zeros(len(keys), dtype=bool)
        block[place[(starts - words.first[text]) % size == 0]] = True
        least, most = _text_range(chunk.rank()[text], place, len(keys))
        for bucket, lo, hi in zip(*(x.tolist() for x in C.by_bucket(keys, n_buckets))):
            yield bucket, [_low(keys[lo:hi], n_buckets).tobytes(), C.bits(block[lo:hi]), C.bits(least[lo:hi] < most[lo:hi])]

    return send


def _low(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """32 bits of a key that the bucket does not already tell."""
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype("<u4")


def _text_range(rank: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    least, most = np.full(n, 1 << 40, np.int64), np.full(n, -1, np.int64)
    # texts come in the order of their ids
    most[place] = rank
    least[place[::-1]] = rank[::-1]
    return least, most


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:n].astype(bool)


def _answer_anchors(parts):
    """A key is a hit if it is a block somewhere and stands in two texts."""
    keys = [np.frombuffer(p[0], "<u4") for p in parts]
    sizes = np.array([len(k) for k in keys])
    every = np.concatenate(keys)
    block = np.concatenate([_unpack(p[1], n) for p, n in zip(parts, sizes)])
    many = np.concatenate([_unpack(p[2], n) for p, n in zip(parts, sizes)])
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1]))
    entries = np.diff(np.append(first, len(every)))
    hit = np.logical_or.reduceat(block[order], first) & ((entries > 1) | np.logical_or.reduceat(many[order], first))
    out = np.empty(len(every), dtype=bool)
    out[order] = np.repeat(hit, entries)
    return [C.bits(x) for x in np.split(out, np.cumsum(sizes)[:-1])]


def _candidates(chunk: C.Chunk, words: W.Words, hashes: np.ndarray, window: int, size: int, n_buckets: int):
    """Starts of the sequences that hold an anchor hit; their distinct keys and places."""
    starts, keys, place = _anchors(words, hashes, size)
    hit = C.flags_of(chunk.replies[0], *C.by_bucket(keys, n_buckets))[place] if len(keys) else np.zeros(0, bool)
    total = np.zeros(len(words.starts) + 1, dtype=np.int64)
    marks = np.zeros(len(words.starts), dtype=np.int64)
    marks[starts[hit]] = 1
    np.cumsum(marks, out=total[1:])
    long_starts = W.window_starts(words, window)
    long_starts = long_starts[total[long_starts + window - size + 1] > total[long_starts]]
    full = W.window_hashes(hashes, long_starts, window)
    return long_starts, *np.unique(full, return_inverse=True)


def _send_sequences(window: int, size: int, n_anchor_buckets: int, n_buckets: int):
    def send(chunk: C.Chunk):
        words, hashes = _words(chunk)
        starts, keys, place = _candidates(chunk, words, hashes, window, size, n_anchor_buckets)
        least, _ = _text_range(chunk.rank()[words.text_of()[starts]], place, len(keys))
        own = np.unique(chunk.ids)
        for bucket, lo, hi in zip(*(x.tolist() for x in C.by_bucket(keys, n_buckets))):
            used, at = np.unique(least[lo:hi], return_inverse=True)
            yield bucket, [keys[lo:hi].tobytes(), at.astype("<u2" if len(used) < 65536 else "<u4").tobytes(), own[used].tobytes()]

    return send


def _answer_sequences(parts):
    """A bit for each key that starts in a smaller id than the chunk's smallest."""
    keys = [np.frombuffer(p[0], np.uint64) for p in parts]
    ids = []
    for p, k in zip(parts, keys):
        at = np.frombuffer(p[1], "<u2" if len(p[1]) == 2 * len(k) else "<u4")
        ids.append(np.frombuffer(p[2], np.int64)[at])
    every, own = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(every, kind="stable")
    first = np.flatnonzero(np.append(True, every[order][1:] != every[order][:-1]))
    least = np.empty(len(every), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(own[order], first), np.diff(np.append(first, len(every))))
    return [C.bits(x) for x in np.split(least < own, np.cumsum([len(k) for k in keys])[:-1])]


def _runs(gone: np.ndarray, words: W.Words) -> list[list[dict]]:
    """Removed word ranges of each text."""
    edge = np.zeros(len(gone) + 1, dtype=bool)
    edge[words.first] = True
    before, now = np.append(False, gone), np.append(gone, False)
    begins, ends = np.flatnonzero(now & (~before | edge)), np.flatnonzero(before & (~now | edge))
    text = np.searchsorted(words.first, begins, "right") - 1
    out: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    for t, a, b in zip(text.tolist(), begins.tolist(), ends.tolist()):
        out[t].append({"start": a - int(words.first[t]), "end": b - int(words.first[t])})
    return out


def kept_texts(data: np.ndarray, words: W.Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the kept words, joined by one space."""
    text = words.text_of()[keep]
    starts, ends = words.starts[keep], words.ends[keep]
    follows = np.append(text[1:] == text[:-1], False) if len(text) else np.zeros(0, bool)
    sizes = ends - starts + follows
    at = np.cumsum(sizes)
    total = int(at[-1]) if len(at) else 0
    source = np.arange(total) + np.repeat(starts - (at - sizes), sizes)
    out = np.append(data, np.uint8(32))[np.minimum(source, len(data))]
    out[at[follows] - 1] = 32
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, weights=sizes, minlength=len(words.first) - 1))]).astype(np.int64)
    return out, offsets


def _finish(window: int, size: int, n_anchor_buckets: int, n_buckets: int):
    def run(batches):
        for row in C.rows_of(batches):
            chunk = C.Chunk(row)
            words, hashes = _words(chunk)
            starts, keys, place = _candidates(chunk, words, hashes, window, size, n_anchor_buckets)
            rank = chunk.rank()[words.text_of()[starts]]
            least, _ = _text_range(rank, place, len(keys))
            earlier = C.flags_of(chunk.replies[1], *C.by_bucket(keys, n_buckets))[place] if len(keys) else np.zeros(0, bool)
            repeat = earlier | (rank > least[place]) if len(keys) else earlier
            gone = W.covered(repeat, starts, window, len(words.starts))
            data, offsets = kept_texts(chunk.data, words, ~gone)
            text = pa.Array.from_buffers(pa.large_string(), len(chunk.ids), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.id_list(), pa.int64()), pa.array(words.counts, pa.int64()), pa.array(W.per_text(words, gone), pa.int64()),
                 pa.array(_runs(gone, words), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), text.cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return run


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, spans`` (removed word ranges, end
    exclusive) and ``kept_text`` (kept words joined by one space)."""
    size = (window + 1) // 2
    table = C.chunk_table(docs, id_col, text_col)
    n = C.buckets_for(table, KEY_BYTES)
    first = C.exchange(table, _send_anchors(size, n), _answer_anchors)
    hit = C.with_replies(table, first)
    second = C.exchange(hit, _send_sequences(window, size, n, n), _answer_sequences)
    # each exchange is planned twice; Spark runs equal exchanges once
    return C.with_replies(table, first, second).mapInArrow(_finish(window, size, n, n), OUT)
