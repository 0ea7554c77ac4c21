"""Byte-level BPE encoding and decoding, equal to the public tiktoken library.

A text is cut by the tokenizer's pattern; each distinct piece of a block is
encoded once.  Pieces are bucketed by length into padded numpy matrices of
token ids.  In each round every row merges its leftmost pair of minimum
rank; pairs are looked up in an open-addressing hash table, and rows
without a mergeable pair leave the matrix (compaction).  Pieces longer than
``LONG_PIECE`` bytes, for which one merge a round would cost the square of
their length, merge the same pairs in the same order by a heap.

The vocabulary (a rank file, at most ``MAX_VOCABULARY`` entries) is read on
the driver and broadcast.

Defined results: a null text is encoded as the empty text; ids are packed as
little-endian unsigned 32-bit integers; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import heapq
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared, bounded_batches, lean, texts

MAX_VOCABULARY = 1 << 20
MAX_VOCABULARY_BYTES = 64 << 20
LONG_PIECE = 128
MATRIX_CELLS = 1 << 17
CACHE_PIECES = 50_000
DECODED_ROWS = 500  # that leave a worker at once
_NONE = np.int64(1 << 40)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    if len(ranks) > MAX_VOCABULARY or sum(map(len, ranks)) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary is larger than what is broadcast")
    return ranks


class Tokens:
    """Ranks and bytes of the tokens, numbered densely in the order of rank."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks, key=ranks.get)
        self.rank = np.array([ranks[t] for t in tokens], np.int64)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode_tokens(self, tokens: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, one after the other."""
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.begins[tokens] - (ends - lengths), lengths)
        return self.data[at]


class Vocabulary(Tokens):
    """Tokens with a pair table for merging."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks)
        number = {t: i for i, t in enumerate(sorted(ranks, key=ranks.get))}
        self.byte_token = np.array([number[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, i in number.items():
            for cut in range(1, len(token)):
                a, b = number.get(token[:cut]), number.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = i
        self._fill_table(pairs)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The table as a dict, made where a long piece asks for it."""
        full = np.flatnonzero(self.keys >= 0)
        return dict(zip(self.keys[full].tolist(), self.values[full].tolist()))

    def _fill_table(self, pairs: dict[int, int]):
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        self.bits = max(10, int(2 * len(keys)).bit_length() + 1)
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, _NONE, np.int64)
        place = self._slot(keys)
        self.probes = 0
        while len(keys):  # linear probing: free slots are taken by one key each
            self.probes += 1
            slots, first = np.unique(place, return_index=True)
            won = first[self.keys[slots] == -1]
            self.keys[place[won]], self.values[place[won]] = keys[won], values[won]
            rest = np.ones(len(keys), dtype=bool)
            rest[won] = False
            keys, values, place = keys[rest], values[rest], (place[rest] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, or ``_NONE``."""
        keys = left << 20 | right
        place = self._slot(keys)
        found = self.keys[place]
        out = np.where(found == keys, self.values[place], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[place[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[place[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token numbers of each piece."""
        out: list = [None] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lengths > LONG_PIECE).tolist():
            out[i] = self._encode_long(pieces[i])
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= LONG_PIECE]
        at = 0
        while at < len(order):  # buckets of similar length
            width = max(1, int(lengths[order[at]]))
            most = max(width + (width >> 2), 4)
            end = at + int(np.searchsorted(lengths[order[at:]], most, "right"))
            for lo in range(at, end, max(1, MATRIX_CELLS // most)):
                rows = order[lo : min(end, lo + max(1, MATRIX_CELLS // most))]
                self._encode_matrix(pieces, rows, lengths[rows], out)
            at = end
        return out

    def _encode_matrix(self, pieces, rows, lengths, out):
        width = int(lengths.max())
        raw = np.frombuffer(b"".join(pieces[i] for i in rows.tolist()), np.uint8)
        matrix = np.full((len(rows), width), -1, np.int64)
        matrix[np.arange(width) < lengths[:, None]] = self.byte_token[raw]
        size, ids = lengths.copy(), rows
        pair = self._pairs_of(matrix, size)
        while True:
            best = pair.argmin(axis=1) if pair.shape[1] else np.zeros(len(ids), np.int64)
            line = np.arange(len(ids))
            token = pair[line, best] if pair.shape[1] else np.full(len(ids), _NONE)
            done = token == _NONE
            for i, n, tokens in zip(ids[done].tolist(), size[done].tolist(), matrix[done]):
                out[i] = tokens[:n].copy()
            if done.all():
                return
            go = ~done  # compaction: finished rows and unused columns leave
            ids, best, token, size = ids[go], best[go], token[go], size[go]
            width = int(size.max())
            matrix, pair = matrix[go][:, :width], pair[go][:, : width - 1]
            keep = np.ones(matrix.shape, dtype=bool)
            line = np.arange(len(ids))
            keep[line, best + 1] = False
            matrix[line, best] = token
            matrix = matrix[keep].reshape(len(ids), width - 1)
            kept = np.ones(pair.shape, dtype=bool)
            kept[line, best] = False
            pair = pair[kept].reshape(len(ids), width - 2)
            size = size - 1
            # only the pairs beside the merged token are new
            for shift in (-1, 0):
                at = best + shift
                ok = (at >= 0) & (at + 1 < size)
                if ok.any():
                    r, c = line[ok], at[ok]
                    pair[r, c] = self.merged(matrix[r, c], matrix[r, c + 1])

    def _pairs_of(self, matrix, size):
        if matrix.shape[1] < 2:
            return np.zeros((len(matrix), 0), np.int64)
        pair = np.full((len(matrix), matrix.shape[1] - 1), _NONE, np.int64)
        ok = np.arange(1, matrix.shape[1]) < size[:, None]
        r, c = np.nonzero(ok)
        pair[r, c] = self.merged(matrix[r, c], matrix[r, c + 1])
        return pair

    def _encode_long(self, piece: bytes) -> np.ndarray:
        """The same merges by a heap of (rank, place); a linked list skips merged places."""
        token = self.byte_token[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(token), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := pairs.get(token[i] << 20 | token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j >= n or pairs.get(token[i] << 20 | token[j]) != m:
                continue
            token[i], token[j] = m, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (x := pairs.get(m << 20 | token[after[i]])) is not None:
                    heapq.heappush(heap, (x, i))
            if (p := before[i]) >= 0 and (x := pairs.get(token[p] << 20 | m)) is not None:
                heapq.heappush(heap, (x, p))
        return np.array([t for t in token if t >= 0], np.int64)


def _encoder(vocabulary, pattern: str):
    def run(batches):
        v, find, cache = vocabulary.value, regex.compile(pattern).findall, {}
        for batch in batches:
            for lo, hi, data, offsets in W.blocks(batch.column(1)):
                ids, counts = [], []
                raw = data.tobytes()
                pieces = [find(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                if len(cache) > CACHE_PIECES:
                    cache.clear()
                new = list({p for own in pieces for p in own} - cache.keys())
                for piece, tokens in zip(new, v.encode_pieces([p.encode() for p in new])):
                    cache[piece] = v.rank[tokens].astype("<u4").tobytes()
                for own in pieces:
                    packed = b"".join([cache[p] for p in own])
                    ids.append(packed)
                    counts.append(len(packed) // 4)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    return run


def _decoder(vocabulary):
    def run(batches):
        v = vocabulary.value
        number = np.full(int(v.rank.max()) + 1, -1, np.int64)
        number[v.rank] = np.arange(len(v.rank))
        for whole in batches:
            for lo in range(0, whole.num_rows, DECODED_ROWS):
                batch, out = whole.slice(lo, DECODED_ROWS), []
                for packed in batch.column(batch.schema.get_field_index("ids")).to_pylist():
                    tokens = number[np.frombuffer(packed or b"", "<u4").astype(np.int64)]
                    if (tokens < 0).any():
                        raise ValueError("an id that the vocabulary lacks")
                    out.append(v.decode_tokens(tokens).tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: ids packed as little-endian uint32."""
    vocabulary = Shared(docs.sparkSession, Vocabulary(read_ranks(ranks_path)))
    return texts(docs, id_col, text_col).mapInArrow(lean(_encoder(vocabulary, pattern)), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``encoded`` (with packed ``ids``) and ``decoded`` (bytes)."""
    vocabulary = Shared(encoded.sparkSession, Tokens(read_ranks(ranks_path)))
    bounded_batches(encoded.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(lean(_decoder(vocabulary)), f"{fields}, decoded binary")
