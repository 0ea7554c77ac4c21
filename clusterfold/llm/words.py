"""Vectorised word scanning of Arrow string batches.

The helpers here work on the UTF-8 buffer of a batch as one byte array:
word boundaries, word hashes and hashes of word windows come from a few
numpy passes, without a Python object per word.  Callers cut a batch into
blocks (:func:`blocks`) so that the working set stays at a few megabytes
whatever the batch holds; a single text longer than a block is one block.

Word hashes are 64-bit sums of per-byte random values times odd powers,
followed by a bijective finaliser.  Callers that need exact equality compare
the bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 20
HASHED_BYTES = 1 << 17  # hashed at once: eight times that stays in a processor's cache

# The splitmix64 finaliser's constants.
_M1, _M2, _GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_STEP = 0x5851F42D4C957F2D  # odd multiplier of the positional powers
_STEP_INV = pow(_STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= _M1
    x ^= x >> U64(27)
    x *= _M2
    x ^= x >> U64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * _GOLDEN)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

#: words ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing)
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _power(name: str, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        base = _STEP if name == "up" else _STEP_INV
        steps = np.full(max(4096, 1 << int(n - 1).bit_length()), base, dtype=U64)
        steps[0] = 1
        grown = np.cumprod(steps, dtype=U64)
        if n > 4 * BLOCK_BYTES:  # a very long text: not kept
            return grown
        _powers[name] = grown
    return _powers[name]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(column.buffers()[1], dtype=width)
    offsets = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def cuts(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes together, or one text."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def blocks(column: pa.Array, limit: int = BLOCK_BYTES):
    """(first text, last text + 1, bytes, offsets) for each block."""
    data, offsets = text_bytes(column)
    for lo, hi in cuts(offsets, limit):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


@dataclass
class Words:
    """Words of a block: byte ranges, and each text's first word."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # texts + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def scan(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of the texts; ``data`` is already mapped to its lower case if wanted."""
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = is_word[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return Words(starts, ends, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A word's hash does not depend on its place: stretches of words are hashed by themselves."""
    out, lo = np.empty(len(words.starts), dtype=U64), 0
    while lo < len(out):
        base = int(words.starts[lo])
        hi = int(np.searchsorted(words.starts, base + HASHED_BYTES))
        starts, ends = words.starts[lo:hi] - base, words.ends[lo:hi] - base
        n = int(ends[-1])
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(_BYTE_VALUE[data[base : base + n]] * _power("up", n)[:n], out=total[1:])
        out[lo:hi] = mix((total[ends] - total[starts]) * _power("down", n)[starts] + (ends - starts).astype(U64))
        lo = hi
    return out


def window_starts(words: Words, size: int) -> np.ndarray:
    """Word positions at which ``size`` words of one text stand."""
    last = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(len(words.starts)) + size <= last)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each start."""
    n = len(hashes) - size + 1
    if n <= 0 or not len(starts):
        return np.zeros(0, dtype=U64)
    total, factor = np.zeros(n, dtype=U64), 1
    for k in range(size):
        total += hashes[k : k + n] * U64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    return mix(total[starts])


def covered(flags: np.ndarray, starts: np.ndarray, size: int, n_words: int) -> np.ndarray:
    """Words inside any flagged window of ``size`` words."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    hit = starts[flags]
    np.add.at(change, hit, 1)
    np.add.at(change, np.minimum(hit + size, n_words), -1)
    return np.cumsum(change[:-1]) > 0


def per_text(words: Words, values: np.ndarray) -> np.ndarray:
    """Sum of a value per word, for each text."""
    total = np.zeros(len(values) + 1, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[words.first[1:]] - total[words.first[:-1]]
