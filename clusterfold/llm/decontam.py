"""Benchmark decontamination.

Words are maximal runs of ASCII letters (lower-cased), ASCII digits and
non-ASCII characters.  A benchmark window is ``size`` consecutive words of
one item; an item with fewer words is one window.  The windows' hashes are
broadcast; every document's windows are scanned against them in numpy, hits
are verified word by word against the item's text, and the words covered by
verified hits can be cut out (``remove_spans``) or their documents dropped
(``drop_contaminated``).

The broadcast is bounded: a block holds at most ``BLOCK_WINDOWS`` windows and
``BLOCK_TEXT`` bytes of benchmark text (a larger item is cut into overlapping
parts), and a larger benchmark is processed block by block, the documents'
hits being united afterwards.

Defined results: null and empty texts have no words and no hits; items
without words have no window; repeated items count once per distinct
``item_id``; null item ids are ignored; repeated document rows are judged
each on its own.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared, bounded_batches, saved

SIZE = 10
BLOCK_WINDOWS = 1 << 20
BLOCK_TEXT = 32 << 20

HITS = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"


class WindowSet:
    """Windows of some benchmark items, by window length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.size = size
        found: dict[int, dict[int, list[tuple[bytes, str]]]] = {}
        for item, text in items:
            low = W.LOWER[np.frombuffer(text, np.uint8)]
            offsets = np.array([0, len(low)])
            words = W.scan(low, offsets, W.ALNUM)
            n = len(words.starts)
            if not n:
                continue
            length = min(n, size)
            starts = W.window_starts(words, length)
            raw = low.tobytes()
            parts = [raw[a:b] for a, b in zip(words.starts, words.ends)]
            for at, key in zip(starts.tolist(), W.window_hashes(W.word_hashes(low, words), starts, length).tolist()):
                window = b" ".join(parts[at : at + length])
                here = found.setdefault(length, {}).setdefault(key, [])
                if (window, item) not in here:
                    here.append((window, item))
        self.by_length = {}
        for length, keys in found.items():
            ordered = np.array(sorted(keys), dtype=W.U64)
            bits = max(16, min(24, len(ordered).bit_length() + 6))
            seen = np.zeros(1 << bits, dtype=bool)
            seen[ordered >> W.U64(64 - bits)] = True
            self.by_length[length] = (bits, seen, ordered, keys)

    def hits(self, data: np.ndarray, words: W.Words, hashes: np.ndarray):
        """(start word, window length, item ids) of each verified hit."""
        raw = None
        for length, (bits, seen, ordered, keys) in self.by_length.items():
            starts = W.window_starts(words, length)
            found = W.window_hashes(hashes, starts, length)
            near = np.flatnonzero(seen[found >> W.U64(64 - bits)])
            place = np.minimum(np.searchsorted(ordered, found[near]), len(ordered) - 1)
            near = near[ordered[place] == found[near]]
            for at, key in zip(starts[near].tolist(), found[near].tolist()):
                raw = data.tobytes() if raw is None else raw
                text = b" ".join(raw[a:b] for a, b in zip(words.starts[at : at + length].tolist(), words.ends[at : at + length].tolist()))
                items = [item for window, item in keys[key] if window == text]
                if items:
                    yield at, length, items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int):
    """Benchmark items in blocks of bounded size, read one block at a time."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                            F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).where("item is not null")
    block, n_windows, n_bytes = [], 0, 0
    for row in rows.toLocalIterator(prefetchPartitions=False):
        whole = row["text"].encode()
        low = W.LOWER[np.frombuffer(whole, np.uint8)]
        words = W.scan(low, np.array([0, len(low)]), W.ALNUM)
        n, step = len(words.starts), BLOCK_WINDOWS // 4
        for at in range(0, max(1, n - size + 1), step):
            last = min(n, at + step + size - 1)
            part = whole[words.starts[at] : words.ends[last - 1]] if n else b""
            if block and (n_windows + last - at > BLOCK_WINDOWS or n_bytes + len(part) > BLOCK_TEXT):
                yield block
                block, n_windows, n_bytes = [], 0, 0
            block.append((row["item"], part))
            n_windows, n_bytes = n_windows + last - at, n_bytes + len(part)
    if block:
        yield block


def _found(words: W.Words, hits, n_texts: int):
    spans: list[list[dict]] = [[] for _ in range(n_texts)]
    items: list[set] = [set() for _ in range(n_texts)]
    text_of = None
    for at, length, ids in sorted(hits, key=lambda h: h[:2]):
        text_of = words.text_of() if text_of is None else text_of
        k = int(text_of[at])
        start = at - int(words.first[k])
        if spans[k] and start <= spans[k][-1]["end"]:
            spans[k][-1]["end"] = max(spans[k][-1]["end"], start + length)
        else:
            spans[k].append({"start": start, "end": start + length})
        items[k].update(ids)
    return spans, [sorted(x) for x in items]


def _scan_with(windows):
    """Append word count, hit spans and items to batches whose ``text`` is scanned."""

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            counts, spans, items = [], [], []
            for lo, hi, data, offsets in W.blocks(column):
                low = W.LOWER[data]
                words = W.scan(low, offsets, W.ALNUM)
                found = windows.value.hits(low, words, W.word_hashes(low, words))
                s, i = _found(words, found, hi - lo)
                counts += words.counts.tolist()
                spans += s
                items += i
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")), column, pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                names=["row", "text", "n_words", "spans", "items"])

    return run


def _union_spans(lists):
    """Disjoint word spans from several blocks' spans of one text."""
    every = F.array_sort(F.flatten(lists))

    def add(done, s):
        last = F.try_element_at(done, F.lit(-1))
        joins = F.coalesce(last["end"] >= s["start"], F.lit(False))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(joins, grown).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(every, F.slice(every, 1, 0), add)


def scan(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``row`` (struct of the document's own columns), ``n_words``, ``spans``
    (disjoint hit word ranges, end exclusive) and ``items`` (sorted ids of the
    items with an occurring window)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    own, out = found.schema, None
    blocks = _blocks(benchmark, item_col, item_text_col, size)
    for block in chain([next(blocks, [])], blocks):  # an empty benchmark is one empty block
        windows = Shared(spark, WindowSet(block, size))
        if out is None:
            out = found.mapInArrow(_scan_with(windows), _schema(own))
            continue
        # a further block: the hits so far are saved, so that one block's
        # windows at a time are held by the executors
        before = saved(out).select(F.struct("row", "spans", "items").alias("row"), "text")
        out = before.mapInArrow(_scan_with(windows), _schema(before.schema)).select(
            F.col("row.row").alias("row"), "text", "n_words",
            _union_spans(F.array("row.spans", "spans")).alias("spans"),
            F.array_sort(F.array_union("row.items", "items")).alias("items"))
    return out


def _schema(own: T.StructType) -> T.StructType:
    return T.StructType([*own.fields, *T._parse_datatype_string(HITS).fields])


def n_hit():
    """Hit words, from ``spans``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any hit, columns unchanged."""
    return scan(docs, benchmark, **options).where(F.size("spans") == 0).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents, the hit words cut out of their texts (the characters
    between two hit words go as well; other characters stay)."""
    found = scan(docs, benchmark, text_col=text_col, **options)
    bounded_batches(docs.sparkSession)
    cut = found.mapInArrow(_cut, found.schema)
    return cut.select(*[F.when(F.size("spans") > 0, F.col("text")).otherwise(F.col(f"row.`{c}`").cast("string")).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _cut(batches):
    for batch in batches:
        texts, spans = batch.column(1).to_pylist(), batch.column(3).to_pylist()
        for k, own in enumerate(spans):
            if own:
                raw = np.frombuffer(texts[k].encode(), np.uint8)
                words = W.scan(W.LOWER[raw], np.array([0, len(raw)]), W.ALNUM)
                stay = np.ones(len(raw), dtype=bool)
                for s in own:
                    stay[words.starts[s["start"]] : words.ends[s["end"] - 1]] = False
                texts[k] = raw[stay].tobytes().decode()
        columns = list(batch.columns)
        columns[1] = pa.array(texts, batch.schema.field(1).type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
