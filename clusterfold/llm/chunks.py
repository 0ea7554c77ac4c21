"""Chunks of whole texts, and an exchange of keys between them.

``chunk_table`` packs documents into rows of about two megabytes (compressed,
written once to the shared folder), so that a chunk is the same on every
read.  ``exchange`` sends each chunk's distinct 64- or 32-bit keys to buckets
of the key space, where all chunks' entries of a key meet, and returns to
each chunk one answer per key it sent.  A key that a third of all documents
hold is sent once per chunk, not once per row: the pre-aggregation that keeps
a hot key from filling a bucket.  The number of buckets follows the data, so
a bucket holds about ``BUCKET_KEYS`` keys at any size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterfold.llm import words as W
from clusterfold.llm.frames import bounded_batches, give_back, lean, saved, setting, texts

BUCKET_KEYS = 2_000_000
CHUNK_BYTES = 2 << 20
PART_BYTES = 64 << 20  # of text in a partition of a dealt table, at most about
NULL_ID = (1 << 63) - 1  # a null id counts as the largest

CHUNK = "chunk long, n_bytes long, ids binary, nulls binary, marks binary, sizes binary, blob binary"


def _pack(batches):
    part, number = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        ids = batch.column(0)
        nulls = np.array(ids.is_null())
        known = ids.fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        marks = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        rows = []
        for lo, hi, data, offsets in W.blocks(batch.column(1), CHUNK_BYTES):
            order = np.argsort(known[lo:hi], kind="stable")  # by id, for the answers
            sizes = np.diff(offsets)[order]
            raw = data.tobytes()
            blob = b"".join([raw[offsets[i] : offsets[i + 1]] for i in order.tolist()])
            rows.append((part << 33 | number, len(blob), known[lo:hi][order].tobytes(), nulls[lo:hi][order].tobytes(), marks[lo:hi][order].tobytes(), sizes.astype(np.int64).tobytes(), squeeze(blob)))
            number += 1
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["chunk", "n_bytes", "ids", "nulls", "marks", "sizes", "blob"])


def packed(docs: DataFrame, id_col: str, text_col: str, mark=None) -> DataFrame:
    """Documents in chunks, not yet saved.  ``mark`` is a boolean column of
    the operator (an expression of ``doc_id``), such as "is a training row"."""
    own = texts(docs, id_col, text_col).withColumn("mark", F.coalesce(F.lit(False) if mark is None else mark, F.lit(False)))
    return own.mapInArrow(_pack, CHUNK)


def chunk_table(docs: DataFrame, id_col: str, text_col: str, mark=None) -> DataFrame:
    """:func:`packed`, saved: a chunk's rows and their order are fixed."""
    return saved(packed(docs, id_col, text_col, mark))


def dealt(df: DataFrame, n: int) -> DataFrame:
    """Rows in ``n`` partitions by chunk, saved: such tables join by chunk
    without another exchange.  Spark remembers how a checkpoint is dealt only
    if its plan was not adaptive."""
    with setting(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
        return saved(df.repartition(n, "chunk").sortWithinPartitions("chunk"))


class Chunk:
    """One row of the chunk table; texts are in the order of their ids."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.marks = np.frombuffer(row["marks"], bool)
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int64))])
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=max(1, row["n_bytes"])), np.uint8)
        self.replies = row.get("replies")

    def id_list(self) -> list:
        return [None if null else int(i) for i, null in zip(self.ids, self.nulls)]

    def rank(self) -> np.ndarray:
        """Each text's place among the chunk's distinct ids."""
        return np.concatenate([[0], np.cumsum(self.ids[1:] != self.ids[:-1])]) if len(self.ids) else self.ids


def rows_of(batches):
    """The rows of Arrow batches, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(j)[k].as_py() for j, name in enumerate(batch.schema.names)}


def by_bucket(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, first place, end) of ascending keys: buckets are ranges of the key space."""
    high = (keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, high[1:] != high[:-1])[: len(keys)])
    return high[first].astype(np.int64), first, np.append(first[1:], len(keys))[: len(first)]


def buckets_for(chunks: DataFrame, bytes_per_key: float) -> int:
    total = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return max(1, int(total / bytes_per_key / BUCKET_KEYS) + 1)


def partitions_for(chunks: DataFrame) -> int:
    """Partitions of the dealt tables: the session's number, more where that makes them too large."""
    total = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PART_BYTES + 1)


def exchange(chunks: DataFrame, send: Callable, answer: Callable) -> DataFrame:
    """``chunk, answers`` after one exchange.

    ``send(chunk)`` yields (bucket, list of byte strings).  ``answer(parts)``
    gets a bucket's lists, one per chunk, and returns one byte string for
    each.  ``answers`` is an array of (bucket, reply)."""
    return gathered(replies(chunks, send, answer))


def gathered(found: DataFrame) -> DataFrame:
    """Each chunk's replies in one row."""
    return found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "reply")).alias("answers"))


def gathered_dealt(found: DataFrame, n: int) -> DataFrame:
    """:func:`gathered`, beside the chunks of a table dealt into ``n`` partitions."""
    with setting(found.sparkSession, "spark.sql.adaptive.enabled", "false"):
        return saved(gathered(found.repartition(n, "chunk")).sortWithinPartitions("chunk"))


def replies(chunks: DataFrame, send: Callable, answer: Callable, tally: Callable | None = None, kind: Callable = Chunk) -> DataFrame:
    """``chunk, bucket, reply, tally``: as :func:`exchange`; ``tally(parts)``
    is a byte string for the bucket, carried by one of its rows; ``kind``
    makes a chunk of a row."""
    bounded_batches(chunks.sparkSession)

    def sending(batches):
        for row in rows_of(batches):
            chunk = kind(row)
            sent = [(bucket, parts) for bucket, parts in send(chunk)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in sent], pa.int32()), pa.array([chunk.number] * len(sent), pa.int64()), pa.array([p for _, p in sent], pa.list_(pa.binary()))],
                names=["bucket", "chunk", "parts"])

    def answering(table: pa.Table) -> pa.Table:
        parts = [p for block in table.column("parts").chunks for p in block.to_pylist()]
        notes: list = [None] * len(parts)
        notes[0] = tally(parts) if tally else None
        found = pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "reply": pa.array(answer(parts), pa.binary()), "tally": pa.array(notes, pa.binary())})
        del parts
        give_back()
        return found

    sent = chunks.mapInArrow(lean(sending, False), "bucket int, chunk long, parts array<binary>")
    return sent.groupBy("bucket").applyInArrow(answering, "chunk long, bucket int, reply binary, tally binary")


def with_replies(chunks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Chunks with ``replies``: a list of each exchange's answers."""
    names, columns = [], chunks.columns
    for k, own in enumerate(answers):
        chunks = chunks.join(own.withColumnRenamed("answers", f"_answers{k}").hint("merge"), "chunk", "left")
        names.append(F.coalesce(F.col(f"_answers{k}"), F.array().cast("array<struct<bucket:int,reply:binary>>")))
    return chunks.select(*columns, F.array(*names).alias("replies"))


def flags_of(replies: list[dict], found: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The answered bit of each ascending key (replies hold packed bits)."""
    out = np.zeros(int(end[-1]) if len(end) else 0, dtype=bool)
    by = {r["bucket"]: r["reply"] for r in replies}
    for bucket, lo, hi in zip(found.tolist(), first.tolist(), end.tolist()):
        bits = np.unpackbits(np.frombuffer(by[bucket], np.uint8), bitorder="little")
        out[lo:hi] = bits[: hi - lo]
    return out


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags, bitorder="little").tobytes()
