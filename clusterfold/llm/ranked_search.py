"""Ranked lexical search: Block-Max MaxScore over document shards.

``build`` writes an inverted index of all documents and all their terms as a
Parquet table of shards, one row each: a shard holds about ``SHARD_BYTES`` of
whole texts, their documents in the order of their ids, and for every term a
posting list cut into blocks of ``BLOCK`` postings.  A list keeps the largest
impact of its postings (its bound, once multiplied by the term's weight) and a
block its first and last document and its own largest impact; the postings
themselves are packed to one, two or four bytes a number and are unpacked
only where a query needs them.

``search`` broadcasts a block of queries of bounded size.  Each task goes
through its shards in windows of ``WINDOW`` documents.  The query's lists are
ordered by their bounds; the longest prefix whose bounds add up to less than
the score of the worst kept document is not essential.  The documents of the
essential lists are candidates; the non-essential lists follow from the
highest bound down, and a candidate whose score, block maximum and remaining
bounds stay below that score is rejected before the block is unpacked.  A task
returns at most ``k`` documents a query, and these heaps are merged.

Results are exact, in 64-bit integers: a posting's impact is
``(10^9 * tf) div (1000 * tf + 8 * m)`` with ``m = 100 - b + (b * n * N) div L``
and a term's weight ``floor(1000 * ln((2N + 2) / (2df + 1)))``.  Documents
with equal scores are ordered by ascending id, null ids last.

Defined results: a null or empty text has no terms; it counts neither in N nor
in any list.  Repeated rows are documents of their own, and so are repeated
query rows (two rows with one id give two lists).  A query without terms, or
whose terms no document holds, returns nothing, and so does an empty table.
A text longer than a shard is a shard of its own.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clusterfold.llm import words as W
from clusterfold.llm.frames import Shared, bounded_batches, removed, saved, texts
from clusterfold.session import checkpoint_dir

SHARD_BYTES = 8 << 20
BLOCK = 64
WINDOW = 2048
#: Queries that are broadcast at once: so many terms, with repeats.
QUERY_TERMS = 200_000

INDEX = ("shard long, n_docs int, ids binary, nulls binary, norms binary, terms array<binary>, df array<int>, widths binary, "
         "block_low binary, block_high binary, block_top binary, packed binary")


# ---- terms and weights -------------------------------------------------------------


def term_array(data: np.ndarray, words: W.Words) -> pa.Array:
    """The words' bytes, one Arrow value each (their bytes stand one after
    another once everything between words is left out)."""
    size = words.ends - words.starts
    change = np.zeros(len(data) + 1, np.int8)
    change[words.starts] += 1
    change[words.ends] -= 1
    body = data[np.cumsum(change[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def _terms(text: bytes) -> list[bytes]:
    low = W.LOWER[np.frombuffer(text, np.uint8)]
    words = W.scan(low, np.array([0, len(low)]), W.ALNUM)
    raw = low.tobytes()
    return [raw[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]


def norms(sizes: np.ndarray, n_docs: int, n_terms: int, b: int) -> np.ndarray:
    """Each document's m from its number of terms, in exact integers."""
    if not len(sizes):
        return sizes.astype(np.int64)
    if b * int(sizes.max()) * n_docs < 1 << 62:
        return 100 - b + (b * sizes.astype(np.int64) * n_docs) // max(1, n_terms)
    return np.array([100 - b + (b * n * n_docs) // max(1, n_terms) for n in sizes.tolist()], np.int64)


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ---- building ----------------------------------------------------------------------


def counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """(N: documents with a term, L: all their terms)."""

    def run(batches):
        n_docs = n_terms = 0
        for batch in batches:
            for _, _, data, offsets in W.blocks(batch.column(0)):
                found = W.scan(W.LOWER[data], offsets, W.ALNUM).counts
                n_docs, n_terms = n_docs + int((found > 0).sum()), n_terms + int(found.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names=["n", "l"])

    own = texts(docs, id_col, text_col).select("text").mapInArrow(run, "n long, l long")
    total = own.agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return int(total["n"] or 0), int(total["l"] or 0)


def _pack(values: np.ndarray, lists: np.ndarray, place: np.ndarray, width: np.ndarray, start: np.ndarray, out: np.ndarray) -> None:
    """Write each posting's number into its list's region of ``out``."""
    at, size = start[lists] + place * width[lists], width[lists]
    for byte in range(4):
        some = size > byte
        out[at[some] + byte] = (values[some] >> (8 * byte)) & 255


def _width(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4)).astype(np.int64)


def _shard(parts: list[tuple], number: int, n_docs: int, n_terms: int, b: int) -> dict:
    """One index row from texts given as (ids, nulls, bytes, sizes in bytes)."""
    ids, nulls, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
    data = W.LOWER[np.concatenate([p[2] for p in parts])]
    words = W.scan(data, np.concatenate([[0], np.cumsum(sizes)]), W.ALNUM)
    order = np.lexsort((ids, nulls))  # by id, null ids last
    local = np.empty(len(ids), np.int64)
    local[order] = np.arange(len(ids))
    norm = norms(words.counts[order], n_docs, n_terms, b)
    coded = term_array(data, words).dictionary_encode()
    n_lists = len(coded.dictionary)
    code = coded.indices.to_numpy().astype(np.int64)
    postings, tf = np.unique(code * len(ids) + local[words.text_of()], return_counts=True)
    lists, doc = postings // max(1, len(ids)), postings % max(1, len(ids))
    df = np.bincount(lists, minlength=n_lists)
    begins = np.concatenate([[0], np.cumsum(df)])
    place = np.arange(len(lists)) - begins[lists]
    impact = impacts(tf, norm[doc])
    n_blocks = -(-df // BLOCK)
    first = np.concatenate([[0], np.cumsum(n_blocks)])
    block = first[lists] + place // BLOCK
    heads = np.flatnonzero(place % BLOCK == 0)
    low = doc[heads]
    offset = doc - low[block] if len(doc) else doc
    most = np.zeros(n_lists, np.int64)
    np.maximum.at(most, lists, offset)
    wide_doc = _width(most)
    most[:] = 0
    np.maximum.at(most, lists, tf)
    wide_tf = _width(most)
    region = df * (wide_doc + wide_tf)
    starts = np.concatenate([[0], np.cumsum(region)])
    packed = np.zeros(int(starts[-1]), np.uint8)
    _pack(offset, lists, place, wide_doc, starts[:-1], packed)
    _pack(tf, lists, place, wide_tf, starts[:-1] + df * wide_doc, packed)
    tails = np.append(heads[1:], len(doc)) - 1 if len(doc) else heads
    block_top = np.maximum.reduceat(impact, heads) if len(heads) else impact
    return {
        "shard": number, "n_docs": len(ids), "ids": ids[order].tobytes(), "nulls": nulls[order].tobytes(), "norms": norm.tobytes(),
        "terms": coded.dictionary.cast(pa.binary()), "df": df, "widths": np.stack([wide_doc, wide_tf]).astype(np.uint8).tobytes(),
        "block_low": low.astype(np.int32).tobytes(), "block_high": doc[tails].astype(np.int32).tobytes(),
        "block_top": block_top.astype(np.int32).tobytes(), "packed": packed.tobytes(),
    }


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32())}


def _row(shard: dict) -> pa.RecordBatch:
    names, columns = [], []
    for field in INDEX.split(", "):
        name, kind = field.split(" ")
        value = shard[name]
        if kind.startswith("array"):
            inner = _KINDS[kind].value_type
            value = value if isinstance(value, pa.Array) else pa.array(value, inner)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value))
        else:
            columns.append(pa.array([value], _KINDS[kind]))
        names.append(name)
    return pa.RecordBatch.from_arrays(columns, names=names)


class Index:
    """A written index: its folder and the corpus statistics behind its impacts."""

    def __init__(self, spark: SparkSession, folder: str, n_docs: int, n_terms: int):
        self.spark, self.folder, self.n_docs, self.n_terms = spark, folder, n_docs, n_terms

    def shards(self) -> DataFrame:
        bounded_batches(self.spark)
        return self.spark.read.schema(INDEX).parquet(self.folder)

    def remove(self) -> None:
        removed(self.spark, self.folder)


def build(docs: DataFrame, folder: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", b: int = 75, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index of all documents.  ``folder`` is a shared folder that does not
    exist yet (without one, a new one below the checkpoint folder); ``b`` (0 to
    100) is how far a document's length counts."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/search-index-{uuid.uuid4().hex}"
    n_docs, n_terms = counts(docs, id_col=id_col, text_col=text_col)

    def run(batches):
        part, number, parts, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            ids = batch.column(0)
            nulls = np.array(ids.is_null())
            known = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in W.blocks(batch.column(1), shard_bytes):
                if parts and held + len(data) > shard_bytes:
                    yield _row(_shard(parts, part << 33 | number, n_docs, n_terms, b))
                    number, parts, held = number + 1, [], 0
                parts.append((known[lo:hi], nulls[lo:hi], data.copy(), np.diff(offsets)))
                held += len(data)
        if parts:
            yield _row(_shard(parts, part << 33 | number, n_docs, n_terms, b))

    # rows are large: the writer looks at its row group after each of them
    wide = {"parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
    texts(docs, id_col, text_col).mapInArrow(run, INDEX).write.options(**wide).parquet(folder)
    return Index(spark, folder, n_docs, n_terms)


# ---- searching ---------------------------------------------------------------------


class _Lists:
    """A shard's row while queries run on it; blocks are unpacked at first use."""

    def __init__(self, row: dict):
        self.n_docs = row["n_docs"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.norms = np.frombuffer(row["norms"], np.int64)
        self.lookup, self.df = row["terms"], row["df"]
        self.widths = np.frombuffer(row["widths"], np.uint8).reshape(2, -1)
        # where each list's blocks and bytes begin
        self.first = np.concatenate([[0], np.cumsum(-(-self.df // BLOCK))])
        self.starts = np.concatenate([[0], np.cumsum(self.df * self.widths.sum(axis=0, dtype=np.int64))])
        self.low, self.high = np.frombuffer(row["block_low"], np.int32), np.frombuffer(row["block_high"], np.int32)
        self.block_top = np.frombuffer(row["block_top"], np.int32)
        self.packed = np.frombuffer(row["packed"], np.uint8)
        self.open: dict[int, "_List"] = {}
        self.unpacked = 0

    def of(self, term: bytes) -> "_List | None":
        t = self.lookup.get(term)
        if t is None:
            return None
        if t not in self.open:
            self.open[t] = _List(self, t)
        return self.open[t]


class _List:
    """A posting list: ``docs`` ascends even while blocks are still packed
    (there every entry is its block's first document)."""

    def __init__(self, shard: _Lists, t: int):
        n, (a, b), at = int(shard.df[t]), shard.widths[:, t].tolist(), int(shard.starts[t])
        f, g = int(shard.first[t]), int(shard.first[t + 1])
        self.low, self.high, self.tops = (v[f:g].astype(np.int64) for v in (shard.low, shard.high, shard.block_top))
        self.shard, self.top = shard, int(self.tops.max())
        kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32}
        self.offsets = shard.packed[at : at + n * a].view(kinds[a])
        self.tf = shard.packed[at + n * a : at + n * (a + b)].view(kinds[b])
        self.docs = np.repeat(self.low, BLOCK)[:n]
        self.impact = np.zeros(n, np.int64)
        self.closed = np.ones(g - f, bool)

    def unpack(self, blocks: np.ndarray) -> None:
        blocks = blocks[self.closed[blocks]]
        if not len(blocks):
            return
        self.closed[blocks] = False
        self.shard.unpacked += len(blocks)
        at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < len(self.docs)]
        self.docs[at] += self.offsets[at]
        self.impact[at] = impacts(self.tf[at].astype(np.int64), self.shard.norms[self.docs[at]])

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of ``lo <= document < hi``, unpacked."""
        a, b = np.searchsorted(self.high, lo), np.searchsorted(self.low, hi)
        self.unpack(np.arange(a, b))
        i, j = np.searchsorted(self.docs, (lo, hi))
        return self.docs[i:j], self.impact[i:j]


class _Heap:
    """The best ``k`` documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, []  # (-score, null id, id)

    def least(self) -> int:
        """A document below this score cannot enter; one at it can, by its id."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, score: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        best = np.argsort(-score, kind="stable")[: self.k]  # documents come by ascending id
        new = zip((-score[best]).tolist(), nulls[best].tolist(), ids[best].tolist())
        self.rows = sorted([*self.rows, *new])[: self.k]


def _score_window(lists: list[tuple[int, _List]], bounds: np.ndarray, lo: int, hi: int, shard: _Lists, heap: _Heap) -> None:
    """One query on documents ``lo..hi`` of a shard; ``lists`` are (weight,
    list) by ascending bound, ``bounds`` their running sums from 0."""
    least = heap.least()
    cold = int(np.searchsorted(bounds[1:], least))  # non-essential: together below the least score
    if cold == len(lists):
        return
    total, seen = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, bool)
    for w, own in lists[cold:]:
        docs, impact = own.between(lo, hi)
        total[docs - lo] += w * impact
        seen[docs - lo] = True
    found = np.flatnonzero(seen & (total + bounds[cold] >= least))
    score = total[found]
    for j in range(cold - 1, -1, -1):
        if not len(found):
            return
        w, own = lists[j]
        block = np.searchsorted(own.low, found + lo, "right") - 1
        held = (block >= 0) & (own.high[block] >= found + lo)
        possible = score + np.where(held, w * own.tops[block], 0) + bounds[j]
        alive = possible >= least
        found, score, block, held = found[alive], score[alive], block[alive], held[alive]
        own.unpack(np.unique(block[held]))
        at = np.minimum(np.searchsorted(own.docs, found + lo), len(own.docs) - 1)
        score = score + np.where(held & (own.docs[at] == found + lo), w * own.impact[at], 0)
    good = score >= least
    if good.any():
        at = found[good] + lo
        heap.add(score[good], shard.nulls[at], shard.ids[at])


class _Queries:
    """A block of queries: their terms' weights times their repeats."""

    def __init__(self, queries: list[tuple[int, list[bytes]]], weights: dict[bytes, int]):
        self.terms = {q: [(weights[t], n, t) for t, n in Counter(terms).items() if weights.get(t, 0) > 0] for q, terms in queries}
        self.vocabulary = pa.array(sorted({t for terms in self.terms.values() for _, _, t in terms}), pa.binary())


def _held(terms: pa.Array, wanted: pa.Array) -> tuple[list[bytes], list[int]]:
    """The wanted ones among a shard's terms, and their places."""
    places = pc.indices_nonzero(pc.is_in(terms, value_set=wanted))
    return terms.take(places).to_pylist(), places.to_pylist()


def _searching(shared: Shared, k: int):
    def run(batches):
        queries = shared.value
        heaps = {q: _Heap(k) for q in queries.terms}
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(j)[r] for j, name in enumerate(batch.schema.names)}
                values = {name: v.as_py() for name, v in row.items() if name not in ("terms", "df")}
                values["df"] = row["df"].values.to_numpy().astype(np.int64)
                values["terms"] = dict(zip(*_held(row["terms"].values, queries.vocabulary)))
                _search_shard(_Lists(values), queries, heaps)
        out = [(q, None if null else i, -score) for q, heap in heaps.items() for score, null, i in heap.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], names=["query", "doc_id", "score"])

    return run


def _search_shard(shard: _Lists, queries: _Queries, heaps: dict[int, _Heap]) -> None:
    for q, terms in queries.terms.items():
        lists = [(w * n, own) for w, n, t in terms if (own := shard.of(t)) is not None]
        lists.sort(key=lambda x: x[0] * x[1].top)
        bounds = np.concatenate([[0], np.cumsum([w * own.top for w, own in lists], dtype=np.int64)]).astype(np.int64)
        for lo in range(0, shard.n_docs if lists else 0, WINDOW):
            _score_window(lists, bounds, lo, min(lo + WINDOW, shard.n_docs), shard, heaps[q])


def _blocks(queries: DataFrame, most: int):
    """(query number, terms) of the numbered queries, one bounded block at a time."""
    block, held = [], 0
    for row in queries.select("query", "text").toLocalIterator(prefetchPartitions=False):
        terms = _terms((row["text"] or "").encode())
        if block and held + len(terms) > most:
            yield block
            block, held = [], 0
        block.append((row["query"], terms))
        held += len(terms)
    if block:
        yield block


def _weights(index: Index, wanted: set[bytes]) -> dict[bytes, int]:
    """Weights of the wanted terms by their frequency in the whole index: only
    two columns of it are read, and at most one row a term comes back."""
    shared = Shared(index.spark, pa.array(sorted(wanted), pa.binary()))

    def run(batches):
        for batch in batches:
            terms, df = (column.flatten() for column in batch.columns)
            some = pc.is_in(terms, value_set=shared.value)
            yield pa.RecordBatch.from_arrays([terms.filter(some), df.filter(some).cast(pa.int64())], names=["term", "df"])

    found = index.shards().select("terms", "df").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): weight(r["df"], index.n_docs) for r in found.collect()}


def search(index: Index, queries: DataFrame, k: int = 10, *, id_col: str = "item_id", text_col: str = "text", most_terms: int = QUERY_TERMS) -> DataFrame:
    """``item, rank, doc_id, score``: each query row's ``k`` best documents
    with a score above 0; saved, at most ``k`` rows a query."""
    spark = index.spark
    # numbered once, so that blocks, tasks and the final join agree
    own = saved(queries.select(F.monotonically_increasing_id().alias("query"), F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")))
    best = None
    for block in _blocks(own, most_terms):
        weights = _weights(index, {t for _, terms in block for t in terms})
        shared = Shared(spark, _Queries(block, weights))
        heaps = index.shards().mapInArrow(_searching(shared, k), "query long, doc_id long, score long")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        merged = saved(heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        best = merged if best is None else best.unionByName(merged)
    if best is None:
        best = spark.createDataFrame([], "query long, doc_id long, score long, rank int")
    return own.select("query", "item").join(best, "query").select("item", "rank", "doc_id", "score")


def rank(docs: DataFrame, queries: DataFrame, k: int = 10, *, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", b: int = 75) -> DataFrame:
    """Build an index, search it and remove it again."""
    index = build(docs, id_col=id_col, text_col=text_col, b=b)
    try:
        return search(index, queries, k, id_col=item_col, text_col=item_text_col)
    finally:
        index.remove()
