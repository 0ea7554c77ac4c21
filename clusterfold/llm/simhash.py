"""SimHash near-duplicate detection.

A text's words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) form shingles of
``shingle`` words; a fingerprint bit is set if it is set in over half of the
shingles' XXH64 values (seed 42).  Equal fingerprints are one node.  Distinct
fingerprints are laid out in tiles: a cell is the pair of population counts
of the two 32-bit halves, and a cell's fingerprints are split by hash into
tiles of about ``TILE`` rows.  Tile pairs whose population counts differ by
more than the radius are skipped (they never meet in the join); all others
are compared exactly, by numpy exclusive-or and bit counts.

Of a tile pair's links only a spanning forest leaves the task, so a group of
near copies yields links in proportion to its size; no link between
different fingerprints is lost for the components.

Defined results: a null text is empty; a text without words has fingerprint
zero and is linked like any other; a text of fewer words than a shingle is
one shingle; repeated rows share their fingerprint's component; null ids
count as the largest id, and a component of null ids only has a null
``component_id``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterfold.llm import words as W
from clusterfold.llm.components import components
from clusterfold.llm.frames import bounded_batches, saved, texts

SEED = 42
TILE = 16384
SUB = 256  # rows of a tile that meet the other tile at once


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # on bytes: ASCII only, as the word rule
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return [digest(b" ".join(words), SEED)] if words else []
    join = b" ".join
    return [digest(join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)))]


def fingerprints_of(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of ``counts`` hashes."""
    out = np.zeros(len(counts), dtype="<u8")
    full = np.flatnonzero(counts)
    if len(full):
        ends = np.cumsum(counts)
        begins = ends - counts
        ones = np.zeros((len(full), 64), dtype=np.int64)
        limit = 1 << 15
        for k, i in enumerate(full.tolist()):  # long texts in slices
            for lo in range(int(begins[i]), int(ends[i]), limit):
                part = hashes[lo : min(lo + limit, int(ends[i]))]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones[k] += bits.sum(axis=0, dtype=np.int64)
        set_ = ones * 2 > counts[full][:, None]
        out[full] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _fingerprint_batches(shingle: int):
    def run(batches):
        for batch in batches:
            found = []
            for _, _, data, offsets in W.blocks(batch.column(1)):
                raw = data.tobytes()
                lists = [shingle_hashes(raw[a:b], shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                counts = np.fromiter(map(len, lists), np.int64, len(lists))
                flat = np.fromiter((h for own in lists for h in own), "<u8", int(counts.sum()))
                found.append(fingerprints_of(flat, counts))
            prints = np.concatenate(found) if found else np.zeros(0, "<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long)."""
    return texts(docs, id_col, text_col).mapInArrow(_fingerprint_batches(shingle), "doc_id long, fp long")


class _Forest:
    """Union-find over a growing set of nodes."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        at = parent.setdefault(x, x)
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def _first_links(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a tile pair's link matrix, few links with the same components."""
    rows = np.flatnonzero(near.any(axis=1))
    if not len(rows):
        return rows, rows
    near = near[rows]
    columns = np.flatnonzero(near.any(axis=0))
    near = near[:, columns]
    first_row = near.argmax(axis=0)  # each column's first row
    picked = set(zip(first_row.tolist(), range(len(columns))))
    # labels (a row's number) spread over the links until none gets smaller;
    # the link that lowers a label joins the two, so the picked links connect
    # all that the matrix connects
    label_row = np.arange(len(rows))
    label_col = first_row.copy()
    while True:
        reach = np.where(near, label_col[None, :], len(rows))
        at = reach.argmin(axis=1)
        least = reach[np.arange(len(rows)), at]
        lower = least < label_row
        if not lower.any():
            break
        for r in np.flatnonzero(lower).tolist():
            picked.add((r, int(at[r])))
        label_row = np.minimum(label_row, least)
        back = np.where(near, label_row[:, None], len(rows))
        to = back.argmin(axis=0)
        best = back.min(axis=0)
        for c in np.flatnonzero(best < label_col).tolist():
            picked.add((int(to[c]), c))
        label_col = np.minimum(label_col, best)
    r, c = np.array(sorted(picked)).T
    return rows[r], columns[c]


def compare(left: np.ndarray, right: np.ndarray, radius: int):
    """(i, j) of links between two tiles, with the components of all links."""
    for lo in range(0, len(left), SUB):
        part = left[lo : lo + SUB, None]
        for at in range(0, len(right), 4096):
            near = np.bitwise_count(part ^ right[None, at : at + 4096]) <= radius
            if near.any():
                i, j = _first_links(near)
                yield from zip((i + lo).tolist(), (j + at).tolist())


def _compare_batches(radius: int):
    def run(batches):
        current, forest = None, _Forest()
        for batch in batches:
            own, other = batch.column(0), batch.column(1)
            a, b = [], []
            for key, x, y, p, q in zip(batch.column(4).to_pylist(), own, other, batch.column(2), batch.column(3)):
                if key != current:  # a new first tile
                    current, forest = key, _Forest()
                left, right = (np.asarray(v.values).view(np.uint64) for v in (x, y))
                ids, partners = np.asarray(p.values), np.asarray(q.values)
                for i, j in compare(left, right, radius):
                    u, v = int(ids[i]), int(partners[j])
                    if u != v and forest.join(u, v):
                        a.append(u)
                        b.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _bit_count(c):
    return F.bit_count(c).cast("int")


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` between nodes (``fp`` distinct, ``node``) at ``radius``
    or fewer differing bits: enough of them to have all components."""
    spark = nodes.sparkSession
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    cells = nodes.select("fp", "node", _bit_count(low).alias("p"), _bit_count(high).alias("q"))
    # at most 33 x 33 cells, whatever the input
    sizes = cells.groupBy("p", "q").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n"))
    counts = spark.createDataFrame([tuple(r) for r in sizes.collect()], "p int, q int, n int")
    tiles = cells.join(F.broadcast(counts), ["p", "q"]).withColumn("t", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")) \
        .groupBy("p", "q", "t").agg(F.collect_list(F.struct("fp", "node")).alias("s")) \
        .select("p", "q", "t", F.col("s.fp").alias("fps"), F.col("s.node").alias("nodes"))
    tiles = saved(tiles)
    steps = [(x, y) for x in range(radius + 1) for y in range(-radius, radius + 1) if x + abs(y) <= radius and (x, y) >= (0, 0)]
    offsets = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps])
    # a tile meets the tiles of the cells around its own; one side is sent to each
    near = tiles.select("p", "q", "t", F.col("fps").alias("fps2"), F.col("nodes").alias("nodes2"), F.explode(offsets).alias("d")) \
        .select((F.col("p") - F.col("d.x")).alias("p"), (F.col("q") - F.col("d.y")).alias("q"), F.col("t").alias("t2"), "fps2", "nodes2", "d")
    near = near.join(F.broadcast(counts), ["p", "q"]) \
        .select("p", "q", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("t"), "t2", "fps2", "nodes2", "d") \
        .where("d.x <> 0 or d.y <> 0 or t2 >= t")
    # tiles are large: shuffled, never broadcast, and few to a batch
    pairs = tiles.hint("merge").join(near, ["p", "q", "t"]) \
        .select("fps", "fps2", "nodes", "nodes2", F.struct("p", "q", "t").alias("key"))
    bounded_batches(spark)
    return pairs.mapInArrow(_compare_batches(radius), T.StructType().add("a", "long").add("b", "long"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fp, component_id`` for every document row; the component is
    the smallest id reachable over links of at most ``radius`` bits."""
    return _with_components(saved(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle)), radius)


def _with_components(prints: DataFrame, radius: int) -> DataFrame:
    table = _component_table(prints, radius).select("fp", F.col("least").alias("component_id"))
    return prints.join(table, "fp").select("doc_id", "fp", "component_id")


def _component_table(prints: DataFrame, radius: int) -> DataFrame:
    """``fp, component, least``: the smallest fingerprint of its component,
    which names it, and the smallest id, null if it holds null ids only."""
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    # a node is its fingerprint: ids can be null or shared, fingerprints not
    found = saved(components(links(nodes.select("fp", F.col("fp").alias("node")), radius)).withColumnRenamed("node", "fp"))
    linked = nodes.join(found, "fp")
    firsts = linked.groupBy("component").agg(F.min("least").alias("least"))
    linked = linked.drop("least").join(firsts, "component").select("fp", "component", "least")
    return linked.union(nodes.join(found, "fp", "left_anti").select("fp", F.col("fp").alias("component"), "least"))


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each component, that of the smallest id, columns
    unchanged; rows that repeat both id and text count as one document.  Of a
    component of null ids only, the text of the smallest hash stays."""
    prints = saved(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    table = saved(_component_table(prints, radius))
    first = prints.join(table, "fp").where("doc_id = least").select(F.col("doc_id").alias("_id")).distinct()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("_id"),
                      F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_text"))
    # rows without an id are told apart by their texts
    bare = docs.where(F.col(f"`{id_col}`").cast("long").isNull()).select(F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    marks = fingerprints(bare, shingle=shingle).join(table.where("least is null"), "fp").groupBy("component").agg(F.min("doc_id").alias("_text"))
    kept = own.where("_id is not null").join(first, "_id", "left_semi").select("row", "_id", "_text") \
        .unionByName(own.where("_id is null").join(marks, "_text", "left_semi").select("row", "_id", "_text"))
    return kept.dropDuplicates(["_id", "_text"]).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
