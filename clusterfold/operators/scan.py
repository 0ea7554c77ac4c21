"""A distributed prefix scan of affine maps.

Rows ``keys, _node, _k, _r, _m`` are maps of a d-vector that follow one
another, in each group of ``keys``, by ``(_node, _k)``: a node is the number of
the partition that made them, so nodes are dense and in order.  The scan is a
tree of fan-in ``fan``: an up-sweep composes the maps of ``fan`` neighbouring
nodes into one, level by level (``composed``); a down-sweep gives every map the
vector that all maps before it make of v0 (``prefixes``).  A level is one
exchange by the parent's number; no task holds more than the maps of ``fan``
nodes, and the levels are ``log(nodes) / log(fan)``.

A map is a (d+1) x (d+1) matrix (``_r`` = -1) or, where few rows of wide
vectors made it, the identity plus a product of d x r and r x (d+1)
(``_r`` = r); compositions add ranks and become matrices once that is smaller.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterfold.session import checkpoint_dir

# Nodes that one task composes, and their numbers.
FAN = 64
FAN_VALUES = 1 << 23


class Affine:
    """``v -> A [v; 1]``, dense or of low rank."""

    __slots__ = ("d", "A", "P", "Q")

    def __init__(self, d: int, A=None, P=None, Q=None):
        self.d, self.A, self.P, self.Q = d, A, P, Q

    @staticmethod
    def read(d: int, rank: int, raw: bytes) -> "Affine":
        values = np.frombuffer(raw)
        if rank < 0:
            return Affine(d, values.reshape(d + 1, d + 1))
        return Affine(d, None, values[:d * rank].reshape(d, rank), values[d * rank:].reshape(rank, d + 1))

    @property
    def rank(self) -> int:
        return -1 if self.P is None else self.P.shape[1]

    def bytes(self) -> bytes:
        return np.ascontiguousarray(self.A).tobytes() if self.P is None else np.ascontiguousarray(self.P).tobytes() + np.ascontiguousarray(self.Q).tobytes()

    def dense(self) -> np.ndarray:
        if self.P is None:
            return self.A
        A = np.eye(self.d + 1)
        A[:self.d] += self.P @ self.Q
        return A

    def apply(self, v: np.ndarray) -> np.ndarray:
        """v is a d-vector."""
        if self.P is None:
            return self.A[:self.d, :self.d] @ v + self.A[:self.d, self.d]
        return v + self.P @ (self.Q[:, :self.d] @ v + self.Q[:, self.d])

    def after(self, first: "Affine") -> "Affine":
        """The map that applies ``first``, then this one."""
        ranks = self.rank, first.rank
        if min(ranks) >= 0 and 2 * sum(ranks) <= self.d:
            moved = self.Q + (self.Q[:, :self.d] @ first.P) @ first.Q
            return Affine(self.d, None, np.concatenate([first.P, self.P], axis=1), np.concatenate([first.Q, moved]))
        return Affine(self.d, self.dense() @ first.dense())


def fan_for(d: int) -> int:
    return max(2, min(FAN, FAN_VALUES // ((d + 1) * (d + 1))))


def saved(df: DataFrame) -> DataFrame:
    """Rows written once to the shared folder: a scan reads a level twice."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _maps(table, d: int) -> list[Affine]:
    return [Affine.read(d, r, m) for r, m in zip(table.column("_r").to_pylist(), table.column("_m").to_pylist())]


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in names]


MAP = [T.StructField("_node", T.LongType()), T.StructField("_k", T.IntegerType()), T.StructField("_r", T.IntegerType()), T.StructField("_m", T.BinaryType())]


def composed(maps: DataFrame, keys: Sequence[str], d: int, fan: int) -> DataFrame:
    """One level up: the maps of ``fan`` nodes as one, ``keys, _node, _k, _r, _m``."""
    keys = list(keys)

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("_node", "ascending"), ("_k", "ascending")])
        total = None
        for own in _maps(table, d):
            total = own if total is None else own.after(total)
        heads = {c: table.column(c).slice(0, 1) for c in keys}
        return pa.table({**heads, "_node": pa.array([table.column("_parent")[0].as_py()], pa.int64()), "_k": pa.array([0], pa.int32()),
                         "_r": pa.array([total.rank], pa.int32()), "_m": pa.array([total.bytes()], pa.binary())})

    rows = maps.select(*keys, "_node", "_k", "_r", "_m", parent(fan).alias("_parent"))
    return rows.groupBy(*keys, "_parent").applyInArrow(run, T.StructType([*_fields(maps, keys), *MAP]))


def parent(fan: int) -> Column:
    return F.floor(F.col("_node") / F.lit(fan)).cast("long")


def n_nodes(maps: DataFrame) -> int:
    top = maps.agg(F.max("_node")).first()[0]
    return 0 if top is None else int(top) + 1


def levels(maps: DataFrame, keys: Sequence[str], d: int, fan: int) -> list[DataFrame]:
    """The up-sweep, saved: ``maps`` (saved by the caller) and every level
    above it down to one of at most ``fan`` nodes."""
    out, n = [maps], n_nodes(maps)
    while n > fan:
        out.append(saved(composed(out[-1], keys, d, fan)))
        n = -(-n // fan)
    return out


def total(maps: DataFrame, keys: Sequence[str], d: int, fan: int | None = None) -> DataFrame:
    """One map a group: ``keys, _node, _k, _r, _m``."""
    fan = fan or fan_for(d)
    return composed(levels(maps, keys, d, fan)[-1], keys, d, fan)


def prefixes(maps: DataFrame, keys: Sequence[str], v0: np.ndarray, carry: Sequence[str] = (), fan: int | None = None) -> DataFrame:
    """``keys, carry, _node, _k, _v, _w`` of every map: the vector before it
    (``_v``) and after it (``_w``), as binary doubles.  ``carry`` are further
    columns of ``maps`` to keep."""
    keys, d = list(keys), len(v0)
    fan = fan or fan_for(d)
    swept = levels(maps, keys, d, fan)
    starts = None
    for depth in range(len(swept) - 1, -1, -1):
        kept = list(carry) if depth == 0 else []
        rows = swept[depth].select(*keys, *kept, "_node", "_k", "_r", "_m", parent(fan).alias("_parent"), F.lit(None).cast("binary").alias("_v"))
        if starts is not None:  # the level above: its node is this level's parent
            above = starts.select(*keys, *[F.lit(None).cast(maps.schema[c].dataType).alias(c) for c in kept], F.lit(-1).cast("long").alias("_node"),
                                  F.lit(-1).cast("int").alias("_k"), F.lit(None).cast("int").alias("_r"), F.lit(None).cast("binary").alias("_m"),
                                  F.col("_node").alias("_parent"), "_v")
            rows = rows.unionByName(above)
        schema = T.StructType([*_fields(maps, [*keys, *kept]), *MAP[:2], T.StructField("_v", T.BinaryType()), T.StructField("_w", T.BinaryType())])
        starts = rows.groupBy(*keys, "_parent").applyInArrow(_sweep(v0, [*keys, *kept]), schema)
        if depth:
            starts = saved(starts)
    return starts


def _sweep(v0: np.ndarray, names: list[str]):
    d = len(v0)

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("_node", "ascending"), ("_k", "ascending")])
        v = v0
        if table.column("_node")[0].as_py() < 0:
            v, table = np.frombuffer(table.column("_v")[0].as_py()), table.slice(1)
        before, after = [], []
        for own in _maps(table, d):
            before.append(v.tobytes())
            v = own.apply(v)
            after.append(v.tobytes())
        return pa.table({**{c: table.column(c) for c in names}, "_node": table.column("_node"), "_k": table.column("_k"),
                         "_v": pa.array(before, pa.binary()), "_w": pa.array(after, pa.binary())})

    return run
