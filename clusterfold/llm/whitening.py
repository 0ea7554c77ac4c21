"""Embedding whitening over a weighted multiplicity covariance.

Vectors become integers, ``x = floor(scale * c) + shift`` an entry.  Identical
x vectors are grouped once (partial counts in every task, then one exchange);
the distinct vectors with their multiplicities are written to the shared
folder and everything else works on them:

1. ``n`` and the sums ``S`` of the fit list, exact in integers;
2. the covariance, a weighted GEMM of centred vectors: each task multiplies
   its vectors, less the mean, by blocks, and returns d * d partial sums;
3. the d * d matrix goes to the driver, whose eigenvectors (by falling
   eigenvalue) over the square roots of their eigenvalues whiten;
4. every distinct vector is whitened once, and the covariance of the result is
   measured in the same way;
5. the vectors' rows are joined back by x.  A vector that at least one in
   ``HOT_SHARE`` of all rows share is joined by a broadcast (there are at most
   ``HOT_SHARE`` such vectors), the others by an exchange, so that no task
   gets more than its share of copies.

``weights='counts'`` fits on all rows, ``'one'`` on the distinct vectors.

Defined results: a row whose vector is null, empty or holds a null, NaN or
infinite entry is dropped.  Vectors of different lengths raise.  Repeated rows
and null ids stay rows of their own.  Components whose eigenvalue is at most
``RANK_SHARE`` of the largest have no direction in the data and are left out;
a table without two different vectors has none, so it gives no rows, and so
does an empty one.  ``deviation`` is an exact decimal, however many rows there
are.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.llm.frames import bounded_batches, saved

SCALE, SHIFT = 64, 1_000_000
HOT_SHARE = 1000
RANK_SHARE = 1e-10
_LONG = float(1 << 62)


def whole(v: Column) -> Column:
    """The vector has entries, and all are numbers."""
    every = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & every, F.lit(False))


def points(table: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, h, x`` of the rows that remain; ``h`` is a hash of x that
    makes its comparisons in a sort cheap."""
    bounded_batches(table.sparkSession)
    own = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v")).where(whole(F.col("v")))
    x = F.transform("v", lambda c: F.floor(c * float(scale)) + F.lit(shift).cast("long"))
    return own.select("vec_id", x.alias("x")).select("vec_id", F.xxhash64("x").alias("h"), "x")


def distinct_vectors(rows: DataFrame, weights: str = "counts") -> DataFrame:
    """``h, x, n, w``, saved: every x vector once, the number of its rows and
    its fit weight."""
    if weights not in ("counts", "one"):
        raise ValueError(f"unknown weights {weights!r}")
    w = F.col("n") if weights == "counts" else F.lit(1).cast("long")
    return saved(rows.groupBy("h", "x").agg(F.count(F.lit(1)).alias("n")).select("h", "x", "n", w.alias("w")))


@dataclass
class Fit:
    """What whitening needs: bounded by the vectors' length, not their number."""

    n: int
    sums: list[int]
    projection: np.ndarray  # (d, components)
    explained: np.ndarray

    @property
    def whole_mean(self) -> np.ndarray:
        """The integer below each mean, which is taken off first, exactly."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest_mean(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the large part in integers, the rest below one."""
        return (x - self.whole_mean) - self.rest_mean

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, exact."""
        # n * x - S = n * (x - floor(S/n)) - S mod n
        near, rest = x - self.whole_mean, [s % self.n for s in self.sums]
        if (self.n * (np.abs(near).max(initial=0) + 1.0)) ** 2 * x.shape[1] < _LONG:
            return ((self.n * near - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in near.tolist()]


def _matrix(batch: pa.RecordBatch, name: str, kind) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _length(vectors: DataFrame) -> int:
    """Entries of a vector; 0 if there is none."""
    r = vectors.agg(F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    if r["a"] != r["b"]:
        raise ValueError(f"vectors of different lengths: {r['a']} to {r['b']}")
    return r["a"] or 0


def _moments(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, S) of the fit list in exact integers (the decimals hold any sum)."""

    def run(batches):
        total, n = [0] * d, 0
        for batch in batches:
            x, w = _matrix(batch, "x", np.int64), batch.column(batch.schema.get_field_index("w")).to_numpy()
            if len(w) and float(np.abs(x).max()) * float(w.sum()) >= _LONG:
                part = [sum(a * b for a, b in zip(column, w.tolist())) for column in x.T.tolist()]
            else:
                part = (x * w[:, None]).sum(axis=0).tolist()
            total, n = [a + b for a, b in zip(total, part)], n + int(w.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))], names=["i", "s"])

    rows = vectors.select("x", "w").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    found = {r["i"]: int(r["s"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(d)]


def _products(vectors: DataFrame, name: str, size: int, centre) -> np.ndarray:
    """Sum of w * z z' over the vectors, z = ``centre`` of a batch of them:
    one d * d partial sum a task, added up by the executors."""

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            z = centre(_matrix(batch, name, np.float64 if name != "x" else np.int64))
            w = batch.column(batch.schema.get_field_index("w")).to_numpy().astype(np.float64)
            total += (z * w[:, None]).T @ z
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i * size + j, pa.int32()), pa.array(total[i, j])], names=["spot", "s"])

    out = np.zeros((size, size))
    for r in vectors.select(name, "w").mapInArrow(run, "spot int, s double").groupBy("spot").agg(F.sum("s").alias("s")).collect():
        i, j = divmod(r["spot"], size)
        out[i, j] = out[j, i] = r["s"]
    return out


def fit(vectors: DataFrame, components: int) -> Fit | None:
    """Components of the distinct vectors' weighted covariance; None without
    two different vectors."""
    d = _length(vectors)
    n, sums = _moments(vectors, d) if d else (0, [])
    if not n:
        return None
    raw = Fit(n, sums, np.zeros((d, 0)), np.zeros(0))
    covariance = _products(vectors, "x", d, raw.centred) / n
    value, vector = np.linalg.eigh(covariance)
    value, vector = value[::-1], vector[:, ::-1]
    good = int(np.sum(value > max(0.0, RANK_SHARE * value[0]))) if value[0] > 0 else 0
    good = min(good, components)
    if not good:
        return None
    return Fit(n, sums, vector[:, :good] / np.sqrt(value[:good]), value[:good] / np.trace(covariance))


def _whitened(vectors: DataFrame, model: Fit) -> DataFrame:
    """``h, x, n, w, deviation, white``, saved: every distinct vector once."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch, "x", np.int64) if batch.num_rows else np.zeros((0, len(model.sums)), np.int64)
            white = model.centred(x) @ model.projection
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.deviations(x), pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))],
                names=[*batch.schema.names, "deviation", "white"])

    return saved(vectors.mapInArrow(run, "h long, x array<long>, n long, w long, deviation decimal(38,0), white array<double>"))


def _identity_error(white: DataFrame, n: int, size: int) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    total = white.select("w", F.posexplode("white").alias("i", "v")).groupBy("i").agg(F.sum(F.col("w") * F.col("v")).alias("s")).collect()
    mean = np.zeros(size)
    for r in total:
        mean[r["i"]] = r["s"] / n
    return float(np.abs(_products(white, "white", size, lambda z: z - mean) / n - np.eye(size)).max())


RESULT = "vec_id long, n long, deviation decimal(38,0), white array<double>, explained array<double>, identity_error double"


def whiten(table: DataFrame, components: int = 32, *, id_col: str = "vec_id", vec_col: str = "embedding", weights: str = "counts",
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, n, deviation, white, explained, identity_error`` of every row
    with a whole vector: ``white`` are its first ``components`` whitened
    coordinates, ``explained`` their shares of the variance."""
    rows = points(table, id_col=id_col, vec_col=vec_col, scale=scale, shift=shift)
    vectors = distinct_vectors(rows, weights)
    model = fit(vectors, components)
    if model is None:
        return _nothing(table.sparkSession, rows)
    size = model.projection.shape[1]
    white = _whitened(vectors, model)
    error = _identity_error(white, model.n, size)
    back = _joined(rows, white.select("h", "x", "n", "deviation", "white"))
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    return back.select("vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "white", shares.alias("explained"), F.lit(error).alias("identity_error"))


def _nothing(spark: SparkSession, rows: DataFrame) -> DataFrame:
    kind = rows.schema["vec_id"].dataType.simpleString()
    return spark.createDataFrame([], RESULT.replace("vec_id long", f"vec_id {kind}"))


def _joined(rows: DataFrame, white: DataFrame) -> DataFrame:
    """Rows with their distinct vector's columns; common vectors by broadcast."""
    total = white.agg(F.sum("n")).first()[0]
    common = F.col("n") * HOT_SHARE >= total
    few, many = white.where(common).drop("n"), white.where(~common).drop("n")
    some = rows.join(F.broadcast(few), ["h", "x"])
    rest = rows.join(F.broadcast(few.select("h", "x")), ["h", "x"], "left_anti")
    return some.unionByName(rest.join(many.hint("merge"), ["h", "x"]))
