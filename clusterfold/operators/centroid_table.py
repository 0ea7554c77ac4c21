"""K-means with the centroids as a distributed table (K1-K4 for any k).

Nothing here is of size k on the driver or in one task.  Points
``(id, x, ...)`` and centroids ``(j bigint, c array<double>)`` are laid out as
a grid of ``R`` rows (by a hash of the point's key) and ``S`` columns (by a
hash of j); a cell holds about ``CELL_BYTES`` of either side.  Every point meets
each column once: a cell finds its points' nearest centroid among its
own by tiles of matrix products (``nearest.py``), and the ``S`` answers of a
point are merged by ``min(struct(d, j))``, so ties go to the lowest j.  Points
are sent ``S`` times and centroids ``R`` times; with few centroids ``S`` is 1,
the points move once and no merge runs.

A Lloyd step joins the assignments back to the points by their key, sums
every cluster in partial aggregates and returns the new centroid table; the
loop saves it in the shared folder after each step, so lineage stays short.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterfold.functions.vectors import require_length
from clusterfold.operators.indexing import hash_key
from clusterfold.operators.kmeans import NOT_FINITE
from clusterfold.operators.nearest import nearest
from clusterfold.session import checkpoint_dir

# Fixed value: bytes of points, and of centroids, in one cell of the grid.
CELL_BYTES = 16 << 20


def _saved(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def seed_table(points: DataFrame, share: int, seed: int = 0) -> DataFrame:
    """Centroids ``(j, c)``: the points whose hash key (``indexing.hash_key``)
    is divisible by ``share``, so about one point in ``share`` whatever their
    number; j is the point's id, which must be unique."""
    return points.where(hash_key("id", seed) % share == 0).select(F.col("id").alias("j"), F.col("x").alias("c"))


def _shape(points: DataFrame, centroids: DataFrame, cell_bytes: int) -> tuple[int, int, int]:
    """(d, R, S) from the two counts; centroids of different lengths raise."""
    c = centroids.agg(F.count(F.lit(1)).alias("k"), F.min(F.size("c")).alias("a"), F.max(F.size("c")).alias("b"), F.count_distinct("j").alias("kinds")).first()
    if not c["k"]:
        raise ValueError("no centroid")
    if c["a"] != c["b"]:
        raise ValueError(f"centroids of different lengths: {c['a']} to {c['b']}")
    if c["kinds"] != c["k"]:
        raise ValueError("a centroid id is null or stands twice")
    n, width = points.count(), 8 * max(1, c["a"])
    return c["a"], max(1, math.ceil(n * width / cell_bytes)), max(1, math.ceil(c["k"] * width / cell_bytes))


def _cell_matrix(column, d: int) -> np.ndarray:
    X = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not np.isfinite(X).all():
        raise ValueError(NOT_FINITE)
    return X.reshape(-1, d)


def _cells(keyed: DataFrame, centroids: DataFrame, d: int, R: int, S: int) -> DataFrame:
    """``_key, d, j``: each point's nearest centroid of each column."""

    def answer(left, right):
        import pyarrow as pa

        if not left.num_rows or not right.num_rows:
            return pa.table({"_key": pa.array([], pa.int64()), "d": pa.array([], pa.float64()), "j": pa.array([], pa.int64())})
        j = right.column("j").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(j)  # ties go to the lowest j
        C = _cell_matrix(right.column("c"), d)[order]
        place, dist, _ = nearest(_cell_matrix(left.column("x"), d), [(0, C)])
        return pa.table({"_key": left.column("_key"), "d": pa.array(dist), "j": pa.array(j[order][place])})

    row, column = F.pmod(F.xxhash64("_key"), F.lit(R)).cast("int"), F.pmod(F.xxhash64("j"), F.lit(S)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = keyed.where(require_length("x", d, "point")).select("_key", "x", row.alias("_r"), each(S).alias("_s"))
    right = centroids.select(F.col("j").cast("long").alias("j"), "c", column.alias("_s"), each(R).alias("_r"))
    return left.groupBy("_r", "_s").cogroup(right.groupBy("_r", "_s")).applyInArrow(answer, "_key long, d double, j long")


def assign_keyed(keyed: DataFrame, centroids: DataFrame, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """``_key, d, j`` of points that carry a unique ``_key``."""
    d, R, S = _shape(keyed, centroids, cell_bytes)
    found = _cells(keyed, centroids, d, R, S)
    if S == 1:
        return found
    return found.groupBy("_key").agg(F.min(F.struct("d", "j")).alias("_m")).select("_key", "_m.d", "_m.j")


def keyed(points: DataFrame) -> DataFrame:
    """Points with a unique ``_key``, saved: the key stays the same however
    often the rows are read."""
    return _saved(points.withColumn("_key", F.monotonically_increasing_id()))


def assign_table(points: DataFrame, centroids: DataFrame, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """K2: every point (without ``x``) with its nearest centroid ``j`` and
    distance ``d``.  Repeated points and ids stay rows of their own."""
    own = keyed(points)
    found = assign_keyed(own, centroids, cell_bytes)
    return own.drop("x").join(found.hint("merge"), "_key").drop("_key").select(*[c for c in points.columns if c != "x"], "j", "d")


def _sums(own: DataFrame, found: DataFrame) -> DataFrame:
    """``j, pos, s, n``: every task folds its rows into one sum a cluster
    before anything is exchanged."""
    together = own.select("_key", "x").join(found.select("_key", "j").hint("merge"), "_key")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            j = batch.column(batch.schema.get_field_index("j")).to_numpy(zero_copy_only=False)
            X = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(len(j), -1)
            order = np.argsort(j, kind="stable")
            ids, first, n = np.unique(j[order], return_index=True, return_counts=True)
            S, d = np.add.reduceat(X[order], first, axis=0), X.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, d)), pa.array(np.tile(np.arange(d, dtype=np.int32), len(ids))), pa.array(S.ravel()), pa.array(np.repeat(n, d))],
                names=["j", "pos", "s", "n"])

    return together.select("x", "j").mapInArrow(run, "j long, pos int, s double, n long").groupBy("j", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def step_keyed(own: DataFrame, centroids: DataFrame, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """K3: the new centroid table ``j, c, n`` of one Lloyd step (clusters
    without points vanish)."""
    sums = _sums(own, assign_keyed(own, centroids, cell_bytes))
    packed = sums.groupBy("j").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", (F.col("s") / F.col("n")).alias("v")))).alias("_v"))
    return packed.select("j", F.col("_v.v").alias("c"), "n")


def step_table(points: DataFrame, centroids: DataFrame, cell_bytes: int = CELL_BYTES) -> DataFrame:
    return step_keyed(keyed(points), centroids, cell_bytes)


def moved(old: DataFrame, new: DataFrame, eps: float) -> int:
    """J5 + P3 by a shuffled join: how many centroids of both tables moved
    more than ``eps``."""
    both = new.select("j", F.col("c").alias("_new")).join(old.select("j", F.col("c").alias("_old")).hint("merge"), "j")
    square = F.aggregate(F.zip_with("_new", "_old", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)
    return both.where(F.sqrt(square) > eps).count()


def kmeans_table(points: DataFrame, seeds: DataFrame, max_iter: int = 10, eps: float = 1e-3, cell_bytes: int = CELL_BYTES) -> tuple[DataFrame, list[int]]:
    """K4: ``(centroid table j, c, n; centroids moved at each iteration)``.
    The driver holds one count an iteration."""
    own = keyed(points)
    centroids, trace = _saved(seeds.select(F.col("j").cast("long").alias("j"), "c", F.lit(None).cast("long").alias("n"))), []
    for _ in range(max_iter):
        new = _saved(step_keyed(own, centroids, cell_bytes))
        trace.append(moved(centroids, new, eps))
        centroids = new
        if not trace[-1]:
            break
    return centroids, trace
