"""K-means (Lloyd's algorithm) as DataFrame jobs.

Design
------
* Points are ``(id bigint, x array<double>, label)``; they are read once,
  projected to those columns and persisted.  They never shuffle.
* Centroids are a k x d table (the model) held by the driver.  They reach
  the tasks inside the task closure while small (``CLOSURE_VALUES``), and
  as broadcast chunks beyond that; tasks then take a running argmin chunk
  by chunk, so no k is too large and no candidate is left out.
* Assignment has two physical forms, picked by ``assign_mode='auto'``:
  - ``expr`` (k*d <= ``EXPR_MAX_TERMS``): the nearest centroid is
    ``least(struct(dist_0, 0), ..., struct(dist_k-1, k-1))`` with every
    distance unrolled into arithmetic on ``x[i]``: a plain projection
    compiled by whole-stage codegen, ties going to the lowest id;
  - ``arrow`` (wide vectors): ``mapInArrow``, exact nearest centroids by tiles
    of matrix products (``nearest.py``).  Measured 10x faster than Spark's
    higher-order functions for k*d = 640, which run interpreted, and it
    avoids the 64 KB method limit an unrolled expression of that size hits.
* The loop over wide vectors keeps the points as packed blocks with distance
  bounds (``bounds.py``): a step computes only the points whose bounds no
  longer prove their centroid, and returns the tasks' sums.
* One Lloyd step is one job: projection -> partial aggregate of
  ``count`` and the d coordinate sums per cluster -> shuffle of at most
  k rows per input partition -> final aggregate -> k rows to the driver.
  A cluster holding a third of all points costs nothing extra: each task
  has already folded its share into one buffer before the shuffle.
* Because the new centroids come back as k rows, lineage never grows from
  one iteration to the next (the problem the reference ran into).
* The ``cross`` assignment keeps the reference's stepwise shape for
  comparison: distance rows (n*k), a shuffle to take the per-point argmin,
  a join back to the points, then the cluster sums.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.window import Window

from clusterfold.functions.vectors import as_double_array, dist_const, require_length
from clusterfold.operators.bounds import BoundedLloyd
from clusterfold.operators.indexing import hash_key
from clusterfold.operators.nearest import distances
from clusterfold.operators.nearest import nearest as nearest_places

# Centroid values shipped inside a task closure; beyond that
# they travel as broadcast chunks of at most BROADCAST_CHUNK_VALUES values.
CLOSURE_VALUES = 1_000_000
BROADCAST_CHUNK_VALUES = 4_000_000
# Largest k*d for which the unrolled codegen expression is used.
EXPR_MAX_TERMS = 128

Centroids = dict[int, list[float]]

# One rule for both assignment forms: a NULL, NaN or infinite coordinate raises.
NOT_FINITE = "a point has a coordinate that is not finite"


# ---- points and seeds -----------------------------------------------------


def to_points(
    df: DataFrame, id_col: str, features_col: str, label_col: str | None = None
) -> DataFrame:
    """Project a table to ``(id, x, label)`` with ``x`` as array<double>."""
    cols = [
        F.col(id_col).cast("bigint").alias("id"),
        as_double_array(features_col).alias("x"),
    ]
    if label_col is not None:
        cols.append(F.col(label_col).alias("label"))
    return df.select(*cols)


def k_from_labels(points: DataFrame, label_col: str = "label") -> int:
    """A1: number of distinct labels (one aggregate job)."""
    return points.agg(F.countDistinct(label_col).alias("k")).first()["k"]


def seed_frame(points: DataFrame, k: int, how: str = "first", seed: int = 0) -> DataFrame:
    """K1 as a DataFrame ``(j int, c array<double>)`` of k rows.

    ``first``: the k smallest ids; ``sample`` (or ``hash``): k rows drawn
    without replacement, in the order of a key computed from the id and the
    seed (``indexing.hash_key``): a per-partition top-k, never a full sort,
    and the same rows under any partitioning."""
    if how == "first":
        order = F.col("id")
    elif how in ("sample", "hash"):
        order = hash_key("id", seed)
    else:
        raise ValueError(f"unknown init {how!r}")
    keyed = points.select("id", "x", order.alias("_o"))
    top = keyed.orderBy("_o", "id").limit(k)
    # k rows only (bounded): numbering them in one partition is fine.
    w = Window.orderBy("_o", "id")
    return top.select((F.row_number().over(w) - 1).cast("int").alias("j"), F.col("x").alias("c"))


def collect_centroids(frame: DataFrame) -> Centroids:
    rows = frame.select("j", "c").collect()
    cents = {int(r["j"]): [float(v) for v in r["c"]] for r in rows}
    _check_size(cents)
    return cents


def _check_size(cents: Centroids) -> None:
    """All centroids have one width (any k*d is accepted: see ``_Shipped``)."""
    d = {len(c) for c in cents.values()}
    if len(d) > 1:
        raise ValueError(f"centroids of different lengths: {sorted(d)}")


class _Shipped:
    """A centroid table on its way to the tasks: inside the closure while it
    holds at most ``CLOSURE_VALUES`` numbers, else as broadcast chunks
    (a known size: k*d doubles in total).  ``chunks()`` runs on executors."""

    def __init__(self, spark: SparkSession, cents: Centroids):
        js, C = _matrix(cents)
        self.js = js
        self.k, self.d = C.shape
        self.local = None
        self.parts = []
        if C.size <= CLOSURE_VALUES:
            self.local = C
        else:
            rows = max(1, BROADCAST_CHUNK_VALUES // max(self.d, 1))
            sc = spark.sparkContext
            self.parts = [sc.broadcast(C[s:s + rows]) for s in range(0, self.k, rows)]

    def chunks(self):
        """(offset, matrix) pieces of the table, in centroid order."""
        if self.local is not None:
            yield 0, self.local
            return
        off = 0
        for b in self.parts:
            C = b.value
            yield off, C
            off += len(C)

    def release(self) -> None:
        for b in self.parts:
            b.unpersist()


def centroid_frame(spark: SparkSession, cents: Centroids) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("j", T.IntegerType(), False),
            T.StructField("c", T.ArrayType(T.DoubleType(), False), False),
        ]
    )
    return spark.createDataFrame([(j, c) for j, c in sorted(cents.items())], schema)


# ---- assignment (K2) ------------------------------------------------------


def nearest(x: Column | str, cents: Centroids) -> Column:
    """struct<d double, j int> of the nearest centroid (ties -> lowest j)."""
    if not cents:
        raise ValueError("no centroid")
    cands = [
        F.struct(dist_const(x, c).alias("d"), F.lit(j).cast("int").alias("j"))
        for j, c in sorted(cents.items())
    ]
    return cands[0] if len(cands) == 1 else F.least(*cands)


def _dim(cents: Centroids) -> int:
    return len(next(iter(cents.values())))


def _mode(cents: Centroids, mode: str) -> str:
    if mode == "auto":
        return "expr" if len(cents) * _dim(cents) <= EXPR_MAX_TERMS else "arrow"
    if mode not in ("expr", "arrow"):
        raise ValueError(f"unknown assign mode {mode!r}")
    return mode


def _matrix(cents: Centroids):
    import numpy as np

    js = sorted(cents)
    return np.asarray(js, dtype=np.int32), np.asarray([cents[j] for j in js], dtype=np.float64)


def _with_coords(points: DataFrame, d: int, keep: list[str]) -> DataFrame:
    """``keep`` plus the checked vector column ``x`` for the Arrow path.
    (The array stays one column: splitting 64 coordinates into scalar
    columns was measured slower, the projection outgrows codegen.)"""
    return points.where(require_length("x", d, "point")).select(*keep, "x")


def _batch_points(batch, d: int):
    """(n, d) matrix of an Arrow batch's points (one flat buffer)."""
    import numpy as np

    X = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not np.isfinite(X).all():
        raise ValueError(NOT_FINITE)
    return X.reshape(-1, d)


def _nearest(X, ship):
    """(index into ship.js, distance) of every point's nearest centroid;
    ties go to the lowest j."""
    return nearest_places(X, ship.chunks())[:2]


def _point_schema(points: DataFrame, keep: list[str]) -> str:
    fields = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    return ", ".join([f"{c} {fields[c]}" for c in keep] + ["j int", "d double"])


def assign(points: DataFrame, cents: Centroids, mode: str = "auto") -> DataFrame:
    """K2: every point (without ``x``) with its nearest centroid ``j`` and
    distance ``d``.  No shuffle: points keep their partitioning."""
    _check_size(cents)
    mode = _mode(cents, mode)
    keep = [c for c in points.columns if c != "x"]
    if mode == "expr":
        return _assigned_expr(points, cents).select(*keep, "j", "d")
    ship = _Shipped(points.sparkSession, cents)
    d = ship.d

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            best, dist = _nearest(_batch_points(batch, d), ship)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(ship.js[best]), pa.array(dist)],
                names=[*keep, "j", "d"])

    return _with_coords(points, d, keep).mapInArrow(run, _point_schema(points, keep))


def _checked(points: DataFrame, d: int) -> DataFrame:
    """Points of width d with finite coordinates; any other raises."""
    total = F.lit(0.0)
    for i in range(d):
        total = total + F.col("x")[i] * 0.0  # not finite: NaN
    bad = F.isnan(F.coalesce(total, F.lit(float("nan"))))
    return points.where(require_length("x", d, "point")).where(
        F.when(bad, F.raise_error(F.lit(NOT_FINITE))).otherwise(F.lit(True)))


def _assigned_expr(points: DataFrame, cents: Centroids) -> DataFrame:
    d = _dim(cents)
    checked = _checked(points, d)
    return checked.withColumn("_m", nearest("x", cents)).select(
        *points.columns, F.col("_m.j").alias("j"), F.col("_m.d").alias("d")
    )


def distance_rows(points: DataFrame, cents: Centroids, mode: str = "auto") -> DataFrame:
    """One row ``(id, j, d)`` per point and centroid (n*k rows).

    Generated from the point row itself (the k centroids are constants),
    so no join operator is involved."""
    _check_size(cents)
    mode = _mode(cents, mode)
    if mode == "expr":
        d = _dim(cents)
        pairs = F.array(
            *[
                F.struct(F.lit(j).cast("int").alias("j"), dist_const("x", c).alias("d"))
                for j, c in sorted(cents.items())
            ]
        )
        return (
            _checked(points, d)
            .select("id", F.explode(pairs).alias("_p"))
            .select("id", "_p.j", "_p.d")
        )
    ship = _Shipped(points.sparkSession, cents)
    d = ship.d

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            X = _batch_points(batch, d)
            at = np.arange(len(X))
            for off, C in ship.chunks():
                D = distances(X, C)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(np.repeat(at, len(C)))),
                     pa.array(np.tile(ship.js[off:off + len(C)], len(X))), pa.array(D.reshape(-1))],
                    names=["id", "j", "d"])

    return _with_coords(points, d, ["id"]).mapInArrow(run, "id bigint, j int, d double")


# Fixed value: distances that one slice of points may have in a task.
_SLICE_DISTANCES = 1 << 22


def distance_lists(points: DataFrame, cents: Centroids, mode: str = "auto") -> DataFrame:
    """A2/A3 in the point's own row: ``(id, l)``, l the array of
    ``struct<d, j>`` to every centroid (k entries).  No shuffle."""
    _check_size(cents)
    if _mode(cents, mode) == "expr":
        pairs = F.array(*[F.struct(dist_const("x", c).alias("d"), F.lit(j).cast("int").alias("j"))
                          for j, c in sorted(cents.items())])
        return _checked(points, _dim(cents)).select("id", pairs.alias("l"))
    ship = _Shipped(points.sparkSession, cents)
    d, k = ship.d, ship.k

    def run(batches):
        import numpy as np
        import pyarrow as pa

        rows = max(1, _SLICE_DISTANCES // k)
        for whole in batches:
            for s in range(0, whole.num_rows, rows):
                batch = whole.slice(s, rows)
                X = _batch_points(batch, d)
                D = np.concatenate([distances(X, C) for _, C in ship.chunks()], axis=1)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(D.reshape(-1)), pa.array(np.tile(ship.js, len(X)))], names=["d", "j"])
                offsets = pa.array(np.arange(len(X) + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.ListArray.from_arrays(offsets, pairs)], names=["id", "l"])

    return _with_coords(points, d, ["id"]).mapInArrow(run, "id bigint, l array<struct<d:double,j:int>>")


def assign_stepwise(points: DataFrame, cents: Centroids, mode: str = "auto") -> DataFrame:
    """K9 'cross' form: distances -> per-point argmin (shuffle) -> join back."""
    zik = (
        distance_rows(points, cents, mode)
        .groupBy("id")
        .agg(F.min(F.struct("d", "j")).alias("_m"))
        .select("id", F.col("_m.j").alias("j"), F.col("_m.d").alias("d"))
    )
    # both sides grow with the data: a shuffled join, never an estimate-based broadcast
    return points.join(zik.hint("merge"), "id")


# ---- cluster sums and one step (A4, K3) ------------------------------------


def cluster_sums(assigned: DataFrame) -> DataFrame:
    """A4 in long form: ``(j, pos, s, n)`` coordinate sums and sizes.

    ``posexplode`` feeds a partial aggregate in the same stage, so at most
    k*d rows per partition reach the shuffle.  (A wide aggregate of d sum
    columns was measured 3x slower per job: its generated code is large.)"""
    e = assigned.select("j", F.posexplode("x").alias("pos", "_v"))
    return e.groupBy("j", "pos").agg(F.sum("_v").alias("s"), F.count(F.lit(1)).alias("n"))


def _partial_sums_arrow(points: DataFrame, ship: "_Shipped | Centroids") -> DataFrame:
    """Per partition: nearest centroid by numpy, then the partition's sums
    in long form ``(j, pos, s, n)``: k*d rows per partition at most."""
    if isinstance(ship, dict):
        ship = _Shipped(points.sparkSession, ship)
    js, k, d = ship.js, ship.k, ship.d

    def run(batches):
        import numpy as np
        import pyarrow as pa

        S = np.zeros((k, d))
        N = np.zeros(k, dtype=np.int64)
        for batch in batches:
            X = _batch_points(batch, d)
            best, _ = _nearest(X, ship)
            N += np.bincount(best, minlength=k)
            for t in np.unique(best):
                S[t] += X[best == t].sum(axis=0)
        seen = np.flatnonzero(N)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(js[seen], d)),
             pa.array(np.tile(np.arange(d, dtype=np.int32), len(seen))),
             pa.array(S[seen].reshape(-1)), pa.array(np.repeat(N[seen], d))],
            names=["j", "pos", "s", "n"])

    return _with_coords(points, d, []).mapInArrow(run, "j int, pos int, s double, n bigint")


def cluster_means(assigned: DataFrame) -> DataFrame:
    """A4 as a frame: ``(j, n, c array<double>)`` (k rows)."""
    sums = cluster_sums(assigned)
    return sums.groupBy("j").agg(
        F.max("n").alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))),
                    lambda e: e["s"]).alias("_s"),
    ).select("j", "n", F.transform("_s", lambda v: v / F.col("n")).alias("c"))


def vector_means_long(df: DataFrame, key: str, x: str = "x") -> DataFrame:
    """A4 for any width: ``(key, pos, n, v)`` mean of each coordinate per key.

    ``posexplode`` feeds a partial aggregate in the same stage, so only
    (keys x d) buffers per partition reach the shuffle."""
    e = df.select(key, F.posexplode(x).alias("pos", "_v"))
    return e.groupBy(key, "pos").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("v")
    ).withColumn("pos", F.col("pos").cast("int"))


def step_sums(points: DataFrame, cents: Centroids, assign_mode: str = "auto",
              coalesce: int | None = None) -> list:
    """The aggregate behind one Lloyd step: rows ``(j, pos, s, n)``, one per
    cluster and coordinate, summed over all points by the executors (one
    job).  ``coalesce`` merges the partitions of these k*d sums."""
    _check_size(cents)
    ship = None
    if assign_mode == "cross":
        sums = cluster_sums(assign_stepwise(points, cents, _mode(cents, "auto")))
    elif _mode(cents, assign_mode) == "expr":
        sums = cluster_sums(_assigned_expr(points, cents))
    else:
        ship = _Shipped(points.sparkSession, cents)
        sums = _partial_sums_arrow(points, ship).groupBy("j", "pos").agg(
            F.sum("s").alias("s"), F.sum("n").alias("n"))
    try:
        return (sums.coalesce(coalesce) if coalesce else sums).collect()
    finally:
        if ship is not None:
            ship.release()


def step(
    points: DataFrame, cents: Centroids, assign_mode: str = "auto",
    empty_cluster: str = "drop", coalesce: int | None = None,
) -> tuple[Centroids, dict[int, int]]:
    """K3: one Lloyd step (one job). Returns the new centroids and sizes."""
    d = _dim(cents)
    new: Centroids = {}
    sizes: dict[int, int] = {}
    for r in step_sums(points, cents, assign_mode, coalesce):
        j, pos, n = int(r["j"]), int(r["pos"]), int(r["n"])
        new.setdefault(j, [0.0] * d)[pos] = r["s"] / n
        sizes[j] = n
    return _with_empty(new, sizes, cents, empty_cluster)


def _with_empty(new: Centroids, sizes: dict[int, int], cents: Centroids, empty_cluster: str):
    if empty_cluster == "keep":
        for j, c in cents.items():
            new.setdefault(j, list(c))
            sizes.setdefault(j, 0)
    elif empty_cluster != "drop":
        raise ValueError(f"unknown empty_cluster {empty_cluster!r}")
    return new, sizes


def euclid(a: Sequence[float], b: Sequence[float]) -> float:
    return math.sqrt(sum((x - y) * (x - y) for x, y in zip(a, b, strict=True)))


def shifts(old: Centroids, new: Centroids) -> dict[int, float]:
    """Distance moved by every centroid present in both tables."""
    return {j: euclid(new[j], old[j]) for j in sorted(new) if j in old}


def shift_frame(old: DataFrame, new: DataFrame) -> DataFrame:
    """J5 as a DataFrame: inner join of two k-row centroid tables."""
    from clusterfold.functions.vectors import vdist

    o = old.select("j", F.col("c").alias("c_old"))
    n = new.select("j", F.col("c").alias("c_new"))
    return n.join(F.broadcast(o), "j").select("j", vdist("c_new", "c_old").alias("shift"))


# ---- the loop (K4-K6, K8) ------------------------------------------------------


@dataclass
class KMeansResult:
    centroids: Centroids
    trace: list[dict] = field(default_factory=list)
    sizes: dict[int, int] = field(default_factory=dict)
    # centroids each iteration assigned to (iteration i used history[i-1])
    history: list[Centroids] = field(default_factory=list)

    def centroids_frame(self, spark: SparkSession) -> DataFrame:
        return centroid_frame(spark, self.centroids)

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        schema = (
            "iteration int, n_clusters int, n_compared int, n_moved int, "
            "n_stable int, seconds double"
        )
        rows = [
            (t["iteration"], t["n_clusters"], t["n_compared"], t["n_moved"],
             t["n_stable"], t["seconds"])
            for t in self.trace
        ]
        return spark.createDataFrame(rows, schema)

    def assign(self, points: DataFrame, mode: str = "auto") -> DataFrame:
        return assign(points, self.centroids, mode)


def kmeans(
    points: DataFrame,
    k: int | None = None,
    *,
    init: str | Centroids | DataFrame = "first",
    seed: int = 0,
    max_iter: int = 10,
    eps: float = 1e-3,
    empty_cluster: str = "drop",
    assign_mode: str = "auto",
    cache: bool = True,
    coalesce: int | None = None,
    log: str | None = None,
) -> KMeansResult:
    """K8: parameterised K-means.

    Stops after ``max_iter`` steps or as soon as no centroid moved more than
    ``eps`` (centroids that vanished are not compared, as with an inner
    join).  ``k`` defaults to the number of distinct labels; seeds are taken
    from the persisted points.  ``coalesce`` is the number of partitions of
    the new centroids' sums (never of the points).

    With ``cache``, wide vectors run on packed blocks with distance bounds
    (``bounds.py``): the same assignments, but a step computes distances only
    for the points whose bounds do not prove their centroid
    (``n_recomputed`` in the trace).

    ``log`` names a folder in shared storage to which every finished
    iteration is written; a later call with that folder and the same
    arguments goes on after the last finished one, so that a lost driver
    costs one iteration."""
    pts = points
    done = read_log(points.sparkSession, log) if log else None
    seeded = done is not None or isinstance(init, (dict, DataFrame))
    if cache and not (seeded and assign_mode in ("auto", "arrow")):
        pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
    bounded = None
    try:
        if done is not None:
            cents = done.centroids
        elif isinstance(init, dict):
            cents = {int(j): [float(v) for v in c] for j, c in init.items()}
            _check_size(cents)
        elif isinstance(init, DataFrame):
            cents = collect_centroids(init)
        else:
            if k is None:
                k = k_from_labels(pts)
            cents = collect_centroids(seed_frame(pts, k, init, seed))
        result = done or KMeansResult(centroids=cents)
        if result.trace and (result.trace[-1]["n_moved"] == 0 or not cents):
            return result
        if cache and cents and assign_mode != "cross" and _mode(cents, assign_mode) == "arrow":
            d = _dim(cents)
            bounded = BoundedLloyd(_with_coords(pts, d, []), _batch_points, d)
        elif cache and pts is points:
            pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
        for it in range(len(result.trace) + 1, max_iter + 1):
            t0 = time.perf_counter()
            result.history.append(cents)
            if bounded:
                new, sizes = _bounded_step(bounded, cents, empty_cluster)
                pts.unpersist()  # from here on the blocks hold the points
            else:
                new, sizes = step(pts, cents, assign_mode, empty_cluster, coalesce)
            moved_by = shifts(cents, new)
            n_moved = sum(1 for s in moved_by.values() if s > eps)
            result.trace.append(
                {
                    "iteration": it,
                    "n_clusters": len(new),
                    "n_compared": len(moved_by),
                    "n_moved": n_moved,
                    "n_stable": len(moved_by) - n_moved,
                    "n_recomputed": bounded.recomputed if bounded else sum(sizes.values()),
                    "seconds": time.perf_counter() - t0,
                }
            )
            cents = new
            result.centroids = new
            result.sizes = sizes
            if log:
                write_log(points.sparkSession, log, result)
            if n_moved == 0 or not new:
                break
        return result
    finally:
        if bounded:
            bounded.release()
        if cache and pts is not points or not bounded:
            pts.unpersist()


def _bounded_step(bounded: BoundedLloyd, cents: Centroids, empty_cluster: str):
    """K3 on packed blocks; see ``step``."""
    ship = _Shipped(bounded.points.sparkSession, cents)
    js, C = _matrix(cents)
    try:
        S, N = bounded.step(ship, js, C)
    finally:
        ship.release()
    new = {int(j): (S[i] / N[i]).tolist() for i, j in enumerate(js) if N[i]}
    sizes = {int(j): int(N[i]) for i, j in enumerate(js) if N[i]}
    return _with_empty(new, sizes, cents, empty_cluster)


# ---- the iteration log ---------------------------------------------------------


_LOG = "iteration int, j int, c array<double>, n bigint, c_old array<double>, n_clusters int, n_compared int, n_moved int, n_stable int, n_recomputed bigint, seconds double"


def write_log(spark: SparkSession, folder: str, result: KMeansResult) -> None:
    """The last iteration of ``result``: one row a centroid (new, and the one
    assigned to), as one Parquet file in a folder of its own.  A folder
    without the writer's success mark does not count."""
    t, old = result.trace[-1], result.history[-1]
    report = tuple(t[c] for c in ("n_clusters", "n_compared", "n_moved", "n_stable", "n_recomputed", "seconds"))
    rows = [(t["iteration"], j, result.centroids.get(j), result.sizes.get(j), old.get(j), *report) for j in sorted({*old, *result.centroids})]
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("overwrite").parquet(f"{folder}/iteration={t['iteration']}")


def read_log(spark: SparkSession, folder: str) -> KMeansResult | None:
    """The run up to the last iteration that ``write_log`` finished, or None."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    result, it = None, 1
    while fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/iteration={it}/_SUCCESS")):
        rows = spark.read.schema(_LOG).parquet(f"{folder}/iteration={it}").collect()
        result = result or KMeansResult(centroids={})
        result.centroids = {r["j"]: list(r["c"]) for r in rows if r["c"] is not None}
        result.sizes = {r["j"]: r["n"] for r in rows if r["n"] is not None}
        result.history.append({r["j"]: list(r["c_old"]) for r in rows if r["c_old"] is not None})
        result.trace.append({"iteration": it, **{c: rows[0][c] for c in ("n_clusters", "n_compared", "n_moved", "n_stable", "n_recomputed", "seconds")}})
        it += 1
    return result


# ---- reports (K7, K10) -----------------------------------------------------------


def cluster_labels(assigned: DataFrame, label_col: str = "label") -> DataFrame:
    """Labels present in each cluster, with their point counts."""
    return assigned.groupBy("j", label_col).agg(F.count(F.lit(1)).alias("n"))


def label_trace(points: DataFrame, history: Sequence[Centroids],
                label_col: str = "label") -> DataFrame:
    """K7 at every iteration: ``(iteration, j, label, n)``, the labels found
    in each cluster when iteration i assigned the points to ``history[i-1]``.

    One job for as many iterations as a task closure holds centroids of
    (``CLOSURE_VALUES`` numbers), one iteration at least: each task assigns its
    points under these centroids and returns its counts; a partial + final
    aggregate adds them."""
    if not history:
        raise ValueError("empty history")
    for cents in history:
        _check_size(cents)
    out, group, held = None, [], 0
    for it, cents in enumerate(history, start=1):
        size = len(cents) * _dim(cents)
        if group and held + size > CLOSURE_VALUES:
            part = _label_counts(points, group, label_col)
            out, group, held = part if out is None else out.unionByName(part), [], 0
        group.append((it, cents))
        held += size
    part = _label_counts(points, group, label_col)
    return part if out is None else out.unionByName(part)


def _label_counts(points: DataFrame, history: Sequence[tuple[int, Centroids]], label_col: str) -> DataFrame:
    d = _dim(history[0][1])
    ships = [(it, _Shipped(points.sparkSession, c)) for it, c in history]
    label_type = points.schema[label_col].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            # a NULL label is a label of its own
            labels = batch.column(label_col).dictionary_encode(null_encoding="encode")
            codes = labels.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            width = len(labels.dictionary)
            X = _batch_points(batch, d)
            for it, ship in ships:
                best = _nearest(X, ship)[0]
                found, n = np.unique(best * width + codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), it, np.int32)), pa.array(ship.js[found // width]),
                     labels.dictionary.take(pa.array(found % width)), pa.array(n.astype(np.int64))],
                    names=["iteration", "j", label_col, "n"])

    partial = _with_coords(points, d, [label_col]).mapInArrow(
        run, f"iteration int, j int, {label_col} {label_type}, n bigint")
    return partial.groupBy("iteration", "j", label_col).agg(F.sum("n").alias("n"))


def variant_timings(
    points: DataFrame,
    init: Centroids,
    max_iter: int = 10,
    eps: float = 1e-3,
    caches: Sequence[bool] = (False, True),
    coalesces: Sequence[int | None] = (None, 8),
    assigns: Sequence[str] = ("cross", "auto"),
) -> list[tuple]:
    """Seconds and report per iteration for persist x coalesce (of the
    new centroids) x assignment (``cross``: the reference's cartesian shape;
    ``auto``: the broadcast form it announces)."""
    rows = []
    for a in assigns:
        for c in caches:
            for co in coalesces:
                name = f"persist({'+' if c else '-'}) coalesce({co or '-'}) assign({a})"
                res = kmeans(points, init=init, max_iter=max_iter, eps=eps,
                             assign_mode=a, cache=c, coalesce=co)
                for t in res.trace:
                    rows.append((name, a, c, co or 0, t["iteration"], t["seconds"],
                                 t["n_clusters"], t["n_moved"]))
    return rows
