"""Linear regression by gradient descent (G1-G7), squared loss.

A training frame holds ``x array<double>`` (bias as a trailing 1.0),
``y double`` and, for the order-dependent methods, a unique order key.

Order-free methods
------------------
* ``gradient`` (G1): one aggregate of d sums, sum(2 (w.x - y) x).
* ``batch_gd`` (G2): ``method='gram'`` reads the data once (X'X, X'y, m:
  d*d + d + 1 numbers by partial aggregation) and runs the epochs on the
  driver; beyond ``MAX_GRAM_FEATURES`` the matrix is a table of blocks
  (``block_gram.py``); ``method='scan'`` runs one aggregate per epoch over a
  persisted frame, as the reference does.  Same algebra.

Order-dependent methods (one pass in key order)
-----------------------------------------------
One SGD step ``w <- w - c (w.x - y) x`` is an affine map of w:
``w <- (I - c x x') w + c y x``.  Affine maps compose associatively, so an
ordered pass is a product of (d+1)x(d+1) matrices, which Spark can reduce
in parallel without changing the result:

1. ``repartitionByRange(keys + ord)`` + ``sortWithinPartitions``: every task
   holds contiguous key-ordered ranges.  A hot group spreads over as many
   tasks as its size needs; nothing is gathered in one place.
2. ``mapInPandas``: each task composes its rows' maps (numpy; short runs of
   many groups together, one rank-1 update per row position; long runs block
   by block, each block one triangular solve) into one matrix per group run.
3. without groups, the chunks (one per partition, or per partition and
   shard) go through a prefix scan (``scan.py``): a tree of bounded fan-in
   composes them, and a down-sweep gives the weights after every shard.  No
   task chains the maps of all partitions;
4. with groups, the chunks (at most one per group and partition) are
   hash-partitioned by group and sorted; a second ``mapInPandas`` chains each
   group's chunks in key order and applies them to w0, finishing all
   single-chunk groups in one batched product (no per-group pandas call, so a
   million small groups cost no more than a few large ones).  Beyond
   ``fan`` partitions the scan's up-sweep first shortens the groups that
   have more chunks than that.

The ordered pass (G4), shard averaging (G5), shard relay (G6) and sampled
SGD (G3) are all this one fold with different keys.  AdaGrad (G7) is not
affine (its rate depends on the running squared gradients): small groups are
sequential folds, hash-partitioned by group, sorted, streamed through
``mapInPandas`` with the state carried across Arrow batches (constant
memory; all groups of a batch advance together); large ones are solved in
parallel over their ordered ranges (``adagrad.py``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterfold.functions.vectors import dot_const, require_length
from clusterfold.operators.adagrad import adagrad_in_time
from clusterfold.operators.block_gram import descend
from clusterfold.operators.indexing import hash_key, row_index_counted
from clusterfold.operators.scan import Affine, fan_for, levels, prefixes, saved, total

# Fixed value: rows per block in the pairwise matrix product (memory cap
# of a block: rows * (d+1)^2 doubles).
_BLOCK_VALUES = 1 << 20


# ---- order-free (G1, G2) ------------------------------------------------------


def _check_finite(w: Sequence[float], what: str) -> None:
    if not all(math.isfinite(v) for v in w):
        raise FloatingPointError(f"{what} diverged: {list(w)}")


# Fixed value: up to this feature count the sums are aggregate columns
# (compiled together); wider vectors use long-form partial sums.
_WIDE_FEATURES = 8

# Fixed value: the widest vectors whose d x d matrix the driver holds.
MAX_GRAM_FEATURES = 1024


def gradient(train: DataFrame, w: Sequence[float]) -> list[float]:
    """G1: sum over rows of 2 (w.x - y) x (one aggregate job)."""
    d = len(w)
    checked = train.where(require_length("x", d, "feature vector"))
    if d > _WIDE_FEATURES:
        # residual per row, then (pos, value) rows feed a partial aggregate
        r = checked.select((2.0 * (F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in w]),
                                                            lambda a, b: a * b),
                                                 F.lit(0.0), lambda acc, v: acc + v)
                                     - F.col("y"))).alias("_r"), "x")
        rows = r.select("_r", F.posexplode("x").alias("pos", "v")).groupBy("pos").agg(
            F.sum(F.col("_r") * F.col("v")).alias("g")).collect()
        g = [0.0] * d
        for row in rows:
            g[int(row["pos"])] = float(row["g"])
        return g
    r = 2.0 * (dot_const("x", w) - F.col("y"))
    row = checked.agg(*[F.sum(r * F.col("x")[i]).alias(f"g{i}") for i in range(d)]).first()
    return [float(row[f"g{i}"] or 0.0) for i in range(d)]


def _scalar_gradient(cached: DataFrame, w: Sequence[float]) -> list[float]:
    """G1 over scalar feature columns: one aggregate of d sums."""
    r = F.lit(0.0)
    for i, v in enumerate(w):
        r = r + F.col(f"_x{i}") * float(v)
    r = 2.0 * (r - F.col("y"))
    row = cached.agg(*[F.sum(r * F.col(f"_x{i}")).alias(f"g{i}") for i in range(len(w))]).first()
    return [float(row[f"g{i}"] or 0.0) for i in range(len(w))]


def _gram_wide(train: DataFrame, d: int) -> tuple[int, list[list[float]], list[float]]:
    """X'X, X'y and m for wide vectors: each task forms its own d x d
    products with numpy (Arrow batches) and returns them in long form; a
    partial + final aggregate adds them (d*d + d rows per task)."""
    def run(batches):
        import numpy as np
        import pandas as pd

        G = np.zeros((d, d))
        h = np.zeros(d)
        m = 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf["x"].to_numpy())
            y = pdf["y"].to_numpy(dtype=float)
            G += X.T @ X
            h += X.T @ y
            m += len(pdf)
        ii, kk = np.triu_indices(d)
        yield pd.DataFrame({
            "i": np.concatenate([ii, np.arange(d), [-1]]).astype(np.int32),
            "k": np.concatenate([kk, np.full(d, -1), [-1]]).astype(np.int32),
            "v": np.concatenate([G[ii, kk], h, [float(m)]]),
        })

    src = train.where(require_length("x", d, "feature vector")).select(
        F.col("x").cast("array<double>").alias("x"), F.col("y").cast("double").alias("y"))
    rows = src.mapInPandas(run, "i int, k int, v double").groupBy("i", "k").agg(
        F.sum("v").alias("v")).collect()
    G = [[0.0] * d for _ in range(d)]
    h = [0.0] * d
    m = 0
    for r in rows:
        i, k, v = int(r["i"]), int(r["k"]), float(r["v"])
        if i < 0:
            m = int(round(v))
        elif k < 0:
            h[i] = v
        else:
            G[i][k] = G[k][i] = v
    return m, G, h


def gram(train: DataFrame, d: int) -> tuple[int, list[list[float]], list[float]]:
    """m, X'X and X'y in one aggregate (d*d + d + 1 partial sums per task)."""
    if d > _WIDE_FEATURES:
        return _gram_wide(train, d)
    x = F.col("x")
    aggs = [F.count(F.lit(1)).alias("m")]
    for i in range(d):
        for k in range(i, d):
            aggs.append(F.sum(x[i] * x[k]).alias(f"g{i}_{k}"))
        aggs.append(F.sum(x[i] * F.col("y")).alias(f"h{i}"))
    row = train.where(require_length("x", d, "feature vector")).agg(*aggs).first()
    G = [[0.0] * d for _ in range(d)]
    for i in range(d):
        for k in range(i, d):
            G[i][k] = G[k][i] = float(row[f"g{i}_{k}"] or 0.0)
    h = [float(row[f"h{i}"] or 0.0) for i in range(d)]
    return int(row["m"]), G, h


def batch_gd(
    train: DataFrame, w0: Sequence[float], epochs: int, step: float, method: str = "gram",
) -> list[float]:
    """``w <- w - (step/m) sum 2 (w.x - y) x`` for ``epochs`` epochs."""
    w = [float(v) for v in w0]
    d = len(w)
    if method == "gram" and d > MAX_GRAM_FEATURES:
        method = "blocks"  # the same sums, without a d x d matrix on the driver
    if method == "blocks":
        w = descend(train, w, epochs, step)
        _check_finite(w, "batch_gd")
        return w
    if method == "gram":
        import numpy as np

        m, G, h = gram(train, d)
        if m == 0:
            return w
        G, h, v = np.asarray(G), np.asarray(h), np.asarray(w)
        for _ in range(epochs):
            v = v - 2.0 * (G @ v - h) * (step / m)
        w = v.tolist()
        _check_finite(w, "batch_gd")
        return w
    if method != "scan":
        raise ValueError(f"unknown method {method!r}")
    narrow = d <= _WIDE_FEATURES
    if narrow:  # checked once, kept as d + 1 scalar columns
        cached = train.where(require_length("x", d, "feature vector")).select(
            *[F.col("x")[i].cast("double").alias(f"_x{i}") for i in range(d)],
            F.col("y").cast("double").alias("y"))
    else:
        cached = train.select("x", "y")
    cached = cached.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        m = cached.count()
        if m == 0:
            return w
        for _ in range(epochs):
            g = _scalar_gradient(cached, w) if narrow else gradient(cached, w)
            w = [w[i] - g[i] * (step / m) for i in range(d)]
        _check_finite(w, "batch_gd")
        return w
    finally:
        cached.unpersist()


# ---- the affine fold (G3-G6) ---------------------------------------------------


def _compose(X, y, c):
    """Map of a run of rows (row 1 applied first), by blocks of B rows.

    The residual coefficients u of a block solve a unit lower triangular
    system, (I + C L) u = C (X w - y) with L the strict lower part of X X',
    and the block takes w to w - X' u.  So a block costs a few matrix
    products and one solve instead of B products of (d+1)^2 matrices."""
    import numpy as np

    n, d = X.shape
    rows = max(16, min(64, d))
    many = max(1, _BLOCK_VALUES // (rows * (rows + 2 * d) + (d + 1) * (d + 1)))
    total = np.eye(d + 1)
    idx = np.arange(d)
    for s in range(0, n, rows * many):
        Xs, ys, cs = (v[s:s + rows * many] for v in (X, y, c))
        pad = -len(Xs) % rows  # rows with c = 0 change nothing
        if pad:
            Xs = np.concatenate([Xs, np.zeros((pad, d))])
            ys, cs = np.append(ys, np.zeros(pad)), np.append(cs, np.zeros(pad))
        B = Xs.reshape(-1, rows, d)
        yb, cb = ys.reshape(-1, rows, 1), cs.reshape(-1, rows, 1)
        lower = np.tril(np.matmul(B, B.transpose(0, 2, 1)), -1)
        S = np.linalg.solve(np.eye(rows) + cb * lower, cb * np.concatenate([B, -yb], axis=2))
        M = np.zeros((len(B), d + 1, d + 1))
        M[:, :d, :] = -np.matmul(B.transpose(0, 2, 1), S)
        M[:, idx, idx] += 1.0
        M[:, d, d] = 1.0
        while len(M) > 1:
            if len(M) % 2:
                M = np.concatenate([M, np.eye(d + 1)[None]], axis=0)
            M = np.matmul(M[1::2], M[0::2])
        total = M[0] @ total
    return total


# Fixed value: up to this feature count the features reach pandas as
# scalar columns (whole numpy arrays); beyond it as one array column.
_SCALAR_FEATURES = 16


def _coords(d: int) -> list:
    if d <= _SCALAR_FEATURES:
        return [F.col("x")[i].cast("double").alias(f"_x{i}") for i in range(d)]
    return [F.col("x").cast("array<double>").alias("x")]


def _features(pdf, d: int):
    """(n, d) float64 matrix of a batch's features."""
    import numpy as np

    if d <= _SCALAR_FEATURES:
        return pdf[[f"_x{i}" for i in range(d)]].to_numpy(dtype=np.float64)
    return np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, d))


# Fixed value: runs up to this many rows are composed together, one
# batched rank-1 update per row position; longer runs use ``_compose``.
_SHORT_RUN = 64


def _compose_runs(X, y, c, starts, ends):
    """Composed map of every run ``[starts[i], ends[i])`` of a sorted batch,
    vectorised across runs: (runs, d+1, d+1)."""
    import numpy as np

    d = X.shape[1]
    lengths = ends - starts
    out = np.empty((len(starts), d + 1, d + 1))
    long_runs = np.flatnonzero(lengths > _SHORT_RUN)
    for i in long_runs:
        out[i] = _compose(X[starts[i]:ends[i]], y[starts[i]:ends[i]], c[starts[i]:ends[i]])
    short = np.flatnonzero(lengths <= _SHORT_RUN)
    # slices keep (runs, d+1, d+1) within the same memory budget as a block
    step = max(1, _BLOCK_VALUES // ((d + 1) * (d + 1)))
    for b in range(0, len(short), step):
        sl = short[b:b + step]
        M = np.broadcast_to(np.eye(d + 1), (len(sl), d + 1, d + 1)).copy()
        L, S = lengths[sl], starts[sl]
        for t in range(int(L.max())):
            act = np.flatnonzero(L > t)
            idx = S[act] + t
            x = X[idx]
            now = M[act]
            err = np.matmul(x[:, None, :], now[:, :d, :])  # x'M, less y
            err[:, 0, d] -= y[idx]
            now[:, :d, :] -= (c[idx][:, None] * x)[:, :, None] * err
            M[act] = now
        out[sl] = M
    return out


# Fixed value: from this feature count on a run of few rows keeps its map as a
# product of low rank.
_LOW_RANK_FEATURES = 32


def _low_rank(X, y, c) -> Affine:
    """Map of a short run as the identity plus a product of rank len(X):
    ``w - X' u`` with the residual coefficients u of ``_compose``."""
    import numpy as np

    n, d = X.shape
    lower = np.tril(X @ X.T, -1)
    S = np.linalg.solve(np.eye(n) + c[:, None] * lower, c[:, None] * np.concatenate([X, -y[:, None]], axis=1))
    return Affine(d, None, -X.T, S)


def _run_maps(X, y, c, starts, ends) -> list[Affine]:
    """Composed map of every run of a sorted batch."""
    import numpy as np

    d = X.shape[1]
    if d < _LOW_RANK_FEATURES:
        return [Affine(d, M) for M in _compose_runs(X, y, c, starts, ends)]
    out: list = [None] * len(starts)
    small = (ends - starts) * 2 <= d
    for i in np.flatnonzero(small):
        own = slice(starts[i], ends[i])
        out[i] = _low_rank(X[own], y[own], c[own])
    rest = np.flatnonzero(~small)
    for i, M in zip(rest, _compose_runs(X, y, c, starts[rest], ends[rest]) if len(rest) else ()):
        out[i] = Affine(d, M)
    return out


def _null_safe(df: DataFrame, keys: Sequence[str]):
    """Group keys for pandas: a NULL of a non-string key would become NaN,
    which equals nothing, so such a key travels as a value that is never
    NULL and a flag.  Returns (frame, key columns, function that restores
    the keys of a result)."""
    flags: dict[str, str] = {}
    for k in keys:
        kind = df.schema[k].dataType
        if not isinstance(kind, T.StringType):
            dated = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
            flags[k] = f"_null_{k}"
            df = df.withColumn(flags[k], F.col(k).isNull()).withColumn(
                k, F.coalesce(F.col(k), F.lit("1970-01-01" if dated else "0").cast(kind)))

    def restore(out: DataFrame) -> DataFrame:
        return out.select(*[F.when(~F.col(flags[c]), F.col(c)).alias(c) if c in flags else F.col(c)
                            for c in out.columns if c not in flags.values()])

    return df, [*keys, *flags.values()], restore


def _runs(pdf, cols):
    """Start and end offsets of the runs of equal ``cols`` in a sorted batch."""
    import numpy as np

    change = np.zeros(len(pdf), dtype=bool)
    change[0] = True
    for col in cols:
        v = pdf[col].to_numpy()
        change[1:] |= v[1:] != v[:-1]  # a NULL string is None, equal to itself
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], len(pdf))


def _chunk_schema(df: DataFrame, keys: list[str], ord_col: str) -> T.StructType:
    fields = [df.schema[k] for k in keys]
    fields += [
        T.StructField("_first", df.schema[ord_col].dataType, True),
        T.StructField("_n", T.LongType(), False),
        T.StructField("_node", T.LongType(), False),
        T.StructField("_k", T.IntegerType(), False),
        T.StructField("_r", T.IntegerType(), False),
        T.StructField("_m", T.BinaryType(), False),
    ]
    return T.StructType(fields)


def affine_chunks(
    df: DataFrame, keys: list[str], ord_col: str, coef: float | str, d: int,
    partitions: int | None = None, ordered_input: bool = False,
) -> DataFrame:
    """Phase 1 of the fold: one composed map per (partition, key run).

    ``coef`` is the SGD factor c of ``w <- w - c (w.x - y) x``: a number or
    the name of a per-row column; ``d`` the feature count.  Output: ``keys,
    _first (first ord), _n`` and the map as ``scan.py`` reads it (``_node`` is
    the partition, ``_k`` the place in it): one row per group per partition,
    so a partition emits at most as many rows as it holds groups, and a group
    at most one row per partition.

    ``ordered_input``: ``df`` is already partitioned so that every partition
    holds a contiguous range of the (keys, ord) order (e.g. the output of
    ``row_index``); then only the local sort runs, no new exchange."""
    cexpr = F.col(coef).cast("double") if isinstance(coef, str) else F.lit(float(coef))
    src = df.where(require_length("x", d, "feature vector")).select(
        *keys, ord_col, *_coords(d), F.col("y").cast("double").alias("y"), cexpr.alias("_c"))
    if not ordered_input:
        # no explicit count unless given: AQE may then merge adjacent ranges
        src = (src.repartitionByRange(partitions, *keys, ord_col) if partitions
               else src.repartitionByRange(*keys, ord_col))
    parted = src.sortWithinPartitions(*keys, ord_col)
    schema = _chunk_schema(df, keys, ord_col)

    def run(batches):
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        node, k = TaskContext.get().partitionId(), 0
        cur = None  # (key, first ord, rows, map) of the run that may go on
        # at most a matrix for each row: slices keep them within the budget
        most = max(1, 8 * _BLOCK_VALUES // ((d + 1) * (d + 1)))
        for pdf in (b.iloc[s:s + most] for b in batches for s in range(0, len(b), most)):
            starts, ends = _runs(pdf, keys)
            maps = _run_maps(_features(pdf, d), pdf["y"].to_numpy(dtype=float),
                             pdf["_c"].to_numpy(dtype=float), starts, ends)
            rkeys = [pdf[c].to_numpy()[starts] for c in keys]
            firsts = pdf[ord_col].to_numpy()[starts]
            done = []
            for i, (n, own) in enumerate(zip((ends - starts).tolist(), maps)):
                key = tuple(col[i] for col in rkeys)
                if cur is not None and key == cur[0]:
                    cur = (key, cur[1], cur[2] + n, own.after(cur[3]))
                    continue
                if cur is not None:
                    done.append(cur)
                cur = (key, firsts[i], n, own)
            if done:
                yield _chunk_rows(keys, done, ord_col, node, k)
                k += len(done)
        if cur is not None:
            yield _chunk_rows(keys, [cur], ord_col, node, k)

    return parted.mapInPandas(run, schema)


def _chunk_rows(keys, done, ord_col, node, k):
    import pandas as pd

    data = {c: [t[0][i] for t in done] for i, c in enumerate(keys)}
    data.update(_first=[t[1] for t in done], _n=[t[2] for t in done], _node=node, _k=range(k, k + len(done)),
                _r=[t[3].rank for t in done], _m=[t[3].bytes() for t in done])
    return pd.DataFrame(data)


def _finite(v, what: str = "SGD"):
    import numpy as np

    if not np.isfinite(v).all():
        raise FloatingPointError(f"{what} diverged")
    return v


def _weights(vectors: DataFrame, keys: Sequence[str], d: int, name: str = "_w") -> DataFrame:
    """``keys, pos, w`` from weights as binary doubles (d of them are kept)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(name)).to_pylist()
            W = _finite(np.array([np.frombuffer(r)[:d] for r in rows]).reshape(-1, d))
            at = pa.array(np.repeat(np.arange(len(W)), d))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)).take(at) for c in keys],
                 pa.array(np.tile(np.arange(d, dtype=np.int32), len(W))), pa.array(W.ravel())], names=[*keys, "pos", "w"])

    schema = T.StructType([*[vectors.schema[c] for c in keys], T.StructField("pos", T.IntegerType(), False), T.StructField("w", T.DoubleType(), False)])
    return vectors.select(*keys, name).mapInArrow(run, schema)


def scan_chunks(chunks: DataFrame, w0: Sequence[float], trace: str | None = None) -> DataFrame:
    """Phase 2 without groups: ``pos, w`` after all chunks or, with ``trace``
    (a key of the chunks that grows with their order), ``trace, pos, w`` after
    the last chunk of each of its values."""
    import numpy as np

    d, v0 = len(w0), np.asarray([float(v) for v in w0])
    own = saved(chunks)
    if trace:
        each = prefixes(own, [], v0, carry=[trace])
        last = each.groupBy(trace).agg(F.max_by("_w", F.struct("_node", "_k")).alias("_w"))
        return _weights(last, [trace], d)
    one = total(own, [], d)

    def apply(batches):
        import pyarrow as pa

        for batch in batches:
            w = [Affine.read(d, r, m).apply(v0).tobytes() for r, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary())], names=["_w"])

    return _weights(one.select("_r", "_m").mapInArrow(apply, "_w binary"), [], d)


def _short(chunks: DataFrame, keys: list[str], d: int, partitions: int | None) -> DataFrame:
    """Chunks of which no group has more than the scan's fan-in.  A group has
    one per partition at most, so few partitions need no measuring."""
    fan = fan_for(d)
    most = partitions or int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if most <= fan:
        return chunks
    own = saved(chunks.drop("_first", "_n"))
    longest = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if longest <= fan:
        return own
    return levels(own, keys, d, fan)[-1]


def chain_chunks(
    chunks: DataFrame, group_keys: list[str], w0: Sequence[float], partitions: int | None = None,
) -> DataFrame:
    """Phase 2: per group, chain the chunk maps in order and apply to w0.

    Chunks are hash-partitioned by group and sorted; one ``mapInPandas``
    walks the sorted runs.  Groups with a single chunk (the common case when
    groups are many and small) are finished together in one batched
    product; a group split over partitions holds at most ``fan`` chunks.
    Output ``group_keys, pos, w``: the final weights."""
    import numpy as np

    d = len(w0)
    v0 = np.asarray([float(v) for v in w0])
    gk = list(group_keys)
    src = _short(chunks, gk, d, partitions).select(*gk, "_node", "_k", "_r", "_m")
    src = src.repartition(partitions, *gk) if partitions else src.repartition(*gk)
    parted = src.sortWithinPartitions(*gk, "_node", "_k")
    schema = T.StructType([*[chunks.schema[k] for k in gk], T.StructField("pos", T.IntegerType(), False), T.StructField("w", T.DoubleType(), False)])

    def frame(heads, W):
        import pandas as pd

        data = {k: np.repeat(h, d) for k, h in zip(gk, heads)}
        data.update(pos=np.tile(np.arange(d, dtype=np.int32), len(W)), w=_finite(W).reshape(-1))
        return pd.DataFrame(data)

    def run(batches):
        cur = None  # (key columns of one row, v) of the group that goes on
        for pdf in batches:
            if len(pdf) == 0:
                continue
            starts, ends = _runs(pdf, gk)
            heads = [pdf[k].to_numpy()[starts] for k in gk]
            ranks, raw = pdf["_r"].to_numpy(), pdf["_m"].to_numpy()
            W = np.tile(v0, (len(starts), 1))
            if cur is not None:
                if all(h[0] == c[0] for h, c in zip(heads, cur[0])):
                    W[0] = cur[1]
                else:
                    yield frame(cur[0], cur[1][None])
            single = (ends - starts == 1) & (ranks[starts] < 0)
            fast = np.flatnonzero(single)
            if len(fast):
                M = np.frombuffer(b"".join(raw[starts[fast]])).reshape(-1, d + 1, d + 1)
                W[fast] = np.matmul(M[:, :d, :d], W[fast][:, :, None])[:, :, 0] + M[:, :d, d]
            for r in np.flatnonzero(~single):
                for i in range(starts[r], ends[r]):
                    W[r] = Affine.read(d, ranks[i], raw[i]).apply(W[r])
            if len(starts) > 1:
                yield frame([h[:-1] for h in heads], W[:-1])
            cur = ([h[-1:] for h in heads], W[-1])
        if cur is not None:
            yield frame(cur[0], cur[1][None])

    return parted.mapInPandas(run, schema)


def sgd_pass(
    train: DataFrame, w0: Sequence[float], step: float, ord_col: str = "ord",
    by: Sequence[str] = (), partitions: int | None = None, ordered_input: bool = False,
) -> DataFrame:
    """One pass in ``ord_col`` order, ``w <- w - step 2 (w.x - y) x``,
    one model per ``by`` group (a NULL key is a group).  Returns
    ``by..., pos, w``."""
    train, keys, restore = _null_safe(train, by)
    chunks = affine_chunks(train, keys, ord_col, 2.0 * step, len(w0), partitions,
                           ordered_input)
    if not keys:
        return scan_chunks(chunks, w0)
    return restore(chain_chunks(chunks, keys, w0, partitions))


def with_shards(
    train: DataFrame, shards: int, ord_col: str = "ord", partitions: int | None = None,
) -> tuple[DataFrame, bool]:
    """Shard = floor(idx * P / m) with idx the 0-based rank by ``ord_col``:
    P contiguous, near-equal slices, as ``glom`` gives for data distributed
    in order.  Returns (frame, ordered): a dense unique key is its own rank
    (one aggregate); otherwise the row index supplies it, and the frame
    stays range-partitioned on ``ord_col`` (``ordered`` True)."""
    dense, m = _dense_index(train, ord_col)
    if dense:
        idx, ordered = train.withColumn("_idx", F.col(ord_col).cast("long")), False
    else:
        idx, m = row_index_counted(train, [ord_col], "_idx", partitions)
        ordered = True
    sharded = idx.withColumn(
        "shard", F.floor(F.col("_idx") * shards / F.lit(max(m, 1))).cast("int")).drop("_idx")
    return sharded, ordered


def sgd_averaged(
    train: DataFrame, w0: Sequence[float], step: float, shards: int, ord_col: str = "ord",
    partitions: int | None = None,
) -> DataFrame:
    """Every shard runs G4 from w0; the shard weights are averaged with
    equal weight (an empty shard contributes w0).  Returns ``pos, w``."""
    sharded, ordered = with_shards(train, shards, ord_col, partitions)
    per_shard = sgd_pass(sharded, w0, step, ord_col, by=["shard"], partitions=partitions,
                         ordered_input=ordered)
    return _average(per_shard, w0, shards)


def _average(per_shard: DataFrame, w0: Sequence[float], shards: int) -> DataFrame:
    """Mean of the shards' weights; a shard without rows counts with w0."""
    present = per_shard.groupBy("pos").agg(F.sum("w").alias("sw"), F.count(F.lit(1)).alias("ns"))
    w0s = per_shard.sparkSession.createDataFrame(
        [(i, float(v)) for i, v in enumerate(w0)], "pos int, w0 double"
    )
    return present.join(F.broadcast(w0s), "pos").select(
        "pos", ((F.col("sw") + (F.lit(shards) - F.col("ns")) * F.col("w0")) / shards).alias("w")
    )


def sgd_relay(
    train: DataFrame, w0: Sequence[float], step: float, shards: int, ord_col: str = "ord",
    partitions: int | None = None,
) -> DataFrame:
    """Shards processed in order, each starting from the weights the
    previous one left.  Returns ``shard, pos, w`` (weights after each
    shard; the last shard's row is the model, equal to G4 over all rows)."""
    sharded, ordered = with_shards(train, shards, ord_col, partitions)
    chunks = affine_chunks(sharded, ["shard"], ord_col, 2.0 * step, len(w0), partitions,
                           ordered_input=ordered)
    return scan_chunks(chunks, w0, trace="shard")


def _dense_index(df: DataFrame, ord_col: str) -> tuple[bool, int]:
    """(is the integral order key exactly 0..m-1, each once?, m).

    The keys of a range of 32,768 make one bitmap, partial in every task; a
    bitmap with fewer bits than keys shows a repeated one.  So bitmaps meet in
    the exchange, not keys, and with m keys, no repeat, least 0 and largest
    m - 1 none is missing."""
    if not isinstance(df.schema[ord_col].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        return False, df.count()
    key = F.col(ord_col).cast("long")
    maps = df.select(key.alias("_o")).groupBy(F.bitmap_bucket_number("_o").alias("_b")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("_o"))).alias("bits"), F.count("_o").alias("n"),
        F.count(F.lit(1)).alias("m"), F.min("_o").alias("lo"), F.max("_o").alias("hi"))
    r = maps.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("bits").alias("kinds"), F.sum("m").alias("m")).first()
    m = int(r["m"] or 0)
    return m > 0 and r["lo"] == 0 and r["hi"] == m - 1 and r["kinds"] == m, m


# Fixed value: draws that are broadcast (each is a few numbers).
BROADCAST_DRAWS = 2_000_000


def sgd_sampled(
    train: DataFrame, w0: Sequence[float], step: float, steps: int | None = None,
    seed: int = 0, replicas: int = 1, rule: str = "arith", idx_col: str | None = None,
    ord_col: str = "ord", partitions: int | None = None,
) -> DataFrame:
    """Each step draws one row (with replacement across steps) and
    applies ``w <- w - (step/m) 2 (w.x - y) x``; ``steps`` defaults to m.

    Draws: ``arith``: row pmod(t * 7919 + seed + r * 104729, m) for step t
    of replica r; ``rand``: pmod(hash_key(t, seed + r * 104729), m).  Both
    are reproducible anywhere.  All draws are made in one job, joined to the
    indexed rows and folded in step order.  Up to ``BROADCAST_DRAWS`` draws (their number is
    known) are broadcast, so that only drawn rows are exchanged; beyond that
    rows and draws meet by index.  Returns ``replica, pos, w``."""
    spark = train.sparkSession
    if idx_col is None:
        dense, m = _dense_index(train, ord_col)
        if dense:  # the unique order key already is the 0-based index
            rows, idx_col = train, ord_col
        else:
            rows, m = row_index_counted(train, [ord_col], "_idx", partitions)
            idx_col = "_idx"
    else:
        rows = train
        m = rows.count()
    steps = m if steps is None else steps
    draws = spark.range(steps * replicas).select(
        F.expr(f"id div {steps}").cast("int").alias("replica"),
        (F.col("id") % steps).alias("t"),
    )
    if rule == "arith":
        pick = F.pmod(F.col("t") * 7919 + seed + F.col("replica") * 104729, F.lit(m))
    elif rule == "rand":
        pick = F.pmod(hash_key("t", F.col("replica").cast("long") * 104729 + seed), F.lit(m))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    draws = draws.withColumn(idx_col, pick)
    picked = rows.select(idx_col, "x", "y")
    if steps * replicas <= BROADCAST_DRAWS:
        # the rows stay where they are: the draws meet the scan
        joined = picked.join(F.broadcast(draws), idx_col)
    else:
        joined = draws.join(picked.hint("merge"), idx_col)
    chunks = affine_chunks(joined, ["replica"], "t", 2.0 * step / m, len(w0), partitions)
    return chain_chunks(chunks, ["replica"], w0, partitions)


# ---- AdaGrad (G7) --------------------------------------------------------------

# Rows from which on a group is solved in parallel, and groups
# of that size whose keys are broadcast.
HOT_ROWS = 1_000_000
HOT_GROUPS = 100_000


def _adagrad_runs(X, y, starts, ends, W, S, a, step, eps):
    """AdaGrad passes of all runs of a sorted batch, in place on their states
    W and S (runs, d): row position t of every run is one vector step."""
    import numpy as np

    order = np.argsort(starts - ends, kind="stable")  # the longest first
    lengths = (ends - starts)[order]
    n_active = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), "left")
    for t, n in enumerate(n_active):
        act = order[:n]
        idx = starts[act] + t
        x = X[idx]
        err = 2.0 * ((W[act] * x).sum(axis=1) - y[idx])
        g = a * err[:, None] * x
        S[act] += g * g
        W[act] -= step / np.sqrt(eps + S[act]) * g


def sgd_adagrad(
    train: DataFrame, w0: Sequence[float], s0: Sequence[float], step: float, eps: float,
    scale_gradient: bool = True, ord_col: str = "ord", by: Sequence[str] = (),
    partitions: int | None = None, hot_rows: float = HOT_ROWS,
) -> DataFrame:
    """``g = a 2 (w.x - y) x`` with a = step if ``scale_gradient`` (the
    reference's written form) else 1; ``s <- s + g*g``;
    ``w <- w - step / sqrt(eps + s) * g``.  Returns ``by..., pos, w``.

    The update is not associative.  Groups are hash-partitioned, sorted and
    streamed through ``mapInPandas`` with the state carried across Arrow
    batches (constant memory); all groups of a batch advance together, one row
    position at a time.  A group of more than ``hot_rows`` rows, and without
    ``by`` the whole table, is instead solved in parallel over its ordered
    ranges (``adagrad.py``), with the same result."""
    d = len(w0)
    a = step if scale_gradient else 1.0
    if not by:
        return _weights(adagrad_in_time(train, w0, s0, step, a, eps, ord_col, [], partitions), [], d)
    sizes = train.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    n_hot = sizes.count() if hot_rows < math.inf else 0
    if n_hot:
        sizes = saved(sizes.drop("_n").withColumnsRenamed({c: f"_hot_{c}" for c in by}))
        few = F.broadcast(sizes) if n_hot <= HOT_GROUPS else sizes.hint("merge")
        same = F.lit(True)
        for c in by:
            same = same & train[c].eqNullSafe(sizes[f"_hot_{c}"])
        hot = _weights(adagrad_in_time(train.join(few, same, "left_semi"), w0, s0, step, a, eps, ord_col, by, partitions), by, d)
        rest = sgd_adagrad(train.join(few, same, "left_anti"), w0, s0, step, eps, scale_gradient, ord_col, by, partitions, math.inf)
        return hot.unionByName(rest)
    train, keys, restore = _null_safe(train, by)
    src = train.where(require_length("x", d, "feature vector")).select(
        *keys, ord_col, *_coords(d), F.col("y").cast("double").alias("y"))
    src = src.repartition(partitions, *keys) if partitions else src.repartition(*keys)
    w_init, s_init = [float(v) for v in w0], [float(v) for v in s0]
    schema = T.StructType([train.schema[k] for k in keys] + [
        T.StructField("pos", T.IntegerType(), False), T.StructField("w", T.DoubleType(), False)])

    def rows(heads, W):
        import numpy as np
        import pandas as pd

        if not np.isfinite(W).all():
            raise FloatingPointError("AdaGrad diverged")
        data = {k: np.repeat(h, d) for k, h in zip(keys, heads)}
        data.update(pos=np.tile(np.arange(d, dtype=np.int32), len(W)), w=W.reshape(-1))
        return pd.DataFrame(data)

    def run(batches):
        import numpy as np

        cur = None  # (key columns of one row, w, s) of the group that goes on
        for pdf in batches:
            if len(pdf) == 0:
                continue
            starts, ends = _runs(pdf, keys)
            heads = [pdf[k].to_numpy()[starts] for k in keys]
            W, S = np.tile(w_init, (len(starts), 1)), np.tile(s_init, (len(starts), 1))
            if cur is not None:
                if all(h[0] == c[0] for h, c in zip(heads, cur[0])):
                    W[0], S[0] = cur[1], cur[2]
                else:
                    yield rows(cur[0], cur[1][None])
            _adagrad_runs(_features(pdf, d), pdf["y"].to_numpy(dtype=float), starts, ends, W, S, a, step, eps)
            if len(starts) > 1:
                yield rows([h[:-1] for h in heads], W[:-1])
            cur = ([h[-1:] for h in heads], W[-1], S[-1])
        if cur is not None:
            yield rows(cur[0], cur[1][None])

    return restore(src.sortWithinPartitions(*keys, ord_col).mapInPandas(run, schema))


def sgd_adagrad_averaged(
    train: DataFrame, w0: Sequence[float], s0: Sequence[float], step: float, eps: float,
    shards: int, scale_gradient: bool = True, ord_col: str = "ord",
    partitions: int | None = None,
) -> DataFrame:
    """G7 in the form of G5: every shard runs its own pass from (w0, s0); the
    shard weights are averaged with equal weight (an empty shard contributes
    w0).  Returns ``pos, w``."""
    sharded, _ = with_shards(train, shards, ord_col, partitions)
    per_shard = sgd_adagrad(sharded, w0, s0, step, eps, scale_gradient, ord_col, ["shard"], partitions)
    return _average(per_shard, w0, shards)
