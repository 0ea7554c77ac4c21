"""Batch gradient descent through a distributed block Gram matrix.

For more features than one d x d matrix on the driver allows, X'X is a table of
blocks ``_i, _j, _m`` (``size`` features a side, i <= j, saved in the shared
folder).  Every task forms the blocks of its rows; equal blocks are added up
by a tree of fan-in ``FAN``, so that no task gets the partial sums of all
others.  A task holds at most ``TASK_VALUES`` numbers of the matrix: wider ones
are formed in several passes over the rows, each for a part of the blocks.

An epoch multiplies the blocks with the weights where they lie and brings d
sums to the driver; the rows are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterfold.functions.vectors import require_length
from clusterfold.operators.scan import saved

# Features of a block's side, numbers of the matrix that a task
# holds, and partial blocks that a task adds up.
SIZE = 512
TASK_VALUES = 1 << 24
FAN = 16

_BLOCKS = "_i int, _j int, _part long, _m binary"


def _passes(n_sides: int, size: int, most: int) -> list[list[tuple[int, int]]]:
    """Block places (i <= j), in groups that fit a task."""
    places = [(i, j) for i in range(n_sides) for j in range(i, n_sides)]
    each = max(1, most // (size * size))
    return [places[s:s + each] for s in range(0, len(places), each)]


def _partial(rows: DataFrame, d: int, size: int, places: list[tuple[int, int]]) -> DataFrame:
    """One block a task and place.  The target is a further feature (the
    last), so X'y comes with the matrix."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        own = TaskContext.get().partitionId()
        side = lambda i: slice(i * size, min((i + 1) * size, d + 1))
        total = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            X = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            X = np.concatenate([X, batch.column(1).to_numpy(zero_copy_only=False)[:, None]], axis=1)
            for i, j in places:
                part = X[:, side(i)].T @ X[:, side(j)]
                total[i, j] = total[i, j] + part if (i, j) in total else part
        for (i, j), m in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([own], pa.int64()), pa.array([m.tobytes()], pa.binary())],
                names=["_i", "_j", "_part", "_m"])

    return rows.mapInArrow(run, _BLOCKS)


def _added(blocks: DataFrame) -> DataFrame:
    """Partial blocks of ``FAN`` neighbouring parts as one."""

    def run(table):
        import pyarrow as pa

        total = None
        for raw in table.column("_m"):
            m = np.frombuffer(raw.as_py())
            total = m.copy() if total is None else np.add(total, m, out=total)
        head = {c: table.column(c).slice(0, 1) for c in ("_i", "_j")}
        return pa.table({**head, "_part": table.column("_up").slice(0, 1), "_m": pa.array([total.tobytes()], pa.binary())})

    up = F.floor(F.col("_part") / F.lit(FAN)).cast("long").alias("_up")
    return blocks.select("_i", "_j", "_m", up).groupBy("_i", "_j", "_up").applyInArrow(run, _BLOCKS)


class BlockGram:
    """X'X and X'y of ``m`` rows with d features, as saved blocks."""

    def __init__(self, train: DataFrame, d: int, size: int = SIZE, task_values: int = TASK_VALUES):
        self.d, self.size = d, size
        rows = train.where(require_length("x", d, "feature vector")).select(
            F.col("x").cast("array<double>").alias("x"), F.col("y").cast("double").alias("y"))
        self.m = rows.count()
        self.n_sides = -(-(d + 1) // size)
        self.blocks = None
        for places in _passes(self.n_sides, size, task_values):
            level = saved(_partial(rows, d, size, places))
            top = level.agg(F.max("_part")).first()[0] or 0
            while top:
                level, top = saved(_added(level)), top // FAN
            self.blocks = level if self.blocks is None else self.blocks.unionByName(level)

    def product(self, w: Sequence[float]) -> np.ndarray:
        """X'(Xw - y): one job over the blocks, d numbers back."""
        d, size = self.d, self.size
        v = np.append(np.asarray(w, float), -1.0)  # the target's weight

        def run(batches):
            import pyarrow as pa

            out: dict[int, np.ndarray] = {}

            def add(i, part):
                out[i] = out[i] + part if i in out else part

            for batch in batches:
                for r in range(batch.num_rows):
                    i, j = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                    own, other = v[i * size:(i + 1) * size], v[j * size:(j + 1) * size]
                    M = np.frombuffer(batch.column(2)[r].as_py()).reshape(len(own), len(other))
                    add(i, M @ other)
                    if i != j:
                        add(j, M.T @ own)
            places = np.concatenate([np.arange(i * size, i * size + len(p)) for i, p in out.items()]) if out else np.zeros(0, np.int64)
            sums = np.concatenate(list(out.values())) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(sums)], names=["pos", "g"])

        got = np.zeros(d + 1)
        summed = self.blocks.select("_i", "_j", "_m").mapInArrow(run, "pos long, g double").groupBy("pos").agg(F.sum("g").alias("g"))
        for batch in summed.toArrow().to_batches():
            got[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
        return got[:d]


def descend(train: DataFrame, w0: Sequence[float], epochs: int, step: float, size: int = SIZE, task_values: int = TASK_VALUES) -> list[float]:
    """``w <- w - (step/m) sum 2 (w.x - y) x`` for ``epochs`` epochs."""
    w = np.asarray([float(v) for v in w0])
    gram = BlockGram(train, len(w), size, task_values)
    for _ in range(epochs if gram.m else 0):
        w = w - 2.0 * gram.product(w) * (step / gram.m)
    return w.tolist()
