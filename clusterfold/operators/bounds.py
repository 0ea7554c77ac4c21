"""Lloyd steps that compute distances only where an assignment can change.

The points are packed once into blocks (one row a batch: coordinates and, for
every point, its centroid ``j``, the distance ``u`` to it and a lower bound
``l`` of the distance to any other, all under the centroids of one earlier
step, the base).  The blocks are persisted and never rewritten in place.
At a later step centroid i lies ``m_i`` from where it was at the base, so a
point keeps its centroid if ``u + m_j < l - max m_i`` over the others; it is
certified without a distance (Hamerly's test, by the displacement since the
base instead of a sum of moves).  The other points are computed anew, exactly.
Once more than ``REBASE_SHARE`` of the points had to be, a later step writes
new blocks, with the centroids of that step as their base: the next one, or,
while the centroids still move too far for a base to last a single step, one
after a wait that doubles each time.

A step is one job that returns each task's sums and counts.  While these are at
most ``DIRECT_VALUES`` numbers together they come to the driver as they are;
beyond that the executors add them up by (cluster, coordinate).
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterfold.operators.nearest import nearest

# The share of points computed anew after which the base moves,
# and the longest wait for it;
# numbers of partial sums that the driver adds up itself; the relative margin
# that keeps a certificate clear of rounding.
REBASE_SHARE = 0.3
MOST_WAIT = 16
DIRECT_VALUES = 2_000_000
MARGIN = 1e-9
BLOCK_VALUES = 1 << 16

BLOCKS = "n int, x binary, j binary, u binary, l binary"


def _moves(old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each centroid's displacement, the largest one among the others)."""
    diff = new - old
    m = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    if len(m) < 2:
        return m, np.zeros(len(m))
    top = np.argsort(m)[-2:]
    return m, np.where(np.arange(len(m)) == top[1], m[top[0]], m[top[1]])


def certified(j: np.ndarray, u: np.ndarray, low: np.ndarray, m: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Points whose centroid of the base is still their only nearest one."""
    return (u + m[j]) * (1.0 + MARGIN) < (low - others[j]) * (1.0 - MARGIN)


def _add(S: np.ndarray, N: np.ndarray, X: np.ndarray, j: np.ndarray) -> None:
    N += np.bincount(j, minlength=len(N))
    if len(N) <= 64:  # a small product
        S += (j == np.arange(len(N))[:, None]).astype(np.float64) @ X
        return
    order = np.argsort(j, kind="stable")
    found, first = np.unique(j[order], return_index=True)
    S[found] += np.add.reduceat(X[order], first, axis=0)


class BoundedLloyd:
    """The packed points of one K-means run and their base centroids.

    ``ship`` objects are centroid tables on their way to the tasks, with
    ``k``, ``d`` and ``chunks()`` (offset, matrix); a base and a step must
    have the same centroids in the same order, otherwise the step rebases."""

    def __init__(self, points: DataFrame, to_matrix, d: int):
        self.points, self.to_matrix, self.d = points, to_matrix, d
        self.blocks: DataFrame | None = None
        self.base: tuple[np.ndarray, np.ndarray] | None = None  # (ids, matrix)
        self.partitions = 0
        self.stale = True
        self.recomputed = 0
        self.age = 0  # steps since the base, and the least number before the next
        self.wait = 1

    def release(self) -> None:
        if self.blocks is not None:
            self.blocks.unpersist()

    def _rebased(self, ship) -> DataFrame:
        """Blocks whose base is ``ship``: from the points, or from the blocks
        before (a narrow map each time; a lost block is mapped again)."""
        d, to_matrix, packed = self.d, self.to_matrix, self.blocks is not None
        rows = max(1, BLOCK_VALUES // max(d, 1))

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                for X in _matrices(batch, d) if packed else [to_matrix(batch, d)]:
                    for s in range(0, len(X), rows):
                        part = np.ascontiguousarray(X[s:s + rows])
                        j, u, low = nearest(part, ship.chunks())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([len(part)], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in (part, j, u, low)]],
                            names=["n", "x", "j", "u", "l"])

        return (self.blocks if packed else self.points).mapInArrow(run, BLOCKS)

    def step(self, ship, ids: np.ndarray, matrix: np.ndarray):
        """(sums, counts) of one Lloyd step under the centroids ``ids``,
        ``matrix`` (what ``ship`` holds)."""
        same = self.base is not None and np.array_equal(self.base[0], ids)
        old = None
        if self.stale or not same:
            old = self.blocks
            self.blocks = self._rebased(ship).persist(StorageLevel.MEMORY_AND_DISK)
            self.base, self.age = (ids, matrix), 0
            self.partitions = self.partitions or self.blocks.rdd.getNumPartitions()
        S, N, n_new = self._sums(ship, matrix)
        if old is not None:
            old.unpersist()
        total = int(N.sum())
        self.recomputed = n_new if old is None and same else total
        spent = total > 0 and n_new > REBASE_SHARE * total
        if self.age == 1:
            self.wait = min(2 * self.wait, MOST_WAIT) if spent else 1
        self.stale = spent and self.age >= self.wait
        self.age += 1
        return S, N

    def _sums(self, ship, matrix):
        k, d = ship.k, self.d
        m, others = _moves(self.base[1], matrix)
        still = not m.any()

        def tasks(batches):
            S, N, n_new = np.zeros((k, d)), np.zeros(k, np.int64), 0
            for batch in batches:
                for r in range(batch.num_rows):
                    n, x, j, u, low = (batch.column(c)[r].as_py() for c in range(5))
                    X, j = np.frombuffer(x).reshape(n, d), np.frombuffer(j, np.int64)
                    if not still:
                        new = np.flatnonzero(~certified(j, np.frombuffer(u), np.frombuffer(low), m, others))
                        if len(new):
                            j = j.copy()
                            j[new] = nearest(X[new], ship.chunks())[0]
                            n_new += len(new)
                    _add(S, N, X, j)
            return S, N, n_new

        def packed(batches):
            import pyarrow as pa

            S, N, n_new = tasks(batches)
            yield pa.RecordBatch.from_arrays(
                [pa.array([S.tobytes()], pa.binary()), pa.array([N.tobytes()], pa.binary()), pa.array([n_new], pa.int64())], names=["s", "n", "new"])

        def long(batches):
            import pyarrow as pa

            S, N, n_new = tasks(batches)
            seen = np.flatnonzero(N)
            spot = np.concatenate([np.repeat(seen, d) * d + np.tile(np.arange(d), len(seen)), [-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot), pa.array(np.append(S[seen].ravel(), 0.0)), pa.array(np.append(np.repeat(N[seen], d), n_new))], names=["spot", "s", "n"])

        S, N, n_new = np.zeros((k, d)), np.zeros(k, np.int64), 0
        if self.partitions * k * d <= DIRECT_VALUES:
            for r in self.blocks.mapInArrow(packed, "s binary, n binary, new bigint").collect():
                S += np.frombuffer(r["s"]).reshape(k, d)
                N += np.frombuffer(r["n"], np.int64)
                n_new += r["new"]
            return S, N, n_new
        summed = self.blocks.mapInArrow(long, "spot bigint, s double, n bigint").groupBy("spot").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        for batch in summed.toArrow().to_batches():
            spot, s, n = (batch.column(c).to_numpy() for c in range(3))
            own = spot >= 0
            S.reshape(-1)[spot[own]] = s[own]
            N[spot[own] // d] = n[own]
            n_new += int(n[~own].sum())
        return S, N, n_new


def _matrices(batch, d: int):
    for r in range(batch.num_rows):
        yield np.frombuffer(batch.column(1)[r].as_py()).reshape(-1, d)
