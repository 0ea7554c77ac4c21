"""AdaGrad over one ordered table, parallel in time.

An AdaGrad pass is a recurrence of the state z = (w, s) over the rows in
order; it is not affine, so no prefix scan gives it in one go.  It is solved by
multiple shooting instead:

1. the rows are range-partitioned in order and packed once into blocks of
   ``BLOCK_ROWS`` (saved in the shared folder);
2. every block starts from a guess of its state: the weights after the group's
   first block, and the sums s that these weights would have gathered so far
   (a prefix scan of the blocks' sums);
3. every task runs its blocks from their guesses and returns, for each, the
   end state F and its derivative J by the start: the affine map
   ``z -> F + J (z - guess)``;
4. a prefix scan of these maps (``scan.py``) gives all start states anew.

Steps 3 and 4 are Newton's method on the chain of blocks.  The start of the
first block is known, so at least one more block is exact after each round;
in practice a few rounds take every start to where rounding decides
(``TOLERANCE``), and then the end state is that of the sequential pass.  The
table is read once a round, by all tasks; no task holds more than a block.

A block is run the same way on a smaller scale: ``RUNS`` stretches of it advance
together, one row position at a time, and Newton's method chains them.  A
block on which that fails (the rate changes fast while s is small) is halved,
down to ``SHORT`` rows, which run one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterfold.functions.vectors import require_length
from clusterfold.operators.scan import Affine, prefixes, saved

# Rows of a block, stretches that advance together, rows that
# run one by one; Newton rounds on a block and on the chain; relative change
# below which a state is final; bytes of guesses that are broadcast.
BLOCK_ROWS = 1 << 16
RUNS = 256
SHORT = 512
BLOCK_ROUNDS = 10
ROUNDS = 100
TOLERANCE = 1e-12
GUESS_BYTES = 64 << 20

BLOCK = [T.StructField("_node", T.LongType()), T.StructField("_k", T.IntegerType()), T.StructField("_x", T.BinaryType()), T.StructField("_y", T.BinaryType())]


class Rule:
    """``g = a 2 (w.x - y) x``, ``s <- s + g g``, ``w <- w - step / sqrt(eps + s) g``."""

    def __init__(self, d: int, a: float, step: float, eps: float):
        self.d, self.a, self.step, self.eps = d, a, step, eps

    def runs(self, X, y, Z):
        """End states (R, 2d) of R runs ``X`` (R, T, d) from ``Z``, and their
        derivatives (R, 2d, 2d)."""
        d, a = self.d, self.a
        W, S = Z[:, :d].copy(), Z[:, d:].copy()
        J = np.broadcast_to(np.eye(2 * d), (len(Z), 2 * d, 2 * d)).copy()
        dW, dS = J[:, :d], J[:, d:]
        for t in range(X.shape[1]):
            x = X[:, t]
            g = (2.0 * a) * ((W * x).sum(axis=1) - y[:, t])[:, None] * x
            S += g * g
            q = 1.0 / np.sqrt(self.eps + S)
            dg = (2.0 * a) * x[:, :, None] * np.matmul(x[:, None, :], dW)
            dS += (2.0 * g)[:, :, None] * dg
            dW -= self.step * (q[:, :, None] * dg - (0.5 * q ** 3 * g)[:, :, None] * dS)
            W -= self.step * q * g
        return np.concatenate([W, S], axis=1), J

    def gathered(self, X, y, w):
        """Sum of g g over the rows of each run at fixed weights."""
        g = (2.0 * self.a) * (X @ w - y)[..., None] * X
        return (g * g).sum(axis=-2)

    def block(self, X, y, z):
        """(F, J) of the rows X, y from the state z."""
        n, d = X.shape
        if n <= SHORT:
            F_, J = self.runs(X[None], y[None], z[None])
            return F_[0], J[0]
        found = self._newton(X, y, z)
        if found is not None:
            return found
        half = n // 2
        F1, J1 = self.block(X[:half], y[:half], z)
        F2, J2 = self.block(X[half:], y[half:], F1)
        return F2, J2 @ J1

    def _newton(self, X, y, z):
        n, d = X.shape
        R = min(RUNS, n // 16)
        pad = -n % R  # rows of zeros change nothing
        X = np.concatenate([X, np.zeros((pad, d))]).reshape(R, -1, d)
        y = np.concatenate([y, np.zeros(pad)]).reshape(R, -1)
        Z = np.tile(z, (R, 1))
        Z[1:, d:] += np.cumsum(self.gathered(X, y, z[:d]), axis=0)[:-1]
        with np.errstate(all="ignore"):
            for _ in range(BLOCK_ROUNDS):
                ends, J = self.runs(X, y, Z)
                if not np.isfinite(ends).all():
                    return None
                off = np.abs(ends[:-1] - Z[1:]).max(axis=1) > TOLERANCE / 10 * (1.0 + np.abs(Z[1:]).max(axis=1))
                if not off.any():
                    total = np.eye(2 * d)
                    for own in J:
                        total = own @ total
                    return (ends[-1], total) if np.isfinite(total).all() else None
                new = Z.copy()
                for p in range(R - 1):
                    new[p + 1] = ends[p] + J[p] @ (new[p] - Z[p])
                new[:, d:] = np.maximum(new[:, d:], z[d:])  # s only grows
                if not np.isfinite(new).all():
                    return None
                Z = new
        return None


def packed(train: DataFrame, keys: Sequence[str], ord_col: str, d: int, partitions: int | None = None) -> DataFrame:
    """``keys, _node, _k, _x, _y``: the rows in order, in blocks of one group
    each; a partition holds a contiguous range."""
    keys = list(keys)
    src = train.where(require_length("x", d, "feature vector")).select(
        *keys, ord_col, F.col("x").cast("array<double>").alias("x"), F.col("y").cast("double").alias("y"))
    src = src.repartitionByRange(partitions, *keys, ord_col) if partitions else src.repartitionByRange(*keys, ord_col)
    src = src.sortWithinPartitions(*keys, ord_col)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        node, number, held, head = TaskContext.get().partitionId(), 0, [], None  # head: the key of what is held

        def rows(X, y):
            nonlocal number
            number += 1
            return pa.RecordBatch.from_arrays(
                [*head, pa.array([node], pa.int64()), pa.array([number - 1], pa.int32()), pa.array([X.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                names=[*keys, "_node", "_k", "_x", "_y"])

        def flush(rest):
            nonlocal held
            if not held:
                return
            X, y = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            whole = len(y) if rest else len(y) - len(y) % BLOCK_ROWS
            for s in range(0, whole, BLOCK_ROWS):
                yield rows(X[s:s + BLOCK_ROWS], y[s:s + BLOCK_ROWS])
            held = [(X[whole:], y[whole:])] if whole < len(y) else []

        for batch in batches:
            if not batch.num_rows:
                continue
            X = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = batch.column(batch.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
            columns = [batch.column(i) for i in range(len(keys))]
            starts = _changes(columns, batch.num_rows)
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                own = [c.slice(a, 1) for c in columns]
                if head is not None and any(not x.equals(z) for x, z in zip(head, own)):
                    yield from flush(True)
                head = own
                held.append((X[a:b], y[a:b]))
                if sum(len(h[1]) for h in held) >= BLOCK_ROWS:
                    yield from flush(False)
        if head is not None:
            yield from flush(True)

    return saved(src.mapInArrow(run, T.StructType([*[train.schema[c] for c in keys], *BLOCK])))


def _changes(columns, n: int) -> list[int]:
    """First rows of the runs of equal keys; nulls equal each other."""
    import pyarrow.compute as pc

    change = np.zeros(n, bool)
    change[0] = True
    for c in columns:
        a, b = c[:-1], c[1:]
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        change[1:] |= ~same.to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(change).tolist()


def _together(blocks: DataFrame, guesses: DataFrame) -> DataFrame:
    """Blocks with their ``_v``; the guesses (one state a block, a tiny part
    of the data) are broadcast while they are small."""
    size = guesses.agg(F.coalesce(F.sum(F.octet_length("_v") + 64), F.lit(0))).first()[0]
    side = guesses.select("_node", "_k", "_v")  # a partition numbers its blocks
    return blocks.join(F.broadcast(side) if size <= GUESS_BYTES else side.hint("merge"), ["_node", "_k"])


def _solved(rows: DataFrame, keys: list[str], kept: list[str], rule: Rule, solve) -> DataFrame:
    """``keys, kept, _node, _k, _r, _m, _u`` by ``solve(X, y, v, extra)`` on
    every block; ``_u`` is the start that was used."""
    d = rule.d

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            col = lambda c: batch.column(batch.schema.get_field_index(c))
            for r in range(batch.num_rows):
                X = np.frombuffer(col("_x")[r].as_py()).reshape(-1, d)
                own, used = solve(X, np.frombuffer(col("_y")[r].as_py()), np.frombuffer(col("_v")[r].as_py()))
                yield pa.RecordBatch.from_arrays(
                    [*[col(c).slice(r, 1) for c in [*keys, *kept, "_node", "_k"]], pa.array([own.rank], pa.int32()), pa.array([own.bytes()], pa.binary()), pa.array([used.tobytes()], pa.binary())],
                    names=[*keys, *kept, "_node", "_k", "_r", "_m", "_u"])

    schema = T.StructType([*[rows.schema[c] for c in [*keys, *kept]], *BLOCK[:2], T.StructField("_r", T.IntegerType()), T.StructField("_m", T.BinaryType()), T.StructField("_u", T.BinaryType())])
    return rows.select(*keys, *kept, "_node", "_k", "_x", "_y", "_v").mapInArrow(run, schema)


def _shift(d: int, delta: np.ndarray) -> Affine:
    A = np.eye(2 * d + 1)
    A[:-1, -1] = delta
    return Affine(2 * d, A)


def _linear(rule: Rule, X, y, v, s0: np.ndarray):
    """The block's map around the guess v (made a possible state first)."""
    d = rule.d
    z = np.where(np.isfinite(v), v, 0.0)
    z[d:] = np.maximum(z[d:], s0)
    end, J = rule.block(X, y, z)
    A = np.zeros((2 * d + 1, 2 * d + 1))
    A[:-1, :-1], A[:-1, -1], A[-1, -1] = J, end - J @ z, 1.0
    return Affine(2 * d, A), z


def _change(starts: DataFrame) -> float:
    """Largest relative difference between the used and the new starts."""

    def run(batches):
        import pyarrow as pa

        worst = 0.0
        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = np.frombuffer(u), np.frombuffer(v)
                own = np.abs(u - v).max() / (1.0 + np.abs(v).max())
                worst = max(worst, own if np.isfinite(own) else np.inf)
        yield pa.RecordBatch.from_arrays([pa.array([worst])], names=["c"])

    return starts.select("_u", "_v").mapInArrow(run, "c double").agg(F.max("c")).first()[0] or 0.0


def adagrad_in_time(train: DataFrame, w0: Sequence[float], s0: Sequence[float], step: float, a: float, eps: float,
                    ord_col: str, keys: Sequence[str] = (), partitions: int | None = None, rounds: list | None = None) -> DataFrame:
    """``keys, _w`` (the final state (w, s) as binary doubles) of each group's
    ordered pass.  ``rounds`` gets the largest change of each round."""
    keys, d = list(keys), len(w0)
    rule, z0 = Rule(d, a, step, eps), np.array([*w0, *s0], float)
    s_least = z0[d:]
    blocks = packed(train, keys, ord_col, d, partitions)

    # the first block of each group, exactly; then everyone's guess
    order = F.struct("_node", "_k")
    firsts = blocks.groupBy(*keys).agg(F.min(order).alias("_f")).select("_f._node", "_f._k", F.lit(bytearray(z0.tobytes())).alias("_v"))
    begun = saved(_solved(_together(blocks, saved(firsts)), keys, [], rule, lambda X, y, v: (_shift(d, rule.block(X, y, v)[0] - v), v)))
    after = begun.select(*keys, "_node", "_k", "_m").withColumnsRenamed({"_node": "_node1", "_k": "_k1", "_m": "_m1"})

    def guess(batches):
        import pyarrow as pa

        for batch in batches:
            col = lambda c: batch.column(batch.schema.get_field_index(c))
            for r in range(batch.num_rows):
                first = Affine.read(2 * d, -1, col("_m1")[r].as_py())
                if col("_node")[r] == col("_node1")[r] and col("_k")[r] == col("_k1")[r]:
                    own = first
                else:
                    X = np.frombuffer(col("_x")[r].as_py()).reshape(-1, d)
                    w = first.apply(z0)[:d]
                    own = _shift(d, np.concatenate([np.zeros(d), rule.gathered(X, np.frombuffer(col("_y")[r].as_py()), w)]))
                yield pa.RecordBatch.from_arrays(
                    [*[col(c).slice(r, 1) for c in [*keys, "_node", "_k"]], pa.array([own.rank], pa.int32()), pa.array([own.bytes()], pa.binary())],
                    names=[*keys, "_node", "_k", "_r", "_m"])

    if keys:
        same = [blocks[c].eqNullSafe(after[c]) for c in keys]
        on = same[0]
        for c in same[1:]:
            on = on & c
        near = blocks.join(F.broadcast(after) if _few(after) else after.hint("merge"), on).select(
            *[blocks[c] for c in keys], "_node", "_k", "_x", "_y", "_node1", "_k1", "_m1")
    else:  # one row, as constants
        one = after.first()
        if one is None:
            return blocks.select(F.lit(bytearray(z0.tobytes())).alias("_w")).limit(0)
        near = blocks.withColumns({"_node1": F.lit(one["_node1"]), "_k1": F.lit(one["_k1"]), "_m1": F.lit(one["_m1"])})
    schema = T.StructType([*[blocks.schema[c] for c in keys], *BLOCK[:2], T.StructField("_r", T.IntegerType()), T.StructField("_m", T.BinaryType())])
    starts = saved(prefixes(saved(near.mapInArrow(guess, schema)), keys, z0))

    for _ in range(ROUNDS):
        maps = saved(_solved(_together(blocks, starts), keys, [], rule, lambda X, y, v: _linear(rule, X, y, v, s_least)))
        starts = saved(prefixes(maps, keys, z0, carry=["_u"]))
        change = _change(starts)
        if rounds is not None:
            rounds.append(change)
        if change <= TOLERANCE:
            break
    else:
        raise FloatingPointError("AdaGrad did not settle; it may diverge")
    return starts.groupBy(*keys).agg(F.max_by("_w", order).alias("_w"))


def _few(frame: DataFrame) -> bool:
    return frame.agg(F.coalesce(F.sum(F.octet_length("_m1") + 128), F.lit(0))).first()[0] <= GUESS_BYTES
