"""Row indexing, sampling and small projections.

``row_index`` is the DataFrame form of ``zipWithIndex``: a 0-based,
gap-free index in the order of a unique key, computed without pulling the
table through one partition:

1. range-partition on the order key and sort inside each partition;
2. ``monotonically_increasing_id`` then holds (partition id, position);
3. one pass counts the rows of each partition and compares every key with the
   one before it (one row per partition);
4. the running offsets (a table with one row per partition, bounded by
   the partition count) are broadcast and added to the position.

The range-partitioned frame is checkpointed after step 2: steps 3 and 4 see
the same boundaries even after an executor is lost, and nothing stays
persisted in executor memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterfold.session import checkpoint_dir

# Fixed value: monotonically_increasing_id keeps the row position in the
# lower 33 bits and the partition id above them.
_POS_BITS = 33


def row_index(
    df: DataFrame, order_cols: list[str], name: str = "idx", partitions: int | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """See ``row_index_counted``; returns the indexed frame only."""
    return row_index_counted(df, order_cols, name, partitions, check_unique)[0]


def row_index_counted(
    df: DataFrame, order_cols: list[str], name: str = "idx", partitions: int | None = None,
    check_unique: bool = True,
) -> tuple[DataFrame, int]:
    """Add a 0-based index in the order of ``order_cols`` (a unique key);
    also returns the row count.  The result keeps the range partitioning
    on ``order_cols``: every partition holds one contiguous index range.

    A repeated key would make the index order arbitrary; it raises.  Equal
    keys are neighbours in one sorted range, so the check compares each row
    with the one before it, without a further shuffle."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    # without an explicit count AQE may merge adjacent (small) ranges
    ranged = (df.repartitionByRange(partitions, *order_cols) if partitions
              else df.repartitionByRange(*order_cols))
    tagged = ranged.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    # counts and repeated keys of each partition in one pass over the saved rows
    found = tagged.select("_mid", *(order_cols if check_unique else [])).mapInArrow(_measured, "pid long, n long, repeats long").collect()
    rows = sorted((r["pid"], r["n"]) for r in found)
    repeated = sum(r["repeats"] for r in found)
    if repeated:
        raise ValueError(f"order key {order_cols} is not unique: {repeated} rows repeat one")
    offsets, acc = [], 0
    for pid, cnt in rows:
        offsets.append((pid, acc))
        acc += cnt
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid long, _off long")
    mask = (1 << _POS_BITS) - 1
    out = (
        tagged.withColumn("_pid", F.shiftright("_mid", _POS_BITS))
        .join(F.broadcast(off), "_pid")
        .withColumn(name, F.col("_off") + F.col("_mid").bitwiseAND(F.lit(mask)))
        .drop("_pid", "_off", "_mid")
    )
    return out, acc


def _measured(batches):
    """(partition, rows, rows whose key equals that of the row before) of
    sorted batches of ``_mid`` and the key (none: repeats are not counted)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    pid, n, repeats, last = None, 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if pid is None:
            pid = batch.column(0)[0].as_py() >> _POS_BITS
        n += batch.num_rows
        keys = batch.columns[1:]
        if not keys:
            continue
        repeats += int([c[0].as_py() for c in keys] == last)
        if batch.num_rows > 1:
            same = None
            for column in keys:
                a, b = column[:-1], column[1:]
                both = pc.and_(pc.is_null(a), pc.is_null(b))
                equal = pc.or_(pc.fill_null(pc.equal(a, b), False), both)
                same = equal if same is None else pc.and_(same, equal)
            repeats += pc.sum(same.cast(pa.int64())).as_py()
        last = [c[batch.num_rows - 1].as_py() for c in keys]
    if pid is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (pid, n, repeats)], names=["pid", "n", "repeats"])


def prefix(x: Column | str, n: int) -> Column:
    """P5: the first n elements (a shorter array stays shorter)."""
    return F.slice(F.col(x) if isinstance(x, str) else x, 1, n)


def last(x: Column | str, strict: bool = True) -> Column:
    """The last element; raises on an empty array unless ``strict`` is
    False (then NULL)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.element_at(x, -1) if strict else F.try_element_at(x, F.lit(-1))


# Modulus, multipliers (below 2^31, so that a product of a
# reduced value stays below 2^63) and shifts of the reproducible draw.
HASH_MOD = 1 << 32
HASH_MULTS = (1597334677, 1103515245)
HASH_SHIFTS = (15, 13)


def hash_key(id_col: str, seed: int | Column = 0) -> Column:
    """A pseudo-random number below 2^32 of an integer id and a seed, by
    multiplications modulo 2^32 and shifts, which any engine can recompute.
    Ids are reduced first: no id is too large."""
    mod = F.lit(HASH_MOD)
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    h = F.pmod(F.pmod(F.col(id_col).cast("long"), mod) * HASH_MULTS[0] + F.pmod(seed.cast("long"), mod), mod)
    for mult, shift in zip(HASH_MULTS[::-1], HASH_SHIFTS):
        h = F.pmod(h.bitwiseXOR(F.shiftright(h, shift)) * mult, mod)
    return h


def sample_k(df: DataFrame, k: int, seed: int = 0, order_col: str | None = None) -> DataFrame:
    """K rows without replacement. ``orderBy(key).limit(k)`` runs as a
    per-partition top-k plus a merge of k rows per partition.  The key is
    ``hash_key`` of ``order_col`` (ties broken by the id) or, without one, a
    hash of the whole row: the draw does not depend on the partitioning."""
    if order_col is None:
        cols = [F.col(f"`{c}`") for c in df.columns]
        return df.withColumn("_r", F.xxhash64(F.lit(seed), *cols)).orderBy("_r").limit(k).drop("_r")
    return df.withColumn("_r", hash_key(order_col, seed)).orderBy("_r", order_col).limit(k).drop("_r")


def head_n(df: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    """The first n rows in a deterministic order (top-k, no full sort)."""
    return df.orderBy(*order_cols).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of a column (partial distinct before the shuffle)."""
    return df.select(col).distinct()
