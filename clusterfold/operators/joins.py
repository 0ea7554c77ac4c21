"""Equi-joins: shuffled (J1) and strict broadcast lookup.

``shuffle_join`` forces a shuffled plan (sort-merge by default) through a
join hint, as the reference's ``RDD.join``.  AQE's skew-join handling may
split a key that holds a large share of the rows; ``salt`` spreads every key
over that many tasks whatever the runtime decides.  ``skew_join`` spreads only
the keys that need it: a mergeable frequent-items sketch of the left keys
finds them in one pass, their left rows are dealt into as many parts as their
share asks for, and only their right rows are repeated.

``lookup_join`` is the reference's broadcast-map lookup: every key of the
fact side must exist in the lookup table (a missing key raises), lookup
keys must be unique (it is a map; a repeated key raises at every size).
Both are proven on the side that the join uses.  A lookup within the bounds
(``max_rows`` rows, ``max_bytes`` bytes) is fetched once, counted, checked and
broadcast as it is.  A larger one is joined by shuffle: its exchange by key
is also the aggregate that shows whether a key repeats.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed bounds for broadcasting a lookup table.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def shuffle_join(left: DataFrame, right: DataFrame, on: list[str] | str,
                 strategy: str = "merge", how: str = "inner", salt: int = 1) -> DataFrame:
    """Join with a shuffle on the keys (``merge`` or ``shuffle_hash``).

    ``salt`` > 1 cuts every key's left rows into that many parts by a hash of
    the row and repeats the right rows for each part (inner and left joins)."""
    if strategy not in ("merge", "shuffle_hash", "shuffle_merge"):
        raise ValueError(f"unknown strategy {strategy!r}")
    keys = [on] if isinstance(on, str) else list(on)
    if salt <= 1:
        return left.join(right.hint(strategy), keys, how)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"a salted {how} join would repeat right rows")
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salt)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
    salted = right.withColumn("_salt", parts).hint(strategy)
    return left.withColumn("_salt", part).join(salted, [*keys, "_salt"], how).drop("_salt")


def _bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(16)


def lookup_size(df: DataFrame, keys: list[str]) -> tuple[int, int, int]:
    """(rows, bytes, largest key multiplicity) of a lookup table: one
    aggregate by key, partial in every task, and one over the keys."""
    size = F.lit(0).cast("long")
    for field in df.schema.fields:
        size = size + _bytes(field)
    per_key = df.select(*[F.col(f"`{k}`") for k in keys], size.alias("_b")).groupBy(
        *[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_c"), F.sum("_b").alias("_b"))
    r = per_key.agg(F.sum("_c").alias("n"), F.sum("_b").alias("b"), F.max("_c").alias("mult")).first()
    return int(r["n"] or 0), int(r["b"] or 0), int(r["mult"] or 0)


# A key is hot from one in HOT_SHARE rows on; keys that the
# sketch tracks (its error is far below that share).
HOT_SHARE = 200
TRACKED = 8192


def hot_keys(df: DataFrame, keys: list[str], share: int = HOT_SHARE) -> tuple[int, dict[int, int]]:
    """(rows, {hash of a hot key: its rows, about}): every key that holds at
    least one row in ``share``, by one pass of a frequent-items sketch that
    tasks merge; at most ``2 * share`` come back whatever the data."""
    sketch = F.expr(f"approx_top_k(_h, {2 * share}, {TRACKED})")
    hashed = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("_h"))
    r = hashed.agg(F.count(F.lit(1)).alias("n"), sketch.alias("top")).first()
    # the sketch may be off by a few of its tracked shares
    least = r["n"] / share - 4 * r["n"] / TRACKED
    return r["n"], {t["item"]: t["count"] for t in r["top"] or () if t["count"] >= max(2, least)}


def skew_join(left: DataFrame, right: DataFrame, on: list[str] | str, strategy: str = "merge",
              how: str = "inner", share: int = HOT_SHARE) -> DataFrame:
    """J1 with hot left keys found and spread (inner, left, semi, anti).

    A hot key's left rows are dealt into parts of about one in ``share`` of all
    rows, and its right rows are repeated for each part; the rows of all
    other keys are sent once, as in ``shuffle_join``."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"a salted {how} join would repeat right rows")
    keys = [on] if isinstance(on, str) else list(on)
    n, hot = hot_keys(left, keys, share)
    parts = {h: math.ceil(c * share / n) for h, c in hot.items()} if n else {}
    parts = {h: p for h, p in parts.items() if p > 1}
    if not parts:
        return shuffle_join(left, right, keys, strategy, how)
    known = F.create_map(*[F.lit(v) for item in sorted(parts.items()) for v in item])
    n_parts = F.coalesce(F.try_element_at(known, F.xxhash64(*[F.col(f"`{k}`") for k in keys])), F.lit(1))
    deal = F.pmod(F.monotonically_increasing_id(), n_parts).cast("int")  # any part will do
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    return left.withColumn("_salt", deal).join(repeated.hint(strategy), [*keys, "_salt"], how).drop("_salt")


def _cut(max_rows: int, max_bytes: int):
    """Rows of a task up to one beyond the bounds."""
    def run(batches):
        rows = size = 0
        for batch in batches:
            if rows > max_rows or size > max_bytes:
                return
            yield batch
            rows, size = rows + batch.num_rows, size + batch.nbytes

    return run


# An estimate of Spark's below which a lookup is fetched without
# further bounds, and one that says that Spark does not know.
FETCH_BYTES = 16 << 20
UNKNOWN_BYTES = 1 << 60


def _fetched(lookup: DataFrame, max_rows: int, max_bytes: int) -> pa.Table | None:
    """The lookup's rows, or more rows than the bounds allow if there are
    more; None if they are not worth fetching.  Unless the estimate is small,
    every task stops at the bounds, and so does the one that hands the rows to
    the driver: whatever the table, no more than the bounds travels."""
    estimate = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if max_bytes < estimate < UNKNOWN_BYTES:
        return None
    plain = lookup.toDF(*[f"c{i}" for i in range(len(lookup.columns))])
    try:
        if estimate > FETCH_BYTES:
            cut, kind = _cut(max_rows, max_bytes), plain.schema
            plain = plain.mapInArrow(cut, kind).limit(max_rows + 1).mapInArrow(cut, kind)
        return plain.toArrow()
    except (TypeError, NotImplementedError, pa.ArrowException):  # a type without an Arrow form
        return None


def _repeats(rows: pa.Table, keys: list[str]) -> int:
    """Rows that share the most frequent key."""
    if not rows.num_rows:
        return 0
    return max(rows.select(keys).group_by(keys).aggregate([([], "count_all")]).column("count_all").to_pylist())


def _unique(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key; a repeated one raises as the join runs.  The aggregate's
    exchange by key is the one that the join needs."""
    rest = [c for c in lookup.columns if c not in keys]
    grouped = lookup.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count(F.lit(1)).alias("_c"), F.any_value(F.struct(F.lit(True).alias("_hit"), *[F.col(f"`{c}`") for c in rest])).alias("_rest"))
    why = F.concat(F.lit(f"lookup keys {keys} are not unique ("), F.col("_c"), F.lit(" rows share a key)"))
    return grouped.where(F.when(F.col("_c") > 1, F.raise_error(why)).otherwise(F.lit(True))).select(*[F.col(f"`{k}`") for k in keys], "_rest.*")


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: list[str] | str, strict: bool = True,
    max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``facts`` enriched with ``lookup`` columns; a fact key absent from
    the lookup raises (``strict``) or drops the row (inner join).  A repeated
    lookup key raises: here, if the rows fetched show it, else as the join
    runs."""
    keys = [on] if isinstance(on, str) else list(on)
    rows = _fetched(lookup, max_rows, max_bytes)
    if rows is not None:
        names = [f"c{lookup.columns.index(k)}" for k in keys]
        try:
            multiplicity = _repeats(rows, names)
        except pa.ArrowException:  # a key that Arrow does not group
            rows, multiplicity = None, 0
        if multiplicity > 1:
            raise ValueError(f"lookup keys {keys} are not unique ({multiplicity} rows share a key)")
    if rows is not None and rows.num_rows <= max_rows and rows.nbytes <= max_bytes:
        schema = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(lookup.schema.fields)])
        local = facts.sparkSession.createDataFrame(rows, schema).toDF(*lookup.columns)
        side = F.broadcast(local.withColumn("_hit", F.lit(True)))
    else:
        side = _unique(lookup, keys).hint("merge")
    if not strict:
        return facts.join(side, keys, "inner").drop("_hit")
    joined = facts.join(side, keys, "left")
    msg = F.concat(F.lit(f"lookup key missing for {keys}: "),
                   F.to_json(F.struct(*[F.col(k) for k in keys])))
    check = F.when(F.col("_hit").isNull(), F.raise_error(msg)).otherwise(F.lit(True))
    return joined.where(check).drop("_hit")
