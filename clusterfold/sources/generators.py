"""Generated inputs.

Generators take a frame of keys, so the rows they produce grow with the
data they are derived from (``spark.range`` is used only by tests to
rebuild the reference's own inline inputs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_pairs(df: DataFrame, a: str, b: str, n_keys: int = 3, n_values: int = 100) -> DataFrame:
    """``(k int, n int)`` per row with k in 1..n_keys and n in
    0..n_values-1 (the reference draws them at random; here they are an
    arithmetic function of two key columns, hence reproducible)."""
    k = (F.lit(1) + F.pmod(F.col(a) + F.col(b), F.lit(n_keys))).cast("int")
    n = F.pmod(F.col(a) * 31 + F.col(b) * 17, F.lit(n_values)).cast("int")
    return df.select(k.alias("k"), n.alias("n"))


def line_points(df: DataFrame, key: str, m: int | None = None, normalise: bool = True,
                slope: float = 1.0, intercept: float = 2.0) -> DataFrame:
    """The line-shaped training set over a dense 0-based key.

    v = 2*key + 1 (1, 3, 5, ...); raw: ``x=[v, 1], y=slope*v+intercept``;
    normalised: z = (v - 1) / (2m - 1) with m the row count (for m = 1000
    this is the reference's (v - 1) / 1999), ``x=[z, 1], y=slope*z+intercept``."""
    v = (F.col(key) * 2 + 1).cast("double")
    if normalise:
        if m is None:
            m = df.count()
        v = minmax(v, 1.0, 2.0 * m)
    return df.select(
        F.col(key),
        F.array(v, F.lit(1.0)).alias("x"),
        (v * slope + intercept).alias("y"),
    )


def minmax(c: Column, lo: float, hi: float) -> Column:
    """(c - lo) / (hi - lo)."""
    return (c - F.lit(float(lo))) / F.lit(float(hi - lo))


def minmax_scale(df: DataFrame, col: str, out: str | None = None,
                 lo: float | None = None, hi: float | None = None) -> DataFrame:
    """S6 with measured bounds: one ``agg(min, max)`` job unless both
    bounds are given, then one projection."""
    if lo is None or hi is None:
        r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    if hi == lo:
        return df.withColumn(out or f"{col}_scaled", F.lit(0.0))
    return df.withColumn(out or f"{col}_scaled", minmax(F.col(col), lo, hi))
