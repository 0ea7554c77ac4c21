"""Physical controls and reports (S7, C1, C2, C5, K10 helpers).

The reference prints partition counts and times its loop by hand; here
the same facts are DataFrames: rows per partition, row counts per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_profile(df: DataFrame) -> DataFrame:
    """``(partition int, n bigint)`` rows per partition of ``df``."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n")
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(name, n)`` for several frames in one job (a union of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_noop(df: DataFrame) -> None:
    """Force full evaluation of ``df`` without collecting it."""
    df.write.format("noop").mode("overwrite").save()
