"""Parquet table access.

Tables live as ``<dir>/<name>.parquet``. Reading through ``spark.read``
keeps column pruning and predicate pushdown in Catalyst's hands: callers
select what they need and the scan's ``ReadSchema`` shrinks accordingly.
Every call lists the files anew, so appended files are read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy DataFrame over one table."""
    return spark.read.parquet(table_path(sf_dir, name))
