"""Shared pieces of the registered jobs: inputs and output shaping.

Registered jobs return flat, scalar columns so that results compare
row-by-row with the DuckDB oracle: arrays are exploded to ``(pos, value)``
(``pos`` 0-based) and order-dependent floating sums are rounded to
``DECIMALS`` on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.operators import kmeans as km
from clusterfold.operators.indexing import HASH_MOD, HASH_MULTS, HASH_SHIFTS
from clusterfold.session import checkpoint_dir
from clusterfold.sources.tables import table

# Fixed value: decimals kept when comparing order-dependent float sums.
DECIMALS = 6


def hash_sql(value: str, seed: int | str) -> str:
    """``indexing.hash_key`` as SQL, for the oracles."""
    h = f"((({value}) % {HASH_MOD}) * {HASH_MULTS[0]} + ({seed}) % {HASH_MOD}) % {HASH_MOD}"
    for mult, shift in zip(HASH_MULTS[::-1], HASH_SHIFTS):
        h = f"(xor(({h})::BIGINT, (({h})::BIGINT >> {shift})) * {mult}) % {HASH_MOD}"
    return f"({h})"


def finished(result: DataFrame, *persisted: DataFrame) -> DataFrame:
    """The rows of ``result``, computed now and written to the shared
    checkpoint folder, after which the frames it read are released."""
    checkpoint_dir(result.sparkSession)
    out = result.checkpoint(eager=True)
    for frame in persisted:
        frame.unpersist()
    return out


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, DECIMALS)


def explode_vector(df: DataFrame, keys: list[str], vec: str, value: str,
                   rounded: bool = True) -> DataFrame:
    """``keys + (pos int, value double)`` from an array column."""
    out = df.select(*keys, F.posexplode(vec).alias("pos", value))
    if rounded:
        out = out.withColumn(value, r6(value))
    return out.withColumn("pos", F.col("pos").cast("int"))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as K-means points ``(id, x, label)``."""
    return km.to_points(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def embedding_seeds(points: DataFrame) -> km.Centroids:
    """K-means seeds: the k smallest vec_id, k = number of distinct labels."""
    k = km.k_from_labels(points)
    return km.collect_centroids(km.seed_frame(points, k, "first"))


def weights_frame(spark: SparkSession, w: list[float], keys: dict | None = None) -> DataFrame:
    """A d-value weight vector (bounded by the feature count) as rows."""
    keys = keys or {}
    names = list(keys)
    schema = ", ".join([f"{n} string" for n in names] + ["pos int", "w double"])
    rows = [tuple(keys[n] for n in names) + (i, float(v)) for i, v in enumerate(w)]
    return spark.createDataFrame(rows, schema).withColumn("w", r6("w"))
