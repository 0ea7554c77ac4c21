"""Training frames built from the driver tables.

Fixed values (feature scales): quantity / 50, price / 100000,
account balance / 10000, order total / 500000, bias feature 1.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.operators.joins import lookup_join
from clusterfold.sources.tables import table


def train_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``x = [l_quantity / 50, 1]``, ``y = l_extendedprice / 100000``
    (no unique key: order-free methods only)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.array(F.col("l_quantity") / 50, F.lit(1.0)).alias("x"),
        (F.col("l_extendedprice") / 100000).alias("y"),
    )


def train_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer: ``ord = o_orderkey``,
    ``x = [c_acctbal / 10000, 1]``, ``y = o_totalprice / 500000`` and the
    group columns ``c_mktsegment``, ``o_orderpriority``.

    customer is the lookup side of a size-checked join: broadcast while its
    measured size is within the bound, a sort-merge join on custkey beyond
    it (never an estimate-based broadcast)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"),
                                              "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"),
                                                "c_acctbal", "c_mktsegment")
    j = lookup_join(o, c, "custkey", strict=False)
    return j.select(
        F.col("o_orderkey").alias("ord"),
        "custkey",
        "c_mktsegment",
        "o_orderpriority",
        F.array(F.col("c_acctbal") / 10000, F.lit(1.0)).alias("x"),
        (F.col("o_totalprice") / 500000).alias("y"),
    )


def train_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ord = vec_id``, ``x`` = the embedding (64 features), ``y = label``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("ord"), F.col("embedding").cast("array<double>").alias("x"),
        F.col("label").cast("double").alias("y"))


def train_products(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """``x`` = the products of any two of the first ``n`` coordinates of an
    embedding (n (n + 1) / 2 features) and the bias, ``y = label / 10``."""
    x = F.slice(F.col("embedding").cast("array<double>"), 1, n)
    pairs = F.flatten(F.transform("_e", lambda a, i: F.transform(F.slice("_e", i + 1, n), lambda b: a * b)))
    return table(spark, sf_dir, "embeddings").select(x.alias("_e"), "label").select(
        F.concat(pairs, F.array(F.lit(1.0))).alias("x"), (F.col("label") / 10).alias("y"))
