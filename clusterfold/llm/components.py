"""Connected components of a link table, as Spark joins and aggregations.

Alternating large-star and small-star rounds: every node links its larger
neighbours to its smallest neighbour, then its smaller neighbours to the
smallest of them, until nothing changes.  Each round moves at most the rows
of the link table; the smallest neighbour of a node is a pre-aggregated
minimum that is joined back, so a hub's links are never gathered in one
place.  Each round's links are saved, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterfold.llm.frames import saved


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): m is the smallest of u and its partners."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("p")).select("p.*")
    return both.join(_least(both), "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.col("b").alias("u"), F.col("a").alias("v"))  # a < b
    least = _least(down)
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return down.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).union(own)


def _mark(links: DataFrame) -> tuple:
    # a sum that wraps: xor is order-free and never overflows
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a``, ``b``,
    long; any order, repeats and self-links allowed).  The component is the
    smallest node that can be reached."""
    links = saved(links.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).where("a < b").distinct())
    mark, last = _mark(links), None
    while mark != last and mark[0]:
        links = saved(_small_star(_large_star(links).distinct()).where("a < b").distinct())
        last, mark = mark, _mark(links)
    # every link now leads to its component's smallest node
    leaves = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.union(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
