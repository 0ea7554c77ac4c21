"""Hot keys found and spread, lookups proven by the join, dense keys by bitmaps."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from clusterfold.operators import joins as J
from clusterfold.operators import linear as lin
from clusterfold.operators.indexing import row_index
from clusterfold.plans.inspect import physical_plan

from conftest import SF_SMALL  # noqa: F401


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.when(F.col("id") % 2 == 0, 1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    right = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.sql("select 0L, -1L union all select null, -2L"))
    return left.repartition(4).persist(), right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("strategy", ["merge", "shuffle_hash"])
def test_skew_join_equals_the_plain_one(sides, how, strategy):
    left, right = sides
    want = J.shuffle_join(left, right, "k", strategy, how)
    got = J.skew_join(left, right, "k", strategy, how, share=20)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_hot_keys_are_found_and_bounded(sides, spark):
    left, _ = sides
    n, hot = J.hot_keys(left, ["k"], share=20)
    names = {r["h"]: r["k"] for r in left.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert n == 6000 and {names[h] for h in hot} == {0, 1, None}  # a third, a sixth, a sixth
    assert sum(hot.values()) <= n
    assert J.hot_keys(left.limit(0), ["k"]) == (0, {})
    many = spark.range(100_000).select((F.col("id") % 150).alias("k"))
    assert len(J.hot_keys(many, ["k"], share=200)[1]) == 150


def test_only_hot_keys_are_repeated(sides, spark):
    left, right = sides
    joined = J.skew_join(left, right, "k", share=20)
    assert "_salt" in physical_plan(joined)
    # right rows after the repetition: two rows of key 0 by its parts, and so on
    _, hot = J.hot_keys(left, ["k"], share=20)
    names = {r["k"]: r["h"] for r in left.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    parts = {k: -(-hot[names[k]] * 20 // 6000) for k in (0, 1, None)}
    # key 0: two rows, keys 1 and null: one each, as often as they have parts
    assert _repeated(joined) == 5002 - 4 + 2 * parts[0] + parts[1] + parts[None]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert joined.where("k = 0").groupBy(F.spark_partition_id()).count().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def _repeated(joined) -> int:
    """Rows that the repetition of the right side makes, counted by running it."""
    plan = joined._jdf.queryExecution().analyzed()
    while "Join" not in plan.nodeName():
        plan = plan.children().head()
    right = plan.children().apply(1)
    java = joined.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(joined.sparkSession._jsparkSession, right)
    return java.count()


def test_no_hot_key_is_a_plain_join(spark):
    a = spark.range(1000).withColumnRenamed("id", "k")
    assert "_salt" not in physical_plan(J.skew_join(a, a.withColumn("v", F.lit(1)), "k"))
    with pytest.raises(ValueError, match="repeat right rows"):
        J.skew_join(a, a, "k", how="full")


def test_hot_composite_keys(spark):
    left = spark.range(3000).select(F.lit(1).alias("a"), F.when(F.col("id") % 2 == 0, "x").otherwise(F.col("id").cast("string")).alias("b"), F.col("id").alias("n"))
    right = spark.createDataFrame([(1, "x", 7), (1, "1", 8), (2, "x", 9)], "a int, b string, v int")
    got, want = J.skew_join(left, right, ["a", "b"]), J.shuffle_join(left, right, ["a", "b"])
    assert sorted(got.collect()) == sorted(want.collect()) and "_salt" in physical_plan(got)


# ---- lookups ----------------------------------------------------------------------------


def _facts(spark):
    return spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"))


@pytest.mark.parametrize("max_rows", [10, 1000])
def test_lookup_of_every_type(spark, max_rows):
    lookup = spark.range(50).select(
        F.col("id").alias("k"), F.lit(decimal.Decimal("1.50")).alias("a"), F.array(F.col("id"), F.lit(None)).alias("b"), F.struct(F.col("id").cast("string").alias("s")).alias("c"),
        F.lit(datetime.datetime(2024, 5, 1, 12)).alias("t"), F.create_map(F.lit("m"), "id").alias("m"), F.lit(None).cast("string").alias("z"), F.lit(b"raw").alias("by"))
    got = J.lookup_join(_facts(spark), lookup, "k", max_rows=max_rows)
    plain = _facts(spark).join(lookup, "k")
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert ("BroadcastHashJoin" in physical_plan(got)) == (max_rows == 1000)


def test_large_lookups_are_proven_by_their_own_exchange(spark):
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    joined = J.lookup_join(_facts(spark), lookup, "k", max_rows=10)
    plan = physical_plan(joined)
    assert plan.count("hashpartitioning") == 2 and "Broadcast" not in plan  # facts once, lookup once
    assert joined.count() == 500
    again = lookup.union(lookup.where("k = 7"))
    with pytest.raises(ValueError, match="not unique"):  # seen in the fetched rows
        J.lookup_join(_facts(spark), again, "k", max_rows=10)
    twice = J.lookup_join(_facts(spark), again, "k", max_bytes=1)  # not fetched
    with pytest.raises(Exception, match="not unique"):
        twice.count()
    with pytest.raises(Exception, match="lookup key missing"):
        J.lookup_join(_facts(spark), lookup.where("k <> 7"), "k", max_rows=10).count()
    assert J.lookup_join(_facts(spark), lookup.where("k <> 7"), "k", strict=False, max_rows=10).count() == 490


def test_lookup_bytes_bound_and_tasks_that_stop(spark, monkeypatch):
    monkeypatch.setattr(J, "FETCH_BYTES", 0)
    lookup = spark.range(50).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("v"))
    assert "BroadcastHashJoin" in physical_plan(J.lookup_join(_facts(spark), lookup, "k"))
    assert "SortMergeJoin" in physical_plan(J.lookup_join(_facts(spark), lookup, "k", max_bytes=20_000))
    assert J._fetched(lookup, 1000, 100) is None
    assert J._fetched(lookup, 10, 1 << 20).num_rows == 11 and J._fetched(lookup, 1000, 1 << 20).num_rows == 50
    unknown = spark.createDataFrame([(k, "x" * 1000) for k in range(300)], "k long, v string").repartition(3)
    assert J._fetched(unknown, 5, 1 << 20).num_rows == 6
    assert "SortMergeJoin" in physical_plan(J.lookup_join(_facts(spark), unknown, "k", max_bytes=2000))


def test_empty_and_null_lookups(spark):
    nothing = spark.createDataFrame([], "k long, v int")
    assert J.lookup_join(_facts(spark), nothing, "k", strict=False).count() == 0
    with pytest.raises(Exception, match="lookup key missing"):
        J.lookup_join(_facts(spark), nothing, "k").count()
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k long, v int")
    with pytest.raises(ValueError, match="not unique"):
        J.lookup_join(_facts(spark), nulls, "k")


# ---- dense keys and draws -----------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 32767, 32768, 32769, 100_000])
def test_dense_keys_by_bitmaps(spark, n):
    keys = spark.range(n).withColumnRenamed("id", "ord")
    assert lin._dense_index(keys.repartition(5), "ord") == (True, n)
    assert not lin._dense_index(keys.union(keys.where("ord = 0")), "ord")[0]
    assert not lin._dense_index(keys.where("ord <> 0").union(keys.where(f"ord = {n - 1}")), "ord")[0] or n == 1
    assert not lin._dense_index(keys.select((F.col("ord") + 1).alias("ord")), "ord")[0]
    assert not lin._dense_index(keys.union(spark.sql("select cast(null as long)")), "ord")[0]


def test_dense_keys_that_are_not(spark):
    swapped = spark.sql("select explode(array(0, 1, 1, 3)) as ord")  # one missing, one repeated
    assert lin._dense_index(swapped, "ord") == (False, 4)
    assert lin._dense_index(spark.sql("select -1 as ord union all select 1"), "ord") == (False, 2)
    assert lin._dense_index(swapped.limit(0), "ord") == (False, 0)
    assert lin._dense_index(spark.sql("select 'a' as ord"), "ord") == (False, 1)


def test_few_draws_do_not_move_the_rows(spark, monkeypatch):
    train = spark.range(2000).select(F.col("id").alias("ord"), F.array(F.col("id") / 2000, F.lit(1.0)).alias("x"), (F.col("id") / 1000).alias("y"))
    seen = []
    chunks = lin.affine_chunks
    monkeypatch.setattr(lin, "affine_chunks", lambda df, *a, **b: seen.append(physical_plan(df)) or chunks(df, *a, **b))
    few = lin.sgd_sampled(train, [0.0, 0.0], 0.1, steps=40, replicas=2, rule="rand").collect()
    assert "BroadcastHashJoin" in seen[0] and "SortMergeJoin" not in seen[0] and "hashpartitioning" not in seen[0]
    monkeypatch.setattr(lin, "BROADCAST_DRAWS", 0)
    many = lin.sgd_sampled(train, [0.0, 0.0], 0.1, steps=40, replicas=2, rule="rand").collect()
    assert "SortMergeJoin" in seen[1]
    assert [tuple(r) for r in sorted(few)] == [pytest.approx(tuple(r)) for r in sorted(many)]


def test_row_index_counts_and_checks_in_one_pass(spark):
    rows = spark.range(1000).select((F.col("id") * 3 % 1000).alias("k"), (F.col("id") % 2).alias("g"))
    got = {r["k"]: r["i"] for r in row_index(rows, ["k"], "i", partitions=7).collect()}
    assert got == {k: k for k in range(1000)}
    with pytest.raises(ValueError, match="not unique: 998 rows"):
        row_index(rows, ["g"])
    assert row_index(rows, ["g"], check_unique=False).count() == 1000
    assert row_index(rows.limit(0), ["k"]).count() == 0
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    with pytest.raises(ValueError, match="not unique: 1 rows"):
        row_index(nulls, ["k"])
