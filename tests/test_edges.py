"""Inputs beyond the fixtures: sizes, NULLs, large ids, bad numbers."""

import pytest
from pyspark.sql import functions as F

from clusterfold.operators import joins as J
from clusterfold.operators import kmeans as km
from clusterfold.operators import text as TX
from clusterfold.operators.indexing import hash_key, row_index, sample_k
from clusterfold.plans.common import hash_sql
from clusterfold.plans.inspect import physical_plan
from clusterfold.sources.tables import table


@pytest.mark.parametrize("max_rows", [2, 1000])
def test_repeated_lookup_key_raises_at_every_size(spark, max_rows):
    facts = spark.createDataFrame([(1, 2), (2, 3)], "k int, n int")
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (1, "z")], "k int, v string")
    with pytest.raises(ValueError, match="not unique"):
        J.lookup_join(facts, lookup, "k", max_rows=max_rows)


def test_lookup_size_counts_all_rows(spark):
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.lit("abc").alias("v"))
    rows, size, most = J.lookup_size(lookup, ["k"])
    assert (rows, most) == (5000, 1) and size == 5000 * (16 + 11)


def test_salted_join_spreads_a_hot_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain, salted = J.shuffle_join(left, right, "k"), J.shuffle_join(left, right, "k", salt=8)
    assert sorted(plain.collect()) == sorted(salted.collect())
    assert "_salt" in physical_plan(salted)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny partitions would merge
    try:
        parts = [df.where("k = 0").groupBy(F.spark_partition_id()).count().count() for df in (plain, salted)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert parts[0] == 1 < parts[1]
    with pytest.raises(ValueError):
        J.shuffle_join(left, right, "k", how="outer", salt=4)


def test_hash_of_large_ids(spark):
    import duckdb

    ids = [0, 1, 4_000_000_000, (1 << 40) + 9, (1 << 62) + 5]
    got = [r["h"] for r in spark.createDataFrame([(i,) for i in ids], "id long").select(hash_key("id", 7).alias("h")).collect()]
    want = [duckdb.connect().execute(f"SELECT {hash_sql(f'({i}::BIGINT)', 7)}").fetchone()[0] for i in ids]
    assert got == want and len(set(got)) == len(ids) and all(0 <= h < 1 << 32 for h in got)


def test_sample_does_not_depend_on_the_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") * 3).alias("v"))
    draws = {tuple(sorted(r["id"] for r in sample_k(df.repartition(n), 20, 3).collect())) for n in (1, 7)}
    assert len(draws) == 1 and len(draws.pop()) == 20


def test_row_index_rejects_repeats_and_keeps_nothing_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.range(100).select((F.col("id") % 60).alias("k"))
    with pytest.raises(ValueError, match="40 rows"):
        row_index(df, ["k"])
    assert row_index(spark.range(100), ["id"]).where("id <> idx").count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def _points(spark, rows):
    return spark.createDataFrame(rows, "id long, x array<double>, label int")


def test_label_trace_counts_null_labels(spark):
    pts = _points(spark, [(i, [float(i % 2), 0.0], None if i % 2 else i % 4) for i in range(12)])
    got = km.label_trace(pts, [{0: [0.0, 0.0], 1: [1.0, 0.0]}]).collect()
    assert sorted(((r["j"], r["label"], r["n"]) for r in got), key=str) == [(0, 0, 3), (0, 2, 3), (1, None, 6)]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
@pytest.mark.parametrize("mode", ["expr", "arrow"])
def test_a_coordinate_that_is_not_finite_raises(spark, bad, mode):
    pts = _points(spark, [(0, [0.0, 1.0], 1), (1, [bad, 1.0], 1)])
    with pytest.raises(Exception, match="not finite"):
        km.assign(pts, {0: [0.0, 0.0], 1: [1.0, 1.0]}, mode).collect()


@pytest.mark.parametrize("cache", [False, True])
@pytest.mark.parametrize("coalesce", [None, 2])
@pytest.mark.parametrize("mode", ["expr", "arrow", "cross"])
def test_physical_options_do_not_change_the_fit(spark, cache, coalesce, mode):
    pts = _points(spark, [(i, [float(i % 5), float(i % 3)], 1) for i in range(60)])
    init = {0: [0.0, 0.0], 1: [4.0, 2.0]}
    want = km.kmeans(pts, init=init, max_iter=4)
    got = km.kmeans(pts, init=init, max_iter=4, cache=cache, coalesce=coalesce, assign_mode=mode)
    assert got.sizes == want.sizes
    assert all(got.centroids[j] == pytest.approx(want.centroids[j]) for j in want.centroids)


def test_counters_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], "line string")
    assert tuple(TX.line_counters(empty).first()) == (0, 0, 0)
    long = spark.createDataFrame([("a" + " " * 200_000 + "b   ",)], "line string")
    assert TX.line_counters(long).first()["n_words"] == 200_001


def test_appended_files_are_read(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).write.parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 10
    spark.range(5).write.mode("append").parquet(path)
    assert table(spark, str(tmp_path), "t").count() == 15
