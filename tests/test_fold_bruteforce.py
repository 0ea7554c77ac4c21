"""The parallel affine fold against a plain sequential fold (brute force)
on groups of very different sizes, several partition counts and small
Arrow batches (so runs cross batch boundaries)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterfold.operators import linear as lin


def _train(spark):
    # group sizes: many 1- and 2-row groups, a few long ones, one hot group
    sizes = [1] * 40 + [2] * 30 + [5] * 10 + [70, 150, 700] + [3000]
    rows, ord_ = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            a = ((ord_ * 7919) % 1000) / 1000.0
            rows.append((ord_, f"g{g:03d}", [a, 1.0], 0.7 * a + 0.3 + ((ord_ * 31) % 7 - 3) / 100.0))
            ord_ += 1
    # shuffle the input order so the fold must sort
    rows = sorted(rows, key=lambda r: (r[0] * 2654435761) % (1 << 32))
    return spark.createDataFrame(rows, "ord long, g string, x array<double>, y double"), rows


def _brute(rows, step, shards=None):
    out = {}
    for ord_, g, x, y in sorted(rows, key=lambda r: r[0]):
        w = out.setdefault(g, [0.0, 0.0])
        err = w[0] * x[0] + w[1] * x[1] - y
        out[g] = [w[0] - x[0] * (2 * step * err), w[1] - x[1] * (2 * step * err)]
    return out


@pytest.mark.parametrize("parts,batch", [(1, 10000), (7, 16), (32, 3)])
def test_grouped_pass_equals_sequential(spark, parts, batch):
    df, rows = _train(spark)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = lin.sgd_pass(df.repartition(5), [0.0, 0.0], 0.05, "ord", by=["g"], partitions=parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    exp = _brute(rows, 0.05)
    res = {}
    for r in got:
        res.setdefault(r["g"], [None, None])[r["pos"]] = r["w"]
    assert sorted(res) == sorted(exp)
    for g in exp:
        assert res[g] == pytest.approx(exp[g], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("parts,batch", [(1, 10000), (9, 5)])
def test_relay_trace_equals_sequential_prefixes(spark, parts, batch):
    df, rows = _train(spark)
    one = df.withColumn("g", F.lit("all"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = lin.sgd_relay(one, [0.0, 0.0], 0.01, 5, "ord", partitions=parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    ordered = sorted(rows, key=lambda r: r[0])
    m = len(ordered)
    for shard in range(5):
        upto = [r for i, r in enumerate(ordered) if (i * 5) // m <= shard]
        exp = _brute([(o, "all", x, y) for o, _, x, y in upto], 0.01)["all"]
        w = sorted((r["pos"], r["w"]) for r in got if r["shard"] == shard)
        assert [v for _, v in w] == pytest.approx(exp, rel=1e-9, abs=1e-12)


def _brute_adagrad(rows, step, eps, scale=True):
    import math

    w, s = {}, {}
    for ord_, g, x, y in sorted(rows, key=lambda r: r[0]):
        wg = w.setdefault(g, [0.0, 0.0])
        sg = s.setdefault(g, [0.0, 0.0])
        err = 2.0 * (wg[0] * x[0] + wg[1] * x[1] - y)
        for i in range(2):
            gi = (step if scale else 1.0) * err * x[i]
            sg[i] += gi * gi
            wg[i] -= step / math.sqrt(eps + sg[i]) * gi
    return w


@pytest.mark.parametrize("parts,batch", [(1, 10000), (6, 4)])
def test_adagrad_equals_sequential(spark, parts, batch):
    df, rows = _train(spark)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = lin.sgd_adagrad(df.repartition(3), [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, True, "ord",
                              by=["g"], partitions=parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    exp = _brute_adagrad(rows, 0.1, 1e-5)
    res = {}
    for r in got:
        res.setdefault(r["g"], [None, None])[r["pos"]] = r["w"]
    assert sorted(res) == sorted(exp)
    for g in exp:
        assert res[g] == pytest.approx(exp[g], rel=1e-12, abs=1e-15)


def test_adagrad_whole_table_is_one_pass(spark):
    df, rows = _train(spark)
    got = lin.sgd_adagrad(df.drop("g"), [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, False, "ord")
    exp = _brute_adagrad([(o, "all", x, y) for o, _, x, y in rows], 0.1, 1e-5, scale=False)["all"]
    assert got.columns == ["pos", "w"]
    w = [r["w"] for r in got.orderBy("pos").collect()]
    assert w == pytest.approx(exp, rel=1e-12, abs=1e-15)


def test_adagrad_averaged_is_the_mean_of_the_shards(spark):
    df, rows = _train(spark)
    rows, shards = sorted(rows, key=lambda r: r[0]), 3
    own = [(o, i * shards // len(rows), x, y) for i, (o, _, x, y) in enumerate(rows)]
    exp = _brute_adagrad(own, 0.1, 1e-5)
    got = lin.sgd_adagrad_averaged(df.drop("g"), [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, shards)
    w = [r["w"] for r in got.orderBy("pos").collect()]
    assert w == pytest.approx([sum(exp[g][p] for g in exp) / shards for p in (0, 1)], rel=1e-12)


def test_wide_fold_equals_sequential(spark):
    rng = np.random.default_rng(4)
    n, d = 300, 40
    X, y = rng.normal(size=(n, d)) / 8, rng.normal(size=n)
    df = spark.createDataFrame([(i, X[i].tolist(), float(y[i])) for i in range(n)], "ord int, x array<double>, y double")
    w = np.zeros(d)
    for i in range(n):
        w = w - 0.05 * 2 * (w @ X[i] - y[i]) * X[i]
    got = lin.sgd_pass(df.repartition(3), [0.0] * d, 0.05, "ord", partitions=2)
    assert np.allclose([r["w"] for r in got.orderBy("pos").collect()], w, rtol=1e-10)


def test_null_keys_are_one_group(spark):
    rows = [(i, None if i % 2 else 5, [0.5, 1.0], 1.0) for i in range(8)]
    df = spark.createDataFrame(rows, "ord int, g int, x array<double>, y double")
    for got in (lin.sgd_pass(df, [0.0, 0.0], 0.1, "ord", by=["g"]),
                lin.sgd_adagrad(df, [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, ord_col="ord", by=["g"])):
        found = sorted(((r["g"], r["pos"]) for r in got.collect()), key=str)
        assert found == [(5, 0), (5, 1), (None, 0), (None, 1)]


def test_hot_group_is_split_across_tasks(spark):
    # one group holds a third of the rows: phase 1 must cut it into chunks
    df = spark.range(0, 30000, 1, 6).select(
        F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.array(F.lit(0.5), F.lit(1.0)).alias("x"), F.lit(1.0).alias("y"))
    chunks = lin.affine_chunks(df, ["g"], "ord", 0.01, 2, partitions=8)
    per_group = {r["g"]: r["count"] for r in chunks.groupBy("g").count().collect()}
    assert per_group["hot"] >= 3
    assert max(n for g, n in per_group.items() if g != "hot") <= 2
