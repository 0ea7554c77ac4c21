"""
v = 1, 3, ..., 1999, y = v + 2, normalised z = (v - 1) / 1999)."""

import pytest
from pyspark.sql import functions as F

from clusterfold.operators import linear as lin
from clusterfold.sources.generators import line_points

REL = 1e-7


def _line(spark, normalise, parts=4):
    keys = spark.range(0, 1000, 1, parts).withColumnRenamed("id", "ord")
    return line_points(keys, "ord", m=1000, normalise=normalise)


def _w(df, keys=()):
    rows = df.orderBy(*keys, "pos").collect()
    return [r["w"] for r in rows]


def test_batch_gd_golden(spark):
    raw = lin.batch_gd(_line(spark, False), [0.0, 0.0], 100, 1e-8)
    assert raw == pytest.approx([0.934385918, 0.000701789368], rel=REL, abs=5e-9)
    norm = lin.batch_gd(_line(spark, True), [0.0, 0.0], 100, 0.1)
    assert norm == pytest.approx([1.01444806, 1.99227085], rel=REL, abs=5e-9)


def test_batch_gd_gram_equals_scan(spark):
    t = _line(spark, True)
    assert lin.batch_gd(t, [0.0, 0.0], 10, 0.1, "gram") == pytest.approx(
        lin.batch_gd(t, [0.0, 0.0], 10, 0.1, "scan"), rel=1e-12)


def test_ordered_pass_golden(spark):
    w = _w(lin.sgd_pass(_line(spark, False), [0.0, 0.0], 1e-7, "ord"))
    assert w == pytest.approx([1.00099855, 0.00440175], rel=REL, abs=5e-9)


@pytest.mark.parametrize("shards,expected", [
    (1, [0.36984172, 2.61408876]),
    (2, [0.62038727, 2.16180787]),
    (4, [0.78193584, 1.99394302]),
    (8, [0.83841411, 1.85353543]),
])
def test_averaged_golden(spark, shards, expected):
    w = _w(lin.sgd_averaged(_line(spark, True), [0.0, 0.0], 0.01, shards, "ord"))
    assert w == pytest.approx(expected, rel=REL, abs=5e-9)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_relay_equals_pass(spark, shards):
    t = _line(spark, True)
    relay = lin.sgd_relay(t, [0.0, 0.0], 0.01, shards, "ord")
    last = relay.where(F.col("shard") == shards - 1)
    assert _w(last) == pytest.approx([0.36984172, 2.61408876], rel=REL, abs=5e-9)
    assert relay.select("shard").distinct().count() == shards


def test_adagrad_golden(spark):
    t = _line(spark, True)
    written = _w(lin.sgd_adagrad(t, [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, True, "ord"))
    assert written == pytest.approx([1.54573968, 1.4569951], rel=REL, abs=5e-9)
    book = _w(lin.sgd_adagrad(t, [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, False, "ord"))
    assert book == pytest.approx([1.59897337, 1.40401828], rel=REL, abs=5e-9)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_fold_invariant_to_partitioning(spark, parts):
    t = _line(spark, True, parts)
    assert _w(lin.sgd_pass(t, [0.0, 0.0], 0.01, "ord", partitions=parts)) == pytest.approx(
        [0.36984172, 2.61408876], rel=REL, abs=5e-9)


def test_grouped_pass_matches_single(spark):
    t = _line(spark, True).withColumn("g", (F.col("ord") % 2).cast("string"))
    both = lin.sgd_pass(t, [0.0, 0.0], 0.01, "ord", by=["g"])
    for g in ("0", "1"):
        single = lin.sgd_pass(t.where(F.col("g") == g), [0.0, 0.0], 0.01, "ord")
        assert _w(both.where(F.col("g") == g)) == pytest.approx(_w(single), rel=1e-12)


def test_sampled_replicas_and_rule(spark):
    t = _line(spark, True)
    out = lin.sgd_sampled(t, [0.0, 0.0], 0.1, steps=500, replicas=3, ord_col="ord")
    assert out.count() == 6
    r = lin.sgd_sampled(t, [0.0, 0.0], 0.1, steps=200, rule="rand", seed=1, ord_col="ord")
    assert r.count() == 2


def test_divergence_raises(spark):
    with pytest.raises(FloatingPointError):
        lin.batch_gd(_line(spark, False), [0.0, 0.0], 200, 1.0)


def test_wide_features_gram_scan_numpy(spark):
    import numpy as np

    d, n = 20, 3000
    rng = np.random.default_rng(0)
    X = rng.normal(size=(n, d))
    X[:, -1] = 1.0
    w_true = rng.normal(size=d)
    y = X @ w_true + 0.01 * rng.normal(size=n)
    df = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(n)],
                               "x array<double>, y double").repartition(4)
    m, G, h = lin.gram(df, d)
    assert m == n
    assert np.allclose(G, X.T @ X) and np.allclose(h, X.T @ y)
    w0 = [0.0] * d
    gram_w = lin.batch_gd(df, w0, 5, 0.05, "gram")
    scan_w = lin.batch_gd(df, w0, 5, 0.05, "scan")
    ref = np.zeros(d)
    for _ in range(5):
        ref = ref - (0.05 / n) * 2 * (X.T @ (X @ ref - y))
    assert np.allclose(gram_w, ref, rtol=1e-9, atol=1e-12)
    assert np.allclose(scan_w, ref, rtol=1e-9, atol=1e-12)
    assert np.allclose(lin.gradient(df, list(w_true)), 2 * X.T @ (X @ w_true - y), atol=1e-8)


def test_sampled_dense_key_equals_row_index_path(spark):
    t = _line(spark, True)
    dense = _w(lin.sgd_sampled(t, [0.0, 0.0], 0.1, steps=700, seed=5, ord_col="ord"))
    gaps = t.withColumn("ord", F.col("ord") * 3 + 7)  # same order, not an index
    via_index = _w(lin.sgd_sampled(gaps, [0.0, 0.0], 0.1, steps=700, seed=5, ord_col="ord"))
    assert dense == pytest.approx(via_index, rel=1e-12)


def test_shards_from_dense_key_equal_row_index_path(spark):
    t = _line(spark, True)
    gaps = t.withColumn("ord", F.col("ord") * 3 + 7)
    for shards in (3, 8):
        a = _w(lin.sgd_averaged(t, [0.0, 0.0], 0.01, shards, "ord"))
        b = _w(lin.sgd_averaged(gaps, [0.0, 0.0], 0.01, shards, "ord"))
        assert a == pytest.approx(b, rel=1e-12)
    r1 = _w(lin.sgd_relay(t, [0.0, 0.0], 0.01, 4, "ord"), ["shard"])
    r2 = _w(lin.sgd_relay(gaps, [0.0, 0.0], 0.01, 4, "ord"), ["shard"])
    assert r1 == pytest.approx(r2, rel=1e-12)
