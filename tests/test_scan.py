"""The prefix scan of affine maps and AdaGrad parallel in time."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from clusterfold.operators import adagrad, linear as lin, scan
from clusterfold.plans.inspect import physical_plan

from conftest import SF_SMALL


def random_map(rng, d):
    if rng.random() < 0.5:
        return scan.Affine(d, np.vstack([np.hstack([np.eye(d) + rng.normal(0, 0.2, (d, d)), rng.normal(0, 1, (d, 1))]), np.eye(d + 1)[-1:]]))
    return scan.Affine(d, None, rng.normal(0, 0.3, (d, 1)), rng.normal(0, 0.3, (1, d + 1)))


def test_affine_forms_agree():
    rng = np.random.default_rng(0)
    for _ in range(60):
        d = int(rng.integers(1, 7))
        f, g, v = random_map(rng, d), random_map(rng, d), rng.normal(0, 1, d)
        both = g.after(f)
        assert np.allclose(both.apply(v), g.apply(f.apply(v)))
        assert np.allclose(both.dense() @ np.append(v, 1), np.append(both.apply(v), 1))
        assert np.allclose(scan.Affine.read(d, both.rank, both.bytes()).apply(v), both.apply(v))
    low = [scan.Affine(8, None, rng.normal(0, 1, (8, 1)), rng.normal(0, 1, (1, 9))) for _ in range(2)]
    assert low[1].after(low[0]).rank == 2


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_scan_equals_one_after_another(spark, fan):
    rng, d = np.random.default_rng(fan), 3
    rows, want, last = [], {}, {}
    for g in ("a", None, "b"):
        v = np.array([1.0, -2.0, 0.5])
        nodes = sorted(rng.choice(40, {"a": 25, None: 1, "b": 7}[g], replace=False).tolist())
        for node in nodes:
            for k in range(int(rng.integers(1, 3))):
                own = random_map(rng, d)
                w = own.apply(v)
                rows.append((g, node, k, own.rank, own.bytes(), f"{g}{node}{k}"))
                want[g, node, k] = (v, w)
                v = w
        last[g] = v
    maps = scan.saved(spark.createDataFrame(rows, "g string, _node long, _k int, _r int, _m binary, tag string").repartition(5))
    got = scan.prefixes(maps, ["g"], np.array([1.0, -2.0, 0.5]), carry=["tag"], fan=fan).collect()
    assert {(r["g"], r["_node"], r["_k"]): r["tag"] for r in got} == {(r[0], r[1], r[2]): r[5] for r in rows}
    for r in got:
        v, w = want[r["g"], r["_node"], r["_k"]]
        assert np.allclose(np.frombuffer(r["_v"]), v) and np.allclose(np.frombuffer(r["_w"]), w)
    for r in scan.total(maps, ["g"], d, fan=fan).collect():
        assert np.allclose(scan.Affine.read(d, r["_r"], r["_m"]).apply(np.array([1.0, -2.0, 0.5])), last[r["g"]])


def sgd(rows, w, step):
    for x, y in rows:
        w = w - step * 2 * (w @ x - y) * x
    return w


@pytest.mark.parametrize("d", [2, 40])
def test_folds_over_many_partitions(spark, d, monkeypatch):
    """More partitions than the fan-in: several levels up and down."""
    monkeypatch.setattr(lin, "fan_for", lambda d: 3)
    monkeypatch.setattr(scan, "fan_for", lambda d: 3)
    rng = np.random.default_rng(d)
    X, y = rng.normal(0, 0.3, (500, d)), rng.normal(0, 1, 500)
    train = spark.createDataFrame([(i, X[i].tolist(), float(y[i]), i % 2) for i in range(500)], "ord long, x array<double>, y double, g int").repartition(4)
    w0 = [0.1] * d
    got = {r["pos"]: r["w"] for r in lin.sgd_pass(train, w0, 0.05, partitions=25).collect()}
    assert np.allclose([got[i] for i in range(d)], sgd(zip(X, y), np.array(w0), 0.05))
    relay = {(r["shard"], r["pos"]): r["w"] for r in lin.sgd_relay(train, w0, 0.05, 6, partitions=25).collect()}
    w = np.array(w0)
    for s in range(6):
        own = [i for i in range(500) if i * 6 // 500 == s]
        w = sgd(zip(X[own], y[own]), w, 0.05)
        assert np.allclose([relay[s, i] for i in range(d)], w)
    # a group in more partitions than the fan-in
    grouped = {(r["g"], r["pos"]): r["w"] for r in lin.sgd_pass(train, w0, 0.05, by=["g"], partitions=25).collect()}
    for g in (0, 1):
        assert np.allclose([grouped[g, i] for i in range(d)], sgd(zip(X[g::2], y[g::2]), np.array(w0), 0.05))
    assert lin.sgd_pass(train.limit(0), w0, 0.05).count() == 0


def test_ungrouped_folds_have_no_single_task(spark):
    for name in ("sgd_relay", "sgd_pass_wide", "sgd_adagrad_whole"):
        assert "SinglePartition" not in physical_plan(queries()[name](spark, SF_SMALL)), name
    train = spark.range(100).select(F.col("id").alias("ord"), F.array(F.lit(1.0), F.col("id") / 100).alias("x"), F.lit(1.0).alias("y"))
    assert "SinglePartition" not in physical_plan(lin.sgd_pass(train, [0.0, 0.0], 0.1))


# ---- AdaGrad ----------------------------------------------------------------------------


def ada(rows, w, s, step, a, eps):
    w, s = w.copy(), s.copy()
    for x, y in rows:
        g = a * 2 * (w @ x - y) * x
        s += g * g
        w -= step / np.sqrt(eps + s) * g
    return w, s


def test_adagrad_block_and_its_derivative():
    rng = np.random.default_rng(6)
    X, y = rng.normal(0, 1, (3000, 3)), rng.normal(0, 1, 3000)
    rule, z = adagrad.Rule(3, 0.1, 0.1, 1e-5), np.array([0.3, 0.0, -1.0, 0.0, 0.1, 0.0])
    end, J = rule.block(X, y, z)
    assert np.allclose(end, np.concatenate(ada(zip(X, y), z[:3], z[3:], 0.1, 0.1, 1e-5)), rtol=1e-10, atol=1e-10)
    for i in (0, 4):
        h = np.zeros(6)
        h[i] = 1e-6
        numeric = (np.concatenate(ada(zip(X, y), (z + h)[:3], (z + h)[3:], 0.1, 0.1, 1e-5)) - end) / 1e-6
        assert np.allclose(J[:, i], numeric, rtol=1e-3, atol=1e-4)


@pytest.fixture(scope="module")
def ordered(spark):
    rng = np.random.default_rng(12)
    n = 9000
    X = np.concatenate([rng.normal(0, 1, (n, 1)), np.ones((n, 1))], axis=1)
    y = 0.7 * X[:, 0] - 0.2 + rng.normal(0, 0.3, n)
    key = [("hot" if i % 3 else None) if i % 10 else f"small{i % 7}" for i in range(n)]
    rows = [(i * 2, X[i].tolist(), float(y[i]), key[i]) for i in range(n)]
    return X, y, key, spark.createDataFrame(rows, "ord long, x array<double>, y double, key string").repartition(6).persist()


@pytest.mark.parametrize("scaled", [True, False])
def test_adagrad_in_time_equals_the_pass(ordered, scaled, monkeypatch):
    monkeypatch.setattr(adagrad, "BLOCK_ROWS", 700)
    X, y, _, train = ordered
    a, w0, s0, rounds = 0.1 if scaled else 1.0, [0.5, 0.0], [0.0, 0.2], []
    out = adagrad.adagrad_in_time(train, w0, s0, 0.1, a, 1e-5, "ord", partitions=5, rounds=rounds).collect()
    assert len(out) == 1
    w, s = ada(zip(X, y), np.array(w0), np.array(s0), 0.1, a, 1e-5)
    assert np.allclose(np.frombuffer(out[0]["_w"]), np.concatenate([w, s]), rtol=1e-9)
    assert 1 < len(rounds) <= 8  # Newton's rounds, not one a block
    got = {r["pos"]: r["w"] for r in lin.sgd_adagrad(train, w0, s0, 0.1, 1e-5, scaled).collect()}
    assert np.allclose([got[0], got[1]], w, rtol=1e-9)


def test_adagrad_hot_groups_in_time(ordered, monkeypatch):
    monkeypatch.setattr(adagrad, "BLOCK_ROWS", 500)
    X, y, key, train = ordered
    out = lin.sgd_adagrad(train, [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5, by=["key"], partitions=6, hot_rows=2000)
    got = {}
    for r in out.collect():
        got.setdefault(r["key"], {})[r["pos"]] = r["w"]
    assert got.keys() == set(key)
    for k in got:
        own = [i for i in range(len(key)) if key[i] == k]
        w, _ = ada(zip(X[own], y[own]), np.zeros(2), np.zeros(2), 0.1, 0.1, 1e-5)
        assert np.allclose([got[k][0], got[k][1]], w, rtol=1e-9), k


def test_adagrad_in_time_edges(spark, ordered):
    train = ordered[3]
    assert lin.sgd_adagrad(train.limit(0), [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5).count() == 0
    one = spark.createDataFrame([(0, [2.0, 1.0], 1.0)], "ord long, x array<double>, y double")
    got = {r["pos"]: r["w"] for r in lin.sgd_adagrad(one, [0.0, 0.0], [0.0, 0.0], 0.1, 1e-5).collect()}
    w, _ = ada([(np.array([2.0, 1.0]), 1.0)], np.zeros(2), np.zeros(2), 0.1, 0.1, 1e-5)
    assert math.isclose(got[0], w[0]) and math.isclose(got[1], w[1])
    with pytest.raises(Exception, match="length"):
        lin.sgd_adagrad(one, [0.0], [0.0], 0.1, 1e-5).collect()
