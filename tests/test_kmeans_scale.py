"""Tiled nearest centroids, distance bounds, distributed centroids, the log."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterfold.operators import bounds
from clusterfold.operators import centroid_table as ct
from clusterfold.operators import kmeans as km
from clusterfold.operators import nearest as nr
from clusterfold.plans.common import embedding_points
from clusterfold.plans.inspect import physical_plan
from clusterfold.session import checkpoint_dir

from conftest import SF_SMALL


def plain(X, C):
    D = nr.distances(X, C)
    at = D.argmin(axis=1)
    return at, D[np.arange(len(X)), at], np.sort(D, axis=1)[:, 1] if len(C) > 1 else np.full(len(X), np.inf)


@pytest.mark.parametrize("scale", [1.0, 1e-8, 1e6])
def test_nearest_equals_the_definition(monkeypatch, scale):
    monkeypatch.setattr(nr, "TILE_VALUES", 1 << 12)
    rng = np.random.default_rng(4)
    X = rng.normal(5, 1, (700, 9)) * scale
    C = np.concatenate([rng.normal(5, 1, (300, 9)) * scale, X[:40], X[:40]])  # equal centroids: the lowest place
    at, dist, second = plain(X, C)
    got = nr.nearest(X, [(0, C[:77]), (77, C[77:])])
    assert (got[0] == at).all() and (got[1] == dist).all()
    assert (got[2] <= second).all() and np.allclose(got[2], second, atol=1e-5 * scale)
    one = nr.nearest(X, [(0, C[:1])])
    assert (one[0] == 0).all() and np.isinf(one[2]).all()
    assert all(len(v) == 0 for v in nr.nearest(X[:0], [(0, C)]))


def test_nearest_beyond_squares_of_a_double():
    X = np.array([[1e200, 0.0], [3.0, 4.0], [-1e200, 1.0]])
    C = np.array([[1.0, 1.0], [1e200, 1.0]])
    at, dist, _ = plain(X, C)
    got = nr.nearest(X, [(0, C)])
    assert (got[0] == at).all() and (got[1] == dist).all()


def test_nearest_memory_is_bounded_for_any_k():
    import tracemalloc

    rng = np.random.default_rng(1)
    X, C = rng.normal(0, 1, (10_000, 16)), rng.normal(0, 1, (20_000, 16))
    tracemalloc.start()
    at = nr.nearest(X[:2000], [(0, C)])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    assert (at[:50] == plain(X[:50], C)[0]).all()


def test_certificates_hold():
    rng = np.random.default_rng(9)
    X, C = rng.normal(0, 1, (500, 3)), rng.normal(0, 1, (12, 3))
    j, u, low = nr.nearest(X, [(0, C)])
    for size in (0.0, 0.01, 0.1, 1.0):
        new = C + rng.normal(0, size, C.shape)
        sure = bounds.certified(j, u, low, *bounds._moves(C, new))
        assert (plain(X, new)[0][sure] == j[sure]).all()
        assert size > 0.05 or sure.mean() > 0.8


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 6, (12, 20))
    X = centres[rng.integers(0, 12, 3000)] + rng.normal(0, 1, (3000, 20))
    return spark.createDataFrame([(i, x.tolist(), i % 3) for i, x in enumerate(X)], "id long, x array<double>, label int").repartition(5).persist()


@pytest.mark.parametrize("empty", ["drop", "keep"])
def test_bounded_loop_equals_lloyd(spark, clustered, empty, monkeypatch):
    monkeypatch.setattr(bounds, "BLOCK_VALUES", 4000)
    seeds = {j: c for j, c in km.collect_centroids(km.seed_frame(clustered, 12, "sample", 5)).items()}
    seeds[12] = [500.0] * 20  # nobody's
    got = km.kmeans(clustered, init=seeds, max_iter=15, eps=1e-9, empty_cluster=empty)
    want = km.kmeans(clustered, init=seeds, max_iter=15, eps=1e-9, empty_cluster=empty, cache=False)
    assert got.sizes == want.sizes and len(got.trace) == len(want.trace)
    for a, b in zip(got.history, want.history):
        assert a.keys() == b.keys() and all(np.allclose(a[j], b[j], rtol=0, atol=1e-11) for j in a)
    work = [t["n_recomputed"] for t in got.trace]
    assert work[0] == 3000 and min(work) < 300  # most points keep their centroid unseen
    assert all(t["n_recomputed"] == 3000 for t in want.trace)


def test_bounded_sums_by_executors_equal_the_direct_ones(clustered, monkeypatch):
    seeds = km.collect_centroids(km.seed_frame(clustered, 12, "sample", 5))
    direct = km.kmeans(clustered, init=seeds, max_iter=4, eps=0.0)
    monkeypatch.setattr(bounds, "DIRECT_VALUES", 0)
    long = km.kmeans(clustered, init=seeds, max_iter=4, eps=0.0)
    assert long.sizes == direct.sizes and [t["n_recomputed"] for t in long.trace] == [t["n_recomputed"] for t in direct.trace]
    assert all(np.allclose(long.centroids[j], direct.centroids[j], atol=1e-11) for j in direct.centroids)


def test_bounded_loop_checks_points(spark):
    bad = spark.createDataFrame([(0, [1.0] * 200), (1, [float("nan")] * 200)], "id long, x array<double>")
    with pytest.raises(Exception, match="not finite"):
        km.kmeans(bad, init={0: [0.0] * 200, 1: [1.0] * 200})
    short = spark.createDataFrame([(0, [1.0] * 200), (1, [1.0])], "id long, x array<double>")
    with pytest.raises(Exception, match="length"):
        km.kmeans(short, init={0: [0.0] * 200, 1: [1.0] * 200})


def test_log_resumes_after_a_lost_driver(spark, clustered, tmp_path, monkeypatch):
    seeds = km.collect_centroids(km.seed_frame(clustered, 12, "sample", 5))
    whole = km.kmeans(clustered, init=seeds, max_iter=9, eps=1e-3)
    folder, written = f"{checkpoint_dir(spark)}/log-{tmp_path.name}", km.write_log

    def stops(spark, folder, result):
        if len(result.trace) == 4:  # lost before the fourth iteration is written
            raise KeyboardInterrupt
        written(spark, folder, result)

    monkeypatch.setattr(km, "write_log", stops)
    with pytest.raises(KeyboardInterrupt):
        km.kmeans(clustered, init=seeds, max_iter=9, eps=1e-3, log=folder)
    monkeypatch.undo()
    assert len(km.read_log(spark, folder).trace) == 3
    again = km.kmeans(clustered, init=seeds, max_iter=9, eps=1e-3, log=folder)
    keys = ("iteration", "n_clusters", "n_compared", "n_moved", "n_stable")
    assert [[t[k] for k in keys] for t in again.trace] == [[t[k] for k in keys] for t in whole.trace]
    assert again.sizes == whole.sizes and all(np.allclose(again.centroids[j], whole.centroids[j], atol=1e-11) for j in whole.centroids)
    assert [sorted(h) for h in again.history] == [sorted(h) for h in whole.history]
    # a finished run is read, not run again
    done = km.kmeans(clustered, init=seeds, max_iter=9, eps=1e-3, log=folder)
    assert done.trace == again.trace and done.centroids == again.centroids


# ---- distributed centroids ------------------------------------------------------------


@pytest.mark.parametrize("cell_bytes", [1 << 24, 40_000, 3000])
def test_table_assignment_equals_the_broadcast_one(spark, cell_bytes):
    pts = embedding_points(spark, SF_SMALL)
    seeds = ct.seed_table(pts, 7, 3)
    cents = {r["j"]: list(r["c"]) for r in seeds.collect()}
    want = {r["id"]: (r["j"], r["d"], r["label"]) for r in km.assign(pts, cents).collect()}
    got = ct.assign_table(pts, seeds, cell_bytes)
    assert got.columns == ["id", "label", "j", "d"]
    assert {r["id"]: (r["j"], r["d"], r["label"]) for r in got.collect()} == want
    new, sizes = km.step(pts, cents)
    rows = ct.step_table(pts, seeds, cell_bytes).collect()
    assert {r["j"]: r["n"] for r in rows} == sizes
    assert all(np.allclose(r["c"], new[r["j"]], atol=1e-12) for r in rows)


def test_table_loop_equals_lloyd(spark, clustered):
    seeds = ct.seed_table(clustered, 100, 1)
    cents = {r["j"]: list(r["c"]) for r in seeds.collect()}
    want = km.kmeans(clustered, init=cents, max_iter=4, eps=1e-3)
    table, trace = ct.kmeans_table(clustered, seeds, max_iter=4, eps=1e-3, cell_bytes=50_000)
    assert trace == [t["n_moved"] for t in want.trace]
    got = {r["j"]: (r["n"], r["c"]) for r in table.collect()}
    assert {j: n for j, (n, _) in got.items()} == want.sizes
    assert all(np.allclose(c, want.centroids[j], atol=1e-11) for j, (_, c) in got.items())


def test_table_edges(spark):
    pts = spark.createDataFrame([(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [4.0, 0.0])], "id long, x array<double>")
    cents = spark.createDataFrame([(7, [2.0, 0.0]), (3, [2.0, 0.0]), (9, [9.0, 9.0])], "j long, c array<double>")
    rows = ct.assign_table(pts, cents, 16).collect()
    assert sorted(((r["id"], r["j"], r["d"]) for r in rows), key=str) == [(1, 3, 2.0), (1, 3, 2.0), (None, 3, 2.0)]
    assert ct.assign_table(pts.limit(0), cents).count() == 0
    with pytest.raises(ValueError, match="no centroid"):
        ct.assign_table(pts, cents.limit(0))
    with pytest.raises(ValueError, match="twice"):
        ct.assign_table(pts, cents.unionAll(cents))
    with pytest.raises(Exception, match="length"):
        ct.assign_table(pts, spark.createDataFrame([(1, [0.0])], "j long, c array<double>")).collect()


def test_table_plan_has_no_single_task_and_no_broadcast(spark):
    pts = embedding_points(spark, SF_SMALL)
    plan = physical_plan(ct.step_table(pts, ct.seed_table(pts, 7, 3), 20_000))
    assert "SinglePartition" not in plan and "Broadcast" not in plan and "CartesianProduct" not in plan
