import pytest
from pyspark.sql import functions as F

from clusterfold.operators import kmeans as km
from clusterfold.plans.common import embedding_points, embedding_seeds
from clusterfold.plans.inspect import count_operator, physical_plan

from conftest import SF_SMALL


def _close(a, b, tol=1e-9):
    assert sorted(a) == sorted(b)
    for j in a:
        assert a[j] == pytest.approx(b[j], abs=tol)


def test_tie_goes_to_lowest_id(spark):
    # kmeans_tie fixture: point [0], centroids 0 -> [1] and 1 -> [-1]
    pts = spark.createDataFrame([(0, [0.0])], "id bigint, x array<double>")
    for mode in ("expr", "arrow"):
        r = km.assign(pts, {0: [1.0], 1: [-1.0]}, mode).first()
        assert r["j"] == 0 and r["d"] == 1.0


def test_assign_modes_agree(spark):
    pts = embedding_points(spark, SF_SMALL)
    seeds = embedding_seeds(pts)
    a = {r["id"]: (r["j"], round(r["d"], 9)) for r in km.assign(pts, seeds, "arrow").collect()}
    small = {j: c[:2] for j, c in list(seeds.items())[:3]}
    p2 = pts.select("id", F.slice("x", 1, 2).alias("x"))
    e = {r["id"]: (r["j"], round(r["d"], 9)) for r in km.assign(p2, small, "expr").collect()}
    w = {r["id"]: (r["j"], round(r["d"], 9)) for r in km.assign(p2, small, "arrow").collect()}
    assert e == w
    assert len(a) == pts.count()


def test_step_equals_stepwise_and_invariant(spark):
    pts = embedding_points(spark, SF_SMALL)
    seeds = embedding_seeds(pts)
    base, sizes = km.step(pts, seeds)
    cross, sizes2 = km.step(pts, seeds, "cross")
    _close(base, cross)
    assert sizes == sizes2
    for n in (1, 4, 16):
        other, _ = km.step(pts.repartition(n), seeds)
        _close(base, other)


def test_empty_cluster_drop_and_keep(spark):
    # kmeans_far_seed fixture: the seeds plus one centroid at 100 everywhere
    pts = embedding_points(spark, SF_SMALL)
    seeds = embedding_seeds(pts)
    far = dict(seeds)
    far[len(seeds)] = [100.0] * 64
    dropped, _ = km.step(pts, far, empty_cluster="drop")
    kept, sizes = km.step(pts, far, empty_cluster="keep")
    assert len(seeds) not in dropped and len(dropped) == len(seeds)
    assert kept[len(seeds)] == [100.0] * 64 and sizes[len(seeds)] == 0


def test_fit_stops_and_reports(spark):
    pts = embedding_points(spark, SF_SMALL)
    res = km.kmeans(pts, init=embedding_seeds(pts), max_iter=30, eps=1e-3)
    last = res.trace[-1]
    assert last["n_moved"] == 0 and last["n_stable"] == last["n_compared"]
    assert len(res.trace) < 30
    # one more step from the result moves nothing more than eps
    again, _ = km.step(pts, res.centroids)
    assert max(km.shifts(res.centroids, again).values()) <= 1e-3


def test_sampled_init_is_k_rows(spark):
    pts = embedding_points(spark, SF_SMALL)
    res = km.kmeans(pts, init="sample", seed=3, max_iter=2)
    assert 1 <= len(res.centroids) <= 10


def test_assignment_does_not_shuffle_points(spark):
    pts = embedding_points(spark, SF_SMALL)
    a = km.assign(pts, embedding_seeds(pts))
    assert count_operator(a, "Exchange") == 0
    s = km._partial_sums_arrow(pts, embedding_seeds(pts))
    assert "MapInArrow" in physical_plan(s)


def test_large_centroid_tables_go_as_broadcast_chunks(spark, monkeypatch):
    """No cap on k: beyond the closure bound the table is broadcast in
    chunks and the argmin runs chunk by chunk, with the same result."""
    pts = embedding_points(spark, SF_SMALL)
    seeds = embedding_seeds(pts)
    base_assign = {r["id"]: (r["j"], r["d"]) for r in km.assign(pts, seeds, "arrow").collect()}
    base_step, base_sizes = km.step(pts, seeds, "arrow")
    base_rows = sorted((r["id"], r["j"], r["d"]) for r in km.distance_rows(pts, seeds, "arrow").collect())
    monkeypatch.setattr(km, "CLOSURE_VALUES", 10)
    monkeypatch.setattr(km, "BROADCAST_CHUNK_VALUES", 64 * 3)  # 3 centroids per chunk
    ship = km._Shipped(spark, seeds)
    assert ship.local is None and len(ship.parts) == 4
    ship.release()
    got = {r["id"]: (r["j"], r["d"]) for r in km.assign(pts, seeds, "arrow").collect()}
    assert got == base_assign
    step, sizes = km.step(pts, seeds, "arrow")
    _close(step, base_step)
    assert sizes == base_sizes
    rows = sorted((r["id"], r["j"], r["d"]) for r in km.distance_rows(pts, seeds, "arrow").collect())
    assert rows == base_rows


def test_ties_across_chunks_go_to_lowest_id(spark, monkeypatch):
    monkeypatch.setattr(km, "CLOSURE_VALUES", 1)
    monkeypatch.setattr(km, "BROADCAST_CHUNK_VALUES", 1)  # one centroid per chunk
    pts = spark.createDataFrame([(0, [0.0])], "id bigint, x array<double>")
    r = km.assign(pts, {0: [1.0], 1: [-1.0], 2: [1.0]}, "arrow").first()
    assert r["j"] == 0 and r["d"] == 1.0
