"""Registered K-means jobs over ``embeddings`` and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.functions import vectors as V
from clusterfold.operators import centroid_table as ct
from clusterfold.operators import indexing as IX
from clusterfold.operators import kmeans as km
from clusterfold.sources.tables import table
from clusterfold.plans.common import (
    embedding_points,
    embedding_seeds,
    explode_vector,
    hash_sql,
    r6,
)

# Fixed values of the registered jobs (reference settings: eps 0.001, at
# most 30 iterations for the full loop and 10 for each timed variant).
EPS = 0.001
MAX_ITER = 30
VARIANT_ITER = 10
FAR_COORD = 100.0
SAMPLE_K = 10
SAMPLE_SEED = 7
FIT_SEED = 11
SEED_SHARE = 10
HEAD_N = 3
PREFIX_LEN = 4


def _centroid_rows(spark: SparkSession, cents: km.Centroids, sizes=None) -> DataFrame:
    frame = km.centroid_frame(spark, cents)
    out = explode_vector(frame, ["j"], "c", "c")
    if sizes is not None:
        n = spark.createDataFrame(sorted(sizes.items()), "j int, n bigint")
        out = out.join(F.broadcast(n), "j")
    return out


def q_kmeans_init(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    k = km.k_from_labels(pts)
    return explode_vector(km.seed_frame(pts, k, "first"), ["j"], "c", "c", rounded=False)


def q_kmeans_assign(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    a = km.assign(pts, embedding_seeds(pts))
    return a.select(F.col("id").alias("vec_id"), "label", "j", r6("d").alias("d"))


def q_kmeans_step(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    new, sizes = km.step(pts, embedding_seeds(pts))
    return _centroid_rows(spark, new, sizes)


def q_kmeans_stepwise(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    new, sizes = km.step(pts, embedding_seeds(pts), assign_mode="cross")
    return _centroid_rows(spark, new, sizes)


def _fit(spark, sf_dir):
    """The fit from the k smallest vec_ids, k = number of labels; both are
    read from the persisted points."""
    pts = embedding_points(spark, sf_dir)
    return pts, km.kmeans(pts, init="first", max_iter=MAX_ITER, eps=EPS)


def q_kmeans_fit(spark, sf_dir):
    _, res = _fit(spark, sf_dir)
    return _centroid_rows(spark, res.centroids, res.sizes)


def q_kmeans_trace(spark, sf_dir):
    _, res = _fit(spark, sf_dir)
    return res.trace_frame(spark).drop("seconds")


def q_cluster_labels(spark, sf_dir):
    pts, res = _fit(spark, sf_dir)
    return km.cluster_labels(res.assign(pts))


def q_cluster_labels_trace(spark, sf_dir):
    """K7 at every iteration of the fit (one job after the loop)."""
    pts, res = _fit(spark, sf_dir)
    return km.label_trace(pts, res.history)


def q_centroid_shift(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    seeds = embedding_seeds(pts)
    new, _ = km.step(pts, seeds)
    sh = km.shift_frame(km.centroid_frame(spark, seeds), km.centroid_frame(spark, new))
    return sh.select("j", r6("shift").alias("shift"))


def q_kmeans_empty_cluster(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    seeds = embedding_seeds(pts)
    far = dict(seeds)
    far[len(seeds)] = [FAR_COORD] * len(next(iter(seeds.values())))
    new, sizes = km.step(pts, far, empty_cluster="drop")
    return _centroid_rows(spark, new, sizes)


def q_kmeans_empty_keep(spark, sf_dir):
    """K6 with ``empty_cluster='keep'``: the empty cluster keeps its centroid, n = 0."""
    pts = embedding_points(spark, sf_dir)
    seeds = embedding_seeds(pts)
    far = dict(seeds)
    far[len(seeds)] = [FAR_COORD] * len(next(iter(seeds.values())))
    new, sizes = km.step(pts, far, empty_cluster="keep")
    return _centroid_rows(spark, new, sizes)


def q_cross_distances(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    rows = km.distance_rows(pts, embedding_seeds(pts))
    return rows.select(F.col("id").alias("vec_id"), "j", r6("d").alias("d"))


def q_distances_by_point(spark, sf_dir):
    """A2: every point's list of (d, j), sorted, published exploded.

    A list holds k entries (bounded by the centroid count) and is made in
    the point's own row."""
    pts = embedding_points(spark, sf_dir)
    lists = km.distance_lists(pts, embedding_seeds(pts))
    return lists.select(F.col("id").alias("vec_id"), F.posexplode(F.array_sort("l")).alias("rank", "p")).select(
        "vec_id", F.col("rank").cast("int").alias("rank"), F.col("p.j").cast("int").alias("j"),
        r6("p.d").alias("d"),
    )


def q_nearest_centroid(spark, sf_dir):
    """A3: argmin per point over its distances (min of (d, j))."""
    pts = embedding_points(spark, sf_dir)
    lists = km.distance_lists(pts, embedding_seeds(pts))
    m = lists.select("id", F.array_min("l").alias("m"))
    return m.select(F.col("id").alias("vec_id"), F.col("m.j").alias("j"), r6("m.d").alias("d"))


def q_cluster_means(spark, sf_dir):
    """A4 keyed by the true label: mean vector and size per label."""
    pts = embedding_points(spark, sf_dir)
    means = km.cluster_means(pts.select(F.col("label").alias("j"), "x"))
    return explode_vector(means.withColumnRenamed("j", "label"), ["label", "n"], "c", "c")


def q_k_from_labels(spark, sf_dir):
    k = km.k_from_labels(embedding_points(spark, sf_dir))
    return spark.createDataFrame([(k,)], "k bigint")


def q_label_domain(spark, sf_dir):
    from clusterfold.operators.indexing import distinct_values

    return distinct_values(embedding_points(spark, sf_dir), "label")


def q_head_n(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    top = IX.head_n(pts, HEAD_N, ["id"])
    return explode_vector(top.withColumnRenamed("id", "vec_id"), ["vec_id", "label"], "x", "v",
                          rounded=False)


def q_vec_prefix(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    pre = pts.select(F.col("id").alias("vec_id"), IX.prefix("x", PREFIX_LEN).alias("p"))
    return explode_vector(pre, ["vec_id"], "p", "v", rounded=False)


def q_sample_k(spark, sf_dir):
    """K sampled rows with their coordinates."""
    e = IX.sample_k(table(spark, sf_dir, "embeddings"), SAMPLE_K, SAMPLE_SEED, order_col="vec_id")
    return explode_vector(e, ["vec_id"], "embedding", "v", rounded=False).withColumn("v", F.col("v").cast("double"))


def q_vec_ops(spark, sf_dir):
    """V1-V7 on consecutive pairs (vec_id, vec_id + 1), reduced to scalars."""
    pts = embedding_points(spark, sf_dir)
    a = pts.select(F.col("id").alias("vec_id"), F.col("x").alias("a"))
    b = pts.select((F.col("id") - 1).alias("vec_id"), F.col("x").alias("b"))
    p = a.join(b.hint("merge"), "vec_id").where(V.require_same_length("a", "b"))
    return p.select(
        "vec_id",
        r6(V.vsum(V.vadd("a", "b"))).alias("sum_add"),
        r6(V.vsum(V.vsub("a", "b"))).alias("sum_sub"),
        r6(V.vdot("a", "b")).alias("dot"),
        r6(V.vsum(V.vscale("a", 0.5))).alias("sum_scaled"),
        r6(V.vsum(V.hadamard("a", "b"))).alias("sum_hadamard"),
        r6(V.vdist("a", "b")).alias("dist"),
        F.size(V.zeros(F.size("a"))).alias("zero_len"),
    )


def _variants(spark, sf_dir):
    pts = embedding_points(spark, sf_dir)
    rows = km.variant_timings(pts, embedding_seeds(pts), max_iter=VARIANT_ITER, eps=EPS)
    return spark.createDataFrame(
        rows, "variant string, assign string, persist boolean, coalesce int, "
        "iteration int, seconds double, n_clusters int, n_moved int"
    )


def q_kmeans_variants_trace(spark, sf_dir):
    """K10 without seconds: every variant's report, which must be one and the same."""
    return _variants(spark, sf_dir).select("assign", "persist", "coalesce", "iteration", "n_clusters", "n_moved")


def q_cluster_labels_null(spark, sf_dir):
    """K7 at the first iteration over labels of which every third is NULL."""
    pts = embedding_points(spark, sf_dir)
    some = pts.withColumn("label", F.when(F.col("id") % 3 != 0, F.col("label")))
    found = km.label_trace(some, [embedding_seeds(pts)])
    return found.withColumn("label", F.coalesce(F.col("label").cast("string"), F.lit("null")))


def q_kmeans_variants(spark, sf_dir):
    """K10 timing matrix with A7 (total seconds per variant)."""
    t = _variants(spark, sf_dir).drop("n_clusters", "n_moved")
    totals = t.groupBy("variant").agg(F.sum("seconds").alias("total_seconds"))
    return t.join(F.broadcast(totals), "variant")


def q_sample_k_hashed(spark, sf_dir):
    """P7 with a reproducible key: k rows ordered by hash(vec_id, seed)."""
    from clusterfold.operators.indexing import sample_k

    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return sample_k(e, SAMPLE_K, SAMPLE_SEED, order_col="vec_id")


def q_kmeans_fit_hashed(spark, sf_dir):
    """K1 + K4 from k seeds drawn by the reproducible hash order."""
    pts = embedding_points(spark, sf_dir)
    k = km.k_from_labels(pts)
    seeds = km.collect_centroids(km.seed_frame(pts, k, "hash", SAMPLE_SEED))
    res = km.kmeans(pts, init=seeds, max_iter=MAX_ITER, eps=EPS)
    return _centroid_rows(spark, res.centroids, res.sizes)


def q_kmeans_fit_sampled(spark, sf_dir):
    """K1 with sampled seeds (k = number of labels), then the full loop."""
    pts = embedding_points(spark, sf_dir)
    res = km.kmeans(pts, init="sample", seed=FIT_SEED, max_iter=MAX_ITER, eps=EPS)
    return _centroid_rows(spark, res.centroids, res.sizes)


def q_kmeans_assign_table(spark, sf_dir):
    """K2 with a centroid table that grows with the points (about one in
    ``SEED_SHARE``), distributed like them."""
    pts = embedding_points(spark, sf_dir)
    a = ct.assign_table(pts, ct.seed_table(pts, SEED_SHARE, SAMPLE_SEED))
    return a.select(F.col("id").alias("vec_id"), "label", "j", r6("d").alias("d"))


def q_kmeans_step_table(spark, sf_dir):
    """K3 on that table: the new centroids and sizes."""
    pts = embedding_points(spark, sf_dir)
    new = ct.step_table(pts, ct.seed_table(pts, SEED_SHARE, SAMPLE_SEED))
    return explode_vector(new, ["j", "n"], "c", "c")


QUERIES = {
    "kmeans_assign_table": q_kmeans_assign_table,
    "kmeans_step_table": q_kmeans_step_table,
    "kmeans_init": q_kmeans_init,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_step": q_kmeans_step,
    "kmeans_stepwise": q_kmeans_stepwise,
    "kmeans_fit": q_kmeans_fit,
    "kmeans_trace": q_kmeans_trace,
    "cluster_labels": q_cluster_labels,
    "cluster_labels_trace": q_cluster_labels_trace,
    "centroid_shift": q_centroid_shift,
    "kmeans_empty_cluster": q_kmeans_empty_cluster,
    "kmeans_empty_keep": q_kmeans_empty_keep,
    "cross_distances": q_cross_distances,
    "distances_by_point": q_distances_by_point,
    "nearest_centroid": q_nearest_centroid,
    "cluster_means": q_cluster_means,
    "k_from_labels": q_k_from_labels,
    "label_domain": q_label_domain,
    "head_n": q_head_n,
    "vec_prefix": q_vec_prefix,
    "sample_k": q_sample_k,
    "vec_ops": q_vec_ops,
    "kmeans_variants": q_kmeans_variants,
    "kmeans_variants_trace": q_kmeans_variants_trace,
    "cluster_labels_null": q_cluster_labels_null,
    "kmeans_fit_sampled": q_kmeans_fit_sampled,
    "sample_k_hashed": q_sample_k_hashed,
    "kmeans_fit_hashed": q_kmeans_fit_hashed,
}


# ---- DuckDB oracles -----------------------------------------------------------

_P = "p AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings)"
_C0 = (
    "c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY vec_id) - 1)::INTEGER AS j, "
    "embedding::DOUBLE[] AS c FROM embeddings "
    "QUALIFY row_number() OVER (ORDER BY vec_id) <= (SELECT count(DISTINCT label) FROM embeddings))"
)


def _assign_cte(name: str, cents: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT p.vec_id, p.label, p.x, "
        f"arg_min({cents}.j, (list_distance(p.x, {cents}.c), {cents}.j)) AS j, "
        f"min(list_distance(p.x, {cents}.c)) AS d "
        f"FROM p, {cents} GROUP BY p.vec_id, p.label, p.x)"
    )


def _step_ctes(i: int, prev: str) -> list[str]:
    """CTEs a{i} (assignment to {prev}) and m{i} (new centroids j, n, c)."""
    return [
        _assign_cte(f"a{i}", prev),
        f"e{i} AS MATERIALIZED (SELECT j, unnest(range(0, len(x))) AS pos, unnest(x) AS v FROM a{i})",
        f"v{i} AS MATERIALIZED (SELECT j, pos, avg(v) AS v, count(*) AS n FROM e{i} GROUP BY j, pos)",
        f"m{i} AS MATERIALIZED (SELECT j, max(n) AS n, list(v ORDER BY pos) AS c FROM v{i} GROUP BY j)",
    ]


def _rows_of(cents: str, with_n: bool = True) -> str:
    n = "n, " if with_n else ""
    return (
        f"SELECT j, {n}(pos - 1)::INTEGER AS pos, round(c[pos], 6) AS c "
        f"FROM (SELECT j, {n}c, unnest(range(1, len(c) + 1)) AS pos FROM {cents})"
    )


_HASH = hash_sql("vec_id", SAMPLE_SEED)


def _c0_hash(seed: int) -> str:
    key = hash_sql("vec_id", seed)
    return (
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY {key}, vec_id) - 1)::INTEGER AS j, "
        "embedding::DOUBLE[] AS c FROM embeddings "
        f"QUALIFY row_number() OVER (ORDER BY {key}, vec_id) <= "
        "(SELECT count(DISTINCT label) FROM embeddings))"
    )


def _fit_sql(max_iter: int, eps: float, final: str, seed_cte: str = _C0) -> str:
    ctes = [_P, seed_cte, "s0 AS (SELECT false AS s)"]
    trace = []
    for i in range(1, max_iter + 1):
        prev = f"c{i - 1}"
        ctes += _step_ctes(i, prev)
        ctes.append(
            f"t{i} AS MATERIALIZED (SELECT {i} AS iteration, "
            f"(SELECT count(*) FROM m{i}) AS n_clusters, count(*) AS n_compared, "
            f"count(*) FILTER (WHERE list_distance(m{i}.c, {prev}.c) > {eps}) AS n_moved "
            f"FROM m{i} JOIN {prev} USING (j))"
        )
        ctes.append(
            f"c{i} AS MATERIALIZED (SELECT j, c, n FROM m{i} WHERE NOT (SELECT s FROM s{i - 1}) "
            f"UNION ALL SELECT j, c, n FROM {prev} WHERE (SELECT s FROM s{i - 1}))"
            if i > 1
            else f"c{i} AS MATERIALIZED (SELECT j, c, n FROM m{i})"
        )
        ctes.append(
            f"s{i} AS (SELECT (SELECT s FROM s{i - 1}) OR (SELECT n_moved FROM t{i}) = 0 AS s)"
        )
        trace.append(
            f"SELECT iteration::INTEGER AS iteration, n_clusters::INTEGER AS n_clusters, "
            f"n_compared::INTEGER AS n_compared, n_moved::INTEGER AS n_moved, "
            f"(n_compared - n_moved)::INTEGER AS n_stable FROM t{i} "
            f"WHERE NOT (SELECT s FROM s{i - 1})"
        )
    last = f"c{max_iter}"
    ctes.append(_assign_cte("fa", last))
    head = "WITH " + ",\n".join(ctes) + "\n"
    if final == "centroids":
        return head + _rows_of(last)
    if final == "trace":
        return head + "\nUNION ALL\n".join(trace)
    if final == "labels":
        return head + "SELECT j, label, count(*) AS n FROM fa GROUP BY j, label"
    if final == "label_trace":
        return head + "\nUNION ALL\n".join(
            f"SELECT {i}::INTEGER AS iteration, j, label, count(*) AS n FROM a{i} "
            f"WHERE NOT (SELECT s FROM s{i - 1}) GROUP BY j, label"
            for i in range(1, max_iter + 1)
        )
    raise ValueError(final)


def _one_step_sql(seed_cte: str, final: str = "centroids") -> str:
    ctes = [_P, seed_cte] + _step_ctes(1, "c0")
    head = "WITH " + ",\n".join(ctes) + "\n"
    if final == "centroids":
        return head + _rows_of("m1")
    if final == "shift":
        return head + (
            "SELECT j, round(list_distance(m1.c, c0.c), 6) AS shift FROM m1 JOIN c0 USING (j)"
        )
    raise ValueError(final)


_C0_TABLE = (
    "c0 AS MATERIALIZED (SELECT vec_id AS j, embedding::DOUBLE[] AS c FROM embeddings "
    f"WHERE {_HASH} % {SEED_SHARE} = 0)"
)

_ASSIGN_TABLE_SQL = (
    f"WITH {_C0_TABLE}, near AS (SELECT vec_id, label, min({{'d': list_distance(embedding::DOUBLE[], c), 'j': j}}) AS m "
    "FROM embeddings, c0 GROUP BY vec_id, label) SELECT vec_id, label, m.j AS j, round(m.d, 6) AS d FROM near"
)

_C0_FAR = (
    "c0 AS MATERIALIZED (SELECT * FROM (SELECT (row_number() OVER (ORDER BY vec_id) - 1)::INTEGER AS j, "
    "embedding::DOUBLE[] AS c FROM embeddings "
    "QUALIFY row_number() OVER (ORDER BY vec_id) <= (SELECT count(DISTINCT label) FROM embeddings)) "
    f"UNION ALL SELECT (SELECT count(DISTINCT label) FROM embeddings)::INTEGER AS j, "
    f"list_transform(range((SELECT max(len(embedding)) FROM embeddings)), "
    f"lambda i: {FAR_COORD}::DOUBLE) AS c)"
)

ORACLES = {
    "kmeans_assign_table": _ASSIGN_TABLE_SQL,
    "kmeans_step_table": _one_step_sql(_C0_TABLE),
    "kmeans_init": (
        f"WITH {_C0} SELECT j, (pos - 1)::INTEGER AS pos, c[pos] AS c "
        "FROM (SELECT j, c, unnest(range(1, len(c) + 1)) AS pos FROM c0)"
    ),
    "kmeans_assign": (
        f"WITH {_P}, {_C0}, {_assign_cte('a', 'c0')} "
        "SELECT vec_id, label, j, round(d, 6) AS d FROM a"
    ),
    "kmeans_step": _one_step_sql(_C0),
    "kmeans_stepwise": _one_step_sql(_C0),
    "kmeans_empty_cluster": _one_step_sql(_C0_FAR),
    "kmeans_empty_keep": (
        "WITH " + ",\n".join([_P, _C0_FAR] + _step_ctes(1, "c0")) + ", "
        "kept AS (SELECT j, n, c FROM m1 UNION ALL "
        "SELECT j, 0::BIGINT AS n, c FROM c0 WHERE j NOT IN (SELECT j FROM m1)) "
        + _rows_of("kept")
    ),
    "centroid_shift": _one_step_sql(_C0, "shift"),
    "kmeans_fit": _fit_sql(MAX_ITER, EPS, "centroids"),
    "kmeans_fit_hashed": _fit_sql(MAX_ITER, EPS, "centroids", _c0_hash(SAMPLE_SEED)),
    "kmeans_fit_sampled": _fit_sql(MAX_ITER, EPS, "centroids", _c0_hash(FIT_SEED)),
    "kmeans_variants_trace": (
        "SELECT a.assign, p.persist, c.c AS coalesce, t.iteration, t.n_clusters, t.n_moved FROM ("
        + _fit_sql(VARIANT_ITER, EPS, "trace") + ") t, (VALUES ('cross'), ('auto')) a(assign), "
        "(VALUES (true), (false)) p(persist), (VALUES (0::INTEGER), (8::INTEGER)) c(c)"
    ),
    "cluster_labels_null": (
        f"WITH {_P}, {_C0}, {_assign_cte('a', 'c0')}, n AS (SELECT j, "
        "CASE WHEN vec_id % 3 <> 0 THEN label::VARCHAR ELSE 'null' END AS label FROM a) "
        "SELECT 1::INTEGER AS iteration, j, label, count(*) AS n FROM n GROUP BY j, label"
    ),
    "sample_k": (
        "SELECT vec_id, (pos - 1)::INTEGER AS pos, embedding[pos]::DOUBLE AS v FROM "
        "(SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM "
        f"(SELECT * FROM embeddings ORDER BY {_HASH}, vec_id LIMIT {SAMPLE_K}))"
    ),
    "sample_k_hashed": (
        f"SELECT vec_id, label FROM embeddings ORDER BY {_HASH}, vec_id LIMIT {SAMPLE_K}"
    ),
    "kmeans_trace": _fit_sql(MAX_ITER, EPS, "trace"),
    "cluster_labels": _fit_sql(MAX_ITER, EPS, "labels"),
    "cluster_labels_trace": _fit_sql(MAX_ITER, EPS, "label_trace"),
    "cross_distances": (
        f"WITH {_P}, {_C0} SELECT vec_id, j, round(list_distance(p.x, c0.c), 6) AS d FROM p, c0"
    ),
    "distances_by_point": (
        f"WITH {_P}, {_C0} SELECT vec_id, (row_number() OVER (PARTITION BY vec_id "
        "ORDER BY list_distance(p.x, c0.c), j) - 1)::INTEGER AS rank, j, "
        "round(list_distance(p.x, c0.c), 6) AS d FROM p, c0"
    ),
    "nearest_centroid": (
        f"WITH {_P}, {_C0}, {_assign_cte('a', 'c0')} SELECT vec_id, j, round(d, 6) AS d FROM a"
    ),
    "cluster_means": (
        f"WITH {_P}, e AS (SELECT label, unnest(range(0, len(x))) AS pos, unnest(x) AS v FROM p) "
        "SELECT label, count(*) AS n, pos::INTEGER AS pos, round(avg(v), 6) AS c "
        "FROM e GROUP BY label, pos"
    ),
    "k_from_labels": "SELECT count(DISTINCT label) AS k FROM embeddings",
    "label_domain": "SELECT DISTINCT label FROM embeddings",
    "head_n": (
        "SELECT vec_id, label, (pos - 1)::INTEGER AS pos, embedding[pos]::DOUBLE AS v FROM "
        "(SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM "
        f"(SELECT * FROM embeddings ORDER BY vec_id LIMIT {HEAD_N}))"
    ),
    "vec_prefix": (
        "SELECT vec_id, (pos - 1)::INTEGER AS pos, embedding[pos]::DOUBLE AS v FROM "
        f"(SELECT vec_id, embedding, unnest(range(1, least(len(embedding), {PREFIX_LEN}) + 1)) AS pos "
        "FROM embeddings)"
    ),
    "vec_ops": (
        "WITH p AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings) "
        "SELECT a.vec_id, "
        "round(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] + b.x[i])), 6) AS sum_add, "
        "round(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] - b.x[i])), 6) AS sum_sub, "
        "round(list_dot_product(a.x, b.x), 6) AS dot, "
        "round(list_sum(list_transform(a.x, lambda v: v * 0.5)), 6) AS sum_scaled, "
        "round(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])), 6) AS sum_hadamard, "
        "round(list_distance(a.x, b.x), 6) AS dist, len(a.x)::INTEGER AS zero_len "
        "FROM p a JOIN p b ON b.vec_id = a.vec_id + 1"
    ),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit to convergence, then assign every point: (vec_id, label, j, d)."""
    pts, res = _fit(spark, sf_dir)
    a = res.assign(pts)
    return a.select(F.col("id").alias("vec_id"), "label", "j", r6("d").alias("d"))
