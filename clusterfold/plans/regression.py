"""Registered gradient-descent jobs and their DuckDB oracles."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from clusterfold.operators import linear as lin
from clusterfold.plans.common import finished, hash_sql, r6, weights_frame
from clusterfold.plans.training import train_embeddings, train_lineitem, train_orders, train_products

# Fixed values of the registered jobs.
W_PROBE = [0.1, 0.2]          # weights at which gradient_once is evaluated
GD_EPOCHS = 100               # batch GD epochs (reference: 100)
GD_STEP = 0.1                 # batch GD step (reference, normalised data: 0.1)
SCAN_EPOCHS = 100             # epochs of the one-job-per-epoch variant (reference: 100)
SGD_STEP = 0.01               # ordered / averaged / relay SGD step (reference: 0.01)
AVG_SHARDS = 16
RELAY_SHARDS = 4
ADA_STEP = 0.1                # AdaGrad step and epsilon (reference: 0.1, 1e-5)
ADA_EPS = 1e-5
SAMPLED_STEP = 0.1            # sampled SGD step (reference: 0.1)
SAMPLED_REPLICAS = 2
SAMPLED_SEED = 0
GROUPS = ["c_mktsegment", "o_orderpriority"]
CUSTOMERS = ["custkey"]       # a key that grows with the data
ZERO = [0.0, 0.0]
WIDE = 64                     # features of ``embeddings``
PRODUCTS = 45                 # coordinates whose 1,035 products are features
BLOCK_EPOCHS = 5


def q_gradient_once(spark, sf_dir):
    g = lin.gradient(train_lineitem(spark, sf_dir), W_PROBE)
    return spark.createDataFrame(list(enumerate(g)), "pos int, g double").withColumn("g", r6("g"))


def q_batch_gd(spark, sf_dir):
    w = lin.batch_gd(train_lineitem(spark, sf_dir), ZERO, GD_EPOCHS, GD_STEP, "gram")
    return weights_frame(spark, w)


def q_batch_gd_scan(spark, sf_dir):
    w = lin.batch_gd(train_lineitem(spark, sf_dir), ZERO, SCAN_EPOCHS, GD_STEP, "scan")
    return weights_frame(spark, w)


def q_batch_gd_blocks(spark, sf_dir):
    """G2 over more features than the driver's matrix allows."""
    n = PRODUCTS * (PRODUCTS + 1) // 2 + 1
    return weights_frame(spark, lin.batch_gd(train_products(spark, sf_dir, PRODUCTS), [0.0] * n, BLOCK_EPOCHS, GD_STEP, "gram"))


def _on_orders(spark, sf_dir, job):
    """A job over orders joined to customer: the join runs once (persisted
    for the job's passes, then released); the weights are rounded."""
    train = train_orders(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    return finished(job(train).withColumn("w", r6("w")), train)


def q_sgd_pass(spark, sf_dir):
    return _on_orders(spark, sf_dir, lambda t: lin.sgd_pass(t, ZERO, SGD_STEP, "ord", by=GROUPS))


def q_sgd_pass_null(spark, sf_dir):
    """G4 by an integer key that is NULL for every second order."""
    def job(t):
        some = t.withColumn("g", F.when(F.col("ord") % 2 == 0, (F.col("ord") % 7).cast("int")))
        out = lin.sgd_pass(some, ZERO, SGD_STEP, "ord", by=["g"])
        return out.withColumn("g", F.coalesce(F.col("g").cast("string"), F.lit("null")))

    return _on_orders(spark, sf_dir, job)


def q_sgd_pass_wide(spark, sf_dir):
    """G4 over 64 features."""
    out = lin.sgd_pass(train_embeddings(spark, sf_dir), [0.0] * WIDE, SGD_STEP, "ord")
    return out.withColumn("w", r6("w"))


def q_sgd_averaged(spark, sf_dir):
    return _on_orders(spark, sf_dir, lambda t: lin.sgd_averaged(t, ZERO, SGD_STEP, AVG_SHARDS, "ord"))


def q_sgd_relay(spark, sf_dir):
    return _on_orders(spark, sf_dir, lambda t: lin.sgd_relay(t, ZERO, SGD_STEP, RELAY_SHARDS, "ord"))


def _adagrad(spark, sf_dir, by, scaled):
    return _on_orders(spark, sf_dir, lambda t: lin.sgd_adagrad(
        t, ZERO, ZERO, ADA_STEP, ADA_EPS, scale_gradient=scaled, ord_col="ord", by=by))


def q_sgd_adagrad(spark, sf_dir):
    return _adagrad(spark, sf_dir, CUSTOMERS, True)


def q_sgd_adagrad_textbook(spark, sf_dir):
    return _adagrad(spark, sf_dir, CUSTOMERS, False)


def q_sgd_adagrad_segments(spark, sf_dir):
    return _adagrad(spark, sf_dir, GROUPS, True)


def q_sgd_adagrad_averaged(spark, sf_dir):
    return _on_orders(spark, sf_dir, lambda t: lin.sgd_adagrad_averaged(
        t, ZERO, ZERO, ADA_STEP, ADA_EPS, AVG_SHARDS, ord_col="ord"))


def q_sgd_adagrad_whole(spark, sf_dir):
    """G7 as one ordered pass over the whole table."""
    return _adagrad(spark, sf_dir, [], True)


def q_sgd_adagrad_whole_textbook(spark, sf_dir):
    return _adagrad(spark, sf_dir, [], False)


def _sampled(spark, sf_dir, rule):
    return _on_orders(spark, sf_dir, lambda t: lin.sgd_sampled(
        t, ZERO, SAMPLED_STEP, seed=SAMPLED_SEED, replicas=SAMPLED_REPLICAS, rule=rule, ord_col="ord"))


def q_sgd_sampled_rand(spark, sf_dir):
    return _sampled(spark, sf_dir, "rand")


def q_sgd_sampled(spark, sf_dir):
    return _sampled(spark, sf_dir, "arith")


QUERIES = {
    "gradient_once": q_gradient_once,
    "batch_gd": q_batch_gd,
    "batch_gd_scan": q_batch_gd_scan,
    "batch_gd_blocks": q_batch_gd_blocks,
    "sgd_pass": q_sgd_pass,
    "sgd_pass_null": q_sgd_pass_null,
    "sgd_pass_wide": q_sgd_pass_wide,
    "sgd_averaged": q_sgd_averaged,
    "sgd_relay": q_sgd_relay,
    "sgd_adagrad": q_sgd_adagrad,
    "sgd_sampled": q_sgd_sampled,
    "sgd_adagrad_textbook": q_sgd_adagrad_textbook,
    "sgd_adagrad_segments": q_sgd_adagrad_segments,
    "sgd_adagrad_averaged": q_sgd_adagrad_averaged,
    "sgd_sampled_rand": q_sgd_sampled_rand,
    "sgd_adagrad_whole": q_sgd_adagrad_whole,
    "sgd_adagrad_whole_textbook": q_sgd_adagrad_whole_textbook,
}


# ---- DuckDB oracles -----------------------------------------------------------

_TL = ("tl AS (SELECT l_quantity / 50.0 AS x0, 1.0::DOUBLE AS x1, "
       "l_extendedprice / 100000.0 AS y FROM lineitem)")
_TO = ("tr AS (SELECT o_orderkey AS ord, o_custkey AS custkey, c_mktsegment, o_orderpriority, "
       "c_acctbal / 10000.0 AS x0, 1.0::DOUBLE AS x1, o_totalprice / 500000.0 AS y "
       "FROM orders JOIN customer ON o_custkey = c_custkey)")


def _gd_sql(epochs: int) -> str:
    return (
        f"WITH RECURSIVE {_TL}, "
        "s AS (SELECT count(*) AS m, sum(x0 * x0) AS g00, sum(x0 * x1) AS g01, "
        "sum(x1 * x1) AS g11, sum(x0 * y) AS h0, sum(x1 * y) AS h1 FROM tl), "
        "gd(e, w0, w1) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL "
        f"SELECT e + 1, w0 - 2 * (g00 * w0 + g01 * w1 - h0) * ({GD_STEP} / m), "
        f"w1 - 2 * (g01 * w0 + g11 * w1 - h1) * ({GD_STEP} / m) FROM gd, s WHERE e < {epochs}) "
        f"SELECT 0 AS pos, round(w0, 6) AS w FROM gd WHERE e = {epochs} UNION ALL "
        f"SELECT 1 AS pos, round(w1, 6) AS w FROM gd WHERE e = {epochs}"
    )


# State of a fold: a struct with the weights (and AdaGrad sums); list
# elements carry the same fields so list_reduce sees one type.
_Z = "0.0::DOUBLE"


def _elem(ada: bool) -> str:
    extra = f", 's0': {_Z}, 's1': {_Z}" if ada else ""
    return f"{{'w0': {_Z}, 'w1': {_Z}{extra}, 'x0': x0, 'x1': x1, 'y': y}}"


def _init(ada: bool) -> str:
    extra = f", 's0': {_Z}, 's1': {_Z}" if ada else ""
    return f"{{'w0': {_Z}, 'w1': {_Z}{extra}, 'x0': {_Z}, 'x1': {_Z}, 'y': {_Z}}}"


def _sgd_lambda(c: str) -> str:
    err = "(a.w0 * e.x0 + a.w1 * e.x1 - e.y)"
    return (f"lambda a, e: {{'w0': a.w0 - e.x0 * ({c} * {err}), "
            f"'w1': a.w1 - e.x1 * ({c} * {err}), 'x0': {_Z}, 'x1': {_Z}, 'y': {_Z}}}")


def _ada_lambda(step: float, eps: float, scale: float | None = None) -> str:
    scale = step if scale is None else scale
    err = "(a.w0 * e.x0 + a.w1 * e.x1 - e.y)"
    g0 = f"({scale} * 2.0 * {err} * e.x0)"
    g1 = f"({scale} * 2.0 * {err} * e.x1)"
    s0 = f"(a.s0 + {g0} * {g0})"
    s1 = f"(a.s1 + {g1} * {g1})"
    return (f"lambda a, e: {{'w0': a.w0 - {step} / sqrt({eps} + {s0}) * {g0}, "
            f"'w1': a.w1 - {step} / sqrt({eps} + {s1}) * {g1}, 's0': {s0}, 's1': {s1}, "
            f"'x0': {_Z}, 'x1': {_Z}, 'y': {_Z}}}")


def _unpivot(src: str, keys: list[str]) -> str:
    k = "".join(f"{c}, " for c in keys)
    return (f"SELECT {k}0 AS pos, round(r.w0, 6) AS w FROM {src} UNION ALL "
            f"SELECT {k}1 AS pos, round(r.w1, 6) AS w FROM {src}")


def _grouped_fold_sql(lam: str, ada: bool, groups: list[str] = GROUPS) -> str:
    g = ", ".join(groups)
    return (
        f"WITH {_TO}, f AS (SELECT {g}, list_reduce(list({_elem(ada)} ORDER BY ord), "
        f"{lam}, {_init(ada)}) AS r FROM tr GROUP BY {g}) " + _unpivot("f", groups)
    )


def _whole_fold_sql(lam: str) -> str:
    return f"WITH {_TO}, f AS (SELECT list_reduce(list({_elem(True)} ORDER BY ord), {lam}, {_init(True)}) AS r FROM tr) " + _unpivot("f", [])


_SHARDED = (
    "sh AS (SELECT *, floor((row_number() OVER (ORDER BY ord) - 1) * {p} / "
    "(SELECT count(*) FROM tr))::INTEGER AS shard FROM tr)"
)

_AVG_SQL = (
    f"WITH {_TO}, {_SHARDED.format(p=AVG_SHARDS)}, "
    f"f AS (SELECT shard, list_reduce(list({_elem(False)} ORDER BY ord), "
    f"{_sgd_lambda(f'{SGD_STEP} * 2.0')}, {_init(False)}) AS r FROM sh GROUP BY shard), "
    "u AS (SELECT 0 AS pos, r.w0 AS w FROM f UNION ALL SELECT 1 AS pos, r.w1 AS w FROM f) "
    f"SELECT pos, round(sum(w) / {AVG_SHARDS}, 6) AS w FROM u GROUP BY pos"
)

_AVG_ADA_SQL = (
    f"WITH {_TO}, {_SHARDED.format(p=AVG_SHARDS)}, "
    f"f AS (SELECT shard, list_reduce(list({_elem(True)} ORDER BY ord), "
    f"{_ada_lambda(ADA_STEP, ADA_EPS)}, {_init(True)}) AS r FROM sh GROUP BY shard), "
    "u AS (SELECT 0 AS pos, r.w0 AS w FROM f UNION ALL SELECT 1 AS pos, r.w1 AS w FROM f) "
    f"SELECT pos, round(sum(w) / {AVG_SHARDS}, 6) AS w FROM u GROUP BY pos"
)

_WIDE_ZERO = f"list_transform(range({WIDE}), lambda i: 0.0::DOUBLE)"
_WIDE_SQL = (
    "WITH f AS (SELECT list_reduce(list({'w': " + _WIDE_ZERO + ", 'x': embedding::DOUBLE[], 'y': label::DOUBLE} "
    "ORDER BY vec_id), lambda a, e: {'w': list_transform(range(1, " + str(WIDE + 1) + "), lambda i: a.w[i] - "
    f"{SGD_STEP} * 2.0 * (list_dot_product(a.w, e.x) - e.y) * e.x[i]), 'x': e.x, 'y': e.y}}, "
    "{'w': " + _WIDE_ZERO + ", 'x': " + _WIDE_ZERO + ", 'y': 0.0::DOUBLE}) AS r FROM embeddings) "
    f"SELECT (pos - 1)::INTEGER AS pos, round(r.w[pos], 6) AS w FROM f, (SELECT unnest(range(1, {WIDE + 1})) AS pos)"
)

_RELAY_SQL = (
    f"WITH {_TO}, {_SHARDED.format(p=RELAY_SHARDS)}, "
    f"l AS (SELECT list({_elem(False)} ORDER BY ord) AS l FROM sh), "
    "ends AS (SELECT shard, sum(count(*)) OVER (ORDER BY shard) AS upto FROM sh GROUP BY shard), "
    f"f AS (SELECT shard, list_reduce(list_slice(l.l, 1, upto), "
    f"{_sgd_lambda(f'{SGD_STEP} * 2.0')}, {_init(False)}) AS r FROM ends, l) "
    + _unpivot("f", ["shard"])
)

_SAMPLED_ELEM = f"{{'w0': {_Z}, 'w1': {_Z}, 'c': c, 'x0': x0, 'x1': x1, 'y': y}}"
_SAMPLED_INIT = f"{{'w0': {_Z}, 'w1': {_Z}, 'c': {_Z}, 'x0': {_Z}, 'x1': {_Z}, 'y': {_Z}}}"
_SAMPLED_LAMBDA = (
    "lambda a, e: {'w0': a.w0 - e.x0 * (e.c * (a.w0 * e.x0 + a.w1 * e.x1 - e.y)), "
    "'w1': a.w1 - e.x1 * (e.c * (a.w0 * e.x0 + a.w1 * e.x1 - e.y)), "
    f"'c': {_Z}, 'x0': {_Z}, 'x1': {_Z}, 'y': {_Z}}}"
)
def _sampled_sql(pick: str) -> str:
    return (
        f"WITH {_TO}, ix AS (SELECT row_number() OVER (ORDER BY ord) - 1 AS idx, x0, x1, y FROM tr), "
        "mm AS (SELECT count(*) AS m FROM tr), "
        f"dr AS (SELECT r.replica::INTEGER AS replica, ix.idx AS t, "
        f"{pick} AS pick, "
        f"2.0 * {SAMPLED_STEP} / mm.m AS c "
        f"FROM range({SAMPLED_REPLICAS}) r(replica), ix, mm), "
        "st AS (SELECT dr.replica, dr.t, dr.c, ix.x0, ix.x1, ix.y FROM dr JOIN ix ON ix.idx = dr.pick), "
        f"f AS (SELECT replica, list_reduce(list({_SAMPLED_ELEM} ORDER BY t), "
        f"{_SAMPLED_LAMBDA}, {_SAMPLED_INIT}) AS r "
        "FROM st GROUP BY replica) " + _unpivot("f", ["replica"])
    )


_SAMPLED_SQL = _sampled_sql(f"(ix.idx * 7919 + {SAMPLED_SEED} + r.replica * 104729) % mm.m")

def _products_sql(epochs: int) -> str:
    ctes = [
        f"e AS (SELECT vec_id, list_slice(embedding::DOUBLE[], 1, {PRODUCTS}) AS x, label / 10 AS y FROM embeddings)",
        f"ab AS (SELECT a, b, row_number() OVER (ORDER BY a, b) - 1 AS pos FROM range(1, {PRODUCTS + 1}) r(a), range(1, {PRODUCTS + 1}) s(b) WHERE a <= b)",
        "f AS MATERIALIZED (SELECT vec_id, y, pos, x[a] * x[b] AS v FROM e, ab UNION ALL SELECT vec_id, y, (SELECT count(*) FROM ab), 1.0::DOUBLE FROM e)",
        "w0 AS MATERIALIZED (SELECT DISTINCT pos, 0.0::DOUBLE AS w FROM f)",
    ]
    for i in range(epochs):
        ctes += [
            f"r{i} AS MATERIALIZED (SELECT vec_id, sum(v * w) - any_value(y) AS r FROM f JOIN w{i} USING (pos) GROUP BY vec_id)",
            f"w{i + 1} AS MATERIALIZED (SELECT pos, any_value(w) - 2 * sum(r * v) * ({GD_STEP} / (SELECT count(*) FROM e)) AS w "
            f"FROM f JOIN r{i} USING (vec_id) JOIN w{i} USING (pos) GROUP BY pos)",
        ]
    return "WITH " + ", ".join(ctes) + f" SELECT pos::INTEGER AS pos, round(w, 6) + 0.0 AS w FROM w{epochs}"


ORACLES = {
    "batch_gd_blocks": _products_sql(BLOCK_EPOCHS),
    "gradient_once": (
        f"WITH {_TL} SELECT 0 AS pos, round(sum(2 * ({W_PROBE[0]} * x0 + {W_PROBE[1]} * x1 - y) * x0), 6) AS g "
        f"FROM tl UNION ALL SELECT 1 AS pos, "
        f"round(sum(2 * ({W_PROBE[0]} * x0 + {W_PROBE[1]} * x1 - y) * x1), 6) AS g FROM tl"
    ),
    "batch_gd": _gd_sql(GD_EPOCHS),
    "batch_gd_scan": _gd_sql(SCAN_EPOCHS),
    "sgd_pass": _grouped_fold_sql(_sgd_lambda(f"{SGD_STEP} * 2.0"), False),
    "sgd_pass_null": (
        _grouped_fold_sql(_sgd_lambda(f"{SGD_STEP} * 2.0"), False, ["g"]).replace(
            "AS custkey,", "AS custkey, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 7)::VARCHAR "
            "ELSE 'null' END AS g,", 1)
    ),
    "sgd_pass_wide": _WIDE_SQL,
    "sgd_adagrad": _grouped_fold_sql(_ada_lambda(ADA_STEP, ADA_EPS), True, CUSTOMERS),
    "sgd_adagrad_textbook": _grouped_fold_sql(_ada_lambda(ADA_STEP, ADA_EPS, 1.0), True, CUSTOMERS),
    "sgd_adagrad_segments": _grouped_fold_sql(_ada_lambda(ADA_STEP, ADA_EPS), True),
    "sgd_adagrad_averaged": _AVG_ADA_SQL,
    "sgd_adagrad_whole": _whole_fold_sql(_ada_lambda(ADA_STEP, ADA_EPS)),
    "sgd_adagrad_whole_textbook": _whole_fold_sql(_ada_lambda(ADA_STEP, ADA_EPS, 1.0)),
    "sgd_sampled_rand": _sampled_sql(hash_sql("ix.idx", f"(r.replica * 104729 + {SAMPLED_SEED})") + " % mm.m"),
    "sgd_averaged": _AVG_SQL,
    "sgd_relay": _RELAY_SQL,
    "sgd_sampled": _SAMPLED_SQL,
}
