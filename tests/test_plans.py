"""Plan properties that the scale design depends on (regression guards)."""

from __spark_entry__ import queries
from clusterfold.operators import linear as lin
from clusterfold.plans.inspect import count_operator, physical_plan
from clusterfold.plans.training import train_orders

from conftest import SF_SMALL


def _plan(spark, name):
    return physical_plan(queries()[name](spark, SF_SMALL))


def test_text_jobs_do_not_shuffle(spark):
    for name in ("text_lines", "tokenize", "delimited_points", "gen_pairs", "vec_prefix"):
        assert count_operator(queries()[name](spark, SF_SMALL), "Exchange") == 0, name


def test_broadcast_only_where_checked(spark):
    assert "BroadcastHashJoin" in _plan(spark, "join_broadcast")
    shuffle = _plan(spark, "join_shuffle")
    assert "SortMergeJoin" in shuffle and "BroadcastHashJoin" not in shuffle
    # both sides grow with the data: never an estimate-based broadcast
    assert "SortMergeJoin" in _plan(spark, "vec_ops")


def test_fold_has_no_per_group_python_call(spark):
    plan = physical_plan(lin.sgd_pass(train_orders(spark, SF_SMALL), [0.0, 0.0], 0.01, "ord",
                                      by=["c_mktsegment", "o_orderpriority"]))
    assert "FlatMapGroupsInPandas" not in plan
    assert plan.count("MapInPandas") >= 2
    assert "rangepartitioning" in plan.lower()


def test_shard_folds_shuffle_once(spark):
    from pyspark.sql import functions as F

    dense = train_orders(spark, SF_SMALL)  # o_orderkey is 0..m-1: its own rank
    def relay_chunks(train):  # the relay saves its chunks before it scans them
        sharded, ordered = lin.with_shards(train, 4, "ord")
        return lin.affine_chunks(sharded, ["shard"], "ord", 0.02, 2, ordered_input=ordered)

    plan = physical_plan(relay_chunks(dense)).lower()
    assert "rangepartitioning(shard" in plan and "inmemoryrelation" not in plan
    # a key with gaps goes through the row index, whose range partitioning
    # the fold reuses: no second range exchange on (shard, ord)
    gaps = dense.withColumn("ord", F.col("ord") * 3 + 1)
    for job in (relay_chunks(gaps),
                lin.sgd_averaged(gaps, [0.0, 0.0], 0.01, 4, "ord")):
        p = physical_plan(job).lower()
        assert "rangepartitioning(shard" not in p and "inmemoryrelation" not in p
    plain = physical_plan(lin.affine_chunks(dense, [], "ord", 0.02, 2))
    assert "rangepartitioning(ord" in plain.lower()


def test_gram_equals_numpy(spark):
    import numpy as np
    from clusterfold.plans.training import train_lineitem

    rows = train_lineitem(spark, SF_SMALL).collect()
    X, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    m, G, h = lin.gram(train_lineitem(spark, SF_SMALL), 2)
    assert m == len(rows) and np.allclose(G, X.T @ X) and np.allclose(h, X.T @ y)


def test_argmin_lists_do_not_shuffle(spark):
    for name in ("nearest_centroid", "distances_by_point"):
        assert count_operator(queries()[name](spark, SF_SMALL), "Exchange") == 0, name
