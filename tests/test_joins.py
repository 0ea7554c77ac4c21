import pytest

from clusterfold.operators import joins as J
from clusterfold.plans.inspect import physical_plan

SMALL = [(1, "a"), (2, "b"), (3, "c")]


def _big(spark, extra=()):
    rows = [(1 + (i * 7) % 3, (i * 13) % 100) for i in range(100)] + list(extra)
    return spark.createDataFrame(rows, "k int, n int")


def test_shuffle_equals_broadcast(spark):
    small = spark.createDataFrame(SMALL, "k int, v string")
    big = _big(spark)
    a = J.shuffle_join(big, small, "k").select("k", "v", "n")
    b = J.lookup_join(big, small, "k").select("k", "v", "n")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == 100
    assert "SortMergeJoin" in physical_plan(a)
    assert "BroadcastHashJoin" in physical_plan(b)


def test_missing_key_raises_or_drops(spark):
    small = spark.createDataFrame(SMALL, "k int, v string")
    big = _big(spark, extra=[(9, 5)])  # lookup_missing fixture
    with pytest.raises(Exception, match="lookup key missing"):
        J.lookup_join(big, small, "k").count()
    assert J.lookup_join(big, small, "k", strict=False).count() == 100


def test_broadcast_only_below_bound(spark):
    small = spark.createDataFrame(SMALL, "k int, v string")
    big = _big(spark)
    j = J.lookup_join(big, small, "k", max_rows=2)
    plan = physical_plan(j)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert j.count() == 100


def test_duplicate_lookup_key_rejected(spark):
    small = spark.createDataFrame(SMALL + [(1, "z")], "k int, v string")
    with pytest.raises(ValueError, match="not unique"):
        J.lookup_join(_big(spark), small, "k")
