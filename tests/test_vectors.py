import math

import pytest

from clusterfold.functions import vectors as V


def _pair(spark):
    # two_vectors fixture: a = [1, 2], b = [3, 4]
    return spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<double>, b array<double>")


def test_vector_helpers(spark):
    r = _pair(spark).select(
        V.vadd("a", "b").alias("add"), V.vsub("a", "b").alias("sub"),
        V.vdot("a", "b").alias("dot"), V.hadamard("a", "b").alias("had"),
        V.vdist("a", "b").alias("dist"), V.vscale("a", 2.0).alias("sc"),
        V.zeros(3).alias("z"),
    ).first()
    assert r["add"] == [4.0, 6.0]
    assert r["sub"] == [-2.0, -2.0]
    assert r["dot"] == 11.0
    assert r["had"] == [3.0, 8.0]
    assert r["dist"] == pytest.approx(math.sqrt(8))
    assert r["sc"] == [2.0, 4.0]
    assert r["z"] == [0.0, 0.0, 0.0]


def test_constant_forms_match(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([4.0, 6.0],)], "x array<double>")
    r = df.select(V.dist_const("x", [1.0, 2.0]).alias("d"), V.dot_const("x", [3.0, 4.0]).alias("p")).collect()
    assert [x["d"] for x in r] == [0.0, 5.0]
    assert [x["p"] for x in r] == [11.0, 36.0]


def test_length_mismatch_raises(spark):
    # vec_length_mismatch fixture: [1, 2, 3] and [1, 2]
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception, match="lengths differ"):
        df.where(V.require_same_length("a", "b")).count()
    with pytest.raises(Exception, match="length differs"):
        df.where(V.require_length("a", 2)).count()
