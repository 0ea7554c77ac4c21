from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clusterfold.operators.indexing import head_n, row_index, sample_k
from clusterfold.sources.tables import table

from conftest import SF_SMALL


def test_row_index_matches_row_number(spark):
    o = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderdate")
    got = {r["o_orderkey"]: r["idx"] for r in row_index(o, ["o_orderdate", "o_orderkey"]).collect()}
    w = Window.orderBy("o_orderdate", "o_orderkey")
    exp = {r["o_orderkey"]: r["i"] for r in o.select("o_orderkey", (F.row_number().over(w) - 1).alias("i")).collect()}
    assert got == exp


def test_row_index_rejects_duplicate_key(spark):
    import pytest

    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match="not unique"):
        row_index(df, ["k"])


def test_sample_and_head(spark):
    e = table(spark, SF_SMALL, "embeddings")
    s = sample_k(e, 7, seed=1).collect()
    assert len(s) == 7 and len({r["vec_id"] for r in s}) == 7
    assert [r["vec_id"] for r in head_n(e, 3, ["vec_id"]).collect()] == [0, 1, 2]
