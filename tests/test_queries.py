"""Every registered job against its DuckDB oracle (the driver's check),
at sf0.001 for speed; tools/compare.py runs the same at sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, duck

from conftest import SF_SMALL

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        # no SQL form: tests of its operator compare it with brute force
        assert len(got) > 0 and not got.isna().all(axis=0).any()
        return
    ok, why = compare(got, con.execute(sql).df())
    assert ok, why


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["vec_id", "label", "j", "d"]
