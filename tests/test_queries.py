"""Every named query against its statement on the smallest tables, and the shape of the plans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, database

FOLDER = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("key", list(queries()))
def test_query(spark, con, key):
    df = queries()[key](spark, FOLDER)
    if key in SQL:
        note, _ = compare(df, con, SQL[key])
        assert note == ""
    else:
        assert df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(SQL) <= set(queries())


def test_scans_are_pruned_and_filtered(spark):
    plan = queries()["s02_parquet_prune"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,40)]" in plan
    assert "ReadSchema: struct<p_brand:string,p_size:int>" in plan
