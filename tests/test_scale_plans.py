"""Shapes of plans over the smallest tables."""

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"


def _plan(spark, key):
    return queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_price_list_joins_sales_once(spark):
    assert "l_orderkey" not in _plan(spark, "t10_history_and_latest")
