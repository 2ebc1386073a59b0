"""Pairs on an OR are counted from groups of equal rows."""

from __spark_entry__ import queries


def test_rows_are_counted_before_they_meet(spark):
    df = queries()["j12_or_condition"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # one group per side and kind of pair below the joins, one total above
    assert plan.count("Aggregate [") >= 7 and df.dtypes == [("pairs", "bigint")]
