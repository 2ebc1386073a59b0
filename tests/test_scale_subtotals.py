"""A distinct count over sets of columns copies totals, not the values."""

from pyspark.sql import functions as F

from gondola.operators.subtotals import cube_sets, subtotals


def test_values_are_not_copied_for_the_sets(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") % 97).alias("value"), F.col("id").alias("amount"))
    totals = subtotals(df, ["a", "b"], cube_sets(["a", "b"]), {"total": F.col("amount")}, ("value", "values"))
    assert {(r["a"], r["b"]): r["values"] for r in totals.collect() if r["b"] is None} == {(i, None): 97 for i in (0, 1, 2, None)}
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("Window")
