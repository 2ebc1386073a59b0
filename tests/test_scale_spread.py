"""Exploded rows are not broadcast: their size is estimated as that of the rows before."""

from gondola.operators.kit import one_edit_pairs


def test_variants_are_not_broadcast(spark):
    a = spark.createDataFrame([("abc",), ("xy",)], "a string")
    b = spark.createDataFrame([("ab",), ("xyz",), ("q",)], "b string")
    df = one_edit_pairs(a, "a", b, "b")
    assert sorted(map(tuple, df.collect())) == [("abc", "ab"), ("xy", "xyz")]
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
