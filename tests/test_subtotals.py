"""Subtotals against sums taken set by set."""

import random

import pytest
from pyspark.sql import functions as F

from gondola.operators.subtotals import cube_sets, rollup_sets, subtotals

DIMS = ["a", "b", "c"]


def plain(rows, sets):
    """(a, b, c, level) -> (sum, rows, distinct values), by the definition."""
    out = {}
    for chosen in {tuple(d for d in DIMS if d in s) for s in sets}:
        level = sum(0 if d in chosen else 4 >> i for i, d in enumerate(DIMS))
        for *key, value, amount in rows:
            group = out.setdefault((*(k if d in chosen else None for d, k in zip(DIMS, key)), level), [0, 0, set()])
            group[0] += amount
            group[1] += 1
            if value is not None:
                group[2].add(value)
    return {k: (s, n, len(v)) for k, (s, n, v) in out.items()}


@pytest.mark.parametrize("sets", [rollup_sets(DIMS), cube_sets(DIMS), [["a", "c"], ["c", "a"], ["b"]], [[]], [["c"]]])
def test_sets_with_nulls_and_a_heavy_group(spark, sets):
    rng = random.Random(4)
    rows = [("hot" if i % 3 else rng.choice(["x", "y", None]), rng.choice([None, 1, 2]), rng.choice(["p", "q"]), rng.choice([None, *range(30)]), i % 11)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "a string, b int, c string, value int, amount long").repartition(5)
    expected = plain(rows, sets)
    sums = {"total": F.col("amount"), "rows": F.lit(1)}
    got = subtotals(df, DIMS, sets, sums, ("value", "values")).collect()
    assert len(got) == len(expected)
    assert {tuple(r[c] for c in (*DIMS, "level")): (r["total"], r["rows"], r["values"]) for r in got} == expected
    without = subtotals(df, DIMS, sets, sums).collect()
    assert {tuple(r[c] for c in (*DIMS, "level")): (r["total"], r["rows"]) for r in without} == {k: v[:2] for k, v in expected.items()}


def test_a_counted_dimension_and_no_rows(spark):
    df = spark.createDataFrame([("x", 1, "p", 1, 5), ("x", 2, "p", 1, 5)], "a string, b int, c string, value int, amount long")
    got = subtotals(df, ["a", "b"], [["a"]], {"total": F.col("amount")}, ("b", "bs")).collect()
    assert [(r["a"], r["b"], r["level"], r["total"], r["bs"]) for r in got] == [("x", None, 1, 10, 2)]
    assert subtotals(df.limit(0), DIMS, [["a"], []], {"total": F.col("amount")}, ("value", "values")).collect() == []


def test_rows_are_summed_before_they_are_copied(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"), F.col("id").alias("amount"))
    plan = subtotals(df, ["a", "b"], cube_sets(["a", "b"]), {"total": F.col("amount")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")
