"""Texts and what they hold stay out of broadcasts, whatever the planner takes their size for."""

from gondola.operators.kit import contains_join


def test_only_few_terms_are_broadcast(spark):
    texts = [(1, "dipirona"), (1, "dip"), (2, "acido"), (2, "acido"), (None, "dip"), (3, None)]
    terms = ["dip", "id", "o", "dipi", "dip", None, ""]
    t = spark.createDataFrame(texts, "id int, text string")
    w = spark.createDataFrame([(x,) for x in terms], "term string")
    expected = sorted((i, x) for i, s in texts if i and s for x in {x for x in terms if x} if x in s)
    few = contains_join(t, "id", "text", w, "term")
    assert few._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 1
    assert sorted(map(tuple, few.collect())) == expected
    many = contains_join(t, "id", "text", w, "term", sent=0)
    assert sorted(map(tuple, many.collect())) == expected
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
