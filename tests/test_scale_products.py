"""Results that are products of groups are listed by as many tasks as their rows take (F2, F3)."""

from collections import Counter

from pyspark.sql import functions as F

from gondola.operators import fusion, kit, stores


def tasks(df):
    """Rows by the task that listed them."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_a_campaign_is_listed_by_many_tasks(spark, monkeypatch):
    """the stores and products of all campaigns are few bytes, and one task listed all of their products."""
    own = [("a", i, f"p{i}") for i in range(40)] + [("b", 7, "p7"), ("b", 7, "p7"), ("b", None, "p"), (None, 1, "p1"), ("c", 1, "p1")]
    rivals = [("a", i, f"p{i}") for i in range(30, 60)] + [("b", 8, "p8")]
    shops = [("a", i, i % 3) for i in range(80)] + [("b", 1, 1), ("b", 1, 1), (None, 2, 1), ("d", 3, 1), ("b", None, 1)]
    own_df, rivals_df = (spark.createDataFrame(x, "campaign string, product_id long, name string") for x in (own, rivals))
    shops_df = spark.createDataFrame(shops, "campaign string, store_id long, account_id int")
    both = {(*r, "campaign") for r in own} | {(*r, "rival") for r in rivals}
    want = Counter((c, s, a, p, n, k, "|".join(str(x) for x in (s, p) if x is not None)) for c, s, a in shops for d, p, n, k in both if c is not None and c == d)
    few = stores.campaign_dimension(own_df, rivals_df, shops_df)
    assert few.columns == ["campaign", "store_id", "account_id", "product_id", "name", "kind", "store_product"]
    assert Counter(map(tuple, few.collect())) == want
    monkeypatch.setattr(kit, "TASK_PAIRS", 200)
    blocks = kit.product_join
    monkeypatch.setattr(stores, "product_join", lambda *a: blocks(*a, block=3))
    many = stores.campaign_dimension(own_df, rivals_df, shops_df)
    assert Counter(map(tuple, many.collect())) == want
    listed = tasks(many)
    assert len(listed) > 10 and max(listed) < 0.25 * sum(want.values())


def test_pairs_of_a_slug_are_listed_by_many_tasks(spark, monkeypatch):
    """references and products are few bytes, and a task or two listed all of their pairs."""
    entries = spark.createDataFrame([("r", f"n{i}", None) for i in range(90)], "reference_slug string, name_slug string, registration string")
    refs = spark.createDataFrame([("r", 1000 + i) for i in range(50)], "slug string, code int")
    others = spark.createDataFrame([(f"n{i}", None, i, "k") for i in range(90)], "slug string, registration string, code int, kind string")
    denied = spark.createDataFrame([(1003, 5)], "reference_code int, other_code int")
    monkeypatch.setattr(kit, "TASK_PAIRS", 200)
    df = fusion.interchangeable_pairs(entries, refs, others, denied, block=5)
    got = {tuple(r) for r in df.collect()}
    assert got == {(1000 + i, j, "k") for i in range(50) for j in range(90)} - {(1003, 5, "k")}
    listed = tasks(df)
    assert sum(listed) == len(got) and len(listed) > 8 and max(listed) < 0.35 * len(got)
