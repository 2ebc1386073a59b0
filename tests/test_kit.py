"""Building blocks against brute force, with keys that hold a large part of all rows."""

import itertools
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.operators import kit
from gondola.session import checkpoint_folder, lineage_cut, scratch


def test_order_positions_with_one_heavy_group(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 else f"g{i % 7}", rng.randrange(50), i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(6)
    got = kit.order_positions(df, ["g"], [F.desc("v"), F.col("id")], total="v").collect()
    expected = {}
    for g, rows in itertools.groupby(sorted(data, key=lambda r: (r[0], -r[1], r[2])), key=lambda r: r[0]):
        rows, run = list(rows), 0
        for k, (_, v, i) in enumerate(rows, 1):
            run += v
            expected[i] = (k, run, len(rows), sum(r[1] for r in rows))
    assert {r["id"]: (r["position"], r["running"], r["group_rows"], r["group_total"]) for r in got} == expected


def test_order_positions_without_groups_and_with_null_groups(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "g string, v int")
    assert sorted((r["v"], r["position"]) for r in kit.order_positions(df, [], [F.col("v")]).collect()) == [(1, 1), (2, 2), (3, 3)]
    assert sorted((r["v"], r["position"]) for r in kit.order_positions(df, ["g"], [F.col("v")]).collect()) == [(1, 1), (2, 1), (3, 2)]


def test_exact_percentiles_with_ties(spark):
    rng = random.Random(2)
    data = [("hot", 7.0)] * 900 + [(g, float(rng.randrange(30))) for g in ("hot", "b", "c") for _ in range(101)]
    got = kit.exact_percentiles(spark.createDataFrame(data, "g string, v double"), ["g"], "v", {"a": 0.1, "b": 0.5, "c": 0.93}).collect()
    for r in got:
        values = [v for g, v in data if g == r["g"]]
        assert [round(r[c], 9) for c in "abc"] == [round(float(x), 9) for x in np.percentile(values, [10, 50, 93])]


def test_spread_join_with_a_key_heavy_on_both_sides(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
    many = spark.range(3000).select(hot.otherwise(F.concat(F.lit("k"), F.col("id") % 11)).alias("k"), F.col("id").alias("a"))
    few = spark.range(300).select(hot.otherwise(F.concat(F.lit("k"), F.col("id") % 13)).alias("k"), F.col("id").alias("b"))
    left, right = many.collect(), few.collect()
    expected = sorted((x["k"], x["a"], y["b"]) for x in left for y in right if x["k"] is not None and x["k"] == y["k"])
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        joined = kit.spread_join(many, few, "k").select("k", "a", "b")
        assert sorted(map(tuple, joined.collect())) == expected
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("block, least", [(1, 1), (3, 1), (8, 2), (200, 1), (4, 3)])
def test_co_occurrence_against_brute_force(spark, block, least):
    rng = random.Random(3)
    baskets = {b: set(rng.sample(range(30), rng.randrange(1, 7))) for b in range(60)}
    baskets[100], baskets[101], baskets[102] = set(range(25)), set(range(10, 30)), set(range(0, 30, 2))
    lines = spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items], "sale_id int, item int")
    got = {(r["item_a"], r["item_b"]): r["together"] for r in kit.co_occurrence(lines, "sale_id", "item", least, block).collect()}
    truth = {}
    for items in baskets.values():
        for p in itertools.combinations(sorted(items), 2):
            truth[p] = truth.get(p, 0) + 1
    assert got == {p: n for p, n in truth.items() if n >= least}


def test_a_basket_with_a_third_of_all_lines_is_split(spark):
    lines = [(0, i) for i in range(600)] + [(1 + i // 3, i) for i in range(1200)]
    df = spark.createDataFrame(lines, "sale_id int, item int")
    pairs = kit.co_occurrence(df, "sale_id", "item", 2, block=50)
    assert {(r["item_a"], r["item_b"]) for r in pairs.collect()} == {
        p for k in range(200) for p in itertools.combinations(range(3 * k, 3 * k + 3), 2)}
    # rows that share a key of the pair join: two blocks at most
    wide = df.groupBy("sale_id").count().agg(F.max("count")).first()[0]
    blocks = -(-wide // 50)
    dealt = df.filter("sale_id = 0").groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks))).count().agg(F.max("count")).first()[0]
    assert blocks == 12 and dealt < 100


def test_contains_join(spark):
    texts = {1: "dipirona sodica", 2: "acido", 3: "a", 4: "", 5: "cafeina + dipirona"}
    terms = ["dip", "a", "id", "sodica", "cafeina + d", "zz", "ir"]
    t = spark.createDataFrame(list(texts.items()), "id int, text string")
    got = kit.contains_join(t, "id", "text", spark.createDataFrame([(x,) for x in terms], "term string"), "term")
    assert sorted(map(tuple, got.collect())) == sorted((i, x) for i, s in texts.items() for x in terms if x in s)


def test_prefix_join(spark):
    texts, prefixes = ["abc-de", "abd", "ab", "x", None], ["ab", "abc-", "abd", "x", "y", "abc-de-f"]
    a = spark.createDataFrame([(x,) for x in texts], "t string")
    b = spark.createDataFrame([(x,) for x in prefixes], "p string")
    got = sorted(map(tuple, kit.prefix_join(a, "t", b, "p").select("t", "p").collect()))
    assert got == sorted((x, p) for x in texts if x for p in prefixes if x.startswith(p))


def test_one_edit_pairs(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(80)]
    a, b = words[:40], words[40:]

    def near(x, y):
        row = list(range(len(y) + 1))
        for i, cx in enumerate(x, 1):
            previous, row = row, [i]
            for j, cy in enumerate(y, 1):
                row.append(min(previous[j] + 1, row[-1] + 1, previous[j - 1] + (cx != cy)))
        return row[-1] < 2

    df = kit.one_edit_pairs(spark.createDataFrame([(x,) for x in a], "a string"), "a", spark.createDataFrame([(x,) for x in b], "b string"), "b")
    assert sorted(map(tuple, df.collect())) == sorted({(x, y) for x in a for y in b if near(x, y)})


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200), (300, 5)] + [(500, 600 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in kit.components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert {got[i] for i in range(41)} == {0} and got[300] == 0
    assert {got[100], got[101], got[102]} == {100} and 200 not in got
    assert {got[600 + i] for i in range(30)} == {500}


def test_ranks_share_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 5), (4, 1), (5, None)], "id int, v int")
    assert {r["id"]: r["place"] for r in kit.ranks(df, [], "v", "place").collect()} == {2: 1, 1: 2, 3: 2, 4: 4, 5: 5}


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = kit.latest(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scratch_deletes_intermediate_tables(spark):
    checkpoint_folder(spark)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")) / "cuts"
    with scratch(spark):
        before = set(folder.iterdir()) if folder.exists() else set()
        assert sorted(r["id"] for r in lineage_cut(spark.range(5)).collect()) == [0, 1, 2, 3, 4]
        assert len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) <= before
