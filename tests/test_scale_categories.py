"""The confidence of a category is found for what is on offer, not for every pair of product and category."""

import re

from gondola.operators import enrich


def test_fit_of_offers_only(spark):
    products = spark.createDataFrame([(i, [f"c{i % 3}", f"c{i % 3}"] if i % 2 else [f"c{i % 3}", "d"]) for i in range(12)], "product_id int, categories array<string>")
    rules = spark.createDataFrame([(i % 12, i * 5 % 12, (i % 7) / 7, 1.0) for i in range(60)], "a int, b int, confidence double, support double")
    offers = spark.createDataFrame([(1, "c0"), (2, "d"), (3, "zz"), (None, "d")], "product_id int, category string")
    df = enrich.category_recommendations(offers, rules, offers.limit(0), products, 2, 0.5, 100)
    own = {r["product_id"]: r["categories"] for r in products.collect()}
    between = {}
    for a, b, c, _ in rules.collect():
        for x in own[a]:
            for y in own[b]:
                between.setdefault((x, y), []).append(c)
    fit = {k: sum(v) / len(v) for k, v in between.items() if len(v) >= 2 and k[0] != k[1]}
    rows = df.collect()
    assert {(r["product_id"], r["category"]) for r in rows} >= {(1, "c0"), (2, "d"), (3, "zz"), (None, "d")}
    for r in rows:
        known = [fit[x, r["category"]] for x in own.get(r["product_id"], []) if (x, r["category"]) in fit]
        assert r["confidence"] is None if not known else abs(r["confidence"] - sum(known) / len(known)) < 1e-8
    assert not re.search(r"keys=\[product_id#\d+L?, to#", df._jdf.queryExecution().executedPlan().toString())
