"""Classes by place without placing every row (F5)."""

import math
from pathlib import Path

from pyspark.sql import functions as F

from gondola.operators import kit, stores
from gondola.plans import inputs
from gondola.plans import stores as plans

LISTED = "account_id int, store_id long, product_id long, stock long"
SOLD = "store_id long, product_id long, qty long, revenue decimal(26,4), cost decimal(26,4)"


def listing(spark):
    """Stores of one to ninety products, equal demands, null products, accounts, quantities and margins."""
    listed = [(None if s == 3 else s % 2, s, None if p == 5 else p, p % 7) for s in range(6) for p in range((1, 2, 3, 10, 30, 90)[s])]
    sold = [(s, p, None if p % 9 == 4 else p * 5 % 4, float(p * 3 % 8), None if p % 11 == 6 else 1.0) for s in range(6) for p in range(90) if (p + s) % 4]
    sold = spark.createDataFrame(sold, "store_id long, product_id long, qty long, revenue double, cost double")
    return listed, spark.createDataFrame(listed, LISTED).repartition(5), sold.selectExpr("store_id", "product_id", "qty", "CAST(revenue AS decimal(26,4)) AS revenue", "CAST(cost AS decimal(26,4)) AS cost")


def expected(listed, sold, a, b):
    by = {(r["store_id"], r["product_id"]): r for r in sold.collect()}
    rows = {}
    for account, s, p, stock in listed:
        r = by.get((s, p))
        qty = r["qty"] if r else None
        margin = None if r is None or None in (r["revenue"], r["cost"]) else round(float(r["revenue"] - r["cost"]) / (qty if qty and qty > 0 else 1), 6)
        rows.setdefault((account, s), []).append((p, qty, margin))
    out = {}
    for (account, s), own in rows.items():
        n = len(own)
        upto = [math.ceil(n * a), math.ceil(n * b)]
        for i, name in ((1, "demand"), (2, "margin")):
            order = sorted(own, key=lambda r: (r[i] is None, -(r[i] or 0), r[0] is not None, r[0] or 0))
            for k, r in enumerate(order, 1):
                kind = "A" if k <= upto[0] else "B" if k <= upto[1] else "C"
                out.setdefault((account, s, r[0]), {})[name] = None if i == 1 and not r[1] else kind
    return {k: (v["demand"], v["margin"]) for k, v in out.items()}


def test_classes_are_those_of_the_places(spark, monkeypatch):
    listed, df, sold = listing(spark)
    for sent in (1 << 19, 0):
        monkeypatch.setattr(stores, "SENT_STORES", sent)
        for a, b in ((0.2, 0.5), (0.0, 0.01), (0.7, 1.5)):
            got = stores.store_product_abc(df, sold, F.lit(30), a, b).collect()
            assert len(got) == len(listed)
            assert {(r["account_id"], r["store_id"], r["product_id"]): (r["demand_abc"], r["margin_abc"]) for r in got} == expected(listed, sold, a, b)


def test_rows_that_are_there_twice_have_places_of_their_own(spark):
    df = spark.createDataFrame([(0, 1, 7, 1)] * 10, LISTED)
    got = stores.store_product_abc(df, spark.createDataFrame([], SOLD), F.lit(30)).collect()
    assert sorted(r["margin_abc"] for r in got) == ["A"] * 2 + ["B"] * 3 + ["C"] * 5 and {r["demand_abc"] for r in got} == {None}


def test_the_listing_is_written_once(spark, monkeypatch):
    """Each of the two orders wrote, and shuffled twice, all columns of the listing."""
    _, df, sold = listing(spark)
    made = []
    for module in (stores, kit):
        def kept(some, cut=module.lineage_cut):
            made.append((some.columns, cut(some)))
            return made[-1][1]

        monkeypatch.setattr(module, "lineage_cut", kept)
    stores.store_product_abc(df, sold, F.lit(30)).collect()
    assert sum("stock" in columns for columns, _ in made) == 1
    assert [len(columns) for columns, _ in made if "_at" in columns] == [6, 6]
    left = [columns for columns, t in made if Path(t.inputFiles()[0].removeprefix("file://").removeprefix("file:")).exists()]
    assert not any("_at" in columns or "stock" not in columns and "product_id" in columns for columns in left)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_products_and_stores_that_are_there_twice(spark, tmp_path, monkeypatch):
    """The sums of lines meet products and stores once, and count as lines that met each of them."""
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    lines = [(o, o % 4 if o % 7 else None, o % 3 if o % 5 else None, None if o % 6 == 1 else float(o % 4 + 1), 10.0 + o, 0.1, "RNA"[o % 3], "OF"[o % 2]) for o in range(60)]
    table("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string")
    spark.read.parquet(f"{tmp_path}/lineitem.parquet").withColumn("l_shipdate", F.lit("2001-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/more/lineitem.parquet")
    table("more/orders", [(1, 1, "O", 1.0, "a")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    spark.read.parquet(f"{tmp_path}/more/orders.parquet").withColumn("o_orderdate", F.lit("2001-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/last/orders.parquet")
    table("last/supplier", [(0, "s", 1, 1.0), (1, "s", 1, 1.0), (1, "s", 1, 2.0), (2, "s", 1, 1.0), (2, "s", None, 1.0), (None, "s", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    table("last/part", [(0, "n", "b", "t", 1, 1.5), (1, "n", "b", "t", 1, 2.5), (1, "n", "b", "t", 1, 3.5), (2, "n", "b", "t", 1, None), (2, "n", "b", "t", 1, 4.0), (None, "n", "b", "t", 1, 1.0)],
          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    spark.read.parquet(f"{tmp_path}/more/lineitem.parquet").write.parquet(f"{tmp_path}/last/lineitem.parquet")
    found = {}
    monkeypatch.setattr(plans.op, "store_product_abc", lambda listed, sold, days: found.update(listed=listed, sold=sold) or listed)
    from gondola.plans.registry import QUERIES, Tables

    QUERIES["d73_store_product_abc"](spark, f"{tmp_path}/last")
    t = Tables(spark, f"{tmp_path}/last")
    listed = inputs.lines(t).join(inputs.stores(t), "store_id").groupBy("account_id", "store_id", "product_id").agg(
        F.sum(F.when(F.col("channel") == "O", F.col("qty")).otherwise(0)).alias("stock"))
    sold = inputs.lines(t).filter("sale_kind <> 'R'").join(inputs.products(t), "product_id").groupBy("store_id", "product_id").agg(
        F.sum("qty").alias("qty"), F.sum("net").alias("revenue"), F.sum(inputs.cost()).alias("cost"))
    for got, want in ((found["listed"], listed), (found["sold"], sold)):
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 5
