import pytest
from pyspark.sql import functions as F

import gondola.session as session
from gondola.operators import baskets, incentives, stores
from gondola.session import sized_shuffles


def seen_by(monkeypatch, module):
    """The shuffle partitions that hold whenever `module` writes a table."""
    found, cut = [], module.lineage_cut

    def watched(df):
        found.append(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return cut(df)

    monkeypatch.setattr(module, "lineage_cut", watched)
    return found


def test_tasks_follow_the_rows_and_settings_come_back(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    df = spark.range(5000).groupBy((F.col("id") % 1000).alias("id")).count()
    with sized_shuffles(spark, 1000):
        assert spark.conf.get(keys[0]) == "100"
        tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 90 and [spark.conf.get(k) for k in keys] == before
    with pytest.raises(KeyError), sized_shuffles(spark, 1000):
        raise KeyError
    assert [spark.conf.get(k) for k in keys] == before
    for rows in (None, 0, 5):
        with sized_shuffles(spark, rows):
            assert [spark.conf.get(k) for k in keys] == before


def test_store_tiers_deal_many_sales_over_more_tasks(spark, monkeypatch):
    """with rows that come twice, null keys, a sale in two months and stores without active clerks."""
    rows = [(s % 3 if s else None, s if s % 5 else None, s % 4 if s % 3 else None, f"2001-0{1 + s % 7}-0{1 + s % 9}", s % 24, 1, float(s), s % 6) for s in range(60)]
    rows += [*rows[:20], (1, 7, 2, "2001-02-01", 1, 1, 5.0, 1), (9, 7, 2, "1999-02-01", 1, 1, 5.0, 1), (9, 8, 2, None, 1, 1, 5.0, 1)]
    sales = spark.createDataFrame(rows, "store_id long, sale_id long, clerk_id long, day string, hour int, qty long, net double, product_id long")
    sales = sales.withColumn("sold_on", F.to_date("day")).withColumn("net", F.col("net").cast("decimal(16,4)"))
    kinds = spark.createDataFrame([(i, i % 2 == 0, i % 3 == 0) for i in range(5)], "product_id long, rx boolean, otc boolean")
    few = sorted(map(tuple, stores.store_tiers(sales, kinds, "2001-08-02").collect()))
    monkeypatch.setattr(session, "TASK_ROWS", 4)
    found = seen_by(monkeypatch, stores)
    assert sorted(map(tuple, stores.store_tiers(sales, kinds, "2001-08-02", rows=len(rows)).collect())) == few
    assert found == [str(-(-len(rows) // 4))]
    by_store = {r[0]: r for r in few}
    active = {(r[0], r[2]) for r in rows if r[2] is not None and (r[3] or "0") >= "2001-06-28"}
    for store in (0, 1, 2, 9):
        own = [r for r in rows if r[0] == store]
        assert by_store[store][1:3] == (sum(a == store for a, _ in active), len({r[1] for r in own} - {None}))
        months = {m: [r for r in own if (r[3] or "")[:7] == m] for m in {(r[3] or "")[:7] for r in own}}
        assert by_store[store][6] == pytest.approx(sum(r[6] for r in own) / len(months), abs=0.006)
        tickets = [round(sum(r[6] for r in x) / len({r[1] for r in x} - {None}), 2) for x in months.values() if {r[1] for r in x} - {None}]
        assert by_store[store][5] == pytest.approx(sum(tickets) / len(tickets), abs=0.006)


def test_rules_deal_many_lines_over_more_tasks(spark, monkeypatch):
    """F15"""
    lines = spark.createDataFrame([(s, (s * k) % 11) for s in range(80) for k in (1, 2, 3)] * 2, "sale_id long, item long")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(11)], "item long, name string")
    few = sorted(map(tuple, baskets.association_rules(lines, "item", names).collect()))
    monkeypatch.setattr(session, "TASK_ROWS", 30)
    found = seen_by(monkeypatch, baskets)
    assert few and sorted(map(tuple, baskets.association_rules(lines, "item", names, rows=480).collect())) == few
    assert found == ["16", "16"]


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_facts_neither_sort_nor_hold_many_lines(spark, monkeypatch):
    """repeated and null keys on every side."""
    tables = [
        spark.createDataFrame([(s % 7 or None, s % 5 or None, s % 3, s % 4, float(s)) for s in range(40)] * 2, "sale_id long, product_id long, store_id long, qty long, net double"),
        spark.createDataFrame([*((s, s % 6 or None, s % 4 or None) for s in (1, 2, 3, 4, 4, 5)), (None, 1, 1)], "sale_id long, customer_id long, clerk_id long"),
        spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "product_id long, brand string"),
        F.broadcast(spark.createDataFrame([(0, 10), (1, 11)], "store_id long, account_id long")),
        spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "customer_id long, segment string"),
        spark.createDataFrame([(1, "2001-01-01"), (None, "2001-01-02")], "clerk_id long, clerk_since string")]
    columns = ["sale_id", "product_id", "store_id", "customer_id", "clerk_id", "qty", "net", "brand", "account_id", "segment", "clerk_since", "unit_price"]
    lines, headers, products, shops, customers, clerks = tables
    before = lines.join(headers, "sale_id").join(products, "product_id", "left").join(shops, "store_id", "left").join(
        customers, "customer_id", "left").join(clerks, "clerk_id", "left").withColumn("unit_price", F.expr("CASE WHEN qty > 0 THEN round(net / qty, 4) END"))
    expected = sorted(map(str, before.select(columns).collect()))
    few = stores.sales_facts(*tables)
    monkeypatch.setattr(session, "TASK_ROWS", 5)
    many = stores.sales_facts(*tables, rows=80)
    assert len(expected) > 80 and sorted(map(str, few.select(columns).collect())) == sorted(map(str, many.select(columns).collect())) == expected
    assert planned(many).count("ShuffledHashJoin") == 4 and "SortMergeJoin" not in planned(many)


def test_cashback_leaves_out_lines_without_a_discount_before_it_sums(spark, monkeypatch):
    """F18"""
    lines = spark.createDataFrame(
        [(a, i, "2000-01-0" + str(1 + i % 3), p, 2, float(i), "P" if i % 2 else "F") for a in (1, 2, None) for i in (1, 2, 3, 3, None) if i for p in (1, 2, 3, None)],
        "account_id long, invoice long, day string, product_id long, qty long, net double, status string"
    ).withColumn("day", F.to_date("day")).withColumn("net", F.col("net").cast("decimal(16,4)"))
    discounts = spark.createDataFrame([(1, 10), (2, 20), (2, 30)], "product_id long, discount int").withColumn("discount", F.col("discount").cast("decimal(5,2)"))
    columns = ["account_id", "product_id", "day", "units", "value", "invoices", "cashback"]

    def paid(rows):
        out = incentives.pix_cashback(incentives.unsettled(lines, lines.filter("invoice = 1"), rows), discounts, "2000-01-01", "2000-01-02")
        return out.select(columns)

    few = paid(None)
    grouped = planned(few).split("partial_sum(qty")[1]
    assert "LeftSemi" in grouped
    monkeypatch.setattr(session, "TASK_ROWS", 5)
    many = paid(60)
    assert "ShuffledHashJoin" in planned(many)
    got = sorted(map(str, few.collect()))
    assert got == sorted(map(str, many.collect()))
    by_key = {(r["account_id"], r["product_id"], str(r["day"])): [] for r in few.collect()}
    for r in few.collect():
        by_key[r["account_id"], r["product_id"], str(r["day"])].append((r["units"], float(r["value"]), r["invoices"], float(r["cashback"])))
    # invoice 3 falls on the first day, twice; invoice 1 is settled where the account is known
    assert by_key[1, 1, "2000-01-01"] == [(4, 6.0, 1, 0.6)] and sorted(by_key[2, 2, "2000-01-01"]) == [(4, 6.0, 1, 1.2), (4, 6.0, 1, 1.8)]
    assert by_key[None, 1, "2000-01-02"] == [(2, 1.0, 1, 0.1)] and (1, 3, "2000-01-01") not in by_key
