"""Stores, sales, stock and prices over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import stores as op
from gondola.plans import inputs as src
from gondola.plans.inputs import COST_SQL, HEADERS, LINES, PRODUCTS, SALES, STORES, as_doubles, d, r
from gondola.plans.registry import query


# Clerks of the stand-in: event users; a sale was made by the user its key points to, one in seven by nobody known.
_CLERK = "CASE WHEN {k} % 7 > 0 THEN {k} % 150 END"


@query("d70_sales_facts", f"""
WITH {SALES}, {PRODUCTS}, {STORES}, clerks AS (SELECT user_id AS clerk_id, min(CAST(ts AS DATE)) AS clerk_since FROM events GROUP BY 1)
SELECT s.sale_id, s.product_id, s.store_id, s.customer_id, account_id, brand, c_mktsegment AS segment, qty,
       {d('net')} AS net, {r('CAST(net AS DOUBLE) / qty', 4)} AS unit_price, status, {_CLERK.format(k='sale_id')} AS clerk_id, clerk_since
FROM sales s JOIN products p ON s.product_id = p.product_id JOIN stores t ON s.store_id = t.store_id
JOIN customer ON c_custkey = customer_id LEFT JOIN clerks ON clerk_id = {_CLERK.format(k='sale_id')}""")
def sales_facts(t):
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    clerks = t.events.groupBy(F.col("user_id").alias("clerk_id")).agg(F.min(F.to_date("ts")).alias("clerk_since"))
    headers = src.headers(t).withColumn("clerk_id", F.expr(_CLERK.format(k="sale_id")))
    out = op.sales_facts(src.lines(t), headers, src.products(t), src.stores(t), customers, clerks, rows=t.line_rows)
    return as_doubles(out, "net").select(
        "sale_id", "product_id", "store_id", "customer_id", "account_id", "brand", "segment", "qty", "net",
        "unit_price", "status", "clerk_id", "clerk_since")


@query("d70_basket_facts", f"""
WITH {SALES}
SELECT sale_id, customer_id, status, count(*) AS lines, CAST(sum(qty) AS BIGINT) AS units, {d('sum(net)')} AS value,
       count(DISTINCT product_id) AS products, count(DISTINCT store_id) AS stores
FROM sales GROUP BY ALL""")
def basket_facts(t):
    out = op.basket_facts(src.lines(t), src.headers(t).select("sale_id", "customer_id", "status"))
    return as_doubles(out, "value")


@query("d71_abc_by_revenue", f"""
WITH {LINES}, sold AS (SELECT product_id, CAST(sum(qty) AS BIGINT) AS qty, sum(net) AS revenue FROM lines GROUP BY 1),
x AS (SELECT *, row_number() OVER w AS place, {d('sum(revenue) OVER w')} / {d('sum(revenue) OVER ()')} AS s FROM sold
      WINDOW w AS (ORDER BY revenue DESC, product_id ROWS UNBOUNDED PRECEDING))
SELECT product_id, qty, {d('revenue')} AS revenue, place, {r('s', 4)} AS cumulative_share,
       CASE WHEN s <= 0.80 THEN 'A' WHEN s <= 0.95 THEN 'B' ELSE 'C' END AS abc
FROM x""")
def abc_by_revenue(t):
    return as_doubles(op.abc_by_revenue(src.lines(t)), "revenue")


_LISTING = """listing AS (
  SELECT account_id, l.store_id, product_id, CAST(sum(CASE WHEN channel = 'O' THEN qty ELSE 0 END) AS BIGINT) AS stock
  FROM lines l JOIN stores s ON l.store_id = s.store_id GROUP BY 1, 2, 3)"""


def _listing(t):
    # lines are summed by store and product, as what they meet next; a store that is there n times counts n times
    stock = src.lines(t).groupBy("store_id", "product_id").agg(F.sum(F.when(F.col("channel") == "O", F.col("qty")).otherwise(0)).alias("stock"))
    stores = src.stores(t).groupBy("store_id", "account_id").agg(F.count(F.lit(1)).alias("_times"))
    return stock.join(stores, "store_id").select("account_id", "store_id", "product_id", (F.col("stock") * F.col("_times")).alias("stock"))


@query("d73_store_product_abc", f"""
WITH {SALES}, {PRODUCTS}, {STORES}, {_LISTING},
sold AS (SELECT s.store_id, s.product_id, CAST(sum(qty) AS BIGINT) AS qty, sum(net) AS revenue, sum({COST_SQL}) AS cost
         FROM sales s JOIN products p ON s.product_id = p.product_id WHERE sale_kind <> 'R' GROUP BY 1, 2),
span AS (SELECT date_diff('day', min(sold_on), max(sold_on)) + 1 AS days FROM headers),
b AS (SELECT l.*, qty, {r("CAST(revenue - cost AS DOUBLE) / CASE WHEN qty > 0 THEN qty ELSE 1 END", 6)} AS margin,
             qty / days AS daily
      FROM listing l LEFT JOIN sold USING (store_id, product_id) CROSS JOIN span),
x AS (SELECT *, row_number() OVER (PARTITION BY account_id, store_id ORDER BY qty DESC NULLS LAST, product_id) AS dp,
             row_number() OVER (PARTITION BY account_id, store_id ORDER BY margin DESC NULLS LAST, product_id) AS mp,
             count(*) OVER (PARTITION BY account_id, store_id) AS n FROM b)
SELECT account_id, store_id, product_id, qty, {r('margin', 4)} AS margin, {r('daily', 6)} AS daily_demand,
       {r('CASE WHEN daily > 0 THEN stock / daily END', 4)} AS days_of_stock,
       CASE WHEN qty IS NULL OR qty = 0 THEN NULL WHEN dp <= ceil(n * 0.2) THEN 'A' WHEN dp <= ceil(n * 0.5) THEN 'B'
            ELSE 'C' END AS demand_abc,
       CASE WHEN mp <= ceil(n * 0.2) THEN 'A' WHEN mp <= ceil(n * 0.5) THEN 'B' ELSE 'C' END AS margin_abc
FROM x""")
def store_product_abc(t):
    # lines are summed before they meet the products; a product that is there n times counts n times, each with its price
    units = src.lines(t).filter("sale_kind <> 'R'").groupBy("store_id", "product_id").agg(F.sum("qty").alias("qty"), F.sum("net").alias("revenue"))
    prices = src.products(t).groupBy("product_id").agg(F.count(F.lit(1)).alias("_times"), F.sum("list_price").alias("_price"))
    sold = units.join(prices, "product_id").select(
        "store_id", "product_id", (F.col("qty") * F.col("_times")).alias("qty"), (F.col("revenue") * F.col("_times")).cast("decimal(26,4)").alias("revenue"),
        (F.col("qty") * F.col("_price")).cast("decimal(26,4)").alias("cost"))
    days = src.headers(t).agg(F.datediff(F.max("sold_on"), F.min("sold_on")) + 1).scalar()
    return op.store_product_abc(_listing(t), sold, days)


_STOCK = """stock AS (
  SELECT store_id, product_id, qty AS stock FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY shipped_on DESC, sale_id DESC, qty DESC) AS k
    FROM lines) WHERE k = 1)"""


def _stock(t):
    return op.latest_stock(
        src.lines(t), [F.desc("shipped_on"), F.desc("sale_id"), F.desc("qty")]
    ).select("store_id", "product_id", F.col("qty").alias("stock"))


def _coverage_sql(stock: str, daily: str) -> str:
    return f"CASE WHEN {daily} > 0 THEN {stock} / ({daily}) WHEN {stock} > 0 THEN NULL ELSE 0.0 END"


def _class_sql(days: str) -> str:
    return f"CASE WHEN {days} IS NULL THEN 'No sales' WHEN {days} > 5 THEN 'High' ELSE 'Low' END"


@query("d74_stock_coverage", f"""
WITH {SALES}, {PRODUCTS}, {_STOCK},
sold AS (SELECT store_id, product_id, sum(qty) AS sold FROM sales
         WHERE sold_on >= DATE '2001-02-01' GROUP BY 1, 2),
p AS (SELECT k.store_id, k.product_id, brand, stock, coalesce(sold, 0) AS sold, coalesce(sold, 0) / 180.0::DOUBLE AS daily
      FROM stock k JOIN products USING (product_id) LEFT JOIN sold USING (store_id, product_id)),
b AS (SELECT store_id, brand, CAST(sum(stock) AS BIGINT) AS brand_stock, sum(sold) / 180.0::DOUBLE AS brand_daily FROM p GROUP BY 1, 2),
x AS (SELECT p.*, brand_stock, {_coverage_sql('stock', 'daily')} AS days,
             {_coverage_sql('brand_stock', 'brand_daily')} AS bdays FROM p JOIN b USING (store_id, brand))
SELECT store_id, product_id, brand, stock, {r('daily', 6)} AS daily, {r('days', 4)} AS days, {_class_sql('days')} AS class,
       brand_stock, {r('bdays', 4)} AS brand_days, {_class_sql('bdays')} AS brand_class
FROM x""")
def stock_coverage(t):
    sold = src.sales(t).filter(F.col("sold_on") >= F.lit("2001-02-01").cast("date"))
    return op.stock_coverage(_stock(t), sold, src.products(t), 180)


TEST_ACCOUNTS = ["%_7", "nation_1_", "%_2%"]


@query("d75_store_ranking", f"""
WITH {LINES}, {STORES},
x AS (SELECT l.store_id, n_name AS account_name, CAST(sum(qty) AS BIGINT) AS qty, sum(net) AS revenue
      FROM lines l JOIN stores s ON l.store_id = s.store_id JOIN nation ON n_nationkey = account_id
      WHERE NOT (lower(n_name) LIKE '%#_7' ESCAPE '#' OR lower(n_name) = 'nation_1_' OR lower(n_name) LIKE '%#_2%' ESCAPE '#')
      GROUP BY 1, 2)
SELECT store_id, account_name, qty, {d('revenue')} AS revenue, rank() OVER (ORDER BY revenue DESC) AS place FROM x""")
def store_ranking(t):
    named = src.stores(t).join(src.accounts(t), "account_id").select("store_id", "account_name")
    return as_doubles(op.store_ranking(src.lines(t), named, "account_name", TEST_ACCOUNTS), "revenue")


@query("d76_adherence_score", f"""
WITH {LINES}, {PRODUCTS}, {STORES}, {_LISTING},
c AS (SELECT l.*, {COST_SQL} AS cost FROM lines l JOIN products USING (product_id)),
scope AS (SELECT store_id FROM (SELECT store_id, rank() OVER (ORDER BY sum(net) DESC) AS k FROM lines GROUP BY 1) WHERE k <= 60),
n AS (SELECT count(*) AS n FROM scope),
sold AS (SELECT *, CASE WHEN net > 0 THEN CAST(net - cost AS DOUBLE) / CAST(net AS DOUBLE) ELSE 0.0 END AS m
         FROM c WHERE store_id IN (FROM scope)),
store AS (SELECT store_id, avg(m) AS sm, {r('CAST(sum(net) AS DOUBLE) / count(DISTINCT sale_id)', 2)} AS ticket FROM sold GROUP BY 1),
pair AS (SELECT product_id, store_id, sum(qty) AS q, avg(m) AS m,
                CASE WHEN sum(qty) > 0 THEN {r('CAST(sum(net) AS DOUBLE) / sum(qty)', 2)} ELSE 0.0 END AS price FROM sold GROUP BY 1, 2),
dens AS (SELECT product_id, {r('sum(q) / count(*)', 6)} AS density, count(*) AS selling FROM pair GROUP BY 1),
p90 AS (SELECT quantile_cont(density, 0.9) AS p90 FROM dens),
pres AS (SELECT product_id, count(*) FILTER (stock > 0) AS k FROM listing WHERE store_id IN (FROM scope) GROUP BY 1),
prod AS (SELECT product_id, k / n AS s_stock, selling / n AS f, least(1.0, density / p90) AS dd
         FROM dens JOIN pres USING (product_id), n, p90),
s AS (SELECT product_id, s_stock, dd * f AS s_volume,
        f * CASE WHEN price / ticket <= 0.5 THEN 1.0 WHEN price / ticket >= 2 THEN 0.0 ELSE (2 - price / ticket) / 1.5 END AS s_price,
        f * CASE WHEN sm > 0 THEN least(1.0, greatest(0.0, m / sm)) ELSE 0.0 END AS s_margin
      FROM pair JOIN store USING (store_id) JOIN prod USING (product_id)),
z AS (SELECT product_id, {r('s_stock * 0.4 + s_volume * 0.2 + s_price * 0.2 + s_margin * 0.2', 4)}::DECIMAL(9,4) AS score,
        {r('s_stock', 4)}::DECIMAL(9,4) AS s_stock, {r('s_volume', 4)}::DECIMAL(9,4) AS s_volume,
        {r('s_price', 4)}::DECIMAL(9,4) AS s_price, {r('s_margin', 4)}::DECIMAL(9,4) AS s_margin FROM s)
SELECT product_id, count(*) AS stores, {', '.join(f"{r(f'CAST(sum({c}) AS DOUBLE) / count(*)', 2)} AS {c}"
       for c in ('score', 's_stock', 's_volume', 's_price', 's_margin'))}
FROM z GROUP BY 1""")
def adherence(t):
    lines = src.lines(t).join(src.products(t), "product_id").withColumn("cost", src.cost())
    return op.adherence(lines, _listing(t), stores_in_scope=60)


@query("d77_store_tiers", f"""
WITH {SALES}, o AS (SELECT *, CAST(product_id % 24 AS INTEGER) AS hour FROM sales),
m AS (SELECT store_id, strftime(sold_on, '%Y-%m') AS month, CAST(sum(net) AS DOUBLE) AS rev, sum(net) AS net, count(DISTINCT sale_id) AS k,
             max(day(last_day(sold_on))) AS days FROM o GROUP BY 1, 2),
a AS (SELECT store_id, {r(f"avg({r('rev / days', 2)})", 2)} AS daily_revenue, {r(f"avg({r('rev / k', 2)})", 2)} AS ticket,
             {r('CAST(sum(net) AS DOUBLE) / count(*)', 2)} AS monthly_revenue FROM m GROUP BY 1),
t AS (SELECT store_id, count(DISTINCT customer_id % 50) FILTER (date_diff('day', sold_on, DATE '2001-08-02') <= 35) AS clerks,
             count(DISTINCT sale_id) AS sales, min(sold_on) AS first FROM o GROUP BY 1),
ph AS (SELECT store_id, hour AS peak_hour FROM (SELECT store_id, hour, row_number() OVER (PARTITION BY store_id ORDER BY sum(qty) DESC, hour) AS k
       FROM o GROUP BY 1, 2) WHERE k = 1),
mix AS (SELECT store_id, {r("count(*) FILTER (p_type IN ('SMALL', 'PROMO')) / count(*)", 2)} AS rx_share,
               {r("count(*) FILTER (p_type IN ('LARGE', 'ECONOMY')) / count(*)", 2)} AS otc_share
        FROM (SELECT DISTINCT store_id, product_id FROM o) JOIN part ON p_partkey = product_id GROUP BY 1),
z AS (SELECT t.store_id, clerks, sales, date_diff('month', first, DATE '2001-08-02') - CASE WHEN day(first) > 2 THEN 1 ELSE 0 END AS tenure_months,
             daily_revenue, ticket, monthly_revenue, peak_hour, rx_share, otc_share
      FROM t JOIN a USING (store_id) JOIN ph USING (store_id) LEFT JOIN mix USING (store_id)),
q AS (SELECT quantile_cont(monthly_revenue, [0.25, 0.5, 0.75]) AS qm, quantile_cont(clerks, [0.25, 0.5, 0.75]) AS qc,
             quantile_cont(sales, [0.25, 0.5, 0.75]) AS qs FROM z),
v AS (SELECT z.*, {', '.join(f"(monthly_revenue >= qm[{i}])::INT + (clerks >= qc[{i}])::INT + (sales >= qs[{i}])::INT AS v{i}" for i in (1, 2, 3))}
      FROM z, q)
SELECT * EXCLUDE (v1, v2, v3), CASE WHEN v3 >= 2 THEN 'G' WHEN v2 >= 2 THEN 'M' WHEN v1 >= 1 THEN 'P' ELSE 'PP' END AS tier FROM v""")
def store_tiers(t):
    sales = src.sales(t).withColumns({
        "clerk_id": F.col("customer_id") % 50, "hour": (F.col("product_id") % 24).cast("int")})
    kinds = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_type").isin("SMALL", "PROMO").alias("rx"),
                          F.col("p_type").isin("LARGE", "ECONOMY").alias("otc"))
    return op.store_tiers(sales, kinds, src.AS_OF, rows=t.line_rows)


_NAMES = lambda names: "[" + ", ".join(f"'{n}'" for n in names) + "]"


@query("d78_calendar", f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) + 365 AS b FROM orders),
x AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
SELECT day, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS day_of_month,
       {_NAMES(op.WEEKDAYS)}[dayofweek(day) + 1] AS weekday_name, {_NAMES(op.MONTHS)}[month(day)] AS month_name,
       CAST(dayofweek(day) + 1 AS INTEGER) AS weekday, CAST(quarter(day) AS INTEGER) AS quarter,
       CAST(weekofyear(day) AS INTEGER) AS week, 'Semana ' || weekofyear(day) AS week_name,
       dayofweek(day) IN (0, 6) AS is_weekend, dayofweek(day) NOT IN (0, 6) AS is_business_day
FROM x""")
def calendar(t):
    span = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.date_add(F.to_date(F.max("o_orderdate")), 365).alias("b"))
    return op.calendar(t.spark, F.col("a"), F.col("b"), span)


# Campaigns of the stand-in: one per brand; its own products are the PROMO ones, rivals the brand's others.
_CAMPAIGN = """own AS (SELECT brand AS campaign, product_id, name FROM products WHERE category = 'PROMO'),
rivals AS (SELECT brand AS campaign, product_id, name FROM products WHERE category = 'LARGE')"""


def _campaign(t):
    p = src.products(t).select(F.col("brand").alias("campaign"), "product_id", "name", "category")
    return p.filter("category = 'PROMO'").drop("category"), p.filter("category = 'LARGE'").drop("category")


@query("d79_campaign_dimension", f"""
WITH {PRODUCTS}, {STORES}, {_CAMPAIGN}, both_kinds AS (
  SELECT *, 'campaign' AS kind FROM own UNION SELECT *, 'rival' AS kind FROM rivals)
SELECT campaign, store_id, account_id, product_id, name, kind, store_id || '|' || product_id AS store_product
FROM both_kinds JOIN stores ON campaign = 'Brand#' || (account_id + 1)""")
def campaign_dimension(t):
    own, rivals = _campaign(t)
    stores = src.stores(t).select("store_id", "account_id").withColumn(
        "campaign", F.concat(F.lit("Brand#"), (F.col("account_id") + 1).cast("string")))
    return op.campaign_dimension(own, rivals, stores)


_STATUS = ["CASE WHEN s_acctbal < 500 THEN 'churn_voluntary' WHEN s_acctbal < 1500 THEN 'churn_forced' ",
           "WHEN s_acctbal > 9700 THEN 'active' WHEN s_acctbal > 5000 THEN 'onboarding' ELSE 'paused' END"]


@query("d80_account_status", f"""
WITH s AS (SELECT s_nationkey AS account_id, {''.join(_STATUS)} AS status FROM supplier WHERE s_nationkey % 5 <> 4),
n AS (SELECT account_id, status, count(*) AS k FROM s GROUP BY 1, 2),
common AS (SELECT account_id, arg_min(status, (-k, status)) AS common FROM n WHERE status NOT LIKE 'churn%' GROUP BY 1),
f AS (SELECT account_id, count(*) AS stores, bool_or(status = 'active') AS aa, bool_and(status LIKE 'churn%') AS ac FROM s GROUP BY 1),
x AS (SELECT n_nationkey AS account_id, CASE WHEN n_nationkey % 3 = 0 THEN 'active' ELSE 'onboarding' END AS current,
             coalesce(stores, 0) AS stores, CASE WHEN stores IS NULL THEN 'no_stores' WHEN aa THEN 'active' WHEN ac THEN 'churn'
             ELSE common END AS status
      FROM nation LEFT JOIN f ON f.account_id = n_nationkey LEFT JOIN common c ON c.account_id = n_nationkey)
SELECT *, current IS DISTINCT FROM status AS changed FROM x""")
def account_status(t):
    stores = t.supplier.filter("s_nationkey % 5 <> 4").select(
        F.col("s_nationkey").alias("account_id"), F.expr("".join(_STATUS)).alias("status"))
    accounts = t.nation.select(
        F.col("n_nationkey").alias("account_id"),
        F.when(F.col("n_nationkey") % 3 == 0, "active").otherwise("onboarding").alias("current"))
    return op.account_status(accounts, stores)


@query("d81_clerk_transitions", f"""
WITH {HEADERS}, s AS (SELECT DISTINCT customer_id FROM headers WHERE sold_on >= DATE '2001-05-04'),
x AS (SELECT c_custkey AS clerk_id, c_acctbal > 3000 AS was_active,
             s.customer_id IS NOT NULL AND NOT contains(c_name, '99') AS active
      FROM customer LEFT JOIN s ON c_custkey = customer_id)
SELECT was_active, active, count(*) AS clerks FROM x GROUP BY ALL""")
def clerk_transitions(t):
    clerks = t.customer.select(
        F.col("c_custkey").alias("clerk_id"), F.col("c_name").alias("name"), (F.col("c_acctbal") > 3000).alias("was_active"))
    sellers = src.headers(t).filter("sold_on >= DATE '2001-05-04'").select(F.col("customer_id").alias("clerk_id"))
    return op.transitions(op.clerk_activity(clerks, sellers, "99"))


@query("d82_silent_stores", f"""
WITH {SALES}, {STORES}, a AS (SELECT store_id, CAST(sum(qty) AS BIGINT) AS sold FROM sales WHERE sold_on >= DATE '2001-07-26' GROUP BY 1),
b AS (SELECT store_id, count(*) FILTER (status = 'O') AS shown FROM sales WHERE sold_on >= DATE '2001-07-20' AND sale_kind = 'N' AND channel = 'F' GROUP BY 1)
SELECT a.store_id, sold, shown, store_name, account_id FROM a LEFT JOIN b USING (store_id) JOIN stores USING (store_id)
WHERE coalesce(shown, 0) = 0""")
def silent_stores(t):
    s = src.sales(t)
    sold = s.filter("sold_on >= DATE '2001-07-26'").select("store_id", F.col("qty").alias("n"))
    shown = s.filter("sold_on >= DATE '2001-07-20' AND sale_kind = 'N' AND channel = 'F'").select(
        "store_id", (F.col("status") == "O").cast("long").alias("n"))
    return op.silent_stores(sold, shown, src.stores(t).select("store_id", "store_name", "account_id"))


@query("d83_stock_snapshot", f"""
WITH {LINES}, {PRODUCTS}, {_CAMPAIGN}, {_STOCK},
scope AS (SELECT product_id, 'campaign' AS kind FROM own UNION SELECT product_id, 'rival' FROM rivals)
SELECT store_id, product_id, stock, kind, DATE '2001-08-02' AS taken_on, '2001-08' AS month
FROM stock JOIN scope USING (product_id)""")
def stock_snapshot(t):
    own, rivals = _campaign(t)
    return op.stock_snapshot(_stock(t), own, rivals, F.lit(src.AS_OF).cast("date"))


@query("d50_availability", f"""
WITH {SALES}, {STORES}, {PRODUCTS}, {_CAMPAIGN}, {_LISTING},
scope AS (SELECT product_id FROM sales WHERE sold_on >= DATE '2001-05-02' UNION SELECT product_id FROM own
          UNION SELECT product_id FROM products WHERE product_id NOT IN (SELECT product_id FROM lines))
SELECT product_id, account_id, store_id, count(*) OVER (PARTITION BY product_id) AS stores
FROM (SELECT DISTINCT product_id, account_id, store_id FROM listing WHERE stock > 0 AND product_id IN (FROM scope))""")
def availability(t):
    own, _ = _campaign(t)
    recent = src.sales(t).filter("sold_on >= DATE '2001-05-02'").select("product_id")
    unsold = src.products(t).join(src.lines(t), "product_id", "left_anti").select("product_id")
    scope = recent.union(own.select("product_id")).union(unsold)
    return op.availability(_listing(t), scope)


@query("d84_mission_week_totals", f"""
WITH {SALES}, {PRODUCTS}
SELECT category AS mission, s.product_id, CAST(date_trunc('week', sold_on) AS DATE) AS week, CAST(sum(qty) AS BIGINT) AS units,
       {d('sum(net)')} AS value, count(DISTINCT sale_id) AS sales
FROM sales s JOIN products p ON s.product_id = p.product_id WHERE category IN ('PROMO', 'ECONOMY') GROUP BY ALL""")
def mission_week_totals(t):
    missions = src.products(t).filter(F.col("category").isin("PROMO", "ECONOMY")).select(
        F.col("category").alias("mission"), "product_id")
    return as_doubles(op.weekly_units(src.sales(t), missions), "value")
