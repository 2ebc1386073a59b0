"""Settlements and incentives over the driver's tables. Invoice = order, account = nation of the store;
clerks of the bonus and prize queries are customers and event users."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import contracts
from gondola.operators import incentives as op
from gondola.plans import inputs as src
from gondola.plans.inputs import FEED, PRODUCTS, SALES, STORES, as_doubles, d, r
from gondola.plans.registry import query

# Combo rules of the stand-in: brand, units needed within the window, discount.
COMBOS = [
    ("P", 1, "Brand#1", 60, "0.05"), ("P", 1, "Brand#2", 60, "0.04"),
    ("M", 2, "Brand#1", 90, "0.06"), ("M", 2, "Brand#2", 90, "0.05"), ("M", 2, "Brand#3", 60, "0.05"),
    ("G", 3, "Brand#1", 120, "0.08"), ("G", 3, "Brand#2", 120, "0.07"), ("G", 3, "Brand#3", 120, "0.07"), ("G", 3, "Brand#4", 60, "0.06"),
]
FIRST, LAST = "1996-01-01", "2000-12-31"
_COMBOS_SQL = "rules(combo, priority, brand, units, discount) AS (VALUES " + ", ".join(
    f"('{c}', {p}, '{b}', {u}, CAST({x} AS DECIMAL(5,4)))" for c, p, b, u, x in COMBOS) + ")"


def _rules(t):
    return t.spark.createDataFrame(COMBOS, "combo string, priority int, brand string, units int, discount string").withColumn(
        "discount", F.col("discount").cast("decimal(5,4)"))


def _invoices(t):
    s = src.sales(t).join(src.stores(t).select("store_id", "account_id"), "store_id")
    return s.join(src.products(t).select("product_id", "brand"), "product_id").select(
        "account_id", F.col("sale_id").alias("invoice"), F.col("sold_on").alias("day"), "product_id", "brand", "qty", "net", "status")


_INVOICES = f"""{SALES}, {PRODUCTS}, {STORES}, invoices AS (
  SELECT account_id, sale_id AS invoice, sold_on AS day, s.product_id, brand, qty, net, status
  FROM sales s JOIN stores t ON s.store_id = t.store_id JOIN products p ON s.product_id = p.product_id)"""

_COMBO_SQL = f"""{_INVOICES}, {_COMBOS_SQL},
settled AS (SELECT DISTINCT account_id, invoice FROM invoices WHERE status = 'P' AND invoice % 3 = 0),
open AS (SELECT * FROM invoices ANTI JOIN settled USING (account_id, invoice)),
daily AS (SELECT account_id, brand, day, sum(qty) AS q, sum(net) AS n FROM open GROUP BY 1, 2, 3),
days AS (SELECT DISTINCT account_id, day FROM daily WHERE day BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
tot AS (SELECT s.account_id, s.day, x.brand, sum(q) AS q7, sum(n) AS n7, sum(CASE WHEN x.day = s.day THEN q ELSE 0 END) AS q1,
               sum(CASE WHEN x.day = s.day THEN n ELSE 0 END) AS n1
        FROM days s JOIN daily x ON x.account_id = s.account_id AND x.day BETWEEN s.day - 7 AND s.day GROUP BY 1, 2, 3),
met AS (SELECT account_id, day, combo, priority, count(*) FILTER (q7 >= units) AS m7, count(*) FILTER (q1 >= units) AS m1,
               round(sum(n7 * discount), 2) AS cash_7d, round(sum(n1 * discount), 2) AS cash_day
        FROM tot JOIN rules USING (brand) GROUP BY 1, 2, 3, 4),
need AS (SELECT combo, count(*) AS k FROM rules GROUP BY 1),
best AS (SELECT account_id, day, combo, cash_7d, cash_day, m1 = k AS day_alone FROM (
           SELECT met.*, k, row_number() OVER (PARTITION BY account_id, day ORDER BY priority DESC, combo) AS z
           FROM met JOIN need USING (combo) WHERE m7 = k) WHERE z = 1)"""


def _combo_days(t):
    lines = _invoices(t)
    done = lines.filter("status = 'P' AND invoice % 3 = 0")
    return op.combo_days(op.unsettled(lines, done), _rules(t), FIRST, LAST)


@query("d62_combo_days", f"""
WITH {_COMBO_SQL} SELECT account_id, day, combo, {d('cash_7d')} AS cash_7d, {d('cash_day')} AS cash_day, day_alone FROM best""")
def combo_days(t):
    return as_doubles(_combo_days(t), "cash_7d", "cash_day")


@query("d62_combo_cashback", f"""
WITH RECURSIVE {_COMBO_SQL},
seq AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY day) AS i FROM best),
walk AS (
  SELECT account_id, i, day AS last, true AS paid, day, combo, cash_7d AS cash FROM seq WHERE i = 1
  UNION ALL
  SELECT s.account_id, s.i, CASE WHEN s.day - w.last >= 7 OR s.day_alone THEN s.day ELSE w.last END,
         s.day - w.last >= 7 OR s.day_alone, s.day, s.combo, CASE WHEN s.day - w.last >= 7 THEN s.cash_7d ELSE s.cash_day END
  FROM walk w JOIN seq s ON s.account_id = w.account_id AND s.i = w.i + 1)
SELECT account_id, day, combo, {d('cash')} AS cashback FROM walk WHERE paid""")
def combo_cashback(t):
    return as_doubles(op.combo_cashback(_combo_days(t)), "cashback")


@query("d63_pix_cashback", f"""
WITH {_INVOICES},
open AS (SELECT * FROM invoices WHERE NOT (status = 'P' AND invoice % 3 = 0)),
b AS (SELECT account_id, product_id, day, CAST(sum(qty) AS BIGINT) AS units, round(sum(net), 2) AS value, count(DISTINCT invoice) AS invoices
      FROM open WHERE day BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY 1, 2, 3)
SELECT account_id, product_id, day, units, {d('value')} AS value, invoices, {d('round(value * CAST(p_size AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(3,2)), 2)')} AS cashback
FROM b JOIN part ON p_partkey = product_id WHERE p_type = 'PROMO'""")
def pix_cashback(t):
    lines = _invoices(t)
    discounts = t.part.filter("p_type = 'PROMO'").select(
        F.col("p_partkey").alias("product_id"), F.col("p_size").cast("decimal(5,2)").alias("discount"))
    out = op.pix_cashback(op.unsettled(lines, lines.filter("status = 'P' AND invoice % 3 = 0"), t.line_rows), discounts, FIRST, LAST)
    return as_doubles(out, "value", "cashback").drop("discount")


_DROPS = f"""{SALES}, {STORES}, x AS (
  SELECT account_id, s.store_id, s.product_id, sale_id, sold_on, qty, net FROM sales s JOIN stores USING (store_id)),
p AS (SELECT account_id, store_id, product_id, sold_on, {r('CAST(sum(net) AS DOUBLE) / sum(qty)', 2)} AS price FROM x GROUP BY 1, 2, 3, 4)"""


@query("w04_price_drops", f"""
WITH {_DROPS}, g AS (SELECT *, lag(price) OVER (PARTITION BY account_id, store_id, product_id ORDER BY sold_on) AS prev FROM p)
SELECT account_id, store_id, product_id, min(sold_on) AS first_drop FROM g WHERE price < prev GROUP BY 1, 2, 3""")
def price_drops(t):
    keys = ["account_id", "store_id", "product_id"]
    s = src.sales(t).join(src.stores(t).select("store_id", "account_id"), "store_id")
    return op.price_drops(op.day_prices(s, keys), keys)


# Stock prices of the stand-in: what a store paid per unit on the day of its lines, for products with an even key.
@query("d64_reimbursement", f"""
WITH {_DROPS.replace('qty, net FROM sales', 'qty, net, sale_kind FROM sales').replace('FROM x GROUP', "FROM x WHERE sale_kind <> 'R' GROUP")},
c AS (SELECT * FROM x WHERE sold_on BETWEEN DATE '1998-06-01' AND DATE '2000-12-31'),
i AS (SELECT * FROM p WHERE sold_on BETWEEN DATE '1998-06-01' AND DATE '2000-12-31'),
b AS (SELECT account_id, store_id, product_id, arg_max(price, sold_on) AS p1, max(sold_on) AS d1 FROM p WHERE sold_on < DATE '1998-06-01' GROUP BY 1, 2, 3),
a AS (SELECT account_id, store_id, product_id, arg_min(price, sold_on) AS p2, min(sold_on) AS d2 FROM i GROUP BY 1, 2, 3),
st AS (SELECT l_suppkey AS store_id, l_partkey AS product_id, min(CAST(l_shipdate AS DATE)) AS d3, any_value(p_retailprice) AS p3
       FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey % 2 = 0 GROUP BY 1, 2),
dr AS (SELECT account_id, store_id, product_id, min(sold_on) AS first_drop FROM
       (SELECT *, lag(price) OVER (PARTITION BY account_id, store_id, product_id ORDER BY sold_on) AS prev FROM i) WHERE price < prev GROUP BY 1, 2, 3),
z AS (SELECT c.*, first_drop, coalesce(p1, p2, p3) AS original, CASE WHEN p1 IS NOT NULL THEN 'sale_before' WHEN p2 IS NOT NULL THEN 'sale_inside' WHEN p3 IS NOT NULL THEN 'stock' END AS source,
             coalesce(d1, d2, d3) AS source_day, {r('CAST(net AS DOUBLE) / qty', 2)} AS unit
      FROM c LEFT JOIN a USING (account_id, store_id, product_id) LEFT JOIN b USING (account_id, store_id, product_id)
      LEFT JOIN st USING (store_id, product_id) LEFT JOIN dr USING (account_id, store_id, product_id)),
y AS (SELECT *, {r('(original - unit) / original * 100', 2)} AS pct FROM z),
w AS (SELECT *, CASE WHEN pct IS NOT NULL THEN least(pct, 20.0) END AS capped, {r('original * (least(pct, 20.0) / 100)', 2)} AS unit_refund0 FROM y),
v AS (SELECT *, CASE WHEN pct IS NOT NULL THEN unit_refund0 END AS unit_refund FROM w)
SELECT account_id, store_id, product_id, sale_id, qty, unit, original, source, source_day, first_drop, pct, CAST(capped AS DOUBLE) AS capped, unit_refund,
       CASE WHEN unit_refund IS NOT NULL THEN greatest({r('unit_refund * qty', 2)}, CAST(0 AS DOUBLE)) END AS refund FROM v""")
def reimbursement(t):
    s = src.sales(t).join(src.stores(t).select("store_id", "account_id"), "store_id")
    prices = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price"))
    stock = src.lines(t).filter("product_id % 2 = 0").select("store_id", "product_id", F.col("shipped_on").alias("taken_on")).join(prices, "product_id")
    return op.reimbursement(s, stock, "1998-06-01", "2000-12-31", tells_price=F.col("sale_kind") != "R").select(
        "account_id", "store_id", "product_id", "sale_id", "qty", "unit", "original", "source", "source_day", "first_drop",
        "pct", "capped", "unit_refund", "refund")


_BONUS = [("onboarding", 2, 100.0), ("onboarding", 4, 180.0), ("active", 1, 150.0), ("active", 3, 400.0)]


@query("d65_manager_bonus", f"""
WITH rules(status, required, premium) AS (VALUES {', '.join(f"('{s}', {c}, CAST({p} AS DOUBLE))" for s, c, p in _BONUS)}),
n AS (SELECT count(*) AS n FROM supplier),
l AS (SELECT o_custkey AS clerk_id, o_custkey % n AS store_id, 1 + o_orderkey % 5 AS level,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders, n),
s AS (SELECT s_suppkey AS store_id, CASE WHEN s_acctbal > 5000 THEN 'active' ELSE 'onboarding' END AS status FROM supplier),
g AS (SELECT store_id, status, level, count(*) AS c FROM l JOIN s USING (store_id) WHERE k = 1 AND
      ((status = 'onboarding' AND level >= 3) OR (status = 'active' AND level = 5)) GROUP BY ALL),
c AS (SELECT store_id, status, CAST(sum(c) AS BIGINT) AS clerks, string_agg(level || '=' || c, '|' ORDER BY level || '=' || c) AS by_level FROM g GROUP BY 1, 2),
b AS (SELECT store_id, c.status, clerks, by_level, max(premium) AS premium FROM c JOIN rules r ON r.status = c.status AND clerks >= required GROUP BY ALL),
h AS (SELECT c_custkey % n AS store_id, c_custkey AS manager_id FROM customer, n WHERE c_custkey % 10 = 3),
m AS (SELECT store_id, count(*) AS managers FROM h GROUP BY 1)
SELECT store_id, manager_id, status, clerks, by_level, premium, managers, coalesce({r('premium / managers', 2)}, premium) AS bonus
FROM b LEFT JOIN m USING (store_id) LEFT JOIN h USING (store_id)""")
def manager_bonus(t):
    n = t.supplier.agg(F.count(F.lit(1))).scalar()
    levels = t.orders.select(
        F.col("o_custkey").alias("clerk_id"), (F.col("o_custkey") % n).alias("store_id"), (1 + F.col("o_orderkey") % 5).alias("level"),
        F.col("o_orderdate").alias("updated_at"), F.col("o_orderkey").alias("seq"))
    stores = t.supplier.select(F.col("s_suppkey").alias("store_id"),
                               F.when(F.col("s_acctbal") > 5000, "active").otherwise("onboarding").alias("status"))
    rules = t.spark.createDataFrame(_BONUS, "status string, clerks int, premium double")
    managers = t.customer.filter("c_custkey % 10 = 3").select(
        (F.col("c_custkey") % n).alias("store_id"), F.col("c_custkey").alias("manager_id"))
    return op.manager_bonus(levels, stores, rules, managers).select(
        "store_id", "manager_id", "status", "clerks", "by_level", "premium", "managers", "bonus")


_LEDGER = f"""{FEED}, ledger AS (SELECT user_id AS clerk_id, event_type AS mission, CAST(date_trunc('week', day) AS DATE) AS started_on,
  CAST(round(value) AS BIGINT) AS coins FROM feed)"""


def _ledger(t):
    week = F.date_trunc("week", F.col("day")).cast("date")
    return src.feed(t).select(F.col("user_id").alias("clerk_id"), F.col("event_type").alias("mission"),
                              week.alias("round_id"), F.round("value").cast("long").alias("coins"))


@query("d66_clerk_prizes", f"""
WITH {_LEDGER}, w AS (SELECT started_on, CASE WHEN mission IN ('signup', 'error') THEN 'internal' ELSE 'sponsored' END AS kind, mission, clerk_id, sum(coins) AS coins
     FROM ledger GROUP BY ALL HAVING started_on >= DATE '2024-01-15' AND sum(coins) > 0)
SELECT started_on, kind, clerk_id, CAST(floor(sum(coins) / 100) AS BIGINT) AS prize, count(*) AS missions, CAST(weekofyear(started_on) AS INTEGER) AS week
FROM w GROUP BY ALL""")
def clerk_prizes(t):
    ledger = _ledger(t)
    rounds = ledger.select("round_id", F.col("round_id").alias("started_on")).distinct()
    missions = ledger.select("mission").distinct().withColumn(
        "kind", F.when(F.col("mission").isin("signup", "error"), "internal").otherwise("sponsored"))
    return op.clerk_prizes(ledger, rounds, missions, "2024-01-15")


_PROGRESS = f"""{FEED}, pr AS (
  SELECT user_id AS clerk_id, event_type AS mission, CAST(max(k) % 6 AS INTEGER) AS level, CAST(sum(k) AS BIGINT) AS points,
         CAST(min(k) AS BIGINT) AS m1, CAST(max(k) AS BIGINT) AS m2, CASE WHEN min(k) > 2 THEN count(*) END AS m3, CAST(10 AS BIGINT) AS m4, CAST(min(k) * 2 AS BIGINT) AS m5
  FROM feed GROUP BY 1, 2)"""
_M = [f"m{i}" for i in range(1, 6)]
_UNLOCKED = " + ".join(f"CASE WHEN level >= {i} THEN coalesce(m{i}, 0) ELSE 0 END" for i in range(1, 6))


def _progress(t):
    n = F.count(F.lit(1))
    low, high = F.min("k").cast("long"), F.max("k").cast("long")
    return src.feed(t).groupBy(F.col("user_id").alias("clerk_id"), F.col("event_type").alias("mission")).agg(
        (F.max("k") % 6).cast("int").alias("level"), F.sum("k").alias("points"), low.alias("m1"), high.alias("m2"),
        F.when(low > 2, n).alias("m3"), F.lit(10).cast("long").alias("m4"), (low * 2).alias("m5"))


@query("d67_clerk_coins", f"""
WITH {_PROGRESS} SELECT clerk_id, CAST(sum({_UNLOCKED}) AS BIGINT) AS unlocked,
  CAST(sum({' + '.join(f'coalesce({m}, 0)' for m in _M)}) AS BIGINT) AS potential FROM pr GROUP BY 1""")
def clerk_coins(t):
    return op.clerk_coins(_progress(t), _M)


@query("d68_leaderboard", f"""
WITH {_PROGRESS}, pl AS (SELECT clerk_id % 4 AS account_id, mission, clerk_id AS player_id, 'Clerk ' || (clerk_id % 37) AS name, level, points, {_UNLOCKED} AS coins FROM pr),
b AS (SELECT * FROM pl WHERE level = 5), c AS (SELECT account_id, mission, count(*) AS n FROM b GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY account_id, mission ORDER BY points DESC, name, player_id) AS k FROM pl WHERE level <> 5 AND coins > 0),
u AS (SELECT * FROM b UNION ALL SELECT o.* EXCLUDE (k) FROM o LEFT JOIN c USING (account_id, mission) WHERE k <= 10 - coalesce(n, 0)),
x AS (SELECT *, row_number() OVER (PARTITION BY account_id, mission ORDER BY points DESC, name, player_id) AS place FROM u)
SELECT account_id, mission, place, player_id, points, '{{"place":' || place || ',"name":"' || name || '","level":' || level || ',"prize":"'
  || CASE WHEN coins = 0 THEN '-' ELSE 'R$ ' || CAST(floor(coins / 100) AS BIGINT) END || '"}}' AS line FROM x""")
def leaderboard(t):
    players = _progress(t).select(
        (F.col("clerk_id") % 4).alias("account_id"), "mission", F.col("clerk_id").alias("player_id"),
        F.concat(F.lit("Clerk "), (F.col("clerk_id") % 37).cast("string")).alias("name"), "level", "points",
        op.coins_up_to(F.col("level"), [F.col(m) for m in _M]).alias("coins"))
    return op.leaderboard(players).select("account_id", "mission", "place", "player_id", "points", "line")


@query("d69_campaign_margin", f"""
WITH {SALES}, {PRODUCTS}, {STORES}, w AS (
  SELECT CAST(date_trunc('week', sold_on) AS DATE) AS week, brand AS campaign, s.product_id, CAST(sum(qty) AS BIGINT) AS qty, {d('sum(net)')} AS value, CAST(sum(qty * 10) AS BIGINT) AS coins
  FROM sales s JOIN products p ON s.product_id = p.product_id JOIN stores t ON s.store_id = t.store_id
  WHERE category = 'PROMO' AND brand = 'Brand#' || (account_id + 1) GROUP BY 1, 2, 3),
x AS (SELECT *, CASE WHEN value > 0 AND value / 6.5::DOUBLE <= 0.2::DOUBLE * value THEN value / 6.5::DOUBLE ELSE 0 END AS spend FROM w WHERE week + 6 < DATE '2001-08-02')
SELECT week, campaign, product_id, qty, value, coins, {r('spend', 4)} AS spend, {r('spend - coins', 2)} AS margin,
       CASE WHEN spend > 0 THEN {r('value / spend', 2)} ELSE 0 END AS roas
FROM x WHERE NOT (week < DATE '1996-01-01' AND product_id % 2 = 0)""")
def campaign_margin(t):
    products = src.products(t).filter("category = 'PROMO'").select("product_id", F.col("brand").alias("campaign"))
    stores = src.stores(t).select("store_id", F.concat(F.lit("Brand#"), (F.col("account_id") + 1).cast("string")).alias("campaign"))
    lines = src.sales(t).withColumn("coins", F.col("qty") * 10)
    new = op.campaign_margin(lines, products, stores, src.AS_OF, 6.5)
    kept = new.filter("week < DATE '1996-01-01' AND product_id % 2 = 0").select("week", "product_id", "campaign")
    out = contracts.only_new(new, kept, ["week", "product_id", "campaign"])
    return out.withColumn("spend", F.round("spend", 4))
