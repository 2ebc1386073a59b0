"""One small query per generic operator: projections, predicates, joins, aggregates, windows, top-k,
sampling and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from gondola.operators import kit
from gondola.operators.baskets import sample_keys
from gondola.operators.stores import like_patterns
from gondola.operators.subtotals import cube_sets, rollup_sets, subtotals
from gondola.plans import inputs as src
from gondola.plans.inputs import FEED, LINES, PRODUCTS, SALES, STORES, as_doubles, d, r
from gondola.plans.registry import query

# --- projection and predicates -------------------------------------------------------------------


@query("p01_select_rename", "SELECT p_partkey AS product_id, upper(p_name) AS name, p_size + 1 AS next_size FROM part")
def select_rename(t):
    return t.part.selectExpr("p_partkey AS product_id", "upper(p_name) AS name", "p_size + 1 AS next_size")


@query("p02_case_chain", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS band FROM part")
def case_chain(t):
    return t.part.select("p_partkey", F.when(F.col("p_size") < 10, "S").when(F.col("p_size") < 30, "M").otherwise("L").alias("band"))


@query("p03_null_safe_equality", """
SELECT a.p_partkey, CASE WHEN a.p_size > 25 THEN a.p_size END IS NOT DISTINCT FROM CASE WHEN a.p_partkey % 2 = 0 THEN a.p_size END AS same FROM part a""")
def null_safe_equality(t):
    a, b = F.when(F.col("p_size") > 25, F.col("p_size")), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size"))
    return t.part.select("p_partkey", a.eqNullSafe(b).alias("same"))


@query("p04_text_predicates", """
SELECT p_partkey FROM part WHERE p_type IN ('PROMO', 'SMALL', 'LARGE') AND p_size BETWEEN 5 AND 45 AND (p_name LIKE '%ri%' OR p_name ILIKE 'RED%' OR regexp_matches(p_name, '^(old|hot) g') OR starts_with(p_brand, 'Brand#1') OR contains(p_name, 'od'))""")
def text_predicates(t):
    n = F.col("p_name")
    return t.part.filter(F.col("p_type").isin("PROMO", "SMALL", "LARGE") & F.col("p_size").between(5, 45) & (
        n.like("%ri%") | n.ilike("RED%") | n.rlike("^(old|hot) g") | F.col("p_brand").startswith("Brand#1") | n.contains("od"))).select("p_partkey")


@query("p05_predicate_list", "SELECT p_partkey FROM part WHERE p_name LIKE '%bolt' OR p_name LIKE 'cold%' OR p_name LIKE '%e r%'")
def predicate_list(t):
    return t.part.filter(reduce(lambda a, b: a | b, [F.col("p_name").like(p) for p in ("%bolt", "cold%", "%e r%")])).select("p_partkey")


@query("p06_like_list", "SELECT p_partkey FROM part WHERE p_name LIKE '%ring' OR p_name LIKE 'blue%' OR p_name LIKE '%ge w%'")
def like_list(t):
    return t.part.filter(F.col("p_name").rlike(like_patterns(["%ring", "blue%", "%ge w%"]))).select("p_partkey")


@query("p07_any_element", "SELECT p_partkey FROM part WHERE len(list_filter(string_split(p_name, ' '), lambda x: x LIKE '%i%g%')) > 0")
def any_element(t):
    return t.part.filter(F.exists(F.split("p_name", " "), lambda x: x.like("%i%g%"))).select("p_partkey")


@query("p08_delete_rows", "SELECT * FROM part WHERE NOT (p_size > 40 AND p_type = 'PROMO')")
def delete_rows(t):
    return t.part.filter(~((F.col("p_size") > 40) & (F.col("p_type") == "PROMO")))


# --- joins ---------------------------------------------------------------------------------------

_ORDERS_AFTER = "o_orderdate >= TIMESTAMP '2001-06-01'"


def _recent(t):
    return t.orders.filter(F.to_date("o_orderdate") >= F.lit("2001-06-01").cast("date"))


@query("j01_inner", "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
def inner(t):
    return t.customer.join(t.orders.filter("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@query("j02_left", f"SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN (SELECT * FROM orders WHERE {_ORDERS_AFTER}) ON o_custkey = c_custkey GROUP BY 1")
def left(t):
    return t.customer.join(_recent(t), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("orders"))


@query("j03_right", "SELECT s_suppkey, n_name FROM (SELECT * FROM supplier WHERE s_acctbal > 8000) RIGHT JOIN nation ON s_nationkey = n_nationkey")
def right(t):
    return t.supplier.filter("s_acctbal > 8000").join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select("s_suppkey", "n_name")


@query("j04_full_outer", """
SELECT coalesce(c.n, s.n) AS nation, customers, suppliers FROM (SELECT c_nationkey AS n, count(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS n, count(*) AS suppliers FROM supplier WHERE s_acctbal < 3000 GROUP BY 1) s ON c.n = s.n""")
def full_outer(t):
    c = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    s = t.supplier.filter("s_acctbal < 3000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    return c.join(s, "nation", "full_outer")


@query("j05_left_semi", f"SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {_ORDERS_AFTER})")
def left_semi(t):
    return t.customer.join(_recent(t), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("j06_left_anti", f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE {_ORDERS_AFTER})")
def left_anti(t):
    return t.customer.join(_recent(t), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j12_or_condition", """
SELECT count(*) AS pairs FROM (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 40 END AS reg FROM customer) c JOIN
(SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 40 END AS reg FROM supplier) s ON c.reg = s.reg OR ((c.reg IS NULL OR s.reg IS NULL) AND c_nationkey = s_nationkey)""")
def or_condition(t):
    c = t.customer.selectExpr("c_custkey", "c_nationkey AS n", "CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 40 END AS reg")
    s = t.supplier.selectExpr("s_suppkey", "s_nationkey AS n", "CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey % 40 END AS reg")
    # rows of equal columns meet the same rows: they meet once, with their number
    c = c.groupBy("n", "reg").agg(F.count(F.lit(1)).alias("_c"))
    s = s.groupBy("n", "reg").agg(F.count(F.lit(1)).alias("_s"))
    numbers = ["_c", "_s"]
    by_reg = c.drop("n").join(s.drop("n"), "reg").select(*numbers)
    no_left = c.filter("reg IS NULL").drop("reg").join(s.drop("reg"), "n").select(*numbers)
    no_right = c.filter("reg IS NOT NULL").drop("reg").join(s.filter("reg IS NULL").drop("reg"), "n").select(*numbers)
    return by_reg.unionByName(no_left).unionByName(no_right).agg(F.coalesce(F.sum(F.col("_c") * F.col("_s")), F.lit(0)).alias("pairs"))


@query("j15_two_step_fallback", """
SELECT p.p_partkey, coalesce(a.v, b.v) AS v FROM part p LEFT JOIN (SELECT p_partkey, 'key ' || p_size AS v FROM part WHERE p_partkey % 3 = 0) a ON a.p_partkey = p.p_partkey
LEFT JOIN (SELECT p_brand, 'brand ' || min(p_partkey) AS v FROM part WHERE p_size > 45 GROUP BY 1) b ON b.p_brand = p.p_brand""")
def two_step_fallback(t):
    by_key = t.part.filter("p_partkey % 3 = 0").selectExpr("p_partkey", "'key ' || p_size AS a")
    by_brand = t.part.filter("p_size > 45").groupBy("p_brand").agg(F.min("p_partkey").alias("m")).selectExpr("p_brand", "'brand ' || m AS b")
    return t.part.join(by_key, "p_partkey", "left").join(by_brand, "p_brand", "left").select("p_partkey", F.coalesce("a", "b").alias("v"))


@query("j17_unnest_json", f"WITH {FEED} SELECT event_id, key, CAST(k AS VARCHAR) AS value FROM (SELECT event_id, k, unnest(['k']) AS key FROM feed)")
def unnest_json(t):
    return t.events.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


@query("j19_lookback_sum", f"""
WITH {SALES}, {STORES}, dl AS (SELECT account_id, sold_on, CAST(sum(qty) AS BIGINT) AS qty FROM sales JOIN stores USING (store_id) GROUP BY 1, 2)
SELECT account_id, sold_on, qty, CAST(sum(qty) OVER (PARTITION BY account_id ORDER BY sold_on RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS qty_7d FROM dl""")
def lookback_sum(t):
    daily = src.sales(t).join(src.stores(t), "store_id").groupBy("account_id", "sold_on").agg(F.sum("qty").alias("qty"))
    # one row per account and calendar day from here on
    w = Window.partitionBy("account_id").orderBy(F.unix_date("sold_on")).rangeBetween(-7, 0)
    return daily.withColumn("qty_7d", F.sum("qty").over(w))


@query("j20_as_of_price", f"""
WITH {SALES}, x AS (SELECT product_id, sold_on, sale_id, {r('CAST(net AS DOUBLE) / qty', 2)} AS price FROM sales WHERE sold_on < DATE '2000-01-01')
SELECT product_id, arg_max(price, (sold_on, sale_id, price)) AS price FROM x GROUP BY 1""")
def as_of_price(t):
    s = src.sales(t).filter("sold_on < DATE '2000-01-01'").withColumn("price", F.round(F.col("net").cast("double") / F.col("qty"), 2))
    return s.groupBy("product_id").agg(F.max_by("price", F.struct("sold_on", "sale_id", "price")).alias("price"))


@query("j13_rule_threshold", """
WITH r(kind, needed, prize) AS (VALUES ('F', 3, 10), ('F', 6, 25), ('O', 4, 15)), c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, max(prize) AS prize FROM c JOIN r ON kind = o_orderstatus AND n >= needed GROUP BY 1""")
def rule_threshold(t):
    rules = t.spark.createDataFrame([("F", 3, 10), ("F", 6, 25), ("O", 4, 15)], "o_orderstatus string, needed int, prize int")
    counted = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(rules, "o_orderstatus").filter("n >= needed").groupBy("o_custkey").agg(F.max("prize").alias("prize"))


@query("j14_argmax", "SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def argmax(t):
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("o_orderkey"))


_EXISTS = """SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F' AND o.o_totalprice > 400000)
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT' AND o.o_totalprice > 450000)"""


@query("j16_exists", _EXISTS)
def exists(t):
    t.customer.createOrReplaceTempView("gondola_customer")
    t.orders.createOrReplaceTempView("gondola_orders")
    return t.spark.sql(_EXISTS.replace("FROM customer", "FROM gondola_customer").replace("FROM orders", "FROM gondola_orders"))


# --- aggregates ----------------------------------------------------------------------------------

@query("a01_basic_aggregates", f"""
WITH {LINES} SELECT store_id, CAST(sum(qty) AS BIGINT) AS units, {r('avg(qty)', 6)} AS mean, {d('min(net)')} AS low, {d('max(net)')} AS high, count(*) AS lines FROM lines GROUP BY 1""")
def basic_aggregates(t):
    out = src.lines(t).groupBy("store_id").agg(
        F.sum("qty").alias("units"), F.round(F.avg("qty"), 6).alias("mean"), F.min("net").alias("low"), F.max("net").alias("high"), F.count(F.lit(1)).alias("lines"))
    return as_doubles(out, "low", "high")


@query("a02_conditional_distinct", f"WITH {LINES} SELECT store_id, count(DISTINCT product_id) AS products, count(DISTINCT product_id) FILTER (qty > 40) AS large FROM lines GROUP BY 1")
def conditional_distinct(t):
    folded = src.lines(t).groupBy("store_id", "product_id").agg(F.max((F.col("qty") > 40).cast("int")).alias("large"))
    return folded.groupBy("store_id").agg(F.count(F.lit(1)).alias("products"), F.sum("large").alias("large"))


@query("a03_count_if", f"WITH {LINES} SELECT channel, count(*) FILTER (qty > 25) AS big, count(*) FILTER (sale_kind = 'R') AS returned FROM lines GROUP BY 1")
def count_if(t):
    return src.lines(t).groupBy("channel").agg(F.count_if(F.col("qty") > 25).alias("big"), F.count_if(F.col("sale_kind") == "R").alias("returned"))


@query("a04_mode", "SELECT p_brand, arg_min(p_type, (-n, p_type)) AS usual FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY 1")
def mode(t):
    return t.part.groupBy("p_brand").agg(F.mode("p_type", True).alias("usual"))


@query("a05_collect_set", "SELECT p_brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS kinds FROM part GROUP BY 1")
def collect_set(t):
    return t.part.groupBy("p_brand").agg(kit.joined(F.collect_set("p_type")).alias("kinds"))


@query("a06_first_set_value", "SELECT p_brand, arg_min(v, k) FILTER (v IS NOT NULL) AS first FROM (SELECT p_brand, p_partkey AS k, CASE WHEN p_size > 30 THEN p_name END AS v FROM part) GROUP BY 1")
def first_set_value(t):
    v = F.when(F.col("p_size") > 30, F.col("p_name"))
    return t.part.groupBy("p_brand").agg(F.min_by(v, F.when(v.isNotNull(), F.col("p_partkey"))).alias("first"))


@query("a07_longest", "SELECT lang, arg_max(doc_id, (length(text), doc_id)) AS doc_id FROM documents GROUP BY 1")
def longest(t):
    return t.documents.groupBy("lang").agg(F.max_by("doc_id", F.struct(F.length("text"), F.col("doc_id"))).alias("doc_id"))


@query("a08_latest_struct", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(event_id) FILTER (event_type = 'view') AS last_view FROM events GROUP BY 1")
def latest_struct(t):
    return t.events.groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id", "event_type"))["event_type"].alias("event_type"), F.max(F.when(F.col("event_type") == "view", F.col("event_id"))).alias("last_view"))


@query("a09_global_quantiles", "SELECT " + ", ".join(f"{r(f'quantile_cont(o_totalprice, {p})', 4)} AS q{int(p * 100)}" for p in (0.2, 0.5, 0.9)) + " FROM orders")
def global_quantiles(t):
    out = kit.exact_percentiles(t.orders, [], "o_totalprice", {"q20": 0.2, "q50": 0.5, "q90": 0.9})
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


@query("a10_grouped_quantiles", f"SELECT o_orderpriority, {r('quantile_cont(o_totalprice, 0.33)', 4)} AS p33, {r('quantile_cont(o_totalprice, 0.66)', 4)} AS p66 FROM orders GROUP BY 1")
def grouped_quantiles(t):
    out = kit.exact_percentiles(t.orders, ["o_orderpriority"], "o_totalprice", {"p33": 0.33, "p66": 0.66})
    return out.select("o_orderpriority", F.round("p33", 4).alias("p33"), F.round("p66", 4).alias("p66"))


@query("a11_map_lookup", "SELECT p_brand, count(*) FILTER (p_type = 'PROMO') AS promo FROM part GROUP BY 1")
def map_lookup(t):
    per = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")).groupBy("p_brand").agg(
        F.map_from_entries(F.collect_list(F.struct("p_type", "n"))).alias("m"))
    return per.select("p_brand", F.coalesce(F.col("m")["PROMO"], F.lit(0)).alias("promo"))


@query("a12_pivot", "SELECT l_returnflag, CAST(sum(l_quantity) FILTER (l_linestatus = 'F') AS DOUBLE) AS F, CAST(sum(l_quantity) FILTER (l_linestatus = 'O') AS DOUBLE) AS O FROM lineitem GROUP BY 1")
def pivot(t):
    return t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity"))


@query("a13_bool_aggregates", "SELECT s_nationkey, bool_or(s_acctbal > 9000) AS any_rich, bool_and(s_acctbal > 1000) AS all_well FROM supplier GROUP BY 1")
def bool_aggregates(t):
    return t.supplier.groupBy("s_nationkey").agg(F.bool_or(F.col("s_acctbal") > 9000).alias("any_rich"), F.bool_and(F.col("s_acctbal") > 1000).alias("all_well"))


@query("a14_two_level", f"""
WITH {SALES}, m AS (SELECT store_id, date_trunc('month', sold_on) AS mo, CAST(sum(qty) AS BIGINT) AS units FROM sales GROUP BY 1, 2) SELECT store_id, {r('avg(units)', 6)} AS monthly FROM m GROUP BY 1""")
def two_level(t):
    per = src.sales(t).groupBy("store_id", F.trunc("sold_on", "month").alias("mo")).agg(F.sum("qty").alias("units"))
    return per.groupBy("store_id").agg(F.round(F.avg("units"), 6).alias("monthly"))


@query("a15_having", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 14")
def having(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).filter("orders > 14")


@query("a16_string_agg", "SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def string_agg(t):
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy("r_name").agg(kit.joined(F.collect_list("n_name"), ", ").alias("nations"))


_MONTHS = "s AS (SELECT *, CAST(date_trunc('month', sold_on) AS DATE) AS month FROM sales)"
_TOTALS = f"CAST(sum(qty) AS BIGINT) AS units, {d('sum(net)')} AS revenue, count(*) AS lines"


def _monthly(t):
    return src.sales(t).withColumn("month", F.trunc("sold_on", "month"))


def _sums():
    return {"units": F.col("qty"), "revenue": F.col("net"), "lines": F.lit(1)}


@query("a17_grouping_sets", f"""
WITH {SALES}, {_MONTHS} SELECT store_id, channel, sale_kind, CAST(grouping(store_id, channel, sale_kind) AS BIGINT) AS level, {_TOTALS}, count(DISTINCT customer_id) AS customers
FROM s GROUP BY GROUPING SETS ((store_id, sale_kind), (channel, sale_kind), (store_id), ())""")
def grouping_sets(t):
    sets = [["store_id", "sale_kind"], ["channel", "sale_kind"], ["store_id"], []]
    return as_doubles(subtotals(src.sales(t), ["store_id", "channel", "sale_kind"], sets, _sums(), ("customer_id", "customers")), "revenue")


@query("a17_rollup", f"""
WITH {SALES}, {_MONTHS} SELECT channel, month, store_id, CAST(grouping(channel, month, store_id) AS BIGINT) AS level, {_TOTALS} FROM s GROUP BY ROLLUP (channel, month, store_id)""")
def rollup(t):
    dims = ["channel", "month", "store_id"]
    return as_doubles(subtotals(_monthly(t), dims, rollup_sets(dims), _sums()), "revenue")


@query("a17_cube", f"""
WITH {SALES}, {_MONTHS} SELECT channel, sale_kind, month, CAST(grouping(channel, sale_kind, month) AS BIGINT) AS level, {_TOTALS}, count(DISTINCT product_id) AS products
FROM s GROUP BY CUBE (channel, sale_kind, month)""")
def cube(t):
    dims = ["channel", "sale_kind", "month"]
    return as_doubles(subtotals(_monthly(t), dims, cube_sets(dims), _sums(), ("product_id", "products")), "revenue")


@query("a18_array_fold", f"WITH {PRODUCTS} SELECT product_id, CAST(list_sum([size, size * 2, size * 3][1:1 + product_id % 3]) AS BIGINT) AS total FROM products")
def array_fold(t):
    a = F.array(F.col("size"), F.col("size") * 2, F.col("size") * 3)
    part = F.slice(a, F.lit(1), (1 + F.col("product_id") % 3).cast("int"))
    return src.products(t).select("product_id", F.aggregate(part, F.lit(0).cast("long"), lambda x, y: x + y).alias("total"))


@query("a19_ordered_distinct", "SELECT p_name, p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2")
def ordered_distinct(t):
    return kit.latest(t.part, ["p_name", "p_brand"], [F.col("p_partkey")]).select("p_name", "p_brand", "p_partkey")


# --- windows -------------------------------------------------------------------------------------

@query("w01_latest_row", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def latest_row(t):
    return kit.latest(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("w02_rank_ties", "SELECT p_brand, p_partkey FROM (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS k FROM part) WHERE k = 1")
def rank_ties(t):
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_size"))
    return t.part.withColumn("k", F.rank().over(w)).filter("k = 1").select("p_brand", "p_partkey")


@query("w03_running_total", """
WITH x AS (SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS v FROM orders)
SELECT o_custkey, o_orderkey, row_number() OVER w AS place, CAST(sum(v) OVER w AS DOUBLE) AS running FROM x WINDOW w AS (PARTITION BY o_custkey ORDER BY v DESC, o_orderkey ROWS UNBOUNDED PRECEDING)""")
def running_total(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
    out = kit.order_positions(rows, ["o_custkey"], [F.desc("v"), F.col("o_orderkey")], total="v")
    return out.select("o_custkey", "o_orderkey", F.col("position").cast("long").alias("place"), F.col("running").cast("double").alias("running"))


@query("w07_fill_first_set", "SELECT p_partkey, coalesce(CASE WHEN p_size > 30 THEN p_name END, f) AS name FROM part JOIN (SELECT p_brand AS b, arg_min(p_name, p_partkey) FILTER (p_size > 30) AS f FROM part GROUP BY 1) ON b = p_brand")
def fill_first_set(t):
    v = F.when(F.col("p_size") > 30, F.col("p_name"))
    first = t.part.groupBy("p_brand").agg(F.min_by(v, F.when(v.isNotNull(), F.col("p_partkey"))).alias("f"))
    return t.part.join(first, "p_brand").select("p_partkey", F.coalesce(v, "f").alias("name"))


@query("w10_level_counts", """
WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, string_agg(o_orderstatus || '=' || n, '|' ORDER BY o_orderstatus) AS levels FROM c GROUP BY 1""")
def level_counts(t):
    per = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    pair = F.concat_ws("=", "o_orderstatus", F.col("n").cast("string"))
    return per.groupBy("o_custkey").agg(kit.joined(F.collect_list(pair)).alias("levels"))  # three statuses at most


@query("w12_distinct_on", """
SELECT s_nationkey, s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC NULLS LAST, s_suppkey) AS k FROM supplier) WHERE k = 1""")
def distinct_on(t):
    return kit.latest(t.supplier, ["s_nationkey"], [F.desc_nulls_last("s_acctbal"), F.col("s_suppkey")]).select("s_nationkey", "s_suppkey")


@query("w11_previous_round", "SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS started_on FROM events WHERE date_trunc('week', ts) < (SELECT max(date_trunc('week', ts)) FROM events) ORDER BY 1 DESC LIMIT 1")
def previous_round(t):
    weeks = t.events.select(F.date_trunc("week", "ts").cast("date").alias("started_on")).distinct()
    return weeks.filter(F.col("started_on") < weeks.agg(F.max("started_on")).scalar()).orderBy(F.desc("started_on")).limit(1)


@query("w13_time_buckets", "SELECT epoch_us(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')) AS bucket, count(*) AS events FROM events GROUP BY 1")
def time_buckets(t):
    at = F.window(F.col("ts").cast("timestamp"), "6 hours")["start"]
    return t.events.groupBy(F.unix_micros(at).alias("bucket")).agg(F.count(F.lit(1)).alias("events"))


# --- top-k and sampling --------------------------------------------------------------------------

@query("l02_top_n", f"WITH {LINES} SELECT product_id, CAST(sum(qty) AS BIGINT) AS units FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100")
def top_n(t):
    return src.lines(t).groupBy("product_id").agg(F.sum("qty").alias("units")).orderBy(F.desc("units"), "product_id").limit(100)


@query("l03_top_n_per_group", """
SELECT p_brand, p_partkey, CAST(k AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS k, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 4 + 1 AS n FROM part) WHERE k <= n""")
def top_n_per_group(t):
    n = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int") % 4 + 1
    return kit.top_n(t.part, ["p_brand"], [F.desc("p_size"), F.col("p_partkey")], 4, "k").filter(F.col("k") <= n).select("p_brand", "p_partkey", "k")


@query("l05_sampled_keys", "SELECT c_custkey FROM customer ORDER BY md5('11:' || c_custkey), c_custkey LIMIT 50")
def sampled_keys(t):
    return sample_keys(t.customer, "c_custkey", 50, "11")


@query("l06_holdout_split", """
WITH h AS (SELECT doc_id FROM documents ORDER BY md5('3:' || doc_id), doc_id LIMIT 60) SELECT lang, doc_id IN (FROM h) AS held, count(*) AS docs FROM documents GROUP BY 1, 2""")
def holdout_split(t):
    held = sample_keys(t.documents, "doc_id", 60, "3").withColumn("h", F.lit(True))
    return t.documents.join(held, "doc_id", "left").groupBy("lang", F.coalesce("h", F.lit(False)).alias("held")).agg(F.count(F.lit(1)).alias("docs"))


@query("l07_fraction", "SELECT c_custkey FROM customer WHERE md5('5:' || c_custkey) < '4'")
def fraction(t):
    """A quarter of the keys, by hash: the same rows whatever the partitions."""
    return t.customer.select("c_custkey").filter(F.md5(F.concat(F.lit("5:"), F.col("c_custkey").cast("string"))) < "4")


@query("l08_truncated_array", "SELECT doc_id, array_to_string(regexp_split_to_array(trim(text), '\\s+')[1:3], ' ') AS head FROM documents")
def truncated_array(t):
    return t.documents.select("doc_id", F.array_join(F.slice(F.split(F.trim("text"), r"\s+"), 1, 3), " ").alias("head"))


# --- sets ----------------------------------------------------------------------------------------

@query("u01_union_all", "SELECT c_nationkey AS n FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t):
    return t.customer.select(F.col("c_nationkey").alias("n")).union(t.supplier.select("s_nationkey"))


@query("u02_union_by_name", "SELECT c_custkey AS id, c_mktsegment AS segment, NULL::VARCHAR AS name FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("u03_union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def union_distinct(t):
    return t.orders.select(F.col("o_custkey").alias("k")).union(t.customer.filter("c_acctbal < 0").select("c_custkey")).distinct()


@query("u04_union_many", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT s_name FROM supplier")
def union_many(t):
    frames = [t.nation.select(F.col("n_name").alias("name")), t.region.select(F.col("r_name").alias("name")), t.supplier.select(F.col("s_name").alias("name"))]
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("u05_except_intersect", """
SELECT k, 'only orders' AS side FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') UNION ALL
SELECT k, 'both' FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def except_intersect(t):
    o = t.orders.select(F.col("o_custkey").alias("k")).distinct()
    b = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"))
    return o.join(b, "k", "left_anti").withColumn("side", F.lit("only orders")).unionByName(o.join(b, "k", "left_semi").withColumn("side", F.lit("both")))


@query("u06_array_sets", f"""
WITH {PRODUCTS}, x AS (SELECT product_id, [split_part(name, ' ', 1), category, brand] AS a, [category, split_part(name, ' ', 2)] AS b FROM products)
SELECT product_id, CAST(len(list_intersect(a, b)) AS INTEGER) AS shared, CAST(len(list_distinct(list_concat(a, b))) AS INTEGER) AS together, CAST(len(list_filter(a, lambda v: NOT list_contains(b, v))) AS INTEGER) AS rest FROM x""")
def array_sets(t):
    a = F.array(F.split_part("name", F.lit(" "), F.lit(1)), "category", "brand")
    b = F.array("category", F.split_part("name", F.lit(" "), F.lit(2)))
    return src.products(t).select(
        "product_id", F.size(F.array_intersect(a, b)).alias("shared"), F.size(F.array_union(a, b)).alias("together"), F.size(F.array_except(a, b)).alias("rest"))
