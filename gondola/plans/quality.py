"""Table contracts and data quality over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.operators import contracts as op
from gondola.operators import quality
from gondola.plans import customers as people
from gondola.plans import inputs as src
from gondola.plans.customers import COMPLETE
from gondola.plans.inputs import HEADERS, PRODUCTS, as_doubles, r
from gondola.plans.registry import query
from gondola.session import lineage_cut


def _profile_sql(frm: str, columns: list[str]) -> str:
    one = "SELECT '{c}' AS \"column\", count(*) AS total, count(*) FILTER (trim(CAST({c} AS VARCHAR)) NOT IN ('', '[]', '()', '{{}}')) AS completeness, count(DISTINCT {c}) AS uniqueness FROM " + frm
    union = " UNION ALL ".join(one.format(c=c) for c in columns)
    return f"""SELECT *, {r('completeness / total', 4)} AS completeness_share, {r('uniqueness / total', 4)} AS uniqueness_share FROM ({union})"""


_PERSON_COLUMNS = ["customer_id", "account_id", "tax_id", "name", "sex", "age_band"]


@query("t01_profile", f"WITH {COMPLETE} " + _profile_sql("complete", _PERSON_COLUMNS))
def profile(t):
    return op.profile(people.complete(t).select(*_PERSON_COLUMNS))


@query("t01_merged_profile", f"""
WITH {COMPLETE}, x AS ({_profile_sql("complete", _PERSON_COLUMNS)})
SELECT "column", total, completeness, true AS distinct_close, "column" IN ('customer_id', 'account_id') AS quantiles_close FROM x""")
def merged_profile(t):
    """The profile of a table from stored sketches of its batches, checked against the exact one: distinct values within 5 %, ranks of quantiles within 3 %."""
    people_ = people.complete(t).select(*_PERSON_COLUMNS)
    stored = lineage_cut(op.sketch_profile(people_, F.pmod(F.xxhash64("customer_id"), F.lit(8))))
    points = (0.25, 0.5, 0.75)
    merged = lineage_cut(op.merged_profile(stored, points))
    exact = op.profile(people_).select("column", F.col("uniqueness").alias("distinct"))
    close = F.abs(F.col("uniqueness") - F.col("distinct")) <= 0.05 * F.col("distinct") + 1
    # two numeric columns: the shares of rows below and up to each quantile surround its point
    numbers = ["customer_id", "account_id"]
    flat = people_.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in numbers])))
    met = flat.join(F.broadcast(merged.select("column", "quantiles")), "column").filter("v IS NOT NULL").groupBy("column").agg(*[
        x for i, p in enumerate(points) for x in (F.avg((F.col("v") < F.col("quantiles")[i]).cast("double")).alias(f"lo{i}"),
                                                  F.avg((F.col("v") <= F.col("quantiles")[i]).cast("double")).alias(f"hi{i}"))])
    good = reduce(lambda a, b: a & b, [(F.col(f"lo{i}") <= p + 0.03) & (F.col(f"hi{i}") >= p - 0.03) for i, p in enumerate(points)])
    ranks = met.select("column", good.alias("good"))
    return merged.join(exact, "column").join(ranks, "column", "left").select(
        "column", "total", "completeness", close.alias("distinct_close"), F.coalesce("good", F.lit(False)).alias("quantiles_close"))


_CONTRACT = T.StructType([
    T.StructField("customer_id", T.LongType(), False), T.StructField("account_id", T.IntegerType()),
    T.StructField("tax_id", T.IntegerType()), T.StructField("sex", T.StringType(), False), T.StructField("loyalty", T.StringType())])


@query("t02_check_contract", f"""
WITH {COMPLETE}
SELECT 'tax_id' AS "column", 'type' AS issue, 'int' AS wanted, 'string' AS found, count(*) FILTER (tax_id IS NOT NULL AND TRY_CAST(tax_id AS INTEGER) IS NULL) AS rows FROM complete
UNION ALL SELECT 'sex', 'null', 'string', 'string', count(*) FILTER (sex IS NULL) FROM complete
UNION ALL SELECT 'loyalty', 'removed', 'string', NULL, count(*) FROM complete
UNION ALL SELECT 'name', 'added', NULL, 'string', count(*) FROM complete""")
def check_contract(t):
    return op.check_contract(people.complete(t).select("customer_id", "account_id", "tax_id", "sex", "name"), _CONTRACT)


@query("t03_conform", """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_acctbal AS DECIMAL(12,1))::DOUBLE AS balance, CAST(c_nationkey AS BIGINT) AS account_id FROM customer""")
def conform(t):
    contract = T.StructType([
        T.StructField("customer_id", T.StringType(), False), T.StructField("balance", T.DecimalType(12, 1)),
        T.StructField("account_id", T.LongType(), False)])
    base = t.customer.select("c_name", F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("account_id"))
    return as_doubles(op.conform(base, contract), "balance")


def _price_list(t):
    """Last sale price per product before 2000 (target) and all prices since (source)."""
    s = src.sales(t).select("product_id", "sold_on", "sale_id", "store_id", "qty", "net")
    s = s.withColumn("price", F.round(F.col("net").cast("double") / F.col("qty"), 2))
    # read by target, source and history, which would join and shuffle the sales each
    s = lineage_cut(s.select("product_id", "price", "store_id", "sold_on", "sale_id"))
    order = [F.desc("sold_on"), F.desc("sale_id"), F.desc("price"), F.desc("store_id")]
    cut = F.lit("1996-01-01").cast("date")
    columns = ["product_id", "price", "store_id", "sold_on"]
    target = op.latest(s.filter(F.col("sold_on") < cut), ["product_id"], order).select(*columns)
    return target, s.filter(F.col("sold_on") >= cut).select(*columns, "sale_id"), order


# Only the lines of the last sale of a product, on either side of the day, get a price.
_PRICES = f"""{src.SALES}, p AS (SELECT *, sold_on < DATE '1996-01-01' AS old FROM sales),
m AS (SELECT product_id, old, arg_max(sale_id, (sold_on, sale_id)) AS last_sale, max(sold_on) AS last_day, count(*) AS n FROM p GROUP BY 1, 2),
c AS (SELECT p.product_id, sold_on, sale_id, store_id, {r('CAST(net AS DOUBLE) / qty', 2)} AS price FROM p JOIN m ON p.product_id = m.product_id AND p.old = m.old AND sold_on = last_day AND sale_id = last_sale),
rk AS (SELECT *, row_number() OVER (PARTITION BY product_id, sold_on ORDER BY price DESC, store_id DESC) AS k FROM c),
tgt AS (SELECT * FROM rk WHERE k = 1 AND sold_on < DATE '1996-01-01'), srcs AS (SELECT * FROM rk WHERE k = 1 AND sold_on >= DATE '1996-01-01')"""


@query("t04_upsert", f"""
WITH {_PRICES} SELECT coalesce(s.product_id, g.product_id) AS product_id, coalesce(s.price, g.price) AS price,
  CASE WHEN g.product_id IS NULL THEN s.store_id ELSE g.store_id END AS store_id, coalesce(s.sold_on, g.sold_on) AS sold_on
FROM tgt g FULL JOIN srcs s ON s.product_id = g.product_id""")
def upsert(t):
    target, source, order = _price_list(t)
    return op.upsert(target, source, ["product_id"], order, update=["price", "sold_on"])


@query("t05_regression_gate", """
WITH f AS (SELECT o_orderdate < TIMESTAMP '1998-01-01' AS old, o_totalprice > 200000 AS big, o_orderstatus = 'F' AS closed FROM orders),
u AS (SELECT old, 'big' AS flag, big AS side FROM f UNION ALL SELECT old, 'closed', closed FROM f)
SELECT flag, side, count(*) FILTER (old) AS before, count(*) FILTER (NOT old) AS now,
  count(*) FILTER (NOT old) >= count(*) FILTER (old) * 0.5 AS passed FROM u GROUP BY ALL""")
def regression_gate(t):
    f = t.orders.select("o_orderdate", (F.col("o_totalprice") > 200000).alias("big"), (F.col("o_orderstatus") == "F").alias("closed"))
    old = F.to_date("o_orderdate") < F.lit("1998-01-01").cast("date")
    return op.regression_gate(f.filter(~old), f.filter(old), ["big", "closed"])


@query("t06_incremental_append", f"""
WITH {HEADERS}, e AS (SELECT * FROM headers WHERE sold_on < DATE '2000-06-01' OR (sold_on = DATE '2000-06-01' AND sale_id % 2 = 0))
SELECT sale_id, sold_on FROM headers WHERE sold_on >= (SELECT max(sold_on) - 1 FROM e) AND sale_id NOT IN (SELECT sale_id FROM e)""")
def incremental(t):
    h = src.headers(t).select("sale_id", "sold_on")
    existing = h.filter("sold_on < DATE '2000-06-01' OR (sold_on = DATE '2000-06-01' AND sale_id % 2 = 0)")
    return op.incremental(existing, h, "sale_id", "sold_on")


@query("t07_sync_checkpoint", """
WITH x AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type = 'purchase')
SELECT 'job ' || user_id AS job, event_id AS last_run, epoch_us(ts) AS since FROM x WHERE k = 1""")
def sync_checkpoint(t):
    state = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failed").otherwise("running")
    runs = src.feed(t).select(F.concat(F.lit("job "), F.col("user_id").cast("string")).alias("job"), F.col("event_id").alias("run_id"),
                              F.col("at_us").alias("started_at"), state.alias("state"))
    return op.last_success(runs)


@query("t08_keep_stamp", """
SELECT p_partkey AS product_id, CASE WHEN p_size > 40 THEN NULL WHEN p_partkey % 3 = 0 THEN p_name || '!' ELSE p_name END AS name, p_size AS size,
  CASE WHEN p_partkey % 7 <> 0 AND (p_size > 40 OR p_partkey % 3 <> 0) THEN 'old' ELSE 'new' END AS stamp FROM part""")
def keep_stamp(t):
    key = F.col("p_partkey").alias("product_id")
    name = F.when(F.col("p_size") <= 40, F.col("p_name"))
    old = t.part.filter("p_partkey % 7 <> 0").select(key, name.alias("name"), F.col("p_size").alias("size"), F.lit("old").alias("stamp"))
    changed = F.when(F.col("p_partkey") % 3 == 0, F.concat(name, F.lit("!"))).otherwise(name)
    new = t.part.select(key, changed.alias("name"), F.col("p_size").alias("size"), F.lit("new").alias("stamp"))
    return op.keep_stamp(new, old, ["product_id"], "stamp")


@query("t09_only_new", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')")
def only_new(t):
    done = t.orders.filter(F.to_date("o_orderdate") >= F.lit("2000-01-01").cast("date")).select(F.col("o_custkey").alias("c_custkey"))
    return op.only_new(t.customer.select("c_custkey", "c_name"), done, ["c_custkey"])


@query("t10_history_and_latest", f"""
WITH {_PRICES}, h AS (SELECT product_id, CAST(sum(CASE WHEN old THEN 1 ELSE n END) AS BIGINT) AS versions FROM m GROUP BY 1)
SELECT coalesce(s.product_id, g.product_id) AS product_id, coalesce(s.price, g.price) AS price, versions FROM tgt g FULL JOIN srcs s ON s.product_id = g.product_id
JOIN h ON h.product_id = coalesce(s.product_id, g.product_id)""")
def history_and_latest(t):
    target, source, order = _price_list(t)
    target = target.withColumn("sale_id", F.lit(None).cast("long"))
    history, current = op.history_and_latest(target, target, source, ["product_id"], order)
    versions = history.groupBy("product_id").agg(F.count(F.lit(1)).alias("versions"))
    return current.join(versions, "product_id").select("product_id", "price", "versions")


@query("t11_quarantine", f"""
WITH {COMPLETE}, x AS (SELECT customer_id, concat_ws('|', CASE WHEN age IS NULL OR age < 0 OR age > 105 THEN 'age' END, CASE WHEN name IS NULL THEN 'name' END,
  CASE WHEN is_person IS NULL THEN 'tax_id' END) AS reasons FROM complete)
SELECT reasons, count(*) AS rows FROM x GROUP BY 1""")
def quarantine(t):
    valid, rejected = op.quarantine(people.complete(t), {
        "age": F.col("age").between(0, 105), "name": F.col("name").isNotNull(), "tax_id": F.col("is_person").isNotNull()})
    return valid.withColumn("reasons", F.lit("")).unionByName(rejected).groupBy("reasons").agg(F.count(F.lit(1)).alias("rows"))


# --- quality -------------------------------------------------------------------------------------

_CATALOG = f"""{PRODUCTS}, catalog AS (
  SELECT product_id, CASE WHEN product_id % 9 = 0 THEN '' ELSE name END AS name, CASE WHEN product_id % 11 = 0 THEN 'null' ELSE brand END AS brand,
         CASE WHEN product_id % 5 <> 0 THEN category END AS category, CASE WHEN product_id % 4 <> 0 THEN CAST(size AS VARCHAR) END AS size,
         CASE WHEN product_id % 13 = 0 THEN '[]' ELSE ean END AS ean, category IN ('SMALL', 'PROMO') AS is_medicine FROM products)"""
_VOCAB = {"category": ["SMALL", "PROMO", "LARGE", "ECONOMY"], "brand": [f"Brand#{i}" for i in range(1, 21)]}
_CRITICAL = (["name", "category", "ean"], ["name", "brand"])
_FIELDS = ["name", "brand", "category", "size", "ean"]


def catalog(t):
    p, i = src.products(t), F.col("product_id")
    return p.select(
        "product_id", F.when(i % 9 == 0, "").otherwise(F.col("name")).alias("name"),
        F.when(i % 11 == 0, "null").otherwise(F.col("brand")).alias("brand"), F.when(i % 5 != 0, F.col("category")).alias("category"),
        F.when(i % 4 != 0, F.col("size").cast("string")).alias("size"), F.when(i % 13 == 0, "[]").otherwise(F.col("ean")).alias("ean"),
        F.col("category").isin("SMALL", "PROMO").alias("is_medicine"))


def _score_sql() -> str:
    def filled(c):
        return f"(CASE WHEN {c} IS NOT NULL AND {c} <> '' AND lower({c}) <> 'null' AND trim({c}) <> '[]' THEN 1 ELSE 0 END)"

    def ok(c):
        return f"(CASE WHEN {filled(c)} = 1 AND {c} IN ({', '.join(repr(v) for v in _VOCAB[c])}) THEN 1 ELSE 0 END)"

    def w(c):
        return f"(CASE WHEN is_medicine THEN {2 if c in _CRITICAL[0] else 1} ELSE {2 if c in _CRITICAL[1] else 1} END)"

    earned = " + ".join(f"{w(c)} * " + (f"({filled(c)} * 0.5::DOUBLE + {ok(c)} * 0.5::DOUBLE)" if c in _VOCAB else filled(c)) for c in _FIELDS)
    q = r(f"({earned}) / ({' + '.join(w(c) for c in _FIELDS)}) * 100", 2)
    full = " + ".join(filled(c) for c in _FIELDS)
    good = " + ".join(ok(c) for c in _VOCAB)
    outside = ", ".join(f"CASE WHEN {filled(c)} = 1 AND {ok(c)} = 0 THEN '{c}' END" for c in sorted(_VOCAB))
    missing = ", ".join(f"CASE WHEN {w(c)} = 2 AND {filled(c)} = 0 THEN '{c}' END" for c in sorted(_FIELDS))
    return f"""WITH {_CATALOG}, s AS (SELECT product_id, {q} AS quality, {r(f'({full}) / 5 * 100', 2)} AS completeness, {r(f'({good}) / 2 * 100', 2)} AS compliance,
  CAST({full} AS INTEGER) AS filled, CAST({good} AS INTEGER) AS compliant, concat_ws('|', {outside}) AS outside_vocabulary, concat_ws('|', {missing}) AS missing_critical FROM catalog)
SELECT *, CASE WHEN quality >= 80 THEN 'excellent' WHEN quality >= 60 THEN 'good' WHEN quality >= 40 THEN 'fair' ELSE 'poor' END AS tier FROM s"""


@query("d108_quality_score", _score_sql())
def quality_score(t):
    out = quality.quality_score(catalog(t), _FIELDS, _VOCAB, F.col("is_medicine"), _CRITICAL)
    return out.select("product_id", "quality", "completeness", "compliance", "filled", "compliant", "outside_vocabulary", "missing_critical", "tier")


@query("d109_quality_metrics", f"""
WITH {COMPLETE}, m AS (SELECT account_id, count(*) AS n, count(name) AS a, count(born_on) AS b, count(*) FILTER (age IS NULL OR age BETWEEN 0 AND 105) AS c,
  count(*) FILTER (sex IS NULL OR sex IN ('f', 'm')) AS e FROM complete GROUP BY 1),
u AS (SELECT account_id, sum(k) AS n, count(*) FILTER (k = 1) AS o FROM (SELECT account_id, age, count(*) AS k FROM complete GROUP BY 1, 2) GROUP BY 1)
SELECT account_id, 'name' AS instance, 'Completeness' AS metric, {r('a / n', 6)} AS value, 'column' AS entity FROM m
UNION ALL SELECT account_id, 'born_on', 'Completeness', {r('b / n', 6)}, 'column' FROM m
UNION ALL SELECT account_id, 'age_possible', 'Compliance', {r('c / n', 6)}, 'column' FROM m
UNION ALL SELECT account_id, 'sex_vocabulary', 'Compliance', {r('e / n', 6)}, 'column' FROM m
UNION ALL SELECT account_id, 'age', 'Uniqueness', {r('o / n', 6)}, 'column' FROM u""")
def quality_metrics(t):
    return quality.quality_metrics(
        people.complete(t), "account_id", ["age"], ["name", "born_on"],
        {"age_possible": F.col("age").isNull() | F.col("age").between(0, 105),
         "sex_vocabulary": F.col("sex").isNull() | F.col("sex").isin("f", "m")})


@query("d110_integrity", f"""
WITH {_CATALOG}, x AS (SELECT count(ean) AS total, count(DISTINCT ean) AS distinct_keys, count(*) FILTER (category IS NULL) AS no_category,
  count(*) FILTER (is_medicine AND ean LIKE '0%') AS leading_zero, count(*) FILTER (is_medicine) AS medicines FROM catalog)
SELECT *, total - distinct_keys AS duplicates, total = distinct_keys AND no_category = 0 AND leading_zero = 0 AS passed FROM x""")
def integrity(t):
    return quality.integrity(
        catalog(t), "ean",
        {"no_category": F.col("category").isNull(), "leading_zero": F.col("is_medicine") & F.col("ean").startswith("0")},
        {"medicines": F.col("is_medicine")})


@query("d111_rule_violations", f"""
WITH {PRODUCTS}
SELECT 'otc_controlled' AS rule, brand, count(*) AS rows FROM products WHERE category IN ('LARGE', 'ECONOMY') AND size > 45 GROUP BY 2
UNION ALL SELECT 'otc_stripe', brand, count(*) FROM products WHERE category IN ('LARGE', 'ECONOMY') AND name NOT LIKE '%red%' AND name NOT ILIKE '%BLUE%' GROUP BY 2""")
def rule_violations(t):
    otc = F.col("category").isin("LARGE", "ECONOMY")
    return quality.rule_violations(src.products(t), {
        "otc_controlled": otc & (F.col("size") > 45),
        "otc_stripe": otc & ~F.col("name").like("%red%") & ~F.col("name").ilike("%BLUE%")}, "brand")


@query("d112_outside_reference", f"""
WITH {_CATALOG}, ref AS (SELECT p_partkey AS product_id, p_brand AS brand, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS name, p_type AS category FROM part WHERE p_partkey % 6 = 3 AND p_size < 30)
SELECT c.product_id, concat_ws(', ', CASE WHEN f.brand IS NOT NULL AND c.brand NOT IN (SELECT brand FROM ref) THEN 'brand' END,
  CASE WHEN f.category IS NOT NULL AND c.category NOT IN (SELECT category FROM ref) THEN 'category' END,
  CASE WHEN f.name IS NOT NULL AND c.name NOT IN (SELECT name FROM ref WHERE name IS NOT NULL) THEN 'name' END) AS invalid_columns
FROM catalog c LEFT JOIN ref f ON f.product_id = c.product_id""")
def outside_reference(t):
    ref = t.part.filter("p_partkey % 6 = 3 AND p_size < 30").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("brand"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).alias("name"), F.col("p_type").alias("category"))
    return quality.outside_reference(catalog(t), ref, "product_id", ["brand", "category", "name"])
