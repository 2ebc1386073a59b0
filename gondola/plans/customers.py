"""Customers over the driver's tables. Personal fields are derived from the customer key."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import customers as op
from gondola.plans import inputs as src
from gondola.plans.inputs import PRODUCTS, SALES, as_doubles, d, r
from gondola.plans.registry import query

_PERSON = {
    "tax_id": "CASE WHEN c_custkey % 7 = 0 THEN lpad(CAST(c_custkey AS STRING), 14, '1') WHEN c_custkey % 7 = 1 THEN CAST(c_custkey AS STRING) ELSE concat('9', lpad(CAST(c_custkey AS STRING), 8, '0'), '-', '42') END",
    "name": "CASE WHEN c_custkey % 5 <> 0 THEN c_name END",
    "sex": "CASE WHEN c_custkey % 4 = 0 THEN 'f' WHEN c_custkey % 4 = 1 THEN 'm' WHEN c_custkey % 4 = 2 THEN 'not-informed' END",
    "born_on": "CASE WHEN c_custkey % 6 <> 0 THEN date_add(DATE '1925-06-15', CAST((c_custkey * 37) % 29000 AS INT)) END",
}
PERSON = f"""person AS (
  SELECT c_custkey AS customer_id, c_nationkey AS account_id, {_PERSON['tax_id'].replace('STRING', 'VARCHAR')} AS tax_id,
         {_PERSON['name']} AS name, {_PERSON['sex']} AS sex,
         CASE WHEN c_custkey % 6 <> 0 THEN DATE '1925-06-15' + CAST((c_custkey * 37) % 29000 AS INTEGER) END AS born_on
  FROM customer)"""
_SIDE = "c_custkey % 3 = 0"


def person(t):
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("account_id"),
        *[F.expr(e).alias(n) for n, e in _PERSON.items()])


def side(t):
    """A look-up table of persons by their cleaned tax id."""
    return t.customer.filter(_SIDE).select(
        F.regexp_replace(F.expr(_PERSON["tax_id"]), "[^0-9]", "").alias("tax_id"), F.col("c_name").alias("name"),
        F.lit("f").alias("sex"), F.expr("date_add(DATE '1960-01-01', CAST(c_custkey % 9000 AS INT))").alias("born_on"))


COMPLETE = f"""{PERSON}, side AS (
  SELECT regexp_replace({_PERSON['tax_id'].replace('STRING', 'VARCHAR')}, '[^0-9]', '', 'g') AS tax_id, c_name AS name, 'f' AS sex,
         DATE '1960-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS born_on FROM customer WHERE {_SIDE}),
filled AS (SELECT p.customer_id, p.account_id, regexp_replace(p.tax_id, '[^0-9]', '', 'g') AS tax_id, coalesce(p.name, s.name) AS name,
                  coalesce(p.sex, s.sex) AS sex0, coalesce(p.born_on, s.born_on) AS born_on
           FROM person p LEFT JOIN side s ON s.tax_id = regexp_replace(p.tax_id, '[^0-9]', '', 'g')),
aged AS (SELECT customer_id, account_id, tax_id, name, CASE WHEN sex0 <> 'not-informed' THEN sex0 END AS sex, born_on,
                CASE length(tax_id) WHEN 11 THEN true WHEN 14 THEN false END AS is_person,
                CAST(year(DATE '2001-08-02') - year(born_on) - CASE WHEN (8, 2) < (month(born_on), day(born_on)) THEN 1 ELSE 0 END AS INTEGER) AS age
         FROM filled),
complete AS (SELECT *, CASE WHEN age IS NULL OR age < 0 THEN NULL WHEN age < 2 THEN 'bebe' WHEN age < 13 THEN 'crianca'
             WHEN age < 18 THEN 'adolescente' WHEN age < 25 THEN 'jovem' WHEN age < 60 THEN 'adulto' ELSE 'idoso' END AS age_band FROM aged)"""


def complete(t):
    return op.complete_person(person(t), side(t), src.AS_OF)


@query("d52_standardise_customers", """
SELECT c_custkey AS customer_id, n_name AS account_name,
       concat_ws(' ', lpad(CAST(c_custkey AS VARCHAR), 8, '0'), c_mktsegment, CAST(c_custkey % 900 AS VARCHAR), NULL,
                 'D' || c_nationkey, n_name, 'SP') AS full_address,
       c_mktsegment AS first_street, CAST(1 AS INTEGER) AS addresses
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def standardise(t):
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("account_id"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("zip"), F.col("c_mktsegment").alias("street"),
        (F.col("c_custkey") % 900).cast("string").alias("number"), F.lit(None).cast("string").alias("complement"),
        F.concat(F.lit("D"), F.col("c_nationkey").cast("string")).alias("district"), F.col("n_name").alias("city"),
        F.lit("SP").alias("state"))
    out = op.standardise(base, src.accounts(t).select("account_id", "account_name"))
    return out.select("customer_id", "account_name", "full_address", F.col("addresses")[0]["street"].alias("first_street"),
                      F.size("addresses").alias("addresses"))


@query("d53_complete_person", f"WITH {COMPLETE} SELECT * FROM complete")
def complete_person(t):
    return complete(t).select(
        "customer_id", "account_id", "tax_id", "name", "sex", "born_on", "is_person", "age", "age_band")


LINES_OF_CUSTOMERS = f"""{SALES}, o AS (
  SELECT customer_id, sale_id, CASE WHEN status <> 'P' THEN sale_id // 2 END AS basket_id, store_id, product_id, sold_on, qty, net,
         CAST(product_id % 24 AS INTEGER) AS hour, p_type IN ('SMALL', 'PROMO') AS is_medicine, p_type AS category, priority, status, sale_kind
  FROM sales JOIN part ON p_partkey = product_id)"""


def lines_of_customers(t):
    return src.sales(t).join(src.products(t).select("product_id", "category"), "product_id").select(
        "customer_id", "sale_id", F.expr("CASE WHEN status <> 'P' THEN sale_id div 2 END").alias("basket_id"), "store_id",
        "product_id", "sold_on", "qty", "net", (F.col("product_id") % 24).cast("int").alias("hour"),
        F.col("category").isin("SMALL", "PROMO").alias("is_medicine"), "category", "priority", "status", "sale_kind")


def mode_sql(name: str, frm: str, key: str, expr: str) -> str:
    """A CTE with the most common value per key, the smallest on ties."""
    return f"""{name} AS (SELECT {key}, arg_min(v, (-k, v)) AS v FROM
      (SELECT {key}, {expr} AS v, count(*) AS k FROM {frm} GROUP BY ALL) WHERE v IS NOT NULL GROUP BY {key})"""


PROFILE = f"""{LINES_OF_CUSTOMERS},
{mode_sql('m1', 'o', 'customer_id', 'store_id')}, {mode_sql('m2', 'o', 'customer_id', 'CAST(day(sold_on) AS INTEGER)')},
{mode_sql('m3', 'o', 'customer_id', 'CAST(dayofweek(sold_on) + 1 AS INTEGER)')}, {mode_sql('m4', 'o', 'customer_id', 'hour')},
agg AS (SELECT customer_id, min(sold_on) AS first_sale, max(sold_on) AS last_sale, count(DISTINCT sale_id) AS sales,
          count(DISTINCT basket_id) AS baskets, count(*) AS items, sum(net) AS value, count(*) FILTER (is_medicine) AS medicines
        FROM o GROUP BY 1),
profile AS (SELECT agg.*, m1.v AS store, m2.v AS day_of_month, m3.v AS weekday, m4.v AS hour,
          {r('CAST(value AS DOUBLE) / sales', 2)} AS ticket, CAST(date_diff('day', first_sale, last_sale) // sales AS INTEGER) AS mean_interval,
          {r('items / sales', 2)} AS items_per_sale, medicines > 0 AS bought_medicine, {r('100.0::DOUBLE * medicines / items', 4)} AS medicine_share
        FROM agg JOIN m1 USING (customer_id) JOIN m2 USING (customer_id) JOIN m3 USING (customer_id) JOIN m4 USING (customer_id))"""


@query("d54_purchase_profile", f"WITH {PROFILE} SELECT * REPLACE ({d('value')} AS value) FROM profile")
def purchase_profile(t):
    return as_doubles(op.purchase_profile(lines_of_customers(t)), "value")


def _rfm_sql(usual: bool) -> str:
    def q(c, rising):
        cuts = [f"{c} <= c{c}[{i}] THEN {i if rising else 6 - i}" for i in range(1, 5)]
        return "CASE " + " ".join(f"WHEN {x}" for x in cuts) + f" ELSE {5 if rising else 1} END"

    rules = " ".join(
        f"WHEN r BETWEEN {lo} AND {hi} AND {s} BETWEEN {a} AND {b} THEN '{name.replace(chr(39), chr(39) * 2)}'"
        for name, (lo, hi), s, (a, b) in op.RFM_RULES)
    p = "[0.2, 0.4, 0.6, 0.8]"
    return f"""
WITH {SALES}, b AS (SELECT customer_id, date_diff('day', max(sold_on), DATE '2001-08-02') AS rr, count(DISTINCT sale_id) AS ff,
     {r('CAST(sum(net) AS DOUBLE) / count(DISTINCT sale_id)', 2)} AS vv FROM sales GROUP BY 1),
c AS (SELECT quantile_cont(rr, {p}) AS crr, quantile_cont(ff, {p}) AS cff, quantile_cont(vv, {p}) AS cvv FROM b),
s AS (SELECT customer_id, {q('rr', not usual)} AS r, {q('ff', usual)} AS f, {q('vv', usual)} AS v FROM b, c),
x AS (SELECT *, (f + v) / 2 AS fv FROM s)
SELECT customer_id, CAST(r AS INTEGER) AS r, CAST(f AS INTEGER) AS f, CAST(v AS INTEGER) AS v, CASE {rules} ELSE '{op.RFM_OTHER}' END AS segment FROM x"""


def _rfm(t, orientation):
    base = src.sales(t).groupBy("customer_id", "sale_id").agg(F.sum("net").alias("n"), F.max("sold_on").alias("d"))
    base = base.groupBy("customer_id").agg(
        F.max("d").alias("last_sale"), F.count(F.lit(1)).alias("sales"),
        F.round(F.sum("n").cast("double") / F.count(F.lit(1)), 2).alias("ticket"))
    return op.rfm_segments(base, src.AS_OF, orientation=orientation).select("customer_id", "r", "f", "v", "segment")


@query("d55_rfm_segments", _rfm_sql(True))
def rfm_segments(t):
    return _rfm(t, "conventional")


@query("d55_rfm_segments_legacy", _rfm_sql(False))
def rfm_segments_legacy(t):
    return _rfm(t, "legacy")


@query("d56_items_by_kind", f"""
WITH {SALES}, {PRODUCTS}
SELECT DISTINCT customer_id, 'restricted' AS kind, s.product_id FROM sales s JOIN products p ON s.product_id = p.product_id WHERE category = 'PROMO'
UNION ALL
SELECT DISTINCT customer_id, 'controlled' AS kind, s.product_id FROM sales s JOIN products p ON s.product_id = p.product_id WHERE size > 45""")
def items_by_kind(t):
    return op.items_by_kind(src.sales(t), src.products(t), {
        "restricted": F.col("category") == "PROMO", "controlled": F.col("size") > 45})


_GROUPS = {
    "size": ("category", ["SMALL", "MEDIUM", "LARGE"]),
    "payment": ("priority", ["1-URGENT", "2-HIGH", "5-LOW"]),
    "channel": ("status", ["O", "F", "P"]),
    "kind": ("sale_kind", ["A", "N", "R"]),
}


def _shares_sql(frm: str, key: str, groups) -> str:
    cols = [key]
    for name, (c, values) in groups.items():
        n = {v: f"count(*) FILTER ({c} = '{v}')" for v in values}
        cols += [f"CASE WHEN count({c}) > 0 THEN {r(f'{n[v]} / count({c})', 6)} END AS \"{name}_{v.lower()}\"" for v in values]
        top = f"greatest({', '.join(n.values())})"
        cols.append(f"CASE WHEN {top} = 0 THEN NULL " + " ".join(f"WHEN {n[v]} = {top} THEN '{v}'" for v in values) + f" END AS {name}_preferred")
    return f"SELECT {', '.join(cols)} FROM {frm} GROUP BY 1"


@query("d57_preferences", f"WITH {LINES_OF_CUSTOMERS} {_shares_sql('o', 'customer_id', _GROUPS)}")
def preferences(t):
    return op.preferences(lines_of_customers(t), "customer_id", _GROUPS)


@query("d58_preferred_forms", f"""
WITH {LINES_OF_CUSTOMERS}, c AS (SELECT customer_id, category, count(*) AS k FROM o GROUP BY ALL),
m AS (SELECT *, max(k) OVER (PARTITION BY customer_id) AS top FROM c)
SELECT customer_id, string_agg(category, '|' ORDER BY category) AS preferred, max(k) AS times FROM m WHERE k = top GROUP BY 1""")
def preferred_forms(t):
    return op.preferred_values(lines_of_customers(t), "customer_id", "category")


# Focus products: the first product of each (name, brand); the others are its alternative codes.
_FAMILY = """fam AS (SELECT p_partkey AS alternative_id, min(p_partkey) OVER (PARTITION BY p_name, p_brand) AS product_id FROM part),
alts AS (SELECT * FROM fam WHERE product_id <> alternative_id)"""


def family(t):
    first = t.part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("product_id"))
    return t.part.join(first, ["p_name", "p_brand"]).select("product_id", F.col("p_partkey").alias("alternative_id"))


@query("d59_product_persona", f"""
WITH {SALES}, {COMPLETE}, {_FAMILY},
u AS (SELECT f.product_id, customer_id, sale_id, net, sold_on FROM sales s JOIN fam f ON s.product_id = f.alternative_id),
ps AS (SELECT product_id, customer_id, sale_id, count(*) AS lines, sum(net) AS value, max(sold_on) AS sold_on FROM u GROUP BY 1, 2, 3),
{mode_sql('w1', 'ps', 'product_id, customer_id', 'CAST(dayofweek(sold_on) + 1 AS INTEGER)')},
{mode_sql('w2', 'ps', 'product_id, customer_id', 'CAST(day(sold_on) AS INTEGER)')},
pc AS (SELECT product_id, customer_id, count(*) AS sales, CAST(sum(lines) AS BIGINT) AS lines, sum(value) AS value, min(sold_on) AS first, max(sold_on) AS last
       FROM ps GROUP BY 1, 2),
e AS (SELECT pc.*, w1.v AS wd, w2.v AS dy, age_band AS ab, sex AS sx FROM pc JOIN w1 USING (product_id, customer_id) JOIN w2 USING (product_id, customer_id)
      LEFT JOIN complete USING (customer_id)),
{mode_sql('z1', 'e', 'product_id', 'wd')}, {mode_sql('z2', 'e', 'product_id', 'dy')}, {mode_sql('z3', 'e', 'product_id', 'ab')}, {mode_sql('z4', 'e', 'product_id', 'sx')},
a AS (SELECT product_id, min(first) AS first_sale, max(last) AS last_sale, count(*) AS buyers, CAST(sum(sales) AS BIGINT) AS sales, CAST(sum(lines) AS BIGINT) AS lines,
        {d('sum(value)')} AS value, {r(f"CAST(sum(CAST({r('CAST(value AS DOUBLE) / sales', 2)} AS DECIMAL(14,2))) AS DOUBLE) / count(*)", 4)} AS ticket,
        {r("sum(date_diff('day', first, last) // sales) / count(*)", 4)} AS interval, count(*) FILTER (lines = 1) AS single_buyers FROM e GROUP BY 1)
SELECT a.*, z1.v AS weekday, z2.v AS day, z3.v AS age_band, z4.v AS sex, {r('100.0::DOUBLE * single_buyers / sales', 4)} AS single_share
FROM a LEFT JOIN z1 USING (product_id) LEFT JOIN z2 USING (product_id) LEFT JOIN z3 USING (product_id) LEFT JOIN z4 USING (product_id)""")
def product_persona(t):
    fam = family(t)
    out = op.product_persona(
        src.sales(t), fam.select("product_id").distinct(), fam.filter("product_id <> alternative_id"),
        complete(t).select("customer_id", "age_band", "sex"))
    return as_doubles(out, "value")


@query("d59_basket_persona", f"WITH {LINES_OF_CUSTOMERS} {_shares_sql('o', 'product_id', {k: _GROUPS[k] for k in ('channel', 'kind')})}")
def basket_persona(t):
    return op.basket_persona(lines_of_customers(t), {k: _GROUPS[k] for k in ("channel", "kind")})


@query("d60_family_buyers", f"""
WITH {SALES}, b AS (SELECT customer_id, count(DISTINCT sale_id) AS sales FROM sales JOIN part ON p_partkey = product_id WHERE p_name LIKE '%widget%' GROUP BY 1),
h AS (SELECT c_custkey % 997 AS person_id, customer_id, sales, CAST(c_acctbal AS INTEGER) AS updated_on FROM b JOIN customer ON c_custkey = customer_id)
SELECT person_id, customer_id, sales FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY updated_on DESC, customer_id DESC) AS k FROM h) WHERE k = 1""")
def family_buyers(t):
    people = t.customer.select(F.col("c_custkey").alias("customer_id"), (F.col("c_custkey") % 997).alias("person_id"),
                               F.round("c_acctbal").cast("int").alias("updated_on"))
    return op.family_buyers(src.sales(t), src.products(t), people, "Widget").select("person_id", "customer_id", "sales")


@query("d61_customers_to_enrich", f"""
WITH {COMPLETE}, b AS (SELECT o_custkey AS customer_id, count(*) AS baskets FROM orders GROUP BY 1),
x AS (SELECT c.*, baskets FROM complete c JOIN b USING (customer_id)),
w AS (SELECT * FROM x WHERE tax_id IS NOT NULL AND baskets > 1 AND is_person AND (born_on IS NULL OR sex IS NULL OR name IS NULL OR age < 0 OR age > 105)
      AND (age IS NULL OR age >= 18 OR age < 0 OR age > 105))
SELECT min(customer_id) AS customer_id, tax_id FROM w WHERE tax_id NOT IN (SELECT tax_id FROM side WHERE tax_id LIKE '%42' AND CAST(tax_id AS BIGINT) % 5 = 0) GROUP BY tax_id""")
def customers_to_enrich(t):
    baskets = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.count(F.lit(1)).alias("baskets"))
    done = side(t).filter("tax_id LIKE '%42' AND CAST(tax_id AS BIGINT) % 5 = 0")
    return op.to_enrich(complete(t).join(baskets, "customer_id"), done).select("customer_id", "tax_id")
