"""Baskets and recommendations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import baskets as op
from gondola.plans import inputs as src
from gondola.plans.customers import _FAMILY, family
from gondola.plans.inputs import FEED, HEADERS, LINES, PRODUCTS, SALES, as_doubles, d, r
from gondola.plans.registry import query


def _rules_sql(item: str, baskets: str, steps: str, names: str, deny: str) -> str:
    """Plain pair self-join; `steps` is the (support, confidence) list of thresholds in order."""
    return f"""
b0 AS ({baskets}),
ok AS (SELECT sale_id FROM b0 GROUP BY 1 HAVING count(*) >= 2), b AS (SELECT * FROM b0 WHERE sale_id IN (FROM ok)),
c AS (SELECT i, count(*) AS n FROM b GROUP BY 1),
f AS (SELECT (SELECT count(*) FROM ok) AS n, (SELECT sum(n) FROM c) / ((SELECT count(*) FROM ok) * (SELECT count(*) FROM c)) AS density),
st AS (SELECT unnest(range(1, len({steps}) + 1)) AS step, unnest({steps}) AS t FROM f),
p AS (SELECT x.i AS a, y.i AS b, count(*) AS together FROM b x JOIN b y ON x.sale_id = y.sale_id AND x.i <> y.i GROUP BY 1, 2),
m AS (SELECT p.*, ca.n AS with_a, cb.n AS with_b, f.n AS transactions, together / f.n AS support, together / ca.n AS confidence,
             (together / ca.n) / (cb.n / f.n) AS lift FROM p JOIN c ca ON ca.i = a JOIN c cb ON cb.i = b, f),
hit AS (SELECT m.*, min(step) AS step FROM m JOIN st ON support >= t[1] - 1e-12 AND confidence >= t[2] - 1e-12 GROUP BY ALL),
chosen AS (SELECT * FROM hit WHERE step <= (SELECT min(step) FROM hit))
SELECT a, b, together, with_a, with_b, transactions, {r('support', 8)} AS support, {r('confidence', 6)} AS confidence, {r('lift', 6)} AS lift,
       CASE WHEN confidence < 1 THEN {r('(1 - with_b / transactions) / (1 - confidence)', 6)} END AS conviction, na.name AS name_a, nb.name AS name_b
FROM chosen JOIN ({names}) na ON na.i = a JOIN ({names}) nb ON nb.i = b
WHERE lift > 1 AND together >= 2 AND na.name <> nb.name AND NOT contains(na.name, '{deny}') AND NOT contains(nb.name, '{deny}')"""


def _steps_sql() -> str:
    out = []
    for mode, bound, sf, s0, cf, c0 in op.DENSITY_MODES:
        s, c = f"greatest({s0}, 2.0::DOUBLE / n, density * {sf}::DOUBLE)", f"greatest({c0}, density * {cf}::DOUBLE)"
        factors, fixed = op.LADDERS[mode]
        steps = [f"[{s}, {c}]"] + [f"[{s} * {a}::DOUBLE, {c} * {b}::DOUBLE]" for a, b in factors] + [f"[{a}::DOUBLE, {b}::DOUBLE]" for a, b in fixed]
        out.append(f"WHEN density > {bound} THEN [{', '.join(steps)}]" if bound else f"ELSE [{', '.join(steps)}]")
    return "CASE " + " ".join(out) + " END"


def _shown(df):
    return df.select(
        "a", "b", "together", "with_a", "with_b", "transactions", F.round("support", 8).alias("support"),
        F.round("confidence", 6).alias("confidence"), F.round("lift", 6).alias("lift"), F.round("conviction", 6).alias("conviction"),
        "name_a", "name_b")


@query("d85_product_rules", f"WITH {LINES}, " + _rules_sql(
    "product_id", "SELECT DISTINCT sale_id, product_id AS i FROM lines", _steps_sql(), "SELECT p_partkey AS i, p_name AS name FROM part", "anvil"))
def product_rules(t):
    names = src.products(t).select("product_id", "name")
    return _shown(op.association_rules(src.lines(t), "product_id", names, deny="anvil", rows=t.line_rows))


@query("d86_category_rules", f"WITH {LINES}, " + _rules_sql(
    "category", "SELECT DISTINCT sale_id, unnest([p_brand, p_type]) AS i FROM lines JOIN part ON p_partkey = product_id", "[[0.001::DOUBLE, 0.005::DOUBLE]]",
    "SELECT DISTINCT unnest([p_brand, p_type]) AS i, i AS name FROM part", "#25"))
def category_rules(t):
    categories = src.products(t).select("product_id", F.array("brand", "category").alias("categories"))
    names = categories.select(F.explode("categories").alias("category")).distinct().withColumn("name", F.col("category"))
    lines = op.category_lines(src.lines(t), categories)
    return _shown(op.association_rules(lines, "category", names, deny="#25", thresholds=(0.001, 0.005)))


@query("d87_publish_rules", f"""
WITH {SALES}, x AS (SELECT product_id AS a, store_id AS b, sold_on AS run, CASE WHEN qty > 3 THEN net END AS score, sale_id FROM sales),
k AS (SELECT *, row_number() OVER (PARTITION BY a, b, year(run) ORDER BY run DESC, sale_id DESC, score DESC) AS n FROM x WHERE score IS NOT NULL)
SELECT a, b, CAST(year(run) AS INTEGER) AS run_year, {d('score')} AS score FROM k WHERE n = 1""")
def publish_rules(t):
    raw = src.sales(t).select(
        F.col("product_id").alias("a"), F.col("store_id").alias("b"), F.year("sold_on").alias("run_year"), "sold_on", "sale_id",
        F.when(F.col("qty") > 3, F.col("net")).cast("double").alias("score"))
    out = op.publish_rules(raw, ["a", "b", "score"], ["a", "b", "run_year"], [F.desc("sold_on"), F.desc("sale_id"), F.desc("score")])
    return out.select("a", "b", "run_year", "score")


# Recommendations of the stand-in: one message per sale; its reference is the smallest product of the
# sale, recommended are the largest one and the one after the reference.
_RECS = f"""{LINES}, m AS (SELECT sale_id AS message_id, sale_id AS basket_id, min(product_id) AS ref, max(product_id) AS top FROM lines GROUP BY 1),
recs AS (SELECT message_id, basket_id, ref, top AS rec FROM m UNION ALL SELECT message_id, basket_id, ref, ref + 1 FROM m)"""


def _recs(t):
    m = src.lines(t).groupBy(F.col("sale_id").alias("message_id")).agg(
        F.min("product_id").alias("ref"), F.max("product_id").alias("top"))
    return m.select("message_id", F.col("message_id").alias("basket_id"), "ref", F.explode(F.array("top", F.col("ref") + 1)).alias("rec"))


@query("d88_attribution", f"""
WITH {_RECS}, c AS (SELECT sale_id AS basket_id, product_id FROM lines WHERE shipped_on < DATE '2001-01-01' GROUP BY ALL),
s AS (SELECT sale_id AS basket_id, product_id, CAST(sum(qty) AS BIGINT) AS qty, sum(net) AS value FROM lines WHERE sale_kind <> 'R' AND shipped_on < DATE '2001-01-01' GROUP BY 1, 2)
SELECT r.*, c1.product_id IS NOT NULL AS ref_in_cart, c2.product_id IS NOT NULL AS rec_in_cart, s1.product_id IS NOT NULL AS ref_sold,
       s2.product_id IS NOT NULL AS rec_sold, s2.qty, {d('round(s2.value, 2)')} AS value, CASE WHEN s2.qty IS NOT NULL THEN 'Converted' ELSE 'Not converted' END AS status
FROM recs r LEFT JOIN c c1 ON c1.basket_id = r.basket_id AND c1.product_id = ref LEFT JOIN c c2 ON c2.basket_id = r.basket_id AND c2.product_id = rec
LEFT JOIN s s1 ON s1.basket_id = r.basket_id AND s1.product_id = ref LEFT JOIN s s2 ON s2.basket_id = r.basket_id AND s2.product_id = rec WHERE ref <> rec""")
def attribution(t):
    cart = src.lines(t).filter("shipped_on < DATE '2001-01-01'").withColumnRenamed("sale_id", "basket_id")
    return as_doubles(op.attribution(_recs(t), cart, cart.filter("sale_kind <> 'R'")), "value")


_KIND = "CASE WHEN k < 30 THEN 'ads' WHEN k < 60 THEN 'focus' WHEN k < 90 THEN 'other' END"


@query("d89_weekly_funnel", f"""
WITH {FEED}, r AS (SELECT user_id * 100 + day(day) AS basket_id, {_KIND} AS kind FROM feed WHERE event_type = 'view'),
b AS (SELECT user_id * 100 + day(day) AS basket_id, min(day) AS opened_on, min(user_id % 7) AS store FROM feed WHERE event_type = 'click' GROUP BY 1),
s AS (SELECT DISTINCT user_id * 100 + day(day) AS basket_id, event_id AS sale_id FROM feed WHERE event_type = 'purchase'),
j AS (SELECT * FROM r FULL JOIN b USING (basket_id) FULL JOIN s USING (basket_id))
SELECT CAST(date_trunc('week', opened_on) AS DATE) AS week, store, count(DISTINCT basket_id) AS baskets, count(DISTINCT sale_id) AS sales,
       count(DISTINCT sale_id) FILTER (kind IS NOT NULL) AS with_any, count(DISTINCT sale_id) FILTER (kind IS NULL) AS without,
       count(DISTINCT sale_id) FILTER (kind = 'ads') AS with_ads, count(DISTINCT sale_id) FILTER (kind = 'focus') AS with_focus
FROM j GROUP BY 1, 2""")
def weekly_funnel(t):
    f = src.feed(t).withColumn("basket_id", F.col("user_id") * 100 + F.dayofmonth("day"))
    recs = f.filter("event_type = 'view'").select("basket_id", F.expr(_KIND).alias("kind"))
    opened = f.filter("event_type = 'click'").groupBy("basket_id").agg(
        F.min("day").alias("opened_on"), F.min(F.col("user_id") % 7).alias("store"))
    sold = f.filter("event_type = 'purchase'").select("basket_id", F.col("event_id").alias("sale_id"))
    return op.weekly_funnel(recs, opened, sold, ["store"])


_PAIRS = f"""{LINES}, prs AS (SELECT min(product_id) AS ref, max(product_id) AS rec FROM lines GROUP BY sale_id)"""


def _pairs(t):
    return src.lines(t).groupBy("sale_id").agg(
        F.min("product_id").alias("ref"), F.max("product_id").alias("rec"))


@query("d90_recommendation_counts", f"WITH {_PAIRS} SELECT ref, rec, count(*) AS times FROM prs GROUP BY 1, 2")
def recommendation_counts(t):
    return op.recommendation_counts(_pairs(t))


@query("d90_top_recommended", f"""
WITH {_PAIRS}, c AS (SELECT ref, rec, count(*) AS times FROM prs GROUP BY 1, 2)
SELECT ref, rec, times FROM (SELECT *, rank() OVER (PARTITION BY ref ORDER BY times DESC) AS k FROM c) WHERE k = 1""")
def top_recommended(t):
    return op.top_recommended(op.recommendation_counts(_pairs(t)))


# Neighbours of the stand-in: the ten products with most revenue whose name ends in the prompt word.
_NEAR = f"""{LINES}, {PRODUCTS}, rev AS (SELECT product_id, sum(net) AS value FROM lines GROUP BY 1),
near AS (SELECT prompt, product_id AS rec, 1 - place / 20.0::DOUBLE AS score, 'phrase ' || product_id AS phrase FROM (
  SELECT split_part(name, ' ', 2) AS prompt, product_id, row_number() OVER (PARTITION BY split_part(name, ' ', 2) ORDER BY value DESC, product_id) AS place
  FROM products JOIN rev USING (product_id)) WHERE place <= 10)"""


def _near(t):
    sold = src.lines(t).groupBy("product_id").agg(F.sum("net").alias("value"))
    named = src.products(t).select("product_id", F.split_part("name", F.lit(" "), F.lit(2)).alias("prompt"))
    best = op.top_sellers(sold.join(named, "product_id"), ["prompt"], 10)
    return best.select("prompt", F.col("product_id").alias("rec"), (1 - F.col("place") / 20.0).alias("score"),
                       F.concat(F.lit("phrase "), F.col("product_id").cast("string")).alias("phrase"))


@query("d91_substitutes", f"""
WITH {_NEAR}, pr AS (SELECT product_id AS focus, split_part(name, ' ', 2) AS prompt, CASE WHEN size < 10 THEN 0.9 WHEN size < 20 THEN 0.8 END AS preset FROM products WHERE category = 'PROMO'),
a AS (SELECT product_id, category IN ('SMALL', 'PROMO') AS med, brand, [split_part(name, ' ', 1), category] AS cats, CASE WHEN size % 3 > 0 THEN size % 3 END AS ing, size % 2 AS route FROM products),
m AS (SELECT focus, rec, coalesce(preset, score) AS score, phrase FROM pr JOIN near USING (prompt) JOIN a x ON x.product_id = focus JOIN a y ON y.product_id = rec
      WHERE (NOT x.med AND NOT y.med AND list_has_any(x.cats, y.cats)) OR (x.med AND y.med AND x.brand <> y.brand AND coalesce(x.ing, -1) = coalesce(y.ing, -1) AND x.route = y.route)
      UNION ALL SELECT focus, focus + 7, 1.0, 'rival' FROM pr WHERE focus % 4 = 0)
SELECT focus, rec, {d('max(score)')} AS score, arg_max(phrase, (score, phrase)) AS phrase FROM m WHERE focus <> rec GROUP BY 1, 2""")
def substitutes(t):
    p = src.products(t)
    prompts = p.filter("category = 'PROMO'").select(
        F.col("product_id").alias("focus"), F.split_part("name", F.lit(" "), F.lit(2)).alias("prompt"),
        F.when(F.col("size") < 10, 0.9).when(F.col("size") < 20, 0.8).alias("preset"))
    described = p.select(
        "product_id", F.col("category").isin("SMALL", "PROMO").alias("is_medicine"), "brand",
        F.array(F.split_part("name", F.lit(" "), F.lit(1)), F.col("category")).alias("categories"),
        F.when(F.col("size") % 3 > 0, (F.col("size") % 3).cast("string")).alias("ingredient"),
        (F.col("size") % 2).cast("string").alias("route"))
    rivals = prompts.filter("focus % 4 = 0").select("focus", (F.col("focus") + 7).alias("rec"), F.lit("rival").alias("phrase"))
    return op.substitutes(prompts, _near(t), described, rivals)


@query("d92_complements", f"""
WITH {_NEAR}, {_FAMILY}, fo AS (SELECT product_id FROM products WHERE category = 'PROMO' AND size < 20),
tg AS (SELECT DISTINCT product_id AS focus, unnest([split_part(name, ' ', 2), CASE WHEN size % 2 = 0 THEN 'gear' ELSE 'ring' END]) AS tag FROM products JOIN fo USING (product_id)),
bar AS (SELECT product_id FROM fo UNION SELECT product_id FROM alts WHERE alternative_id IN (SELECT product_id FROM fo)),
al AS (SELECT prompt AS tag, rec, score, phrase FROM near WHERE rec NOT IN (FROM bar)),
w AS (SELECT * FROM al UNION ALL SELECT tag, alternative_id, score, phrase FROM al JOIN alts ON product_id = rec)
SELECT focus, rec, max(score) AS score, arg_max(phrase, (score, phrase)) AS phrase FROM tg JOIN w USING (tag) GROUP BY 1, 2""")
def complements(t):
    focus = src.products(t).filter("category = 'PROMO' AND size < 20")
    tags = focus.select(F.col("product_id").alias("focus"), F.explode(F.array(
        F.split_part("name", F.lit(" "), F.lit(2)), F.when(F.col("size") % 2 == 0, "gear").otherwise("ring"))).alias("tag"))
    near = _near(t).withColumnRenamed("prompt", "tag")
    return op.complements(tags, near, family(t).filter("product_id <> alternative_id"), focus.select("product_id"))


@query("d93_publish_phrases", f"""
WITH {_PAIRS}, c AS (SELECT DISTINCT ref, rec FROM prs), ph AS (SELECT p_partkey AS rec, CASE WHEN p_size > 25 THEN p_name WHEN p_size > 12 THEN ' ' END AS phrase FROM part)
SELECT ref, rec, CASE WHEN trim(phrase) <> '' THEN phrase END AS phrase, CASE WHEN trim(phrase) <> '' THEN 'published' ELSE 'missing' END AS state FROM c LEFT JOIN ph USING (rec)""")
def publish_phrases(t):
    phrases = t.part.select(F.col("p_partkey").alias("rec"), F.when(F.col("p_size") > 25, F.col("p_name")).when(F.col("p_size") > 12, " ").alias("phrase"))
    good, missing = op.publish_phrases(_pairs(t).select("ref", "rec").distinct(), phrases)
    return good.withColumn("state", F.lit("published")).unionByName(
        missing.withColumn("state", F.lit("missing")), allowMissingColumns=True)


@query("d94_cache_status", f"""
WITH {HEADERS}, e AS (SELECT to_base64(unhex(sha256(customer_id || '|' || status))) AS key, max(sold_on) AS stored_on FROM headers WHERE priority <> '5-LOW' GROUP BY 1),
q AS (SELECT DISTINCT customer_id, status, to_base64(unhex(sha256(customer_id || '|' || status))) AS key FROM headers)
SELECT q.*, stored_on, CASE WHEN date_diff('day', stored_on, DATE '2001-01-01') <= 90 THEN 'HIT' ELSE 'MISS' END AS state FROM q LEFT JOIN e USING (key)""")
def cache_status(t):
    h = src.headers(t).withColumn("key", op.cache_key(F.col("customer_id").cast("string"), F.col("status")))
    entries = h.filter("priority <> '5-LOW'").select("key", F.col("sold_on").alias("stored_on"), F.col("sale_id").alias("seq"))
    return op.cache_status(h.select("customer_id", "status", "key").distinct(), entries, F.lit("2001-01-01").cast("date"), 90)


_JUDGED = f"""{_PAIRS}, {PRODUCTS}, j AS (SELECT ref, rec, (ref + rec) % 3 = 0 AS relevant, category AS segment FROM (SELECT DISTINCT ref, rec FROM prs) JOIN products ON product_id = ref)"""


@query("d95_evaluation", f"""
WITH {_JUDGED}, p AS (SELECT segment, ref, count(*) AS n, count(*) FILTER (relevant) AS good FROM j GROUP BY 1, 2)
SELECT segment, CAST(sum(n) AS BIGINT) AS pairs, count(*) AS refs, {r('sum(good) / sum(n)', 6)} AS precision, {r('count(*) FILTER (good > 0) / count(*)', 6)} AS hit_rate FROM p GROUP BY 1""")
def evaluation(t):
    judged = _pairs(t).select("ref", "rec").distinct().join(
        src.products(t).select(F.col("product_id").alias("ref"), F.col("category").alias("segment")), "ref")
    return op.evaluate(judged.withColumn("relevant", (F.col("ref") + F.col("rec")) % 3 == 0), "segment")


@query("d95_category_overlap", f"""
WITH {_PAIRS}, c AS (SELECT p_partkey AS i, string_split(p_name, ' ') AS cats FROM part), x AS (SELECT list_has_any(a.cats, b.cats) AS h FROM prs JOIN c a ON a.i = ref JOIN c b ON b.i = rec)
SELECT count(*) AS pairs, count(*) FILTER (h) AS overlapping, {r('100.0::DOUBLE * count(*) FILTER (h) / count(*)', 4)} AS share FROM x""")
def category_overlap(t):
    cats = src.products(t).select("product_id", F.split("name", " ").alias("categories"))
    return op.category_overlap(_pairs(t).select("ref", "rec"), cats)


@query("d96_evaluation_set", f"""
WITH {FEED}, p AS (SELECT DISTINCT user_id AS ref, k AS rec FROM feed WHERE day = DATE '2024-01-15'),
s AS (SELECT ref FROM (SELECT DISTINCT ref FROM p) ORDER BY md5('42:' || ref), ref LIMIT 40)
SELECT ref, rec FROM p WHERE ref IN (FROM s)""")
def evaluation_set(t):
    pairs = src.feed(t).select(F.col("user_id").alias("ref"), F.col("k").alias("rec"), "day")
    return op.evaluation_set(pairs, F.lit("2024-01-15").cast("date"), 40, "42")
