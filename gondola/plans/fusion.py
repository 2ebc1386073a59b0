"""Master data and entity resolution over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.functions.text import slug
from gondola.operators import fusion as op
from gondola.operators import kit
from gondola.plans import inputs as src
from gondola.plans.inputs import PRODUCTS, key_sql, nothing_sql, slug_sql
from gondola.plans.registry import query
from gondola.sources.feeds import BLACK, FEEDS, NO_STRIPE, RED, RED_RESTRICTED, parse_feed

# --- sources -------------------------------------------------------------------------------------

_SOURCES = {
    "own": ("product_id % 3 <> 0", "CASE WHEN product_id % 4 = 0 THEN 'n/a' ELSE name END", "CASE WHEN product_id % 5 = 0 THEN '--' ELSE brand END", "'' || (size * 11)"),
    "feed": ("product_id % 2 = 0", "upper(name)", "CASE WHEN product_id % 7 = 0 THEN 'aaa' ELSE lower(brand) END", "CASE WHEN size > 30 THEN 'x' ELSE 'size ' || size END"),
    "market": ("product_id % 5 <> 1", "name || ' ' || category", "' '", "'' || size"),
}


def _source(t, name):
    where, n, b, s = _SOURCES[name]
    return src.products(t).filter(where).selectExpr("ean", f"{n} AS name", f"{b} AS brand", f"{s} AS dosage")


def _fused_sql(first: dict[str, list[str]]) -> str:
    out = ["k.ean"]
    for c in ("name", "brand", "dosage"):
        order = first.get(c, []) + [s for s in _SOURCES if s not in first.get(c, [])]
        out.append("coalesce(" + ", ".join(f"CASE WHEN NOT {nothing_sql(f'{s}.{c}', c == 'dosage')} THEN {s}.{c} END" for s in order) + f") AS {c}")
    ctes = ", ".join(f"{s} AS (SELECT ean, {n} AS name, {b} AS brand, {z} AS dosage FROM products WHERE {w})" for s, (w, n, b, z) in _SOURCES.items())
    joins = " ".join(f"LEFT JOIN {s} ON {s}.ean = k.ean" for s in _SOURCES)
    return f"WITH {PRODUCTS}, {ctes}, k AS ({' UNION '.join(f'SELECT ean FROM {s}' for s in _SOURCES)}) SELECT {', '.join(out)} FROM k {joins}"


@query("d01_fuse_sources", _fused_sql({"name": ["market", "feed"]}))
def fuse_sources(t):
    return op.fuse_sources({s: _source(t, s) for s in _SOURCES}, "ean", ["name", "brand", "dosage"], {"name": ["market", "feed"]}, ["dosage"])


_VERSIONS = """vers AS (SELECT product_id, name, brand, CASE WHEN product_id % 5 <> 0 THEN category END AS category, CASE WHEN product_id % 4 <> 0 THEN size END AS size,
  CASE WHEN product_id % 3 = 0 THEN NULL WHEN product_id % 3 = 1 THEN ' ' ELSE 'text ' || product_id END AS description FROM products)"""


@query("d02_most_complete", f"""
WITH {PRODUCTS}, {_VERSIONS}, s AS (SELECT *, (category IS NOT NULL)::INT + (size IS NOT NULL)::INT + (description IS NOT NULL AND trim(description) <> '')::INT AS sc FROM vers),
b AS (SELECT *, row_number() OVER (PARTITION BY name, brand ORDER BY sc DESC, product_id) AS k FROM s),
l AS (SELECT name, brand, arg_max(description, (length(description), description)) AS lo FROM s WHERE description IS NOT NULL GROUP BY 1, 2)
SELECT name, brand, product_id, category, size, CASE WHEN description IS NULL OR trim(description) = '' THEN lo ELSE description END AS description
FROM b LEFT JOIN l USING (name, brand) WHERE k = 1""")
def most_complete(t):
    df = src.products(t).selectExpr(
        "product_id", "name", "brand", "CASE WHEN product_id % 5 <> 0 THEN category END AS category", "CASE WHEN product_id % 4 <> 0 THEN size END AS size",
        "CASE WHEN product_id % 3 = 0 THEN NULL WHEN product_id % 3 = 1 THEN ' ' ELSE 'text ' || product_id END AS description")
    return op.most_complete(df, ["name", "brand"], [F.col("product_id")])


_PAYLOAD = "'{\"title\":' || CASE WHEN product_id % 3 = 0 THEN 'null' ELSE '\"' || name || '\"' END || ',\"text\":\"' || repeat('ab ', size) || product_id || '\",\"maker\":' || CASE WHEN product_id % 4 < 3 THEN 'null' ELSE '\"m' || product_id || '\"' END || '}'"


@query("d03_store_overrides", f"""
WITH {PRODUCTS}, x AS (SELECT brand, category, product_id, CASE WHEN product_id % 3 <> 0 THEN name END AS title, repeat('ab ', size) || product_id AS text, CASE WHEN product_id % 4 = 3 THEN 'm' || product_id END AS maker FROM products)
SELECT brand, category, arg_min(title, product_id) FILTER (title IS NOT NULL) AS title, arg_max(text, (length(text), text)) AS text, arg_min(maker, product_id) FILTER (maker IS NOT NULL) AS maker FROM x GROUP BY 1, 2""")
def store_overrides(t):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("title", "text", "maker")])
    raw = src.products(t).selectExpr("brand", "category", "product_id", f"{_PAYLOAD} AS payload")
    return op.store_overrides(raw, ["brand", "category"], "payload", schema, ["text"], ["product_id"])


@query("d04_assign_ids", f"""
WITH {PRODUCTS}, reg AS (SELECT ean, 'old-' || product_id AS id FROM products WHERE product_id % 4 = 0), x AS (
  SELECT ean, CASE WHEN product_id % 10 = 5 THEN 'given-' || product_id END AS id, md5(ean) AS h FROM products),
r AS (SELECT x.ean, coalesce(x.id, reg.id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)) AS id, reg.id IS NULL AS new FROM x LEFT JOIN reg ON reg.ean = x.ean)
SELECT ean, id, 'row' AS part FROM r UNION ALL SELECT ean, id, 'registry' FROM reg UNION ALL SELECT ean, id, 'registry' FROM r WHERE new""")
def assign_ids(t):
    p = src.products(t)
    registry = p.filter("product_id % 4 = 0").selectExpr("ean", "'old-' || product_id AS id")
    rows = p.selectExpr("ean", "CASE WHEN product_id % 10 = 5 THEN 'given-' || product_id END AS id")
    with_ids, registered = op.assign_ids(rows, "ean", registry)
    return with_ids.select("ean", "id", F.lit("row").alias("part")).unionByName(registered.withColumn("part", F.lit("registry")))


# Codes of the stand-in: the product number with zero to two leading zeros, so that variants meet.
_CODES = "codes AS (SELECT repeat('0', CAST(product_id % 3 AS INTEGER)) || (product_id // 3 + 1) AS code, CASE WHEN product_id % 5 <> 0 THEN name END AS name, CASE WHEN product_id % 4 <> 0 THEN brand END AS brand FROM products)"


def _codes(t):
    return src.products(t).selectExpr(
        "repeat('0', CAST(product_id % 3 AS INT)) || (product_id div 3 + 1) AS code", "CASE WHEN product_id % 5 <> 0 THEN name END AS name",
        "CASE WHEN product_id % 4 <> 0 THEN brand END AS brand")


_ELECTED = f"""{PRODUCTS}, {_CODES}, z AS (SELECT *, regexp_replace(code, '^0+', '') AS canonical, round(1 - ((name IS NULL)::INT + (brand IS NULL)::INT) / 3, 6) AS completeness, code LIKE '00%7' AS in_campaign FROM codes),
pr AS (SELECT canonical, code AS principal FROM (SELECT *, row_number() OVER (PARTITION BY canonical ORDER BY in_campaign DESC, completeness DESC, code) AS k FROM z) WHERE k = 1),
el AS (SELECT z.*, principal, code = principal AS is_principal FROM z JOIN pr USING (canonical))"""


def _elected(t):
    codes = _codes(t)
    return op.elect_principal(codes, "code", codes.filter("code LIKE '00%7'").select("code"))


@query("d05_elect_principal", f"WITH {_ELECTED} SELECT code, canonical, CAST(completeness AS DOUBLE) AS completeness, in_campaign, principal, is_principal FROM el")
def elect_principal(t):
    return _elected(t).select("code", "canonical", "completeness", "in_campaign", "principal", "is_principal")


@query("d06_fill_from_principal", f"""
WITH {_ELECTED} SELECT e.code, CASE WHEN e.is_principal THEN e.name ELSE coalesce(e.name, m.name) END AS name, CASE WHEN e.is_principal THEN e.brand ELSE coalesce(e.brand, m.brand) END AS brand
FROM el e JOIN el m ON m.canonical = e.canonical AND m.is_principal""")
def fill_from_principal(t):
    return op.fill_from_principal(_elected(t), "canonical", ["name", "brand"]).select("code", "name", "brand")


@query("d07_name_links", f"""
WITH {PRODUCTS}, a AS (SELECT DISTINCT ean AS code, trim(unnest([name, ' ' || split_part(name, ' ', 1) || ' ring', category])) AS name FROM products)
SELECT a.code, a.name, count(DISTINCT p.ean) AS matched FROM a JOIN products p ON trim(p.name) = a.name AND p.ean <> a.code GROUP BY 1, 2""")
def name_links(t):
    p = src.products(t)
    alternates = p.select(
        F.col("ean").alias("code"), F.array("name", F.concat(F.lit(" "), F.split_part("name", F.lit(" "), F.lit(1)), F.lit(" ring")), "category").alias("names"))
    return op.name_links(p.select(F.col("ean").alias("code"), "name"), alternates)


# Alternative codes of the stand-in: arithmetic chains of several lengths, one list over the limit.
_ALTS = """adj AS (SELECT p_partkey AS code, CASE WHEN p_partkey = 77 THEN range(1, 61) WHEN p_partkey % 3 = 0 THEN [p_partkey * 2] WHEN p_partkey % 10 = 1 THEN [p_partkey + 7, p_partkey + 19] ELSE [] END AS alternatives FROM part)"""


def _alternatives(t):
    k = F.col("p_partkey")
    return t.part.select(k.alias("code"), F.when(k == 77, F.sequence(F.lit(1).cast("long"), F.lit(60).cast("long"))).when(k % 3 == 0, F.array(k * 2))
                         .when(k % 10 == 1, F.array(k + 7, k + 19)).otherwise(F.array().cast("array<bigint>")).alias("alternatives"))


def _closure_sql(where: str) -> str:
    return f"""
WITH RECURSIVE {_ALTS}, e0 AS (SELECT code AS a, unnest(alternatives) AS b FROM adj WHERE {where}), e1 AS (SELECT a, b FROM e0 WHERE a <> b),
e AS (SELECT a, b FROM e1 UNION SELECT b, a FROM e1), reach(a, b) AS (SELECT a, a FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
c AS (SELECT a AS code, min(b) AS component FROM reach GROUP BY 1)
SELECT code, component, count(*) OVER (PARTITION BY component) AS members FROM c"""


@query("d08_closure", _closure_sql("len(alternatives) > 0"))
def closure(t):
    return op.closure(_alternatives(t))


_MAKERS = """mk AS (SELECT p_partkey AS code, p_brand AS brand, CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS maker, [p_partkey + 1, p_partkey + 25, (p_partkey * 7) % 2000] AS alternatives FROM part)"""
_SAME = f"""{_MAKERS}, ep AS (SELECT DISTINCT code, brand, maker, unnest(alternatives) AS alternative FROM mk), jd AS (
  SELECT e.code, e.alternative, coalesce({key_sql('e.brand')} = {key_sql('o.brand')} AND {key_sql('e.maker')} = {key_sql('o.maker')}, false) AS same FROM ep e LEFT JOIN mk o ON o.code = e.alternative)"""


def _same_maker(t):
    k = F.col("p_partkey")
    rows = t.part.select(k.alias("code"), F.col("p_brand").alias("brand"), F.when(k % 9 != 0, F.col("p_type")).alias("maker"), F.array(k + 1, k + 25, (k * 7) % 2000).alias("alternatives"))
    return op.same_maker(rows)


@query("d09_same_maker", f"WITH {_SAME} SELECT code, alternative FROM jd WHERE same")
def same_maker(t):
    return _same_maker(t)[0]


@query("d09_rejected_alternatives", f"WITH {_SAME} SELECT code, alternative FROM jd WHERE NOT same")
def rejected_alternatives(t):
    return _same_maker(t)[1]


@query("d10_overlay_exact", f"""
WITH {PRODUCTS} SELECT ean, CASE WHEN product_id % 8 = 0 THEN 'fixed' ELSE name END AS name, CASE WHEN product_id % 16 = 0 THEN NULL WHEN product_id % 8 = 0 THEN 'B' ELSE brand END AS brand FROM products""")
def overlay_exact(t):
    p = src.products(t)
    fix = p.filter("product_id % 8 = 0").selectExpr("ean", "'fixed' AS name", "CASE WHEN product_id % 16 <> 0 THEN 'B' END AS brand")
    return op.overlay_exact(p.select("ean", "name", "brand"), fix, "ean", ["name", "brand"])


_STATUS = f"""{_ELECTED}, sa AS (SELECT code, canonical, principal, in_campaign, name, CASE WHEN length(code) % 2 = 0 THEN 'x' END AS alt FROM el),
st AS (SELECT *, principal <> code AND alt IS NULL AS alone FROM sa),
cs AS (SELECT code, in_campaign, name, CASE WHEN principal = code OR alone THEN 'active' ELSE 'inactive' END AS status, CASE WHEN alone THEN canonical ELSE coalesce(alt, '') END AS alternatives FROM st)"""


def _status(t):
    rows = _elected(t).withColumn("alternatives", F.when(F.length("code") % 2 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")))
    return op.code_status(rows)


@query("d11_code_status", f"WITH {_STATUS} SELECT code, status, alternatives FROM cs")
def code_status(t):
    return _status(t).select("code", "status", F.array_join("alternatives", "|").alias("alternatives"))


@query("d12_final_survivors", f"""
WITH {_STATUS}, d AS (SELECT substr(code, 1, 3) AS code, status, in_campaign, CASE WHEN length(code) % 3 = 0 THEN 'campaign list' WHEN length(code) % 3 = 1 THEN 'the guide' ELSE 'other' END AS source, code AS id FROM cs)
SELECT code, id, status, source FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY status <> 'active', NOT in_campaign, CASE WHEN contains(source, 'campaign') THEN 0 WHEN contains(source, 'guide') THEN 1 ELSE 2 END, id) AS k FROM d) WHERE k = 1""")
def final_survivors(t):
    rows = _status(t).select(
        F.substring("code", 1, 3).alias("code"), "status", "in_campaign", F.col("code").alias("id"),
        F.when(F.length("code") % 3 == 0, "campaign list").when(F.length("code") % 3 == 1, "the guide").otherwise("other").alias("source"))
    return op.final_survivors(rows, "code").select("code", "id", "status", "source")


@query("d13_merge_codes", f"""
WITH {PRODUCTS} SELECT ean, CASE WHEN product_id % 2 = 0 THEN concat_ws('|', ean, CASE WHEN product_id % 3 = 0 THEN '7896206403638' END) ELSE CASE WHEN product_id % 3 = 0 THEN '7896206403638|' ELSE '' END || '12348' END AS codes FROM products""")
def merge_codes(t):
    p = src.products(t)
    a = F.when(F.col("product_id") % 2 == 0, F.array("ean", F.lit("1234"), F.lit("9912345678901"))).otherwise(F.lit(None))
    b = F.array(F.when(F.col("product_id") % 3 == 0, "7896206403638"), F.when(F.col("product_id") % 2 == 0, F.col("ean")).otherwise("12348"))
    return p.select("ean", F.array_join(op.merge_codes(a, b), "|").alias("codes"))


# --- registry matching ---------------------------------------------------------------------------

# Products carry their name (some with a suffix) as brand; registry entries spell the names in seven ways.
_BRAND = "CASE WHEN p_partkey % 4 = 0 THEN p_name || '-' || lower(p_type) WHEN p_partkey % 4 = 1 THEN p_name ELSE p_name || ' x' END"
_REG = "CASE WHEN p_partkey % 10 = 0 THEN 'R' || (p_partkey % 200) END"
_SPELL = "CASE v WHEN 0 THEN nm WHEN 1 THEN replace(nm, 'e', 'a') WHEN 2 THEN nm || ' ab' WHEN 3 THEN split_part(nm, ' ', 1) || ' ' || split_part(nm, ' ', 2) || 's' WHEN 4 THEN split_part(nm, ' ', 2) WHEN 5 THEN 'unseen ' || nm ELSE nm || ' zz' END"
_ENTRIES = f"""en AS (SELECT nm || '/' || v AS entry_id, {_SPELL} AS name, 'ing ' || length(nm) AS ingredient, CASE WHEN v = 4 THEN split_part(nm, ' ', 1) WHEN v = 6 THEN 'large' END AS maker,
  CASE WHEN v % 2 = 0 THEN 'reference' ELSE 'similar' END AS kind, CASE WHEN v = 5 THEN 'R' || (k % 200) END AS registration FROM (SELECT p_name AS nm, min(p_partkey) AS k FROM part GROUP BY 1) , (SELECT unnest(range(0, 7)) AS v)),
pd AS (SELECT p_partkey AS code, {_BRAND} AS brand, 'ing ' || (length(p_name) + p_partkey % 2) AS ingredient, {_REG} AS registration FROM part)"""


def _registry(t):
    names = t.part.groupBy(F.col("p_name").alias("nm")).agg(F.min("p_partkey").alias("k"))
    entries = names.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(6)))).selectExpr(
        "nm || '/' || v AS entry_id", f"{_SPELL} AS name", "'ing ' || length(nm) AS ingredient",
        "CASE WHEN v = 4 THEN split_part(nm, ' ', 1) WHEN v = 6 THEN 'large' END AS maker",
        "CASE WHEN v % 2 = 0 THEN 'reference' ELSE 'similar' END AS kind", "CASE WHEN v = 5 THEN 'R' || (k % 200) END AS registration")
    products = t.part.selectExpr("p_partkey AS code", f"{_BRAND} AS brand", "'ing ' || (length(p_name) + p_partkey % 2) AS ingredient", f"{_REG} AS registration")
    return entries, products


_CASCADE = f"""{_ENTRIES}, l AS (SELECT *, {slug_sql('name')} AS s FROM en), q AS (SELECT code, brand, registration AS rg, ingredient AS ig, {slug_sql('brand')} AS b FROM pd),
m1 AS (SELECT l.*, code, brand, 1 AS stage FROM l JOIN q ON l.registration = rg),
r2 AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM m1 WHERE m1.s = l.s AND m1.ingredient = l.ingredient AND coalesce(m1.maker, '') = coalesce(l.maker, ''))),
m2 AS (SELECT r2.*, code, brand, 2 AS stage FROM r2 JOIN q ON s = b), r3 AS (SELECT * FROM l WHERE s NOT IN (SELECT s FROM m1 UNION SELECT s FROM m2)),
m3 AS (SELECT r3.*, code, brand, 3 AS stage FROM r3 JOIN q ON maker IS NOT NULL AND b = {slug_sql("s || '-' || maker")}), r4 AS (SELECT * FROM r3 WHERE s NOT IN (SELECT s FROM m3)),
m4 AS (SELECT r4.*, code, brand, 4 AS stage FROM r4 JOIN q ON length(s) > 5 AND starts_with(b, s || '-')), r5 AS (SELECT * FROM r4 WHERE s NOT IN (SELECT s FROM m4)),
m5 AS (SELECT r5.*, code, brand, 5 AS stage FROM r5 JOIN q ON length(s) > 5 AND starts_with(b, regexp_replace(s, '-(...|..|.|.-.|..-.|.-..)$', '') || '-')), r6 AS (SELECT * FROM r5 WHERE s NOT IN (SELECT s FROM m5)),
m6 AS (SELECT r6.*, code, brand, 6 AS stage FROM r6 JOIN q ON length(s) > 5 AND levenshtein(b, s) < 2 AND levenshtein({slug_sql('ingredient')}, {slug_sql('ig')}) < 2),
cm AS (SELECT DISTINCT entry_id, name, ingredient, maker, kind, registration, code, brand AS matched_brand, stage FROM (FROM m1 UNION ALL FROM m2 UNION ALL FROM m3 UNION ALL FROM m4 UNION ALL FROM m5 UNION ALL FROM m6))"""


@query("d14_cascade_match", f"WITH {_CASCADE} SELECT entry_id, code, matched_brand, kind, stage FROM cm")
def cascade_match(t):
    return op.cascade_match(*_registry(t)).select("entry_id", "code", "matched_brand", "kind", "stage")


_OTHERS = f"""rf AS (SELECT {slug_sql('p_name')} AS slug, p_partkey AS code FROM part WHERE p_type = 'LARGE'),
ot AS (SELECT {slug_sql("p_name || ' ' || p_brand")} AS slug, CASE WHEN p_partkey % 3 <> 0 THEN 'N' || (p_partkey // 4) END AS registration, p_partkey AS code, p_type AS kind FROM part WHERE p_type <> 'LARGE'),
ent AS (SELECT {slug_sql('p_name')} AS reference_slug, {slug_sql("p_name || ' ' || p_brand")} AS name_slug, CASE WHEN p_partkey % 5 < 2 THEN 'N' || (p_partkey // 4) END AS registration FROM part)"""


@query("d15_interchangeable_pairs", f"""
WITH {_OTHERS}, x AS (SELECT DISTINCT pr.code AS reference_code, ps.code AS other_code, kind FROM ent m JOIN rf pr ON pr.slug = m.reference_slug JOIN ot ps ON
  (m.registration IS NOT NULL AND ps.registration IS NOT NULL AND m.registration = ps.registration) OR ((m.registration IS NULL OR ps.registration IS NULL) AND ps.slug = m.name_slug))
SELECT * FROM x WHERE NOT (reference_code % 2 = 0 AND other_code - reference_code IN (1, 3))""")
def interchangeable_pairs(t):
    k, name = F.col("p_partkey"), slug(F.col("p_name"))
    full, number = slug(F.concat_ws(" ", "p_name", "p_brand")), F.expr("'N' || (p_partkey div 4)")
    refs = t.part.filter("p_type = 'LARGE'").select(name.alias("slug"), k.alias("code"))
    others = t.part.filter("p_type <> 'LARGE'").select(
        full.alias("slug"), F.when(k % 3 != 0, number).alias("registration"), k.alias("code"), F.col("p_type").alias("kind"))
    entries = t.part.select(name.alias("reference_slug"), full.alias("name_slug"), F.when(k % 5 < 2, number).alias("registration"))
    denied = refs.select(F.col("code").alias("reference_code")).filter("reference_code % 2 = 0").withColumn(
        "other_code", F.explode(F.array(F.col("reference_code") + 1, F.col("reference_code") + 3)))
    return op.interchangeable_pairs(entries, refs, others, denied)


_REFTEXT = "CASE product_id % 4 WHEN 0 THEN upper(name) || '; ' || category || ' (x)' WHEN 1 THEN name || '/' || category || ' e ' || brand WHEN 2 THEN name || ' similar abc' ELSE name || '®' END"


@query("d16_reference_names", f"""
WITH {PRODUCTS}, x AS (SELECT ean, regexp_replace(regexp_replace(lower({_REFTEXT}), '\\(.*\\)', ''), '(medicamento|n/a|referência|similar).*$', '') AS t FROM products),
y AS (SELECT ean, unnest(string_split(t, '; ')) AS p FROM x), z AS (SELECT ean, unnest(string_split(p, '/')) AS p FROM y), w AS (SELECT ean, unnest(string_split(p, ' e ')) AS p FROM z)
SELECT DISTINCT ean, trim(regexp_replace(regexp_replace(p, '®$', ''), '(m\\.s|[&,]|genérico).*$', '')) AS reference FROM w WHERE trim(regexp_replace(regexp_replace(p, '®$', ''), '(m\\.s|[&,]|genérico).*$', '')) <> ''""")
def reference_names(t):
    rows = src.products(t).selectExpr("ean", f"{_REFTEXT} AS reference")
    return op.reference_names(rows, "reference")


# Interchangeable pairs of the stand-in: products of size divisible by five are references of the next two; a guide names more.
_ATTACHED = f"""{PRODUCTS}, q AS (SELECT a.ean AS reference_code, a.name AS reference_name, b.ean AS other_code, b.name AS other_name, lower(b.category) AS kind
  FROM products a JOIN products b ON b.product_id IN (a.product_id + 1, a.product_id + 2) WHERE a.size % 5 = 0),
att AS (SELECT reference_code AS code, 'similar' AS side, other_name AS name, kind FROM q UNION SELECT other_code, 'reference', reference_name, 'reference' FROM q
  UNION SELECT ean, CASE WHEN product_id % 2 = 0 THEN 'similar' ELSE 'reference' END, name || ' ' || brand, 'guide' FROM products WHERE product_id % 3 = 0)"""


def _attached(t):
    p = src.products(t)
    reference = p.filter("size % 5 = 0").select(
        F.col("ean").alias("reference_code"), F.col("name").alias("reference_name"), F.explode(F.array(F.col("product_id") + 1, F.col("product_id") + 2)).alias("product_id"))
    other = p.select("product_id", F.col("ean").alias("other_code"), F.col("name").alias("other_name"), F.lower("category").alias("kind"))
    guide = p.filter("product_id % 3 = 0").select(
        F.col("ean").alias("code"), F.when(F.col("product_id") % 2 == 0, "similar").otherwise("reference").alias("side"),
        F.concat_ws(" ", "name", "brand").alias("name"), F.lit("guide").alias("kind"))
    return op.attached(reference.join(other, "product_id"), guide)


@query("d17_attached", f"WITH {_ATTACHED} SELECT * FROM att")
def attached(t):
    return _attached(t)


@query("d17_attached_lists", f"""
WITH {_ATTACHED}, o AS (SELECT DISTINCT code, side, name AS item FROM att),
r AS (SELECT *, sum(length(item) + 3) OVER (PARTITION BY code, side ORDER BY item) AS run, row_number() OVER (PARTITION BY code, side ORDER BY item) AS k, count(*) OVER (PARTITION BY code, side) AS n FROM o)
SELECT code, side, '["' || string_agg(item, '","' ORDER BY item) || '"]' AS items, max(n) AS available FROM r WHERE run + 1 <= 40 OR k = 1 GROUP BY 1, 2""")
def attached_lists(t):
    return op.capped_lists(_attached(t), ["code", "side"], "name", 40)


@query("d17_capped_lists", f"""
WITH {PRODUCTS}, o AS (SELECT DISTINCT brand, name || ' ' || category AS item FROM products),
r AS (SELECT *, sum(length(item) + 3) OVER (PARTITION BY brand ORDER BY item) AS run, row_number() OVER (PARTITION BY brand ORDER BY item) AS k, count(*) OVER (PARTITION BY brand) AS n FROM o)
SELECT brand, '["' || string_agg(item, '","' ORDER BY item) || '"]' AS items, max(n) AS available FROM r WHERE run + 1 <= 300 OR k = 1 GROUP BY 1""")
def capped_lists(t):
    return op.capped_lists(src.products(t).select("brand", F.concat_ws(" ", "name", "category").alias("item")), "brand", "item", 300)


@query("d18_split_sides", f"""
WITH {PRODUCTS}, a AS (SELECT ean, name FROM products WHERE product_id % 3 <> 0), b AS (SELECT ean, upper(name) AS name FROM products WHERE product_id % 2 = 0 OR product_id % 3 = 0)
SELECT ean, coalesce(a.name, b.name) AS name, CASE WHEN a.ean IS NULL THEN 'right' WHEN b.ean IS NULL THEN 'left' ELSE 'both' END AS side FROM a FULL JOIN b USING (ean)""")
def split_sides(t):
    p = src.products(t)
    return op.split_sides(p.filter("product_id % 3 <> 0").select("ean", "name"), p.filter("product_id % 2 = 0 OR product_id % 3 = 0").select("ean", F.upper("name").alias("name")), "ean")


@query("d19_alternate_names", f"""
WITH {PRODUCTS} SELECT DISTINCT brand, name FROM products WHERE product_id % 3 <> 0""")
def alternate_names(t):
    raw = src.products(t).selectExpr("brand", f"{_PAYLOAD} AS payload")
    return op.alternate_names(raw, "brand", "payload", "$.title")


_GENERIC = "CASE WHEN product_id % 3 = 0 THEN split_part(name, ' ', 1) WHEN product_id % 3 = 1 THEN split_part(name, ' ', 2) END"


@query("d20_looks_generic", f"""
WITH {PRODUCTS} SELECT ean, coalesce(length({key_sql(_GENERIC)}) > 4 AND starts_with({key_sql('name')}, {key_sql(_GENERIC)}), false) AS generic FROM products""")
def looks_generic(t):
    return src.products(t).select("ean", op.looks_generic(F.col("name"), F.expr(_GENERIC)).alias("generic"))


@query("d21_first_known", f"""
WITH {PRODUCTS} SELECT ean, list_filter([category, split_part(name, ' ', 2), split_part(name, ' ', 1)], lambda v: v IN ('ring', 'gear', 'red', 'PROMO'))[1] AS kept FROM products""")
def first_known(t):
    values = F.array("category", F.split_part("name", F.lit(" "), F.lit(2)), F.split_part("name", F.lit(" "), F.lit(1)))
    return src.products(t).select("ean", F.get(op.first_known(values, ["ring", "gear", "red", "PROMO"]), F.lit(0)).alias("kept"))


@query("d22_longest_leaflet", """
SELECT source, coalesce(arg_max(text, (length(text), text)) FILTER (lang = 'de' AND trim(text) <> ''), arg_max(text, (length(text), text)) FILTER (lang = 'en' AND trim(text) <> '')) AS leaflet FROM documents GROUP BY 1""")
def longest_leaflet(t):
    rows = t.documents.select("source", F.when(F.col("lang") == "de", F.col("text")).alias("professional"), F.when(F.col("lang") == "en", F.col("text")).alias("patient"))
    return op.longest_leaflet(rows, "source", "professional", "patient")


@query("d23_conflict_matrix", f"""
WITH {PRODUCTS}, {', '.join(f"{s} AS (SELECT ean, {n} AS name, {b} AS brand FROM products WHERE {w})" for s, (w, n, b, _) in _SOURCES.items())},
u AS ({' UNION ALL '.join(f"SELECT ean, '{s}' AS src, 'name' AS attribute, name AS value FROM {s} UNION ALL SELECT ean, '{s}', 'brand', brand FROM {s}" for s in _SOURCES)})
SELECT ean, attribute, {', '.join(f"max(value) FILTER (src = '{s}') AS {s}" for s in _SOURCES)}, CAST(count(DISTINCT value) AS INTEGER) AS values, count(DISTINCT value) > 1 AS conflict FROM u GROUP BY 1, 2""")
def conflict_matrix(t):
    rows = None
    for s in _SOURCES:
        one = _source(t, s).select("ean", F.lit(s).alias("src"), "name", "brand")
        rows = one if rows is None else rows.unionByName(one)
    return op.conflict_matrix(rows, "ean", "src", list(_SOURCES), ["name", "brand"])


# --- feeds ---------------------------------------------------------------------------------------

_TEXTS = {
    "rd": "CASE size % 5 WHEN 0 THEN 'MEDICAMENTO NAO TARJADO' WHEN 1 THEN 'TARJADO EM VERMELHO SEM RETENCAO DA RECEITA' WHEN 2 THEN 'TARJADO EM VERMELHO COM RETENCAO DA RECEITA' WHEN 3 THEN 'TARJA PRETA' END",
    "anvisa": "CASE size % 4 WHEN 0 THEN 'Tarja Vermelha' WHEN 1 THEN 'Tarja Vermelha sob restrição' WHEN 2 THEN 'Tarja Preta' ELSE 'Tarja Sem Tarja' END",
    "kind": "CASE size % 5 WHEN 0 THEN 'Genérico' WHEN 1 THEN 'Novo' WHEN 2 THEN 'Similar' WHEN 3 THEN '   -   ' ELSE 'Outra' END",
    "age": "CASE size % 3 WHEN 0 THEN 'Adulto e Pediátrico' WHEN 1 THEN 'Adulto' ELSE 'Pediátrico acima de 2 anos' END",
}
_STRIPES = {
    "rd": f"CASE WHEN size % 4 > 0 THEN CASE size % 5 WHEN 0 THEN '{NO_STRIPE}' WHEN 1 THEN '{RED}' WHEN 2 THEN '{RED_RESTRICTED}' WHEN 3 THEN '{BLACK}' END END",
    "anvisa": f"CASE size % 4 WHEN 0 THEN '{RED}' WHEN 1 THEN '{RED_RESTRICTED}' WHEN 2 THEN '{BLACK}' ELSE '{NO_STRIPE}' END",
}
_KIND = "CASE size % 5 WHEN 0 THEN 'Medicamento Genérico - Lei 9.787/99' WHEN 1 THEN 'Medicamento Referência' WHEN 2 THEN 'Medicamento Similar' WHEN 3 THEN NULL ELSE 'Outra' END"
_AGE = "CASE size % 3 WHEN 0 THEN 'todos' WHEN 1 THEN 'adulto' ELSE 'crianca' END"
_SHOWN = ["code", "alternatives", "name", "brand", "maker", "ingredient", "kind", "stripe", "categories", "is_medicine", "is_striped", "is_otc", "is_controlled", "age_group", "source"]


def _flags(stripe: str) -> dict[str, str]:
    return {"stripe": stripe, "is_striped": f"coalesce({stripe} <> '{NO_STRIPE}', false)", "is_otc": f"{stripe} = '{NO_STRIPE}'",
            "is_controlled": f"coalesce({stripe} IN ('{BLACK}', '{RED_RESTRICTED}'), false)"}


def _feed_sql(source: str, where: str, **columns: str) -> str:
    exprs = {c: "NULL::BOOLEAN" if c.startswith("is_") else "NULL::VARCHAR" for c in _SHOWN} | {
        "code": "ean", "alternatives": "''", "categories": "NULL::VARCHAR", "is_medicine": "true", "source": f"'{source}'"} | columns
    return f"WITH {PRODUCTS} SELECT {', '.join(f'{exprs[c]} AS {c}' for c in _SHOWN)} FROM products WHERE {where}"


def _feed(t, source, *raw):
    out = parse_feed(src.products(t).selectExpr(*raw), FEEDS[source])
    return out.withColumns({"alternatives": F.array_join("alternatives", "|"), "categories": F.array_join("categories", "|")}).select(*_SHOWN)


@query("d24_feed_rd", _feed_sql("RD", "true", name="name", brand="brand", maker="category", ingredient="'i' || size", categories="category || '|' || brand",
       is_medicine="size % 4 > 0", **(_flags(_STRIPES["rd"]) | {"is_striped": "size % 4 > 1"})))
def feed_rd(t):
    return _feed(t, "RD", "ean", "name", "brand AS marca", "category AS fabricante", "'i' || size AS principioativonovo", "'1mg' AS dosagem",
                 "'<p>a</p>' AS description", "array(category, brand) AS breadcrumb", "size % 4 AS codtarja", f"{_TEXTS['rd']} AS descricaotarja")


@query("d24_feed_minas_mais", _feed_sql("MINAS_MAIS", "product_id % 9 <> 0", maker="category", is_medicine="NULL::BOOLEAN", alternatives="'77|' || size"))
def feed_minas_mais(t):
    return _feed(t, "MINAS_MAIS", "ean AS ean_preferencial", "CASE WHEN product_id % 9 = 0 THEN ' ' ELSE category END AS laboratorio", "' 77, ,' || size AS eans_cadastrados")


@query("d24_feed_iqvia", _feed_sql("IQVIA", "true", code="'' || CAST(ean AS BIGINT)", name="name || ' 10cp'", brand="name", maker="brand", ingredient="CASE WHEN size % 2 = 0 THEN category END",
       is_medicine="size > 20", is_striped="size % 3 = 0", categories="CASE WHEN category <> 'PROMO' THEN category || CASE WHEN size % 2 = 0 THEN ' -> ' || brand ELSE '' END END"))
def feed_iqvia(t):
    return _feed(t, "IQVIA", "ean AS cd_ean", "name || ' 10cp' AS apresentacao", "name AS produto", "brand AS laboratorio", "CASE WHEN size % 2 = 0 THEN category ELSE 'N/I' END AS molecula_br",
                 "CASE WHEN category = 'PROMO' THEN 'NOT OTC' ELSE category END AS cc_1_desc", "CASE WHEN size % 2 = 0 THEN brand END AS cc_2_desc", "category AS cc_3_desc",
                 "CAST(NULL AS STRING) AS cc_4_desc", "size > 20 AS fg_medicamento", "CASE WHEN size % 3 = 0 THEN 'E' WHEN size % 3 = 1 THEN 'O' END AS otc_rx")


_ANVISA = dict(name="name || ', cx'", brand="name", maker="brand", ingredient="category", kind=_KIND, **(
    _flags(_STRIPES["anvisa"]) | {"is_controlled": "size % 4 = 2", "is_otc": "NULL::BOOLEAN"}))
# every fourth product has a second code, which becomes a row of its own
_SECOND = "'2' || substr(ean, 2)"


@query("d24_feed_anvisa", " UNION ALL ".join([
    _feed_sql("Anvisa", "true", alternatives=f"CASE WHEN product_id % 4 = 1 THEN {_SECOND} ELSE '' END", **_ANVISA),
    "SELECT * FROM (" + _feed_sql("Anvisa", "product_id % 4 = 1", code=_SECOND, alternatives="ean", **_ANVISA) + ")"]))
def feed_anvisa(t):
    return _feed(t, "Anvisa", "ean AS ean_1", "CASE WHEN product_id % 4 = 1 THEN '2' || substr(ean, 2) ELSE '    -     ' END AS ean_2", "name AS produto", "'cx' AS apresentacao",
                 "brand AS laboratorio", "category AS substancia", f"{_TEXTS['kind']} AS tipo_de_produto", f"{_TEXTS['anvisa']} AS tarja")


_GROUP = "CASE size % 4 WHEN 0 THEN 'GENERICO' WHEN 1 THEN 'SIMILAR' WHEN 2 THEN 'PROPAGADO' ELSE 'PERFUMARIA' END"


@query("d24_feed_farmarcas", _feed_sql("Farmarcas", "true", name="name || ' ' || 'cx'", brand="name", maker="brand", ingredient="category", is_medicine="size % 4 < 3",
       kind="CASE size % 4 WHEN 0 THEN 'Medicamento Genérico - Lei 9.787/99' WHEN 1 THEN 'Medicamento Similar' END",
       is_otc="CASE WHEN size % 4 = 3 OR size % 3 = 0 THEN true WHEN size % 3 = 1 THEN false END", is_controlled="CASE WHEN size % 4 = 3 THEN false WHEN size % 3 = 1 THEN true WHEN size % 3 = 0 THEN false END"))
def feed_farmarcas(t):
    return _feed(t, "Farmarcas", "ean AS codigo_barras_principal", "name || '>>' AS descricao", "'cx' AS apresentacao", "brand AS fabricante", "category AS substancia_nome", "'1mg' AS concentracao",
                 "'n' AS ncm_descricao", f"{_GROUP} AS grupo_principal", "CASE size % 3 WHEN 0 THEN 'A OTC/MIP' WHEN 1 THEN 'RX B' ELSE 'C' END AS tipo_produto")


@query("d24_feed_anvisa_medicamentos", _feed_sql("AnvisaMedicamentos", "true", name="name || ' cx'", brand="upper(name)", maker="brand", ingredient="category", kind=_KIND, categories="category", age_group=_AGE, **_flags(_STRIPES["anvisa"])))
def feed_anvisa_medicamentos(t):
    return _feed(t, "AnvisaMedicamentos", "ean AS ean_1", "' - ' AS ean_2", "'-' AS ean_3", "name AS produto", "'cx' AS apresentacao", "brand AS laboratorio", "ean AS registro", "category AS substancia",
                 f"{_TEXTS['kind']} AS tipo_de_produto", "category AS ds_categoria_produto", f"{_TEXTS['anvisa']} AS tarja", f"{_TEXTS['age']} AS ds_restricao_uso")


@query("d24_feed_consulta_remedios", _feed_sql("ConsultaRemedios", "true", name="name || ' 20ml'", brand="CASE WHEN size % 2 = 0 THEN brand ELSE name END", maker="category", ingredient="'i' || size",
       kind=_KIND.replace("WHEN 3 THEN NULL", "WHEN 3 THEN '   -   '"), categories="CASE WHEN size % 3 = 0 THEN 'med' ELSE 'prod' END", is_medicine="size % 3 = 0", is_striped="size % 4 = 1", is_otc="size % 4 <> 1"))
def feed_consulta_remedios(t):
    spec = ("map('Código de Barras:', ean, 'Marca:', CASE WHEN size % 2 = 0 THEN brand END, 'Fabricante:', category, 'Princípio Ativo:', 'i' || size, 'Tipo do Medicamento:', "
            f"{_TEXTS['kind']}, 'Categoria do Medicamento:', CASE WHEN size % 3 = 0 THEN 'med' END, 'Categoria do Produto:', 'prod', 'Registro no Ministério da Saúde:', ean, "
            "'Necessita de Receita:', CASE size % 4 WHEN 0 THEN 'Isento de Prescrição Médica' WHEN 1 THEN 'Branca' END) AS especificacoes")
    return _feed(t, "ConsultaRemedios", "CASE WHEN size % 2 = 0 THEN ean END AS ean_apresentacao", "name AS marca", "'20ml' AS nome_complemento", "'d' AS descricao", spec)


@query("d24_feed_sara", _feed_sql("Sara", "true", name="name || ' 5mg'", brand="brand", maker="category", ingredient="'i' || size", kind=_KIND.replace("'Medicamento Referência'", "'Medicamento Novo'").replace("WHEN 3 THEN NULL", "WHEN 3 THEN '   -   '"),
       age_group=_AGE, **_flags(_STRIPES["anvisa"])))
def feed_sara(t):
    return _feed(t, "Sara", "ean", "name AS product_name", "'5mg' AS drug_unit", "CAST(NULL AS STRING) AS drug_quantity", "'d' AS product_description", "ean AS anvisa_code", "'i' || size AS active_ingredient",
                 f"{_TEXTS['anvisa']} AS stripe", f"{_TEXTS['kind']} AS regulatory_class", "category AS manufacturer", "brand AS marketing_company", f"{_TEXTS['age']} AS usage_restrictions")


# --- joins by blocking keys ----------------------------------------------------------------------

@query("j09_contains_join", f"""
WITH {PRODUCTS}, tm AS (SELECT DISTINCT unnest([split_part(name, ' ', 1), substr(name, 3, 4), substr(category, 1, 2)]) AS term FROM products)
SELECT ean, term FROM products JOIN tm ON contains(name, term)""")
def contains_join(t):
    p = src.products(t)
    terms = p.select(F.explode(F.array(
        F.split_part("name", F.lit(" "), F.lit(1)), F.substring("name", 3, 4), F.substring("category", 1, 2))).alias("term"))
    return kit.contains_join(p, "ean", "name", terms, "term")


@query("j10_prefix_join", f"""
WITH {PRODUCTS}, px AS (SELECT DISTINCT substr(name, 1, 3 + product_id % 6) AS prefix FROM products)
SELECT ean, prefix FROM products JOIN px ON starts_with(name, prefix)""")
def prefix_join(t):
    p = src.products(t)
    prefixes = p.select(F.expr("substring(name, 1, CAST(3 + product_id % 6 AS INT))").alias("prefix")).distinct()
    return kit.prefix_join(p.select("ean", "name"), "name", prefixes, "prefix", 3).select("ean", "prefix")


@query("j11_one_edit_pairs", """
WITH a AS (SELECT DISTINCT c_name AS a FROM customer), b AS (SELECT DISTINCT replace(c_name, '#', '') AS b FROM customer)
SELECT a, b FROM a, b WHERE levenshtein(a, b) < 2""")
def one_edit_pairs(t):
    c = t.customer
    return kit.one_edit_pairs(c.select(F.col("c_name").alias("a")), "a", c.select(F.replace("c_name", F.lit("#"), F.lit("")).alias("b")), "b")
