"""Enrichment and classification over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import enrich as op
from gondola.operators import neighbours, standardise
from gondola.plans import inputs as src
from gondola.plans.inputs import LINES, PRODUCTS, key_sql, r
from gondola.plans.registry import query


@query("d25_consolidate_flag", f"""
WITH {PRODUCTS}, c AS (SELECT product_id AS code, qty, sale_id, [CASE WHEN qty % 5 = 0 THEN 'Medicamentos ' || qty ELSE 'Outros' END, 'Casa'] AS supers, qty % 9 AS z,
  row_number() OVER (PARTITION BY product_id ORDER BY shipped_on DESC, sale_id DESC, qty DESC) AS k FROM (SELECT l.*, 1 FROM ({LINES[len('lines AS ('):-1]}) l WHERE product_id % 3 <> 0)),
l AS (SELECT code, CASE WHEN z = 0 THEN NULL ELSE len(list_filter(supers, lambda s: starts_with(s, 'Medicamentos'))) > 0 END AS cat FROM c WHERE k = 1)
SELECT product_id AS code, coalesce(CASE WHEN product_id % 11 = 0 THEN size > 25 END, cat, CASE WHEN product_id % 4 <> 0 THEN category = 'PROMO' END) AS flag,
  CASE WHEN product_id % 11 = 0 THEN 'correction' WHEN cat IS NOT NULL THEN 'category' WHEN product_id % 4 <> 0 THEN 'base' END AS source
FROM products LEFT JOIN l ON code = product_id""")
def consolidate_flag(t):
    p = src.products(t)
    base = p.select(F.col("product_id").alias("code"), F.when(F.col("product_id") % 4 != 0, F.col("category") == "PROMO").alias("flag"))
    q = F.col("qty")
    supers = F.array(F.when(q % 5 == 0, F.concat(F.lit("Medicamentos "), q.cast("string"))).otherwise("Outros"), F.lit("Casa"))
    made = src.lines(t).filter("product_id % 3 <> 0").select(
        F.col("product_id").alias("code"), F.col("shipped_on").alias("made_at"), F.struct("sale_id", "qty").alias("seq"),
        F.when(q % 9 == 0, F.array().cast("array<string>")).otherwise(supers).alias("supers"))
    fixed = p.filter("product_id % 11 = 0").select(F.col("product_id").alias("code"), (F.col("size") > 25).alias("flag"))
    return op.consolidate_flag(base, made, fixed, "Medicamentos")


_PA = """pa AS (SELECT ean, CASE WHEN product_id % 3 <> 0 THEN name END AS name, CASE WHEN product_id % 2 = 0 THEN brand END AS brand, category AS text, size AS note FROM products),
au AS (SELECT ean, upper(name) AS name, CASE WHEN product_id % 5 <> 0 THEN 'auth ' || brand END AS brand, repeat(CASE WHEN product_id % 4 = 0 THEN 'long ' ELSE 'b' END, size) AS text, 'R' || product_id AS registration FROM products WHERE product_id % 7 <> 0)"""


@query("d26_merge_by_precedence", f"""
WITH {PRODUCTS}, {_PA} SELECT p.ean, p.note, registration, coalesce(p.name, a.name) AS name, coalesce(a.brand, p.brand) AS brand, CASE WHEN length(a.text) >= 100 THEN p.text ELSE coalesce(a.text, p.text) END AS text
FROM pa p LEFT JOIN au a ON a.ean = p.ean""")
def merge_by_precedence(t):
    p = src.products(t)
    mine = p.selectExpr("ean", "CASE WHEN product_id % 3 <> 0 THEN name END AS name", "CASE WHEN product_id % 2 = 0 THEN brand END AS brand", "category AS text", "size AS note")
    theirs = p.filter("product_id % 7 <> 0").selectExpr(
        "ean", "upper(name) AS name", "CASE WHEN product_id % 5 <> 0 THEN 'auth ' || brand END AS brand",
        "repeat(CASE WHEN product_id % 4 = 0 THEN 'long ' ELSE 'b' END, size) AS text", "'R' || product_id AS registration")
    return op.merge_by_precedence(mine, theirs, "ean", {
        "ean": "product", "note": "product", "registration": "authority", "name": "product_first", "brand": "authority_first", "text": "authority_unless_long"}, 100)


def _overlay_inputs(t):
    p = src.products(t)
    base = p.selectExpr("ean", "CASE WHEN product_id % 3 <> 0 THEN name END AS name", "brand", "size")
    update = p.filter("product_id % 2 = 0").selectExpr("ean", "upper(name) AS name", "CASE WHEN product_id % 4 = 0 THEN 'new' END AS brand", "'x' AS other")
    return base, update


_OVER = "o AS (SELECT p.ean, CASE WHEN p.product_id % 3 <> 0 THEN p.name END AS n0, p.brand AS b0, p.size, u.ean IS NOT NULL AS hit, upper(p.name) AS n1, CASE WHEN p.product_id % 4 = 0 THEN 'new' END AS b1 FROM products p LEFT JOIN products u ON u.ean = p.ean AND u.product_id % 2 = 0)"


@query("d27_overlay_override", f"WITH {PRODUCTS}, {_OVER} SELECT ean, CASE WHEN hit THEN coalesce(n1, n0) ELSE n0 END AS name, CASE WHEN hit THEN coalesce(b1, b0) ELSE b0 END AS brand, size FROM o")
def overlay_override(t):
    return op.overlay(*_overlay_inputs(t), ["ean"])


@query("d27_overlay_fill", f"WITH {PRODUCTS}, {_OVER} SELECT ean, CASE WHEN hit THEN coalesce(n0, n1) ELSE n0 END AS name, b0 AS brand, size FROM o")
def overlay_fill(t):
    return op.overlay(*_overlay_inputs(t), ["ean"], "fill")


@query("d28_market_backfill", f"""
WITH {PRODUCTS} SELECT ean AS code, CASE WHEN product_id % 5 = 0 THEN CASE WHEN product_id % 3 <> 0 THEN name || ' cx' END WHEN size > 40 THEN CASE WHEN product_id % 3 <> 0 THEN name || ' cx' END ELSE name END AS trade_name,
  CASE WHEN size % 3 = 0 THEN CASE WHEN product_id % 3 = 0 THEN '' ELSE CASE size % 4 WHEN 0 THEN 'generic' WHEN 1 THEN 'reference' WHEN 2 THEN 'similar' ELSE '' END END ELSE 'given' END AS kind,
  CASE WHEN size % 2 = 0 THEN true WHEN product_id % 3 = 0 THEN NULL WHEN size % 5 = 1 THEN true WHEN size % 5 = 2 THEN false END AS is_otc FROM products""")
def market_backfill(t):
    p = src.products(t)
    mine = p.selectExpr("ean AS code", "CASE WHEN product_id % 5 = 0 THEN '' WHEN size > 40 THEN repeat(name, 40) ELSE name END AS trade_name",
                        "CASE WHEN size % 3 = 0 THEN '' ELSE 'given' END AS kind", "CASE WHEN size % 2 = 0 THEN true END AS is_otc")
    market = p.filter("product_id % 3 <> 0").selectExpr(
        "ean AS code", "name || ' cx' AS presentation", "CASE size % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'R' WHEN 2 THEN 'S' ELSE 'M' END AS letter",
        "CASE size % 5 WHEN 1 THEN 'OTC' WHEN 2 THEN 'RX' END AS view")
    return op.market_backfill(mine, market)


@query("d29_manual_corrections", f"""
WITH {PRODUCTS} SELECT ean, CASE WHEN product_id % 4 = 0 AND size <= 20 THEN 'fixed ' || size ELSE name END AS name, CASE WHEN product_id % 4 = 0 THEN 'a|b ' || size ELSE 'old' END AS tags,
  CASE WHEN product_id % 4 = 0 AND size % 2 = 0 THEN category || '|extra' ELSE brand END AS groups, CASE WHEN product_id % 4 = 0 AND size % 3 = 0 THEN 'Preta' ELSE 'none' END AS stripe FROM products""")
def manual_corrections(t):
    p = src.products(t)
    base = p.select("ean", "name", F.lit("old").alias("tags"), F.array("brand").alias("groups"), F.lit("none").alias("stripe"))
    sheet = p.filter("product_id % 4 = 0").selectExpr(
        "ean", "CASE WHEN size > 20 THEN '-' ELSE ' fixed ' || size END AS name", "' a | |b ' || size || '|' AS tags",
        "CASE WHEN size % 2 = 0 THEN category || ' | extra' END AS groups", "CASE WHEN size % 3 = 0 THEN 'BLACK' ELSE 'UNKNOWN' END AS stripe")
    out = op.manual_corrections(base, sheet, "ean", ["tags"], ["groups"], {"stripe": {"BLACK": "Preta", "RED": "Vermelha"}})
    return out.withColumn("groups", F.array_join("groups", "|"))


_PRESCRIPTIONS = [("Branca Comum ", "Receita Branca (comum)", "Vermelha", 30), ("b1 azul", "B1 Azul (retida)", "Preta", 30), ("isento", "Isento", None, None)]
_PRESC = "CASE size % 5 WHEN 0 THEN ' branca comum' WHEN 1 THEN 'B1 AZUL' WHEN 2 THEN 'Isento' WHEN 3 THEN 'Outra (x)' END"


@query("d30_prescriptions", f"""
WITH {PRODUCTS}, m(k, standard, inf, days) AS (VALUES ('branca comum', 'Receita Branca (comum)', 'Vermelha', 30), ('b1 azul', 'B1 Azul (retida)', 'Preta', 30), ('isento', 'Isento', NULL, NULL)),
x AS (SELECT ean AS code, trim(lower({_PRESC})) AS pr, CASE WHEN product_id % 6 = 0 THEN 'Amarela' END AS st, contains(lower(name), 'widget') AS sp FROM products),
y AS (SELECT x.*, lower(coalesce(standard, pr)) AS std, coalesce(st, inf) AS stripe, CAST(days AS INTEGER) AS valid_days FROM x LEFT JOIN m ON k = pr)
SELECT code, CASE WHEN sp THEN 'b1 azul (x)' ELSE std END AS prescription, CASE WHEN sp THEN 'b1 azul' ELSE split_part(std, ' (', 1) END AS type, stripe, valid_days FROM y""")
def prescriptions(t):
    products = src.products(t).selectExpr("ean AS code", f"{_PRESC} AS prescription", "CASE WHEN product_id % 6 = 0 THEN 'Amarela' END AS stripe", "upper(name) AS ingredient")
    mapping = t.spark.createDataFrame(_PRESCRIPTIONS, "prescription string, standard string, stripe_inferred string, valid_days int")
    return op.prescriptions(products, mapping, ["widget"], "b1 azul (x)")


@query("d31_otc_decision", f"""
WITH {PRODUCTS}, li AS (SELECT DISTINCT {key_sql('name')} AS k, unnest([substr(brand, 1, 6), 'tube ' || category]) AS f FROM products WHERE size > 40),
x AS (SELECT ean AS code, {key_sql('name')} AS k, CASE WHEN product_id % 9 = 0 THEN NULL WHEN product_id % 2 = 0 THEN 'the ' || lower(brand) ELSE lower(category) END AS form,
  CASE WHEN size % 3 = 0 THEN size % 2 = 0 END AS otc, CASE WHEN size % 2 = 0 THEN 'Sem Tarja' ELSE 'Preta' END AS stripe FROM products),
h AS (SELECT DISTINCT code FROM x JOIN li ON x.k = li.k WHERE form IS NULL OR contains(form, lower(f)) OR contains(lower(f), form))
SELECT code, CASE WHEN code IN (FROM h) THEN true WHEN otc IS NOT NULL THEN otc WHEN stripe = 'Sem Tarja' THEN true END AS is_otc,
  CASE WHEN code IN (FROM h) THEN 'list' WHEN otc IS NOT NULL THEN 'market' WHEN stripe = 'Sem Tarja' THEN 'stripe' END AS source FROM x""")
def otc_decision(t):
    p = src.products(t)
    products = p.selectExpr(
        "ean AS code", "name AS ingredient", "CASE WHEN product_id % 9 = 0 THEN NULL WHEN product_id % 2 = 0 THEN 'the ' || lower(brand) ELSE lower(category) END AS form",
        "CASE WHEN size % 3 = 0 THEN size % 2 = 0 END AS is_otc", "CASE WHEN size % 2 = 0 THEN 'Sem Tarja' ELSE 'Preta' END AS stripe")
    listed = p.filter("size > 40").select(F.upper("name").alias("ingredient"), F.array(F.substring("brand", 1, 6), F.concat(F.lit("tube "), "category")).alias("forms"))
    return op.otc_decision(products, listed, "Sem Tarja")


@query("d32_controlled_flag", f"""
WITH {PRODUCTS}, tm AS (SELECT DISTINCT lower(substr(name, 2, 5)) AS term FROM products WHERE size = 7),
x AS (SELECT ean AS code, category IN ('SMALL', 'PROMO') AS med, CASE WHEN product_id % 3 <> 0 THEN lower(trim(name)) WHEN length({key_sql('name')}) >= 5 THEN {key_sql('name')} END AS t FROM products)
SELECT code, med AND EXISTS (SELECT 1 FROM tm WHERE contains(x.t, term)) AS is_controlled FROM x""")
def controlled_flag(t):
    p = src.products(t)
    products = p.selectExpr("ean AS code", "name", "CASE WHEN product_id % 3 <> 0 THEN upper(name) END AS ingredient", "category IN ('SMALL', 'PROMO') AS is_medicine")
    return op.controlled_flag(products, p.filter("size = 7").select(F.substring("name", 2, 5).alias("term")))


@query("d33_keyword_classes", f"""
WITH {PRODUCTS}, x AS (SELECT ean AS code, name, CASE WHEN product_id % 4 <> 0 THEN size > 25 END AS med FROM products),
u AS (SELECT code, regexp_matches(name, '^(red|blue)|ring') AS flag FROM x WHERE med IS NULL UNION ALL SELECT code, false FROM x WHERE name LIKE '%gi%o' OR name LIKE 'old%' OR name IN ('red ring', 'hot rod'))
SELECT code, bool_and(flag) AS is_medicine FROM u GROUP BY 1""")
def keyword_classes(t):
    products = src.products(t).selectExpr("ean AS code", "name", "CASE WHEN product_id % 4 <> 0 THEN size > 25 END AS is_medicine")
    return op.keyword_classes(products, "^(red|blue)|ring", ["%gi%o", "old%"], ["red ring", "hot rod"])


_HINT = "CASE doc_id % 12 WHEN 0 THEN 'mantenha fora do alcance das crianças' WHEN 1 THEN 'para bebê' WHEN 2 THEN 'uso infantil' WHEN 3 THEN 'para adolescente' WHEN 4 THEN 'idoso' WHEN 5 THEN 'uso adulto' WHEN 6 THEN 'gestante' WHEN 7 THEN 'barba' WHEN 8 THEN 'evite em mulher' ELSE '' END"


def _re2(pattern: str) -> str:
    return pattern.replace("'", "''")


_GIVEN = {"age_group": "CASE doc_id % 17 WHEN 3 THEN 'jovem' WHEN 5 THEN ' ' END", "sex": "CASE doc_id % 19 WHEN 4 THEN 'homem' WHEN 6 THEN '' END"}
_SAYS = {k: f"regexp_matches({t}, '{_re2(op._any(words))}')" for k, t, words in (
    ("women", "t", op.WOMEN), ("women_name", "n", op.WOMEN_NAMES), ("men", "t", op.MEN), ("men_name", "n", op.MEN_NAMES))}


@query("d34_age_and_sex", f"""
WITH x AS (SELECT doc_id, lower(strip_accents(source)) AS n, lower(strip_accents(concat_ws(' ', source, text || ' ' || {_HINT}, lang))) AS t, {', '.join(f'{e} AS {c}' for c, e in _GIVEN.items())} FROM documents),
y AS (SELECT *, {_SAYS['women']} OR {_SAYS['women_name']} AS women, {_SAYS['men']} OR {_SAYS['men_name']} AS men FROM x)
SELECT doc_id, CASE WHEN trim(age_group) <> '' THEN age_group {' '.join(f"WHEN regexp_matches(t, '{_re2(p)}') THEN '{label}'" for p, label in op.age_rules())} ELSE 'todos' END AS age_group,
  CASE WHEN trim(sex) <> '' THEN sex WHEN regexp_matches(t, '{_re2(op.not_for('mulher'))}') THEN 'homem' WHEN regexp_matches(t, '{_re2(op.not_for('homem'))}') THEN 'mulher'
  WHEN women AND NOT men THEN 'mulher' WHEN men AND NOT women THEN 'homem' ELSE 'todos' END AS sex FROM y""")
def age_and_sex(t):
    products = t.documents.select(
        "doc_id", F.col("source").alias("name"), F.expr(f"text || ' ' || {_HINT}").alias("description"), F.lit(None).cast("string").alias("indication"),
        F.array("lang").alias("categories"), *[F.expr(e).alias(c) for c, e in _GIVEN.items()])
    return op.age_and_sex(products, "doc_id")


@query("d35_token_categories", f"""
WITH {PRODUCTS}, x AS (SELECT ean AS code, category IN ('SMALL', 'PROMO') AS med, string_split(upper(name), ' ') AS n, CASE WHEN size % 2 = 0 THEN [upper(split_part(name, ' ', 2))] ELSE [upper(split_part(name, ' ', 1))] END AS i FROM products),
w AS (SELECT DISTINCT code, med, unnest(list_filter(CASE WHEN med THEN list_filter(n, lambda z: list_contains(i, z)) ELSE n END, lambda z: length(z) >= 4 AND z <> 'GEAR')) AS w FROM x),
v(path, med, w) AS (VALUES ('Meds -> Ring', true, 'RING'), ('Meds -> Widget', true, 'WIDGET'), ('Meds -> Widget', true, 'LARGE'), ('Home -> Tools', false, 'PLATE'), ('Home -> Tools', false, 'ANVIL'), ('Home -> Small', false, 'SMALL'))
SELECT DISTINCT code, path FROM w JOIN v USING (w, med)""")
def token_categories(t):
    products = src.products(t).selectExpr("ean AS code", "name", "CASE WHEN size % 2 = 0 THEN split_part(name, ' ', 2) ELSE split_part(name, ' ', 1) END AS ingredient", "category IN ('SMALL', 'PROMO') AS is_medicine")
    vocabulary = t.spark.createDataFrame(
        [("Meds -> Ring", True, ["ring", " rod"]), ("Meds -> Widget", True, ["Widgét", "large", "gear"]), ("Home -> Tools", False, ["plate", "anvil", "gear"]), ("Home -> Small", False, ["small", "new"])],
        "path string, is_medicine boolean, terms array<string>")
    return op.token_categories(products, vocabulary, ["GEAR"])


_RATIO = "1 - levenshtein(lower(strip_accents(value)), lower(strip_accents(term)))::DOUBLE / greatest(length(value), length(term))"
_CLOSEST = f"""vt AS (SELECT DISTINCT value, unnest(regexp_extract_all(lower(strip_accents(value)), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM vals WHERE trim(value) <> ''),
tt AS (SELECT DISTINCT term, unnest(regexp_extract_all(lower(strip_accents(term)), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM voc),
mt AS (SELECT value, term, count(*) AS overlap, {r(_RATIO, 6)} AS ratio FROM vt JOIN tt USING (w) GROUP BY 1, 2),
best AS (SELECT value, term, overlap, ratio FROM (SELECT *, row_number() OVER (PARTITION BY value ORDER BY overlap DESC, ratio DESC, term) AS k FROM mt) WHERE k = 1)"""


@query("d36_repair_vocabulary", f"""
WITH {PRODUCTS}, voc AS (SELECT DISTINCT name AS term FROM products), vals AS (SELECT DISTINCT replace(name, 'e', 'a') AS value FROM products WHERE product_id % 3 = 0 AND replace(name, 'e', 'a') NOT IN (SELECT term FROM voc)),
{_CLOSEST}, x AS (SELECT ean, CASE WHEN product_id % 3 = 0 THEN replace(name, 'e', 'a') ELSE name END AS name, CASE WHEN size % 2 = 0 THEN 'Brand#7 x' ELSE 'none' END AS brand FROM products)
SELECT ean, coalesce(term, name) AS name, brand FROM x LEFT JOIN best ON value = name""")
def repair_vocabulary(t):
    return _repair(t, standardise.closest_terms)


@query("d36_fuzzy_repair")
def fuzzy_repair(t):
    """The same by the fuzzy scorers."""
    return _repair(t, standardise.fuzzy_terms)


def _repair(t, closest):
    p = src.products(t)
    vocabulary = p.select(F.lit("name").alias("vocabulary"), F.col("name").alias("term")).distinct().unionByName(
        p.filter("size > 50").select(F.lit("brand").alias("vocabulary"), F.col("brand").alias("term")).distinct())
    rows = p.selectExpr("ean", "CASE WHEN product_id % 3 = 0 THEN replace(name, 'e', 'a') ELSE name END AS name", "CASE WHEN size % 2 = 0 THEN 'Brand#7 x' ELSE 'none' END AS brand")
    return op.repair_vocabulary(rows, "ean", vocabulary, ["name", "brand"], closest)


@query("d37_flatten_paths", f"""
WITH {PRODUCTS} SELECT ean, category || ' -> ' || brand || CASE WHEN size % 3 > 0 THEN ' -> ' || name ELSE '' END || '|Home -> Any' AS paths, category = 'PROMO' AS is_promo FROM products""")
def flatten_paths(t):
    rows = src.products(t).select("ean", "category", F.array(
        F.struct(F.col("category").alias("super"), F.col("brand").alias("meso"), F.when(F.col("size") % 3 > 0, F.col("name")).otherwise("null").alias("micro")),
        F.struct(F.lit("Home").alias("super"), F.lit("Any").alias("meso"), F.lit(" ").alias("micro"))).alias("categories"))
    paths = op.flatten_paths(F.col("categories"))
    return rows.select("ean", F.array_join(paths, "|").alias("paths"), F.array_contains(F.transform("categories", lambda c: c["super"]), "PROMO").alias("is_promo"))


@query("d38_valid_paths", f"""
WITH {PRODUCTS}, tx AS (SELECT DISTINCT category AS s, brand AS m, CASE WHEN size % 2 = 0 THEN name END AS i FROM products),
x AS (SELECT ean, CASE WHEN product_id % 4 = 0 THEN lower(category) ELSE category END AS s, CASE WHEN product_id % 7 = 0 THEN 'nowhere' WHEN product_id % 3 = 0 THEN upper(brand) ELSE brand END AS m,
  CASE WHEN product_id % 5 = 0 THEN NULL WHEN product_id % 5 = 1 THEN 'bad' ELSE upper(name) END AS i FROM products),
a AS (SELECT ean, ts.s, m, i FROM x JOIN (SELECT DISTINCT s FROM tx) ts ON lower(ts.s) = lower(x.s)), b AS (SELECT ean, a.s, tm.m, i FROM a JOIN (SELECT DISTINCT s, m FROM tx) tm ON tm.s = a.s AND lower(tm.m) = lower(a.m))
SELECT ean, b.s AS super, b.m AS meso, ti.i AS micro FROM b LEFT JOIN (SELECT DISTINCT s, m, i FROM tx WHERE i IS NOT NULL) ti ON ti.s = b.s AND ti.m = b.m AND lower(ti.i) = lower(b.i)""")
def valid_paths(t):
    p = src.products(t)
    taxonomy = p.select(F.col("category").alias("super"), F.col("brand").alias("meso"), F.when(F.col("size") % 2 == 0, F.col("name")).alias("micro"))
    rows = p.selectExpr(
        "ean", "CASE WHEN product_id % 4 = 0 THEN lower(category) ELSE category END AS super",
        "concat_ws(' -> ', CASE WHEN product_id % 7 = 0 THEN 'nowhere' WHEN product_id % 3 = 0 THEN upper(brand) ELSE brand END, CASE WHEN product_id % 5 = 0 THEN NULL WHEN product_id % 5 = 1 THEN 'bad' ELSE upper(name) END) AS path")
    return op.valid_paths(rows, "ean", taxonomy)


@query("d39_remap_labels", f"""
WITH {PRODUCTS} SELECT ean, concat_ws('|', CASE WHEN split_part(name, ' ', 2) IN ('ring', 'gear', 'rod') THEN 'Std ' || split_part(name, ' ', 2) END, CASE WHEN category IN ('PROMO', 'SMALL') THEN 'Std ' || category END) AS labels FROM products""")
def remap_labels(t):
    rows = src.products(t).select("ean", F.array(F.split_part("name", F.lit(" "), F.lit(2)), F.lit("zz"), F.col("category")).alias("labels"))
    mapping = t.spark.createDataFrame([(x, f"Std {x}") for x in ("ring", "gear", "rod", "PROMO", "SMALL")], "label string, standard string")
    return op.remap_labels(rows, "ean", "labels", mapping).withColumn("labels", F.array_join("labels", "|"))


@query("d40_size_tiers", f"""
WITH {PRODUCTS}, x AS (SELECT ean, CASE WHEN product_id % 9 <> 0 THEN size END AS quantity, category, CASE WHEN size > 45 THEN NULL ELSE split_part(name, ' ', 2) END AS unit FROM products),
c AS (SELECT category, unit, quantile_cont(quantity, 0.33) AS a, quantile_cont(quantity, 0.66) AS b FROM x WHERE quantity IS NOT NULL GROUP BY 1, 2)
SELECT ean, CASE WHEN quantity < a THEN 'P' WHEN quantity > b THEN 'G' ELSE 'M' END AS tier FROM x LEFT JOIN c ON c.category = x.category AND c.unit IS NOT DISTINCT FROM x.unit""")
def size_tiers(t):
    rows = src.products(t).selectExpr("ean", "CASE WHEN product_id % 9 <> 0 THEN size END AS quantity", "category", "CASE WHEN size > 45 THEN NULL ELSE split_part(name, ' ', 2) END AS unit")
    return op.size_tiers(rows, ["category", "unit"], "quantity").select("ean", "tier")


@query("d41_propagate", f"""
WITH {PRODUCTS}, x AS (SELECT ean AS code, name, brand, CAST(size * 2 AS DOUBLE) AS quality, CASE WHEN product_id % 3 <> 0 THEN 't' || size END AS tags, CASE WHEN product_id % 4 = 0 THEN ' ' ELSE 'o' || size END AS other, {key_sql('name')} AS k1, {key_sql('brand')} AS k2 FROM products),
y AS (SELECT *, coalesce(trim(tags) <> '', false) AND coalesce(trim(other) <> '', false) AS whole, row_number() OVER (PARTITION BY k1, k2 ORDER BY quality DESC, code) AS k FROM x),
s AS (SELECT * FROM y WHERE k = 1 AND whole AND quality >= 40)
SELECT y.code, s.code AS source, CASE WHEN trim(y.tags) <> '' THEN y.tags ELSE s.tags END AS tags, CASE WHEN trim(y.other) <> '' THEN y.other ELSE s.other END AS other FROM y JOIN s USING (k1, k2) WHERE NOT y.whole AND y.code <> s.code""")
def propagate(t):
    rows = src.products(t).selectExpr("ean AS code", "name", "brand", "CAST(size * 2 AS DOUBLE) AS quality", "CASE WHEN product_id % 3 <> 0 THEN 't' || size END AS tags", "CASE WHEN product_id % 4 = 0 THEN ' ' ELSE 'o' || size END AS other")
    return op.propagate(rows, ["name", "brand"], ["tags", "other"], "quality", [F.col("code")])


_COSINE = "round(CAST(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS DECIMAL(20,15)), 9)"


@query("d42_neighbour_transfer", f"""
WITH x AS (SELECT vec_id AS code, embedding, CASE WHEN vec_id % 3 <> 0 THEN 'L' || label END AS kind, CASE WHEN vec_id % 5 <> 0 THEN 'R' || label END AS route FROM embeddings),
w AS (SELECT * FROM x WHERE (kind IS NULL OR route IS NULL) AND NOT (code % 2 = 0 AND code % 14 <> 0)), c AS (SELECT * FROM x WHERE kind IS NOT NULL AND route IS NOT NULL),
n AS (SELECT a.code, b.code AS source, {_COSINE} AS score, row_number() OVER (PARTITION BY a.code ORDER BY {_COSINE} DESC, b.code) AS k, coalesce(a.kind, b.kind) AS kind, coalesce(a.route, b.route) AS route FROM w a, c b WHERE {_COSINE} >= 0.2)
SELECT code, source, CAST(score AS DOUBLE) AS score, kind, route FROM n WHERE k = 1""")
def neighbour_transfer(t):
    return _transfer(t)


@query("d42_indexed_transfer")
def indexed_transfer(t):
    """The same with the source found through the clustered index."""

    def nearest(corpus, asked):
        index = neighbours.build(corpus)
        return neighbours.search(index, asked, 1, neighbours.probes_for(index, 1), 0.2)

    return _transfer(t, nearest)


def _transfer(t, nearest=None):
    e = t.embeddings
    products = e.selectExpr("vec_id AS code", "CASE WHEN vec_id % 3 <> 0 THEN 'L' || label END AS kind", "CASE WHEN vec_id % 5 <> 0 THEN 'R' || label END AS route")
    done = e.filter("vec_id % 2 = 0").selectExpr("vec_id AS code", "CASE WHEN vec_id % 14 = 0 THEN DATE '2023-01-01' ELSE DATE '2024-01-01' END AS matched_on")
    vectors = e.select(F.col("vec_id").alias("code"), F.col("embedding").alias("vector"))
    return op.neighbour_transfer(products, vectors, ["kind", "route"], done, F.lit("2023-06-01").cast("date"), 0.2, nearest)


_BACKLOG = """bl AS (SELECT c_custkey AS code, DATE '2024-01-01' + CAST(c_custkey % 100 AS INTEGER) AS made_on, c_custkey % 4 <> 0 AS done FROM customer WHERE c_custkey % 2 = 0),
f AS (SELECT (SELECT count(*) FROM customer) AS total, count(*) FILTER (done) AS many, count(*) FILTER (done AND made_on >= DATE '2024-03-01') AS fresh FROM bl),
pl AS (SELECT code, CASE WHEN done THEN 'redo' ELSE 'never' END AS reason, CASE WHEN many <= 0.1 * total THEN 'all' WHEN fresh > 0.05 * total THEN 'recent only' ELSE 'stop' END AS decision, made_on FROM bl, f)"""


def _backlog(t):
    c = t.customer
    everything = c.select(F.col("c_custkey").alias("code"))
    wanted = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("code"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 100).cast("int")).alias("made_on"))
    enriched = c.filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("code"))
    return op.plan_backlog(everything, wanted, enriched, F.lit("2024-03-01").cast("date"), 0.1, 0.05)


@query("d44_plan_backlog", f"WITH {_BACKLOG} SELECT code, reason, decision, reason = 'never' OR decision = 'all' OR (decision = 'recent only' AND made_on >= DATE '2024-03-01') AS selected FROM pl")
def plan_backlog(t):
    return _backlog(t)


@query("d44_missing_fields", f"""
WITH {_BACKLOG}, e AS (SELECT CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS account FROM customer WHERE c_custkey IN (SELECT code FROM pl WHERE reason = 'redo'))
SELECT 'balance' AS field, count(*) FILTER (balance IS NULL) AS nulls FROM e UNION ALL SELECT 'account', count(*) FILTER (account IS NULL) FROM e""")
def missing_fields(t):
    enriched = t.customer.select(F.col("c_custkey").alias("code"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("account"))
    return op.missing_fields(_backlog(t), enriched, ["balance", "account"])


@query("d45_validated_results", f"""
WITH {PRODUCTS} SELECT ean, CASE WHEN product_id % 3 <> 0 THEN name END AS name, size, NULL::VARCHAR AS other FROM products WHERE product_id % 7 <> 0""")
def validated_results(t):
    raw = src.products(t).selectExpr("CASE WHEN product_id % 7 <> 0 THEN ean END AS ean", "CASE WHEN product_id % 3 = 0 THEN ' NULL ' ELSE name END AS name", "size", "brand AS dropped")
    return op.validated(raw, "ean", ["ean", "name", "size", "other"])


@query("d46_replace_short", f"""
WITH {PRODUCTS}, x AS (SELECT ean, CASE WHEN product_id % 5 <> 0 THEN name END AS name, repeat('d', size) AS description, CASE WHEN product_id % 2 = 0 THEN 'long ' || name END AS n2, CASE WHEN product_id % 2 = 0 AND product_id % 4 = 0 THEN 'text' END AS d2 FROM products)
SELECT ean, CASE WHEN coalesce(length(name), 0) < 9 THEN coalesce(n2, name) ELSE name END AS name, CASE WHEN length(description) < 20 THEN coalesce(d2, description) ELSE description END AS description,
  concat_ws('|', CASE WHEN coalesce(length(name), 0) < 9 THEN 'name' END, CASE WHEN length(description) < 20 THEN 'description' END) AS short FROM x""")
def replace_short(t):
    p = src.products(t)
    rows = p.selectExpr("ean", "CASE WHEN product_id % 5 <> 0 THEN name END AS name", "repeat('d', size) AS description")
    external = p.filter("product_id % 2 = 0").selectExpr("ean", "'long ' || name AS name", "CASE WHEN product_id % 4 = 0 THEN 'text' END AS description")
    return op.replace_short(rows, external, "ean", {"name": 9, "description": 20})


@query("d48_embedding_text", f"""
WITH {PRODUCTS} SELECT ean, concat_ws(chr(10) || chr(10), CASE WHEN name <> '' THEN 'NOME: ' || name END, CASE WHEN product_id % 3 <> 0 THEN 'MARCA: ' || brand END, CASE WHEN size > 25 THEN 'CATEGORIA: ' || category END) AS text FROM products""")
def embedding_text(t):
    parts = [("NOME: ", F.col("name")), ("MARCA: ", F.when(F.col("product_id") % 3 != 0, F.col("brand"))), ("CATEGORIA: ", F.when(F.col("size") > 25, F.col("category")).otherwise(""))]
    return src.products(t).select("ean", op.embedding_text(parts).alias("text"))


# Rules of the stand-in: products of one sale line after another, with a confidence from the quantity.
_RULES = f"""{LINES}, {PRODUCTS}, ru AS (SELECT min(product_id) AS a, max(product_id) AS b, sum(qty) % 10 / 10.0::DOUBLE AS confidence, 0.001::DOUBLE * (sale_id % 3) AS support FROM lines GROUP BY sale_id),
own AS (SELECT product_id, unnest([brand, category]) AS category FROM products),
br AS (SELECT a AS product_id, category FROM ru JOIN own ON product_id = b GROUP BY 1, 2 HAVING count(*) >= 2 AND avg(support) >= 0.0005),
offr AS (SELECT product_id, category, max(c) AS converted FROM (SELECT product_id, 'PROMO' AS category, 1 AS c FROM products WHERE product_id % 5 = 0 UNION ALL SELECT product_id, category, 0 FROM br UNION ALL SELECT product_id, 'Brand#3', 0 FROM products WHERE product_id % 4 = 0) GROUP BY 1, 2),
bt AS (SELECT o1.category AS f, o2.category AS t, avg(confidence) AS c FROM ru JOIN own o1 ON o1.product_id = a JOIN own o2 ON o2.product_id = b GROUP BY 1, 2 HAVING count(*) >= 2 AND o1.category <> o2.category),
fit AS (SELECT product_id, t AS category, {r('avg(c)', 9)} AS confidence FROM own JOIN bt ON own.category = f GROUP BY 1, 2)"""


@query("d49_category_recommendations", f"""
WITH {_RULES}, g AS (SELECT offr.*, confidence FROM offr LEFT JOIN fit USING (product_id, category) WHERE confidence IS NOT NULL OR converted = 1)
SELECT product_id, category, {r('confidence', 6)} AS confidence, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY confidence DESC NULLS LAST, converted DESC, category) AS place FROM g) WHERE place <= 5""")
def category_recommendations(t):
    p = src.products(t)
    rules = src.lines(t).groupBy("sale_id").agg(
        F.min("product_id").alias("a"), F.max("product_id").alias("b"), (F.sum("qty") % 10 / 10.0).alias("confidence")
    ).withColumn("support", 0.001 * (F.col("sale_id") % 3)).drop("sale_id")
    out = op.category_recommendations(
        p.filter("product_id % 5 = 0").select("product_id", F.lit("PROMO").alias("category")), rules,
        p.filter("product_id % 4 = 0").select("product_id", F.lit("Brand#3").alias("category")),
        p.select("product_id", F.array("brand", "category").alias("categories")), 2, 0.0005)
    return out.select("product_id", "category", F.round("confidence", 6).alias("confidence"), "place")


@query("d51_vocabulary_table", f"""
WITH {PRODUCTS}, v AS (SELECT * FROM (VALUES ('stripe', 'Preta', 1), ('stripe', 'Vermelha', 2), ('sex', 'Mulhér', 1)) x(vocabulary, value, place))
SELECT vocabulary, value, CAST(place AS BIGINT) AS place, lower(strip_accents(value)) AS plain FROM v UNION ALL
SELECT 'ingredient', value, row_number() OVER (ORDER BY value), lower(strip_accents(value)) FROM (SELECT DISTINCT upper(name) AS value FROM products)""")
def vocabulary_table(t):
    return op.vocabulary_table({"stripe": ["Preta", "Vermelha"], "sex": ["Mulhér"]}, src.products(t).select(F.upper("name").alias("value")))


@query("d120_priority_backlog", f"""
WITH {LINES}, {PRODUCTS}, s AS (SELECT product_id AS code, CAST(sum(net) AS DOUBLE) AS value FROM lines WHERE product_id % 2 = 0 GROUP BY 1),
x AS (SELECT product_id AS code, name, CASE WHEN product_id % 3 = 0 THEN NULL ELSE brand END AS brand, CASE WHEN product_id % 5 = 0 THEN NULL ELSE category END AS maker FROM products WHERE length(name) >= 8 AND size > 5),
h AS (SELECT product_id AS code, CASE WHEN size % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2023-01-01' END AS looked FROM products WHERE size % 3 = 0)
SELECT code, name, value FROM x LEFT JOIN h USING (code) LEFT JOIN s USING (code) WHERE (brand IS NULL OR maker IS NULL) AND (looked IS NULL OR looked <= DATE '2023-06-01') AND (name ILIKE '%RI%' OR brand ILIKE '%RI%' OR maker ILIKE '%RI%')
ORDER BY value DESC NULLS LAST, code LIMIT 100""")
def priority_backlog(t):
    p = src.products(t)
    rows = p.selectExpr("product_id AS code", "name", "CASE WHEN size > 5 THEN 'd' END AS description", "CASE WHEN product_id % 3 = 0 THEN NULL ELSE brand END AS brand", "CASE WHEN product_id % 5 = 0 THEN NULL ELSE category END AS maker")
    history = p.filter("size % 3 = 0").selectExpr("product_id AS code", "CASE WHEN size % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2023-01-01' END AS looked_up_on")
    sold = src.lines(t).filter("product_id % 2 = 0").groupBy(F.col("product_id").alias("code")).agg(F.sum("net").cast("double").alias("value"))
    return op.priority_backlog(rows, history, sold, F.lit("2023-06-01").cast("date"), 100, "RI", 8)


@query("d121_tags_with_terms", f"""
WITH {PRODUCTS}, tm AS (SELECT unnest(['ring', 'd gea', 'PROMO', 'nothing']) AS term) SELECT ean, lower(term) AS term FROM products JOIN tm ON contains(lower(name || ' ' || category), lower(term))""")
def tags_with_terms(t):
    terms = t.spark.createDataFrame([("ring",), ("d gea",), ("PROMO",), ("nothing",)], "term string")
    return op.tags_with_terms(src.products(t), "ean", ["name", "category"], terms)


@query("d121_missing_and_stale", f"""
WITH {PRODUCTS}, x AS (SELECT ean AS code, CASE WHEN product_id % 4 = 0 THEN ' ' WHEN product_id % 4 = 1 THEN name END AS tags, CASE WHEN size % 3 = 0 THEN DATE '2024-01-01' WHEN size % 3 = 1 THEN DATE '2023-01-01' END AS done FROM products)
SELECT code FROM x WHERE coalesce(trim(tags), '') = '' AND (done IS NULL OR done <= DATE '2023-06-01')""")
def missing_and_stale(t):
    p = src.products(t)
    rows = p.selectExpr("ean AS code", "CASE WHEN product_id % 4 = 0 THEN ' ' WHEN product_id % 4 = 1 THEN name END AS tags")
    done = p.filter("size % 3 < 2").selectExpr("ean AS code", "CASE WHEN size % 3 = 0 THEN DATE '2024-01-01' ELSE DATE '2023-01-01' END AS done_on")
    return op.missing_and_stale(rows, done, "tags", F.lit("2023-06-01").cast("date"))


@query("d122_evaluation_scope", f"""
WITH {LINES}, {PRODUCTS}, b AS (SELECT product_id AS code FROM lines GROUP BY 1 ORDER BY sum(qty) DESC, product_id LIMIT 300),
s AS (SELECT product_id AS code FROM products WHERE category = 'PROMO' UNION SELECT product_id FROM products WHERE category = 'LARGE' AND size / 50.0 > 0.9 UNION FROM b),
j AS (SELECT product_id AS code, size / 50.0 AS score FROM products WHERE product_id % 3 = 0)
SELECT code FROM s WHERE code NOT IN (SELECT code FROM j) UNION ALL SELECT code FROM s WHERE code IN (SELECT code FROM j WHERE score < 0.5)""")
def evaluation_scope(t):
    p = src.products(t)
    scored = p.select(F.col("product_id").alias("code"), "category", (F.col("size") / 50.0).alias("score"))
    sold = src.lines(t).groupBy(F.col("product_id").alias("code")).agg(F.sum("qty").alias("qty"))
    return op.evaluation_scope(scored.filter("category = 'PROMO'"), scored.filter("category = 'LARGE'"), sold, scored.filter("code % 3 = 0"), 300)


@query("d123_label_rows", f"""
WITH {PRODUCTS}, x AS (SELECT ean, lower(category) AS c, split_part(name, ' ', 1) AS w FROM products),
y AS (SELECT ean, CASE WHEN c = 'standard' OR c = w THEN [w] ELSE [c, w] END AS ls FROM x)
SELECT ean, label, CAST(list_position(ls, label) - 1 AS INTEGER) AS place, CASE WHEN label IN ('promo', 'red') THEN 'C1|C2' END AS categories FROM (SELECT ean, ls, unnest(ls) AS label FROM y)""")
def label_rows(t):
    answers = src.products(t).select("ean", F.concat(F.lit(" "), "category", F.lit(",, "), F.split_part("name", F.lit(" "), F.lit(1)), F.lit("\n")).alias("answer"))
    cats = t.spark.createDataFrame([("promo", "C1|C2"), ("red", "C1|C2")], "label string, categories string")
    return op.label_rows(answers, "ean", cats, 7, 2).select("ean", "label", "place", "categories")


@query("d124_rekey", """
SELECT 'new-' || s_suppkey AS store_id, s_acctbal AS balance FROM supplier WHERE s_suppkey % 3 <> 0""")
def rekey(t):
    s = t.supplier
    rows = s.selectExpr("'old-' || s_suppkey AS store_id", "s_acctbal AS balance")
    old = s.selectExpr("'old-' || s_suppkey AS store_id", "s_name AS name")
    new = s.filter("s_suppkey % 3 <> 0").selectExpr("'new-' || s_suppkey AS store_id", "s_name AS name")
    return op.rekey(rows, old, new, "store_id", "name")


@query("w06_group_totals", """
SELECT c_custkey, c_nationkey, c_acctbal, round(max(c_acctbal) OVER (PARTITION BY c_nationkey), 2) AS group_max, count(*) OVER (PARTITION BY c_nationkey) AS group_rows FROM customer""")
def group_totals(t):
    out = op.grouped_total(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], "c_acctbal")
    return out.select("c_custkey", "c_nationkey", "c_acctbal", F.round("group_max", 2).alias("group_max"), "group_rows")
