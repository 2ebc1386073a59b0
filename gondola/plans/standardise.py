"""Standardisation jobs and their column rules over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions import bpe, codes, html, pharma, scoring, text
from gondola.operators import enrich
from gondola.operators import standardise as op
from gondola.operators.kit import dealt
from gondola.plans import inputs as src
from gondola.plans.enrich import _CLOSEST
from gondola.plans.inputs import EAN_SQL, PRODUCTS, key_sql, nothing_sql, r
from gondola.plans.registry import query

_WORDS = "regexp_extract_all(lower(strip_accents({c})), '[\\p{{L}}\\p{{N}}_]+')"
_FILLERS = ", ".join(f"'{w}'" for w in text.FILLER_WORDS)


def tokens_sql(c: str) -> str:
    """Significant words of a text as a list with distinct elements."""
    return (f"list_distinct(list_filter({_WORDS.format(c=c)}, lambda w: length(w) >= 3 AND NOT regexp_matches(w, '^([0-9]+|[0-9]+[a-z]+|[a-z]+[0-9]+)$') "
            f"AND w NOT IN ({_FILLERS})))")


@query("f01_unaccent", "SELECT doc_id, md5(strip_accents(text)) AS digest FROM documents")
def unaccent(t):
    return t.documents.select("doc_id", F.md5(text.unaccent(F.col("text"))).alias("digest"))


@query("f02_alnum_key", f"SELECT doc_id, md5({key_sql('text')}) AS digest FROM documents")
def alnum_key(t):
    return t.documents.select("doc_id", F.md5(text.alnum_key(F.col("text"))).alias("digest"))


@query("f03_identifier", "SELECT conv_id, turn, md5(regexp_replace(regexp_replace(lower(strip_accents(text)), '\\s+', '_', 'g'), '[^\\p{L}\\p{N}_]', '', 'g')) AS digest FROM conversations")
def identifier(t):
    return t.conversations.select("conv_id", "turn", F.md5(text.identifier(F.col("text"))).alias("digest"))


# Contact data of the stand-in: written in the ways people write it, from the customer key.
_CONTACT = {
    "phone": "CASE c_custkey % 6 WHEN 0 THEN '(11) 9' || lpad('' || c_custkey, 8, '3') WHEN 1 THEN '0' || lpad('' || c_custkey, 11, '21') WHEN 2 THEN lpad('' || c_custkey, 8, '4') WHEN 3 THEN '9' || lpad('' || c_custkey, 8, '5') WHEN 4 THEN '123' ELSE '00' || lpad('' || c_custkey, 8, '6') END",
    "tax_id": "'00' || c_custkey || '.' || c_nationkey || '/0001-9'",
    "email": "CASE c_custkey % 4 WHEN 0 THEN ' a' || c_custkey || '@b.com ' WHEN 1 THEN 'a.b@c' WHEN 2 THEN 'no mail' ELSE 'x@y.z@' END",
    "street": "CASE c_custkey % 4 WHEN 0 THEN 'R. das Flores nº ' || c_custkey || ' - Centro' WHEN 1 THEN 'Av. Brasil, ' || c_custkey WHEN 2 THEN 'Rua 27 de Setembro ' || c_custkey || ' casa' ELSE 'Praça Sete' END",
}
_DIGITS = "regexp_replace(regexp_replace(phone, '[^0-9]', '', 'g'), '^0', '')"


@query("n1_contacts", f"""
WITH x AS (SELECT c_custkey, {', '.join(f'{e} AS {c}' for c, e in _CONTACT.items())}, DATE '1930-01-15' + CAST((c_custkey * 53) % 27000 AS INTEGER) AS born_on FROM customer),
y AS (SELECT *, {_DIGITS} AS g, CAST(2001 - year(born_on) - CASE WHEN (8, 2) < (month(born_on), day(born_on)) THEN 1 ELSE 0 END AS INTEGER) AS age FROM x)
SELECT c_custkey, CASE length(g) WHEN 8 THEN substr(g, 1, 4) || '-' || substr(g, 5) WHEN 9 THEN CASE WHEN g LIKE '0%' THEN '(' || substr(g, 1, 2) || ') ' || substr(g, 3, 3) || '-' || substr(g, 6) ELSE substr(g, 1, 5) || '-' || substr(g, 6) END
  WHEN 10 THEN '(' || substr(g, 1, 2) || ') ' || substr(g, 3, 4) || '-' || substr(g, 7) WHEN 11 THEN '(' || substr(g, 1, 2) || ') ' || substr(g, 3, 5) || '-' || substr(g, 8) END AS phone,
  ltrim(regexp_replace(tax_id, '[./-]', '', 'g'), '0') AS tax_id, CASE WHEN regexp_matches(trim(email), '^[^@]*@.*\\.') THEN trim(email) END AS email,
  CASE c_custkey % 4 WHEN 0 THEN 'Rua das Flores, ' || c_custkey WHEN 1 THEN 'Avenida Brasil, ' || c_custkey WHEN 2 THEN 'Rua 27 de Setembro, ' || c_custkey ELSE 'Praça Sete' END AS street,
  age, CASE WHEN age < 0 THEN NULL WHEN age < 2 THEN 'bebe' WHEN age < 13 THEN 'crianca' WHEN age < 18 THEN 'adolescente' WHEN age < 25 THEN 'jovem' WHEN age < 60 THEN 'adulto' ELSE 'idoso' END AS age_band FROM y""")
def contacts(t):
    return op.contacts(_people(t), "c_custkey", src.AS_OF)[0].drop("born_on")


def _people(t):
    return t.customer.selectExpr("c_custkey", *[f"{e} AS {c}" for c, e in _CONTACT.items()], "date_add(DATE '1930-01-15', CAST((c_custkey * 53) % 27000 AS INT)) AS born_on")


@query("n1_contact_rejects", f"""
WITH x AS (SELECT c_custkey, {', '.join(f'{e} AS {c}' for c, e in _CONTACT.items())} FROM customer)
SELECT c_custkey, 'phone' AS field, phone AS value FROM x WHERE length({_DIGITS}) NOT IN (8, 9, 10, 11) UNION ALL
SELECT c_custkey, 'email', email FROM x WHERE NOT regexp_matches(trim(email), '^[^@]*@.*\\.')""")
def contact_rejects(t):
    return op.contacts(_people(t), "c_custkey", src.AS_OF)[1]


@query("f07_pipe_lists", """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 2 END AS parts, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE replace(p_name, ' ', '|') END AS back FROM part""")
def pipe_lists(t):
    raw = F.when(F.col("p_partkey") % 5 == 0, F.lit("  ")).otherwise(F.concat(F.replace("p_name", F.lit(" "), F.lit(" | |")), F.lit("|")))
    parts = text.split_pipe(raw)
    return t.part.select("p_partkey", F.when(parts.isNotNull(), F.size(parts)).alias("parts"), text.join_pipe(parts).alias("back"))


@query("f08_plain_text", "SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\\s._-]', '', 'g'), '\\s+', ' ', 'g'))) AS digest FROM documents")
def plain_text(t):
    return t.documents.select("doc_id", F.md5(text.plain_text(F.col("text"))).alias("digest"))


@query("f09_token_budget", """
WITH x AS (SELECT doc_id, text, regexp_split_to_array(trim(text), '\\s+') AS t FROM documents)
SELECT doc_id, md5(CASE WHEN len(t) > 100 THEN array_to_string(t[1:100], ' ') ELSE text END) AS digest FROM x""")
def token_budget(t):
    return t.documents.select("doc_id", F.md5(text.token_budget(F.col("text"), 100)).alias("digest"))


@query("f09_bpe_budget")
def bpe_budget(t):
    """Texts cut at 100 byte-pair tokens of a published vocabulary."""
    import public_tokenizers

    cut = bpe.token_budget(t.documents, F.col("text"), 100, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return t.documents.select("doc_id", F.md5(cut).alias("digest"))


_CODES = f"CASE p_partkey % 6 WHEN 0 THEN {EAN_SQL} WHEN 1 THEN '12348' WHEN 2 THEN '1234' WHEN 3 THEN '99' || substr({EAN_SQL}, 3) WHEN 4 THEN ' ' || ltrim({EAN_SQL}, '0') ELSE 'x' || p_partkey END"


def _barcodes(t):
    ean = codes.barcode(F.col("p_partkey"))
    k = F.col("p_partkey") % 6
    return t.part.select("p_partkey", F.when(k == 0, ean).when(k == 1, "12348").when(k == 2, "1234").when(k == 3, F.concat(F.lit("99"), F.substring(ean, 3, 13)))
                         .when(k == 4, F.concat(F.lit(" "), F.ltrim(ean, F.lit("0")))).otherwise(F.concat(F.lit("x"), F.col("p_partkey").cast("string"))).alias("code"))


_FULL = "lpad(trim(code), 13, '0')"
_CHECK = " + ".join(f"{3 if i % 2 else 1} * TRY_CAST(substr({_FULL}, {i + 1}, 1) AS INTEGER)" for i in range(12))
_VALID = f"(regexp_matches(trim(code), '^[0-9]{{1,13}}$') AND NOT starts_with(trim(code), '99') AND (10 - ({_CHECK}) % 10) % 10 = TRY_CAST(substr({_FULL}, 13, 1) AS INTEGER))"


@query("n2_barcodes", f"WITH x AS (SELECT p_partkey, {_CODES} AS code FROM part) SELECT p_partkey, code, regexp_replace(trim(code), '^0+', '') AS canonical, coalesce({_VALID}, false) AS valid FROM x")
def barcodes(t):
    return op.barcodes(_barcodes(t), "code")[0]


@query("n2_barcode_report", f"WITH x AS (SELECT {_CODES} AS code FROM part) SELECT coalesce({_VALID}, false) AS valid, CAST(length(trim(code)) AS INTEGER) AS length, count(*) AS codes FROM x GROUP BY 1, 2")
def barcode_report(t):
    return op.barcodes(_barcodes(t), "code")[1]


@query("f11_significant_tokens", f"SELECT doc_id, md5(array_to_string(list_sort({tokens_sql('text')}), '|')) AS digest FROM documents")
def significant_tokens(t):
    return t.documents.select("doc_id", F.md5(F.array_join(F.array_sort(text.significant_tokens(F.col("text"))), "|")).alias("digest"))


@query("f12_jaccard", f"""
WITH x AS (SELECT a.conv_id, a.turn, {tokens_sql('a.text')} AS p, {tokens_sql('b.text')} AS q FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CASE WHEN len(p) > 0 AND len(q) > 0 THEN {r('len(list_intersect(p, q)) / (len(p) + len(q) - len(list_intersect(p, q)))', 6)} ELSE 0 END AS similarity FROM x""")
def jaccard(t):
    c = t.conversations
    following = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_next"))
    both = c.join(following, ["conv_id", "turn"])
    score = text.jaccard(text.significant_tokens(F.col("text")), text.significant_tokens(F.col("_next")))
    return both.select("conv_id", "turn", F.round(score, 6).alias("similarity"))


@query("f13_similar_names", f"""
WITH {PRODUCTS}, x AS (SELECT ean, name, unnest([upper(name), name || ' extra', name || ' ' || brand || ' ' || category, 'other thing', '']) AS n FROM products),
y AS (SELECT *, {tokens_sql('name')} AS p, {tokens_sql('n')} AS q FROM x)
SELECT ean, string_agg(n, '|' ORDER BY n) AS names FROM y WHERE len(q) > 0 AND len(list_intersect(p, q)) / (len(p) + len(q) - len(list_intersect(p, q))) >= 0.4 AND len(list_intersect(p, q)) / (len(p) + len(q) - len(list_intersect(p, q))) < 0.95 GROUP BY 1""")
def similar_names(t):
    names = F.array(F.upper("name"), F.concat("name", F.lit(" extra")), F.concat_ws(" ", "name", "brand", "category"), F.lit("other thing"), F.lit(""))
    kept = text.similar_names(F.col("name"), names, 0.40)
    return dealt(src.products(t), "product_id").select("ean", F.array_join(F.array_sort(kept), "|").alias("names")).filter("names <> ''")


@query("f14_matching_tokens", f"""
WITH {PRODUCTS}, x AS (SELECT ean, list_filter(string_split(upper(name), ' '), lambda w: length(w) >= 4 AND w <> 'GEAR') AS n, list_filter(['CATEGORY', upper(category), upper(split_part(name, ' ', 2))], lambda w: length(w) >= 4 AND w <> 'GEAR') AS i FROM products),
y AS (SELECT ean, n[1:1] AS f, list_filter(i, lambda w: NOT list_contains(n[1:1], w))[1:2] AS m FROM x)
SELECT ean, array_to_string(list_concat(f, m), '|') AS tokens FROM y""")
def matching_tokens(t):
    i = F.concat_ws(" ", F.lit("category 12"), "category", F.split_part("name", F.lit(" "), F.lit(2)))
    return src.products(t).select("ean", F.array_join(text.matching_tokens(F.col("name"), i, 4, ["GEAR"], 1, 2), "|").alias("tokens"))


@query("f15_closest_terms", f"""
WITH {PRODUCTS}, voc AS (SELECT DISTINCT name || ' ' || lower(category) AS term FROM products), vals AS (SELECT DISTINCT upper(name) || CASE WHEN product_id % 2 = 0 THEN ' promó' ELSE ' xx' END AS value FROM products),
{_CLOSEST} SELECT * FROM best""")
def closest_terms(t):
    return op.closest_terms(*_spelled(t)).drop("vocabulary")


@query("f15_fuzzy_terms")
def fuzzy_terms(t):
    return op.fuzzy_terms(*_spelled(t)).drop("vocabulary")


def _spelled(t):
    """(values, vocabulary)"""
    p = src.products(t)
    vocabulary = p.select(F.lit("v").alias("vocabulary"), F.concat_ws(" ", "name", F.lower("category")).alias("term"))
    values = p.select(F.lit("v").alias("vocabulary"), F.concat(F.upper("name"), F.when(F.col("product_id") % 2 == 0, " promó").otherwise(" xx")).alias("value"))
    return values, vocabulary


# Dosages of the stand-in and what they become.
_DOSE = [
    ("size || ' mg'", "size || 'mg'"), ("size || ',5mg'", "size || '.5mg'"), ("'1.000mg'", "'1000mg'"), ("'≥ 2.500.000ui'", "'2500000ui'"),
    ("size || 'ug'", "size || 'mcg'"), ("size || ' u'", "size || 'ui'"), ("size || 'mcg/h'", "size || 'mcg'"), ("'(' || size || ' + 2)mg'", "size || 'mg + 2mg'"),
    ("'9,0mg (4,6mg/24h)'", "'9.0mg'"), ("size || 'mg por comprimido'", "size || 'mg'"), ("'1 comprimido por dia'", "NULL"), ("'100mg - ' || size || 'mg'", "NULL"),
    ("size || '/30mg'", "NULL"), ("'none'", "NULL"),
]


def _dose(i: int) -> str:
    return "CASE product_id % 14 " + " ".join(f"WHEN {k} THEN {d[i]}" for k, d in enumerate(_DOSE)) + " END"


_SALT = "CASE product_id % 4 WHEN 0 THEN name || ' cloridrato; ' || category WHEN 1 THEN 'Ácido ' || name || ', ' || name || ' ácido' WHEN 2 THEN name || ' (maleato) + ' || category || ' 500mg' ELSE '' END"
_DRUGS = {"name": "name || ' ' || size || 'mg/5mL'", "dosage": f"CASE WHEN size % 3 > 0 THEN {_dose(0)} END", "ingredient": _SALT, "form": "CASE WHEN size % 4 > 0 THEN 'Gél / Creme (tubo), ' || category END"}


def _drugs(t):
    return src.products(t).selectExpr("ean", *[f"{e} AS {c}" for c, e in _DRUGS.items()])


@query("n3_drug_fields", f"""
WITH {PRODUCTS}, x AS (SELECT ean, product_id, {', '.join(f'{e} AS {c}' for c, e in _DRUGS.items() if c != 'name')}, size, name AS nm, lower(name) AS low, category FROM products)
SELECT ean, CASE WHEN product_id % 3 = 0 THEN 'kept' ELSE coalesce(CASE WHEN size % 3 > 0 THEN {_dose(1)} END, size || 'mg/5mL') END AS clean_dosage,
  CASE WHEN product_id % 3 = 0 THEN 'KEPT' ELSE CASE product_id % 4 WHEN 0 THEN array_to_string(list_sort([upper(category), 'CLORIDRATO DE ' || upper(nm)]), ' + ') WHEN 1 THEN 'ACIDO ' || upper(nm) WHEN 2 THEN array_to_string(list_sort([upper(category), 'MALEATO DE ' || upper(nm)]), ' + ') ELSE '' END END AS clean_ingredient,
  CASE WHEN product_id % 3 = 0 THEN 'kept' WHEN size % 4 > 0 THEN 'gel|creme|' || lower(category) ELSE '' END AS forms, product_id % 3 <> 0 AS computed
FROM x""")
def drug_fields(t):
    inputs = _drugs(t)
    stored = inputs.join(src.products(t).select("ean", "product_id"), "ean").filter("product_id % 3 <> 1").withColumn(
        "dosage", F.when(F.col("product_id") % 3 == 2, F.lit("changed")).otherwise(F.col("dosage"))).drop("product_id").withColumns({
            "clean_dosage": F.lit("kept"), "clean_ingredient": F.lit("KEPT"), "forms": F.lit("kept")})
    return op.drug_fields(inputs, stored, "ean").select("ean", "clean_dosage", "clean_ingredient", "forms", "computed")


@query("d43_normalisation_cache", f"""
WITH {PRODUCTS} SELECT ean, CASE WHEN product_id % 5 = 0 THEN 'cached' ELSE upper(name) END AS result, product_id % 5 <> 0 AS computed FROM products""")
def normalisation_cache(t):
    p = src.products(t)
    stored = p.filter("product_id % 5 < 2").selectExpr("ean", "CASE WHEN product_id % 5 = 0 THEN name ELSE 'stale' END AS name", "'cached' AS result")
    return op.refresh_results(p, stored, "ean", ["name"], {"result": lambda: F.upper("name")}).select("ean", "result", "computed")


@query("f17_dosage_in_name", f"""
WITH {PRODUCTS}, x AS (SELECT ean, name || CASE size % 4 WHEN 0 THEN ' ' || size || ' MG/5ml' WHEN 1 THEN ' ' || size || ',5 % creme' WHEN 2 THEN ' ' || size || 'g' ELSE ' 10UI / mL x' END AS n, size FROM products)
SELECT ean, CASE size % 4 WHEN 0 THEN size || 'MG/5ml' WHEN 1 THEN size || ',5%' WHEN 3 THEN '10UI/mL' END AS dosage FROM x""")
def dosage_in_name(t):
    n = F.expr("name || CASE size % 4 WHEN 0 THEN ' ' || size || ' MG/5ml' WHEN 1 THEN ' ' || size || ',5 % creme' WHEN 2 THEN ' ' || size || 'g' ELSE ' 10UI / mL x' END")
    return src.products(t).select("ean", pharma.dosage_in_name(n).alias("dosage"))


@query("f21_quintiles", """
SELECT p_partkey, CAST(CASE WHEN p_size <= 10 THEN 1 WHEN p_size <= 20 THEN 2 WHEN p_size <= 30 THEN 3 WHEN p_size <= 40 THEN 4 ELSE 5 END AS INTEGER) AS rising,
  CAST(CASE WHEN p_size <= 10 THEN 5 WHEN p_size <= 20 THEN 4 WHEN p_size <= 30 THEN 3 WHEN p_size <= 40 THEN 2 ELSE 1 END AS INTEGER) AS falling FROM part""")
def quintiles(t):
    cuts = [F.lit(c) for c in (10, 20, 30, 40)]
    return t.part.select("p_partkey", scoring.quintile(F.col("p_size"), cuts).alias("rising"), scoring.quintile(F.col("p_size"), cuts, False).alias("falling"))


_ODD = "CASE p_partkey % 10 WHEN 0 THEN ' N/A ' WHEN 1 THEN '' WHEN 2 THEN '--!' WHEN 3 THEN 'x' WHEN 4 THEN 'aaaa' WHEN 5 THEN '1111' WHEN 6 THEN '12345' WHEN 7 THEN NULL ELSE p_name END"


@query("f22_says_nothing", f"WITH x AS (SELECT p_partkey, {_ODD} AS v FROM part) SELECT p_partkey, {nothing_sql('v')} AS strict, {nothing_sql('v', True)} AS numeric FROM x")
def says_nothing(t):
    v = F.expr(_ODD)
    return t.part.select("p_partkey", scoring.says_nothing(v).alias("strict"), scoring.says_nothing(v, True).alias("numeric"))


def _odd(t):
    return t.part.selectExpr("p_partkey", f"{_ODD} AS v", f"{_ODD} AS code", f"{_ODD} AS kept", f"array({_ODD}, p_brand) AS names")


@query("n4_invalid_sweep", f"""
WITH x AS (SELECT p_partkey, {_ODD} AS v, p_brand FROM part)
SELECT p_partkey, CASE WHEN NOT {nothing_sql('v')} THEN v END AS v, CASE WHEN NOT {nothing_sql('v', True)} THEN v END AS code, v AS kept, CASE WHEN NOT {nothing_sql('v')} THEN v || '|' ELSE '' END || p_brand AS names FROM x""")
def invalid_sweep(t):
    clean, _ = op.invalid_sweep(_odd(t), ["kept"], ["code"])
    return clean.withColumn("names", F.array_join("names", "|"))


@query("n4_null_counts", f"""
WITH x AS (SELECT p_partkey, {_ODD} AS v FROM part)
SELECT 'v' AS "column", count(*) FILTER (v IS NULL) AS nulls_before, count(*) FILTER ({nothing_sql('v')}) AS nulls_after FROM x UNION ALL
SELECT 'code', count(*) FILTER (v IS NULL), count(*) FILTER ({nothing_sql('v', True)}) FROM x UNION ALL SELECT 'kept', count(*) FILTER (v IS NULL), count(*) FILTER (v IS NULL) FROM x UNION ALL
SELECT 'names', 0, 0 UNION ALL SELECT 'p_partkey', 0, 0""")
def null_counts(t):
    return op.invalid_sweep(_odd(t), ["kept"], ["code"])[1]


@query("n5_similar_name_pairs", f"""
WITH a AS (SELECT item_id AS id, {tokens_sql('text')} AS t FROM benchmark), b AS (SELECT conv_id * 1000 + turn AS id, {tokens_sql('text')} AS t FROM conversations),
x AS (SELECT a.id AS left_id, b.id AS right_id, len(list_intersect(a.t, b.t)) AS k, len(a.t) + len(b.t) AS n FROM a, b)
SELECT left_id, right_id, {r('k / (n - k)', 6)} AS similarity FROM x WHERE k > 0 AND {r('k / (n - k)', 6)} >= 0.1 AND {r('k / (n - k)', 6)} < 0.95""")
def similar_name_pairs(t):
    left = t.benchmark.select(F.col("item_id").alias("id"), F.col("text").alias("name"))
    right = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("name"))
    return op.similar_name_pairs(left, right, 0.1)


_HTML = "regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
for _e, _s in text.ENTITIES:
    _HTML = f"replace({_HTML}, '{_e}', '{_s.replace(chr(39), chr(39) * 2)}')"


@query("n6_document_texts", f"SELECT page_id, trim(regexp_replace({_HTML}, '\\s+', ' ', 'g')) AS text FROM pages WHERE page_id % 3 <> 0 AND trim(regexp_replace({_HTML}, '\\s+', ' ', 'g')) <> ''")
def document_texts(t):
    return op.document_texts(t.pages, "page_id", "html", t.pages.filter("page_id % 3 = 0"))[0]


@query("n6_structured_texts")
def structured_texts(t):
    """Pages as lines: paragraphs, headings, lists, tables."""
    return op.document_texts(t.pages, "page_id", "html", render=html.lines)[0]


@query("d47_leaflet_texts", f"SELECT page_id, trim(regexp_replace({_HTML}, '\\s+', ' ', 'g')) AS text FROM pages WHERE page_id NOT IN (SELECT page_id FROM pages WHERE url LIKE '%/en/%')")
def leaflet_texts(t):
    return enrich.leaflet_texts(t.pages, t.pages.filter(F.col("url").like("%/en/%")), "page_id", "html")


@query("f24_sections_text", f"""
WITH x AS (SELECT page_id, trim(regexp_replace({_HTML}, '\\s+', ' ', 'g')) AS t FROM pages) SELECT page_id, md5(t || ' ' || 'end') AS digest FROM x""")
def sections_text(t):
    sections = F.array(F.struct(F.lit("a").alias("title"), F.col("html").alias("content")), F.struct(F.lit("b").alias("title"), F.lit("<b>end</b>").alias("content")))
    return t.pages.select("page_id", F.md5(text.sections_text(sections)).alias("digest"))


@query("f25_forms", f"WITH {PRODUCTS} SELECT ean, CASE WHEN size % 3 > 0 THEN 'gel|creme|' || lower(category) ELSE '' END AS forms FROM products")
def forms(t):
    raw = F.when(F.col("size") % 3 > 0, F.concat(F.lit("Gél / Creme (tubo),, "), "category"))
    return src.products(t).select("ean", F.array_join(pharma.forms(raw), "|").alias("forms"))


@query("f26_most_frequent", f"""
WITH {PRODUCTS}, c AS (SELECT brand, v, count(*) AS n FROM (SELECT brand, unnest(string_split(name, ' ')) AS v FROM products WHERE size % 3 = 0 AND brand <> 'Brand#9') GROUP BY 1, 2), m AS (SELECT brand, arg_min(v, (-n, v)) AS v FROM c GROUP BY 1)
SELECT b.brand, coalesce(v, 'nao_informado') AS most_frequent FROM (SELECT DISTINCT brand FROM products) b LEFT JOIN m USING (brand)""")
def most_frequent(t):
    lists = F.when((F.col("size") % 3 == 0) & (F.col("brand") != "Brand#9"), F.split("name", " ")).otherwise(F.array().cast("array<string>"))
    return op.most_frequent(src.products(t).select("brand", lists.alias("values")), "brand", "values")


@query("f27_prune_empty", f"WITH {PRODUCTS} SELECT ean, concat_ws('|', CASE WHEN size % 2 = 0 THEN name END, CASE WHEN size % 3 > 0 THEN brand END) AS kept, size % 2 = 1 AND size % 3 = 0 AS emptied FROM products")
def prune_empty(t):
    kept = text.prune_empty(F.array(F.when(F.col("size") % 2 == 0, F.col("name")), F.when(F.col("size") % 3 > 0, F.col("brand")).otherwise("")))
    return src.products(t).select("ean", F.coalesce(F.array_join(kept, "|"), F.lit("")).alias("kept"), kept.isNull().alias("emptied"))
