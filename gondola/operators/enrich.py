"""Enrichment: consolidation with provenance, precedence merges, classification rules, backlogs."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.scoring import says_nothing
from gondola.functions.text import alnum_key, html_text, matching_tokens, unaccent
from gondola.operators.kit import contains_join, exact_percentiles, latest, null_safe_join, order_positions, top_n
from gondola.operators.standardise import closest_terms
from gondola.operators.vectors import dense_top_k

# Wording (lower case, without accents) that restricts a product to an age group or sex. A pair of lists stands for a
# word of the first list somewhere before a word of the second.
CHILDREN, BABIES = ["crianca"], ["bebe"]
DENIALS = ["nao recomendado", "nao recomendada", "evite", "contraindicado"]
NOT_FOR_CHILDREN = [
    (DENIALS, CHILDREN + BABIES), (["nao"], ["indicado"], CHILDREN + BABIES),
    (["mantenha", "manter"], ["alcance", "longe"], CHILDREN),
]
FOR_BABIES = ["recem-nascido", "0-2 anos", "chupeta", "mamadeira"]
FOR_CHILDREN = ["infantil", "pediatrico", "para crianca", "3-12 anos"]
CHILD_PAIRS = [(CHILDREN, ["para"]), (["cuidado"], CHILDREN), (CHILDREN, ["cuidado"])]
FOR_TEENS = ["13-17 anos"]
FOR_SENIORS = ["terceira idade", "60+", "65+"]
FOR_ADULTS = ["uso adulto", "para adulto", "produto adulto", "publico adulto"]
WHOLE_WORDS = {"bebe": ["bebe", "bebes"], "adolescente": ["adolescente"], "idoso": ["idoso", "senior"]}
WOMEN = ["mulher", "feminino", "gestante", "gravidez", "menopausa"]
MEN = ["homem", "homens", "masculino", "barba", "prostata"]
WOMEN_NAMES = ["esmalte", "maquiagem", "batom", "rimel", "sombra", "blush", "feminino", "mulher", "rosa", "pink"]
MEN_NAMES = ["barba", "masculino", "homem", "homens"]
SEX_DENIALS = ["nao recomendado", "evite", "contraindicado"]


def _any(words: Sequence[str]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def _in_order(*lists: Sequence[str]) -> str:
    return ".*".join(_any(words) for words in lists)


def _whole(group: str) -> str:
    return rf"(?:^|[^\p{{L}}]){_any(WHOLE_WORDS[group])}(?:$|[^\p{{L}}])"


def age_rules() -> list[tuple[str, str]]:
    """(pattern, age group) in the order in which they are tried."""
    return [
        ("|".join(_in_order(*lists) for lists in NOT_FOR_CHILDREN), "adulto"),
        (f"{_whole('bebe')}|{_any(FOR_BABIES)}", "bebe"),
        (f"{_any(FOR_CHILDREN)}|{'|'.join(_in_order(*pair) for pair in CHILD_PAIRS)}", "crianca"),
        (f"{_whole('adolescente')}|{_any(FOR_TEENS)}", "adolescente"),
        (f"{_whole('idoso')}|{_any(FOR_SENIORS)}", "idoso"),
        (_any(FOR_ADULTS), "adulto"),
    ]


def not_for(person: str) -> str:
    return _in_order(SEX_DENIALS, [person])


def consolidate_flag(base: DataFrame, categories: DataFrame, corrections: DataFrame, prefix: str) -> DataFrame:
    """(code, flag, source): the correction, else whether any category of the latest categorisation starts
    with `prefix`, else the base flag. `base`: code, flag; `categories`: code, made_at, seq, supers;
    `corrections`: code, flag."""
    last = latest(categories, ["code"], [F.desc("made_at"), F.desc("seq")]).select(
        "code", F.when(F.size("supers") > 0, F.exists("supers", lambda s: s.startswith(prefix))).alias("_cat"))
    fixed = corrections.select("code", F.col("flag").alias("_fix"))
    out = base.join(last, "code", "left").join(fixed, "code", "left")
    source = (
        F.when(F.col("_fix").isNotNull(), "correction").when(F.col("_cat").isNotNull(), "category")
        .when(F.col("flag").isNotNull(), "base"))
    return out.select("code", F.coalesce("_fix", "_cat", "flag").alias("flag"), source.alias("source"))


def merge_by_precedence(products: DataFrame, authority: DataFrame, key: str, rules: dict[str, str], long: int = 1000) -> DataFrame:
    """Products with fields of an authority table: per column `product`, `authority`, `product_first`,
    `authority_first`, or `authority_unless_long` (the product's value where the authority's reaches
    `long` characters)."""
    p, a = products.alias("p"), authority.alias("a")
    out = []
    for c, rule in rules.items():
        mine, theirs = F.col(f"p.{c}") if c in products.columns else None, F.col(f"a.{c}") if c in authority.columns else None
        value = {
            "product": lambda m, o: m, "authority": lambda m, o: o, "product_first": lambda m, o: F.coalesce(m, o),
            "authority_first": lambda m, o: F.coalesce(o, m),
            "authority_unless_long": lambda m, o: F.when(F.length(o) >= long, m).otherwise(F.coalesce(o, m)),
        }[rule](mine, theirs)
        out.append(value.alias(c))
    return p.join(a, F.col(f"p.{key}") == F.col(f"a.{key}"), "left").select(*out)


def overlay(df: DataFrame, update: DataFrame, keys: Sequence[str], mode: str = "override") -> DataFrame:
    """Shared columns from `update`: `override` lets its values win, `fill` only fills nulls."""
    shared = [c for c in update.columns if c in df.columns and c not in keys]
    new = update.select(*keys, *[F.col(c).alias(f"_{c}") for c in shared])
    pick = (lambda c: F.coalesce(f"_{c}", c)) if mode == "override" else (lambda c: F.coalesce(c, f"_{c}"))
    return df.join(new, list(keys), "left").select(*[pick(c).alias(c) if c in shared else F.col(c) for c in df.columns])


def market_backfill(products: DataFrame, market: DataFrame, max_name: int = 140) -> DataFrame:
    """Trade name where blank or too long, kind from the market's letter, OTC flag from its view. `products`:
    code, trade_name, kind, is_otc; `market`: code, presentation, letter, view."""
    j = products.join(market, "code", "left")
    name = F.col("trade_name")
    kind = F.when(F.col("letter") == "G", "generic").when(F.col("letter") == "R", "reference").when(F.col("letter") == "S", "similar")
    return j.select(
        "code",
        F.when(name.isNull() | (name == "") | (F.length(name) > max_name), F.col("presentation")).otherwise(name).alias("trade_name"),
        F.when(F.col("kind").isNull() | (F.col("kind") == ""), F.coalesce(kind, F.col("kind"))).otherwise(F.col("kind")).alias("kind"),
        F.coalesce("is_otc", F.when(F.col("view") == "OTC", True).when(F.col("view") == "RX", False)).alias("is_otc"))


def manual_corrections(
    df: DataFrame, sheet: DataFrame, key: str, texts: Sequence[str], lists: Sequence[str], names: dict[str, dict[str, str]]
) -> DataFrame:
    """A correction sheet over the products: blank cells change nothing, pipe texts are trimmed part by
    part, list cells become lists, enumeration names become their values."""
    fix = [F.col(key)]
    for c in sheet.columns:
        if c == key:
            continue
        parts = F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda x: x != "")
        value = F.when(~says_nothing(F.col(c), True), F.trim(c))
        if c in lists:
            value = F.when(F.size(parts) > 0, parts)
        elif c in texts:
            value = F.when(F.size(parts) > 0, F.array_join(parts, "|"))
        elif c in names:
            lookup = F.create_map(*[F.lit(x) for pair in names[c].items() for x in pair])
            value = lookup[F.trim(c)]
        fix.append(value.alias(c))
    return overlay(df, latest(sheet, [key], [F.col(c) for c in sheet.columns if c != key]).select(*fix), [key])


def prescriptions(
    products: DataFrame, mapping: DataFrame, keywords: Sequence[str], keyword_text: str
) -> DataFrame:
    """Standard prescription text, type, validity and stripe: looked up by the trimmed lower-case text, stripe
    inferred where missing, and overridden for ingredients that contain a keyword. `products`: code,
    prescription, stripe, ingredient; `mapping`: prescription, standard, stripe_inferred, valid_days."""
    look = mapping.select(F.trim(F.lower("prescription")).alias("prescription"), "standard", "stripe_inferred", "valid_days")
    j = products.withColumn("prescription", F.trim(F.lower("prescription"))).join(look, "prescription", "left")
    special = F.lit(False)
    for k in keywords:
        special = special | F.coalesce(F.contains(F.lower("ingredient"), F.lit(k)), F.lit(False))
    standard = F.lower(F.coalesce("standard", "prescription"))
    return j.select(
        "code", F.when(special, keyword_text).otherwise(standard).alias("prescription"),
        F.when(special, F.substring_index(F.lit(keyword_text), " (", 1)).otherwise(F.substring_index(standard, " (", 1)).alias("type"),
        F.coalesce("stripe", "stripe_inferred").alias("stripe"), "valid_days")


def otc_decision(products: DataFrame, otc_list: DataFrame, no_stripe: str) -> DataFrame:
    """OTC flag with its source: the official list (same ingredient key; one of its forms within the
    product's form or the other way round, or no form known), else the market flag, else the stripe.
    `products`: code, ingredient, form, is_otc, stripe; `otc_list`: ingredient, forms."""
    listed = otc_list.select(alnum_key(F.col("ingredient")).alias("_k"), F.explode("forms").alias("_f")).select(
        "_k", F.lower(unaccent(F.col("_f"))).alias("_f")).distinct()
    mine = products.withColumn("_k", alnum_key(F.col("ingredient"))).withColumn("_form", F.lower(unaccent(F.col("form"))))
    hit = F.col("_form").isNull() | F.contains(F.col("_form"), F.col("_f")) | F.contains(F.col("_f"), F.col("_form"))
    official = mine.join(listed, "_k").filter(hit).select("code").distinct().withColumn("_official", F.lit(True))
    j = products.join(official, "code", "left")
    by_stripe = F.col("stripe") == no_stripe
    return j.select(
        "code",
        F.when(F.col("_official"), True).when(F.col("is_otc").isNotNull(), F.col("is_otc")).when(by_stripe, True).alias("is_otc"),
        F.when(F.col("_official"), "list").when(F.col("is_otc").isNotNull(), "market").when(by_stripe, "stripe").alias("source"))


def controlled_flag(products: DataFrame, terms: DataFrame, min_name: int = 5) -> DataFrame:
    """Medicines whose ingredient (or, without one, the first words of the name) contains a controlled term.
    `products`: code, name, ingredient, is_medicine; `terms`: term."""
    first = alnum_key(F.regexp_extract("name", r"(?i)^([\p{L}\-]+(?:\s+[\p{L}\-]+)?)", 1))
    looked = F.coalesce(
        F.when(F.trim("ingredient") != "", F.lower(unaccent(F.trim("ingredient")))), F.when(F.length(first) >= min_name, first))
    texts = products.filter("is_medicine").select("code", looked.alias("_text")).filter(F.col("_text").isNotNull())
    plain = terms.select(F.lower(unaccent(F.col("term"))).alias("term"))
    hits = contains_join(texts, "code", "_text", plain, "term").select("code").distinct().withColumn("_hit", F.lit(True))
    return products.join(hits, "code", "left").select("code", F.coalesce("_hit", F.lit(False)).alias("is_controlled"))


def keyword_classes(products: DataFrame, pattern: str, deny_like: Sequence[str], deny_names: Sequence[str]) -> DataFrame:
    """Medicine flag of unclassified products by a keyword pattern on the name; names on the deny lists are
    no medicines, classified or not, and that verdict wins. `products`: code, name, is_medicine."""
    denied = F.col("name").isin(list(deny_names))
    for p in deny_like:
        denied = denied | F.col("name").like(p)
    guessed = products.filter(F.col("is_medicine").isNull()).select("code", F.col("name").rlike(pattern).alias("flag"))
    fixed = products.filter(denied).select("code", F.lit(False).alias("flag"))
    return guessed.unionByName(fixed).groupBy("code").agg(F.bool_and("flag").alias("is_medicine"))


def age_and_sex(products: DataFrame, key: str) -> DataFrame:
    """Recommended age group and sex from the texts of a product, restrictions first, where the product has none: values that
    are given and not blank stay. `products`: key, name, description, indication, categories (list), age_group, sex."""
    text = F.lower(unaccent(F.concat_ws(" ", "name", "description", "indication", F.concat_ws(" ", "categories"))))
    name = F.lower(unaccent(F.col("name")))
    group = F.lit("todos")
    for pattern, label in reversed(age_rules()):
        group = F.when(text.rlike(pattern), label).otherwise(group)
    women = text.rlike(_any(WOMEN)) | name.rlike(_any(WOMEN_NAMES))
    men = text.rlike(_any(MEN)) | name.rlike(_any(MEN_NAMES))
    sex = (
        F.when(text.rlike(not_for("mulher")), "homem").when(text.rlike(not_for("homem")), "mulher")
        .when(women & ~men, "mulher").when(men & ~women, "homem").otherwise("todos"))

    def unless_given(column: str, found: Column) -> Column:
        return F.when(F.trim(column) != "", F.col(column)).otherwise(found).alias(column)

    return products.select(key, unless_given("age_group", group), unless_given("sex", sex))


def token_categories(
    products: DataFrame, vocabulary: DataFrame, deny: Sequence[str], min_term: int = 4, max_name: int = 3, max_ingredient: int = 3
) -> DataFrame:
    """(code, path) of products whose words are terms of a category. Words of medicines must stand in name
    and ingredient, and only match medicine categories; other products match the rest by name. `products`:
    code, name, ingredient, is_medicine; `vocabulary`: path, is_medicine, terms (list)."""
    terms = vocabulary.select("path", "is_medicine", F.explode("terms").alias("_t")).select(
        "path", "is_medicine", F.trim(F.upper(unaccent(F.col("_t")))).alias("_w")).filter(
        (F.length("_w") >= min_term) & ~F.col("_w").isin(list(deny))).distinct()
    none = F.lit(None).cast("string")
    by_name = matching_tokens(F.col("name"), none, min_term, list(deny), max_name, max_ingredient)
    by_both = F.array_intersect(by_name, matching_tokens(none, F.col("ingredient"), min_term, list(deny), max_name, max_ingredient))
    words = products.select(
        "code", "is_medicine", F.explode(F.when(F.col("is_medicine"), by_both).otherwise(by_name)).alias("_w")).distinct()
    return words.join(terms, ["_w", "is_medicine"]).select("code", "path").distinct()


def repair_vocabulary(
    df: DataFrame, key: str, vocabulary: DataFrame, columns: Sequence[str], closest: Callable[[DataFrame, DataFrame], DataFrame] = closest_terms
) -> DataFrame:
    """Values outside their column's vocabulary are replaced by the closest term, where one shares a word.
    `vocabulary`: vocabulary (column name), term; `closest`: `closest_terms` or `fuzzy_terms`."""
    flat = df.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("vocabulary"), F.col(c).alias("value")) for c in columns])))
    wrong = flat.filter(F.trim("value") != "").join(
        vocabulary.select("vocabulary", F.col("term").alias("value")).distinct(), ["vocabulary", "value"], "left_anti")
    terms = closest(wrong.select("vocabulary", "value"), vocabulary)
    fixed = wrong.join(terms, ["vocabulary", "value"]).groupBy(key).agg(*[
        F.max(F.when(F.col("vocabulary") == c, F.col("term"))).alias(c) for c in columns])
    return overlay(df, fixed, [key])


def flatten_paths(categories: Column) -> Column:
    """List of (super, meso, micro) structs to 'super -> meso [-> micro]' texts."""
    return F.transform(categories, lambda c: F.when(
        c["micro"].isNotNull() & (c["micro"] != "null") & (F.trim(c["micro"]) != ""),
        F.concat_ws(" -> ", c["super"], c["meso"], c["micro"])).otherwise(F.concat_ws(" -> ", c["super"], c["meso"])))


def valid_paths(df: DataFrame, key: str, taxonomy: DataFrame) -> DataFrame:
    """Category paths with the taxonomy's spelling, level by level (exact, else ignoring case); an unknown
    super or meso level rejects the path, an unknown micro level is dropped. `df`: key, super, path ('meso'
    or 'meso -> micro'); `taxonomy`: super, meso, micro."""
    parts = F.split("path", " -> ")
    rows = df.filter(F.size(parts) <= 2).select(
        key, "super", F.trim(parts[0]).alias("meso"), F.trim(F.get(parts, F.lit(1))).alias("micro")).filter("meso <> ''")

    def level(names: list[str]) -> DataFrame:
        """One spelling per lower-case name and parents, and every exact spelling."""
        once = taxonomy.select(*names).distinct().filter(F.col(names[-1]).isNotNull())
        low = once.groupBy(*names[:-1], F.lower(names[-1]).alias("_low")).agg(
            F.min(names[-1]).alias("_any"), F.collect_set(names[-1]).alias("_all"))
        return low

    def spell(frame: DataFrame, names: list[str], how: str) -> DataFrame:
        c = names[-1]
        met = frame.withColumn("_low", F.lower(c)).join(level(names), [*names[:-1], "_low"], how)
        right = F.when(F.array_contains("_all", F.col(c)), F.col(c)).otherwise(F.col("_any"))
        return met.withColumn(c, right).drop("_low", "_any", "_all")

    out = spell(rows, ["super"], "inner")
    out = spell(out, ["super", "meso"], "inner")
    out = spell(out, ["super", "meso", "micro"], "left")
    return out.select(key, "super", "meso", "micro")


def remap_labels(df: DataFrame, key: str, labels: str, mapping: DataFrame) -> DataFrame:
    """Labels replaced through a mapping table, unmapped ones dropped, in their order. The list of a row is
    rebuilt from its own elements. `mapping`: label, standard."""
    flat = df.select(key, F.posexplode(labels).alias("_p", "label")).join(mapping, "label")
    lists = flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_p", "standard"))).alias("_l"))
    mapped = F.coalesce(F.transform("_l", lambda x: x["standard"]), F.array().cast("array<string>"))
    return df.join(lists, key, "left").withColumn(labels, F.when(F.col(labels).isNotNull(), mapped)).drop("_l")


def size_tiers(products: DataFrame, group: Sequence[str], quantity: str) -> DataFrame:
    """Small, medium or large by the group's exact thirds; medium when the quantity is unknown."""
    cuts = exact_percentiles(products, group, quantity, {"p33": 0.33, "p66": 0.66})
    q = F.col(quantity)
    out = null_safe_join(products, cuts, group, "left")
    return out.withColumn("tier", F.when(q < F.col("p33"), "P").when(q > F.col("p66"), "G").otherwise("M")).drop("p33", "p66")


def propagate(
    products: DataFrame, group: Sequence[str], attributes: Sequence[str], quality: str, order: Sequence[Column], floor: float = 40
) -> DataFrame:
    """Attributes of the best product of an equivalence group (all attributes filled, quality at least
    `floor`) for its members that lack some. Groups are the non-blank normalised `group` columns; the best
    row is the one with the highest quality. `products`: code, group, attributes, quality."""
    keyed = products.withColumns({f"_{g}": alnum_key(F.col(g)) for g in group})
    keys = [f"_{g}" for g in group]
    for k in keys:
        keyed = keyed.filter(F.coalesce(F.col(k), F.lit("")) != "")
    whole = F.lit(True)
    for a in attributes:
        whole = whole & F.coalesce(F.trim(a) != "", F.lit(False))
    best = latest(keyed, keys, [F.desc_nulls_last(quality), *order]).filter(whole & (F.col(quality) >= floor))
    source = best.select(*keys, F.col("code").alias("source"), *[F.col(a).alias(f"_s_{a}") for a in attributes])
    needy = keyed.filter(~whole).join(source, keys).filter(F.col("code") != F.col("source"))
    return needy.select("code", "source", *[
        F.when(F.trim(a) != "", F.col(a)).otherwise(F.col(f"_s_{a}")).alias(a) for a in attributes])


def neighbour_transfer(
    products: DataFrame, vectors: DataFrame, attributes: Sequence[str], done: DataFrame, cutoff: Column, floor: float,
    nearest: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Attributes copied from the most similar complete product to products that miss some and were never,
    or not since `cutoff`, matched. `products`: code, attributes; `vectors`: code, vector; `done`: code,
    matched_on; `nearest`: finds (query, id, score) in a corpus (id, vector) for queries (query, vector), exactly by default. Returns
    code, source, score and the attributes."""
    missing = F.lit(False)
    for a in attributes:
        missing = missing | F.col(a).isNull()
    waiting = (
        products.filter(missing).join(done, "code", "left")
        .filter(F.col("matched_on").isNull() | (F.col("matched_on") <= cutoff)).drop("matched_on"))
    whole = products.filter(~missing)
    find = nearest or (lambda corpus, asked: dense_top_k(corpus, asked, 1, floor))
    near = find(
        vectors.join(whole.select("code"), "code", "left_semi").withColumnRenamed("code", "id"),
        vectors.join(waiting.select("code"), "code", "left_semi").withColumnRenamed("code", "query"))
    given = whole.select(F.col("code").alias("id"), *[F.col(a).alias(f"_{a}") for a in attributes])
    return waiting.join(near.withColumnRenamed("query", "code"), "code").join(given, "id").select(
        "code", F.col("id").alias("source"), "score", *[F.coalesce(a, f"_{a}").alias(a) for a in attributes])


def plan_backlog(
    all_products: DataFrame, wanted: DataFrame, enriched: DataFrame, since: Column, threshold: float, recent_share: float
) -> DataFrame:
    """Products to process now with the reason and the decision. Never-enriched ones always go. Redone ones
    go when they are at most `threshold` of all products; beyond it only the recent ones (made since
    `since`), if those are more than `recent_share` of all; otherwise the run is to be stopped and no redo is
    selected. `wanted`: code, made_on; `enriched`: code."""
    total = all_products.agg(F.count(F.lit(1)).alias("n")).scalar()
    split = wanted.join(enriched.select("code").distinct().withColumn("_done", F.lit(True)), "code", "left")
    redo = split.filter(F.col("_done"))
    many = redo.agg(F.count(F.lit(1)).alias("n")).scalar()
    fresh = redo.filter(F.col("made_on") >= since).agg(F.count(F.lit(1)).alias("n")).scalar()
    decision = (
        F.when(many <= threshold * total, "all").when(fresh > recent_share * total, "recent only").otherwise("stop"))
    is_new = F.col("_done").isNull()
    selected = is_new | (decision == "all") | ((decision == "recent only") & F.coalesce(F.col("made_on") >= since, F.lit(False)))
    return split.select(
        "code", F.when(is_new, "never").otherwise("redo").alias("reason"), decision.alias("decision"), selected.alias("selected"))


def missing_fields(backlog: DataFrame, enriched: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Nulls per required field among the products to redo."""
    rows = enriched.join(backlog.filter("reason = 'redo'").select("code"), "code", "left_semi")
    one = rows.agg(*[F.count(F.when(F.col(f).isNull(), 1)).alias(f) for f in fields])
    return one.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("nulls")) for f in fields])))


def validated(results: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Results with all columns, 'null' texts as nulls, without rows that have no key."""
    out = []
    for c in columns:
        if c not in results.columns:
            out.append(F.lit(None).cast("string").alias(c))
        elif results.schema[c].dataType.typeName() == "string":
            out.append(F.when(F.lower(F.trim(c)) != "null", F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return results.select(*out).filter(F.col(key).isNotNull())


def replace_short(products: DataFrame, external: DataFrame, key: str, fields: dict[str, int]) -> DataFrame:
    """Fields shorter than their minimum (null counts as empty) take the external text, where there is one;
    the fields that were short are listed."""
    ext = external.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    short = {f: F.coalesce(F.length(f), F.lit(0)) < n for f, n in fields.items()}
    j = products.join(ext, key, "left")
    marked = j.withColumn("short", F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(f)) for f, c in short.items()])), "|"))
    return marked.withColumns({f: F.when(c, F.coalesce(f"_{f}", f)).otherwise(F.col(f)) for f, c in short.items()}).drop(
        *[f"_{f}" for f in fields])


def leaflet_texts(leaflets: DataFrame, done: DataFrame, key: str, html: str) -> DataFrame:
    """Plain text of leaflets not extracted before."""
    return leaflets.join(done.select(key), key, "left_anti").select(key, html_text(F.col(html)).alias("text"))


def embedding_text(parts: Sequence[tuple[str, Column]]) -> Column:
    """Prefixed parts that have a value, joined by a blank line."""
    return F.concat_ws("\n\n", *[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(p), v)) for p, v in parts])


def category_recommendations(
    conversions: DataFrame, rules: DataFrame, tags: DataFrame, products: DataFrame,
    min_rules: int = 5, min_support: float = 0.00012, size: int = 5,
) -> DataFrame:
    """Up to `size` categories to recommend per product: from conversions, from rules (average over at least
    `min_rules` rules, support above the floor) and from tags, ordered by the average confidence between the
    product's own categories and the recommended one; kept when that is known or when it converted.
    `conversions`: product_id, category; `rules`: a, b, confidence, support; `tags`: product_id, category;
    `products`: product_id, categories."""
    own = products.select("product_id", F.explode("categories").alias("category"))
    to = own.select(F.col("product_id").alias("b"), F.col("category").alias("to"))
    by_rule = rules.join(to, "b").groupBy(F.col("a").alias("product_id"), F.col("to").alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("support").alias("s")).filter((F.col("n") >= min_rules) & (F.col("s") >= min_support))
    offers = (
        conversions.select("product_id", "category", F.lit(1).alias("_c"))
        .unionByName(by_rule.select("product_id", "category", F.lit(0).alias("_c")))
        .unionByName(tags.select("product_id", "category", F.lit(0).alias("_c")))
        .groupBy("product_id", "category").agg(F.max("_c").alias("converted")))
    start = own.select(F.col("product_id").alias("a"), F.col("category").alias("from"))
    between = rules.join(start, "a").join(to, "b").groupBy("from", "to").agg(
        F.avg("confidence").alias("c"), F.count(F.lit(1)).alias("n")).filter((F.col("n") >= min_rules) & (F.col("from") != F.col("to")))
    # only what is on offer: a product's categories are not paired with every other one
    fit = (
        offers.join(own.withColumnRenamed("category", "from"), "product_id").join(between.withColumnRenamed("to", "category"), ["from", "category"])
        .groupBy("product_id", "category").agg(F.round(F.avg("c"), 9).alias("confidence")))
    good = offers.join(fit, ["product_id", "category"], "left").filter(F.col("confidence").isNotNull() | (F.col("converted") == 1))
    return top_n(good, ["product_id"], [F.desc_nulls_last("confidence"), F.desc("converted"), F.col("category")], size, "place")


def vocabulary_table(lists: dict[str, Sequence[str]], ingredients: DataFrame) -> DataFrame:
    """All closed vocabularies in one table (vocabulary, value, plain, place), with the distinct ingredients
    in alphabetical order as one more. `ingredients`: value."""
    spark = ingredients.sparkSession
    rows = [(name, v, i + 1) for name, values in lists.items() for i, v in enumerate(values)]
    fixed = spark.createDataFrame(rows, "vocabulary string, value string, place bigint")
    found = ingredients.select("value").filter(F.trim("value") != "").distinct()
    placed = order_positions(found, [], [F.col("value")]).select(F.lit("ingredient").alias("vocabulary"), "value", F.col("position").cast("long").alias("place"))
    return fixed.unionByName(placed).withColumn("plain", F.lower(unaccent(F.col("value"))))


def priority_backlog(
    products: DataFrame, history: DataFrame, sold: DataFrame, cutoff: Column, size: int, term: str | None = None, min_name: int = 10
) -> DataFrame:
    """The `size` products to look up next: without brand or maker, with a usable name and description, not
    looked up since `cutoff`, best sellers first. `products`: code, name, description, brand, maker;
    `history`: code, looked_up_on; `sold`: code, value."""
    open_ = products.filter((F.length("name") >= min_name) & F.col("description").isNotNull() & (F.col("brand").isNull() | F.col("maker").isNull()))
    stale = open_.join(history, "code", "left").filter(F.col("looked_up_on").isNull() | (F.col("looked_up_on") <= cutoff))
    if term:
        like = f"%{term}%"
        stale = stale.filter(F.col("name").ilike(like) | F.col("brand").ilike(like) | F.col("maker").ilike(like))
    ranked = stale.join(sold, "code", "left").orderBy(F.desc_nulls_last("value"), F.col("code"))
    return ranked.limit(size).select("code", "name", "value")


def tags_with_terms(tags: DataFrame, key: str, columns: Sequence[str], terms: DataFrame) -> DataFrame:
    """(key, term): deny terms found anywhere in the tags of a product."""
    texts = tags.select(key, F.lower(F.concat_ws(" ", *columns)).alias("_text"))
    return contains_join(texts, key, "_text", terms.select(F.lower("term").alias("term")), "term")


def missing_and_stale(products: DataFrame, done: DataFrame, column: str, cutoff: Column) -> DataFrame:
    """Products without a value in `column`, never or not since `cutoff` processed. `done`: code, done_on."""
    return products.filter(F.coalesce(F.trim(column), F.lit("")) == "").join(done, "code", "left").filter(
        F.col("done_on").isNull() | (F.col("done_on") <= cutoff)).select("code")


def evaluation_scope(
    campaign: DataFrame, rivals: DataFrame, sold: DataFrame, judged: DataFrame, top: int = 1000, min_score: float = 0.9, redo_below: float = 0.5
) -> DataFrame:
    """Products to judge: campaign products, rivals above a score and the `top` best sellers, without those
    already judged, except where the verdict was low. `campaign`: code; `rivals`: code, score; `sold`: code,
    qty; `judged`: code, score."""
    best = sold.orderBy(F.desc("qty"), F.col("code")).limit(top).select("code")
    scope = campaign.select("code").union(rivals.filter(F.col("score") > min_score).select("code")).union(best).distinct()
    low = judged.filter(F.col("score") < redo_below).select("code").distinct()
    return scope.join(judged.select("code"), "code", "left_anti").union(scope.join(low, "code", "left_semi"))


def label_rows(answers: DataFrame, key: str, categories: DataFrame, max_length: int, max_labels: int) -> DataFrame:
    """(key, place, label, categories): labels of an answer text (one per line or comma, trimmed, lower case,
    not longer than `max_length`, first `max_labels`), each with its categories. `answers`: key, answer;
    `categories`: label, categories."""
    labels = F.array_distinct(F.filter(F.transform(F.split("answer", "[\n,;]"), lambda x: F.lower(F.trim(x))),
                                       lambda x: (x != "") & (F.length(x) <= max_length)))
    flat = answers.select(key, F.posexplode(F.slice(labels, 1, max_labels)).alias("place", "label"))
    return flat.join(categories, "label", "left")


def rekey(df: DataFrame, old: DataFrame, new: DataFrame, key: str, natural: str) -> DataFrame:
    """Rows of one environment under the keys of another, through a natural key both know."""
    bridge = old.select(F.col(key), F.col(natural).alias("_n")).join(
        new.select(F.col(key).alias("_new"), F.col(natural).alias("_n")), "_n").select(key, "_new")
    return df.join(bridge, key).withColumn(key, F.col("_new")).drop("_new")


def grouped_total(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with the total of their group, without a window over the group."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("group_total"), F.count(F.lit(1)).alias("group_rows"), F.max(value).alias("group_max"))
    return null_safe_join(df, totals, keys)

