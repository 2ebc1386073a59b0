"""Master data: fusing sources, electing survivors, linking and matching products."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.functions.codes import canonical_code, valid_barcode
from gondola.functions.scoring import sweep_nothing
from gondola.functions.text import alnum_key, slug
from gondola.operators.kit import (
    components,
    filled,
    latest,
    null_safe_join,
    one_edit_pairs,
    order_positions,
    prefix_join,
    product_join,
)
from gondola.session import lineage_cut


def fuse_sources(
    sources: dict[str, DataFrame], key: str, columns: Sequence[str], overrides: dict[str, Sequence[str]] | None = None,
    allow_numeric: Sequence[str] = (), exclude: Sequence[str] = (),
) -> DataFrame:
    """One row per key over all sources; each column takes the first value that says something, in the
    order of `sources` (for columns in `overrides`, the named sources first). All sources are tagged, put
    one below the other and folded in a single shuffle."""
    overrides = overrides or {}
    for column, names in overrides.items():
        unknown = set(names) - set(sources)
        if unknown:
            raise ValueError(f"unknown sources for {column}: {sorted(unknown)}")
    tagged = None
    for name, df in sources.items():
        clean = sweep_nothing(df, [key, *exclude], allow_numeric)
        row = clean.select(key, F.lit(name).alias("_source"), *[
            F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])
        tagged = row if tagged is None else tagged.unionByName(row)

    def place(column: str) -> Column:
        first = [*overrides.get(column, []), *[s for s in sources if s not in overrides.get(column, [])]]
        return F.element_at(F.create_map(*[x for i, s in enumerate(first) for x in (F.lit(s), F.lit(i))]), F.col("_source"))

    return tagged.groupBy(key).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), place(c))).alias(c) for c in columns])


def most_complete(df: DataFrame, keys: Sequence[str], tie: Sequence[Column], text: str | None = "description") -> DataFrame:
    """The row with most filled columns per key; a blank `text` is taken from the longest one among the
    key's rows."""
    score = sum((filled(df, c) for c in df.columns), F.lit(0))
    best = latest(df.withColumn("_score", score), keys, [F.desc("_score"), *tie]).drop("_score")
    if text is None or text not in df.columns:
        return best
    longest = df.filter(F.col(text).isNotNull()).groupBy(*keys).agg(
        F.max_by(text, F.struct(F.length(text), text)).alias("_longest"))
    blank = F.col(text).isNull() | (F.trim(text) == "")
    return best.join(longest, list(keys), "left").withColumn(
        text, F.when(blank, F.col("_longest")).otherwise(F.col(text))).drop("_longest")


def store_overrides(
    df: DataFrame, keys: Sequence[str], payload: str, schema: T.StructType, longest: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """JSON overrides of stores folded per key: the longest text for the `longest` fields, elsewhere the
    first value that is set, in `order`."""
    parsed = df.select(*keys, *order, F.from_json(payload, schema).alias("_p")).select(*keys, *order, "_p.*")
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    out = []
    for f in schema.fieldNames():
        c = F.col(f)
        if f in longest:
            out.append(F.max_by(c, F.when(c.isNotNull(), F.struct(F.length(f), c))).alias(f))
        else:
            out.append(F.min_by(c, F.when(c.isNotNull(), rank)).alias(f))
    return parsed.groupBy(*keys).agg(*out)


def stable_id(code: Column) -> Column:
    """An id that depends on the code alone, so a retried task mints the same one."""
    h = F.md5(code)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def assign_ids(df: DataFrame, code: str, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with `id`, updated registry): a given id stays, else the registered one of the code, else a
    new one. `registry`: code, id, one row per code."""
    known = registry.select(code, F.col("id").alias("_known"))
    rows = df.join(known, code, "left").withColumn("id", F.coalesce("id", "_known", stable_id(F.col(code))))
    new = rows.filter(F.col("_known").isNull()).groupBy(code).agg(F.min("id").alias("id"))
    return rows.drop("_known"), registry.select(code, "id").unionByName(new)


def elect_principal(df: DataFrame, code: str, in_campaign: DataFrame) -> DataFrame:
    """Marks one principal row among the codes that are equal without leading zeros: campaign codes first,
    then the most complete row, then the smallest code."""
    empties = sum((1 - filled(df, c) for c in df.columns), F.lit(0))
    flagged = (
        df.withColumn("completeness", F.round(1 - empties / len(df.columns), 6))
        .withColumn("canonical", canonical_code(F.col(code)))
        .join(in_campaign.select(code).distinct().withColumn("_c", F.lit(True)), code, "left")
        .withColumn("in_campaign", F.coalesce("_c", F.lit(False))).drop("_c")
    )
    chosen = latest(
        flagged.select("canonical", code, "in_campaign", "completeness"), ["canonical"],
        [F.desc("in_campaign"), F.desc("completeness"), F.col(code)]).select("canonical", F.col(code).alias("principal"))
    return flagged.join(chosen, "canonical").withColumn("is_principal", F.col(code) == F.col("principal"))


def fill_from_principal(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Nulls of the other rows of a group take the value of its principal row."""
    main = df.filter("is_principal").select(group, *[F.col(c).alias(f"_{c}") for c in columns])
    out = df.join(main, group, "left")
    for c in columns:
        out = out.withColumn(c, F.when(F.col("is_principal"), F.col(c)).otherwise(F.coalesce(c, f"_{c}"))).drop(f"_{c}")
    return out


def name_links(products: DataFrame, alternates: DataFrame) -> DataFrame:
    """Products linked by an alternate name that equals another product's name: one row per (code, name)
    with the number of other products of that name. All products of a name hang on the name itself, so a
    common name stays linear in its products. `products`: code, name; `alternates`: code, names."""
    asked = alternates.select("code", F.explode("names").alias("_n")).select("code", F.trim("_n").alias("name")).distinct()
    named = products.select("code", F.trim("name").alias("name")).distinct()
    counts = named.groupBy("name").agg(F.count(F.lit(1)).alias("_all"))
    own = named.withColumn("_own", F.lit(1))
    out = asked.join(counts, "name").join(own, ["code", "name"], "left")
    return out.withColumn("matched", F.col("_all") - F.coalesce("_own", F.lit(0))).filter("matched > 0").select(
        "code", "name", "matched")


def link_members(links: DataFrame, products: DataFrame) -> DataFrame:
    """Edges (code, hub) of the linked products and of the products that bear the name: the input of
    `components` for name links."""
    bears = products.select("code", F.trim("name").alias("name")).join(links.select("name").distinct(), "name", "left_semi")
    hub = F.concat(F.lit("name:"), F.md5("name"))
    return links.select("code", "name").unionByName(bears.select("code", "name")).distinct().select("code", hub.alias("hub"))


def closure(products: DataFrame) -> DataFrame:
    """(code, component, members): codes that reach each other over their alternative codes, in any number
    of steps. The alternatives of a code are the other members of its component. The work grows with the
    number of listed alternatives, so long lists take part. `products`: code, alternatives."""
    edges = products.filter(F.size("alternatives") > 0).select(F.col("code").alias("a"), F.explode("alternatives").alias("b"))
    labelled = components(edges, "a", "b")  # read from a table
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    return labelled.join(sizes, "component").select(F.col("node").alias("code"), "component", "members")


def same_maker(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alternatives whose brand and maker equal those of the product, rejected pairs), one row per pair.
    `products`: code, alternatives, brand, maker."""
    keyed = products.select(
        "code", "alternatives", alnum_key(F.col("brand")).alias("b"), alnum_key(F.col("maker")).alias("m"))
    other = keyed.filter(F.col("b").isNotNull() & F.col("m").isNotNull()).select(
        F.col("code").alias("alternative"), F.col("b").alias("ob"), F.col("m").alias("om"))
    pairs = keyed.select("code", "b", "m", F.explode("alternatives").alias("alternative")).distinct().join(other, "alternative", "left")
    same = F.coalesce((F.col("b") == F.col("ob")) & (F.col("m") == F.col("om")), F.lit(False))
    return pairs.filter(same).select("code", "alternative"), pairs.filter(~same).select("code", "alternative")


def overlay_exact(df: DataFrame, corrections: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Corrected rows take exactly the correction's values, nulls included."""
    fix = corrections.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_fixed"))
    out = df.join(fix, key, "left")
    for c in columns:
        out = out.withColumn(c, F.when(F.col("_fixed"), F.col(f"_{c}")).otherwise(F.col(c))).drop(f"_{c}")
    return out.drop("_fixed")


def code_status(df: DataFrame) -> DataFrame:
    """Active: the principal code, or a code without alternatives (which then lists its canonical code).
    `df`: code, principal, canonical, alternatives."""
    alone = (F.col("principal") != F.col("code")) & (F.size("alternatives") == 0)
    return df.withColumn("status", F.when((F.col("principal") == F.col("code")) | alone, "active").otherwise("inactive")).withColumn(
        "alternatives", F.when(alone, F.array("canonical")).otherwise(F.col("alternatives")))


def final_survivors(df: DataFrame, code: str) -> DataFrame:
    """One row per code: active first, then campaign, then campaign and guide sources, then the id."""
    source = F.when(F.contains("source", F.lit("campaign")), 0).when(F.contains("source", F.lit("guide")), 1).otherwise(2)
    return latest(df, [code], [
        F.when(F.col("status") == "active", 0).otherwise(1), F.when(F.col("in_campaign"), 0).otherwise(1), source, F.col("id")])


def merge_codes(*lists: Column) -> Column:
    """Valid, distinct codes of several lists."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(*[F.coalesce(x, empty) for x in lists]), valid_barcode))


def cascade_match(entries: DataFrame, products: DataFrame) -> DataFrame:
    """(entry columns, code, brand, stage): registry entries matched to products in stages; each one only
    sees entries without a match so far. 1 registration number; 2 brand slug = name slug; 3 = name slug
    with the maker; 4 brand slug starts with name slug and '-' (names over five characters); 5 the same
    after dropping a last part of one to three characters; 6 brand and name, and both ingredients, at most
    one edit apart. `entries`: entry_id, name, ingredient, maker, kind, registration; `products`: code,
    brand, ingredient, registration."""
    left = lineage_cut(entries.withColumn("_slug", slug(F.col("name"))))
    right = lineage_cut(products.select(
        "code", "brand", F.col("registration").alias("_reg"), F.col("ingredient").alias("_ing"), slug(F.col("brand")).alias("_brand")))
    kept = [*entries.columns, "_slug", "code", "brand"]

    def taken(df: DataFrame, stage: int) -> DataFrame:
        return df.select(*kept).distinct().withColumn("stage", F.lit(stage))

    found = [taken(left.filter(F.col("registration").isNotNull()).join(right, F.col("registration") == F.col("_reg")), 1)]
    triple = ["_slug", "ingredient", "_maker"]
    maker = F.coalesce("maker", F.lit("")).alias("_maker")
    rest = left.withColumn("_maker", maker).join(
        found[0].select("_slug", "ingredient", maker).distinct(), triple, "left_anti").drop("_maker")
    found.append(taken(rest.join(right, F.col("_slug") == F.col("_brand")), 2))

    def unmatched(df: DataFrame, matches: list[DataFrame]) -> DataFrame:
        seen = matches[0].select("_slug")
        for m in matches[1:]:
            seen = seen.unionByName(m.select("_slug"))
        return lineage_cut(df.join(seen.distinct(), "_slug", "left_anti"))

    rest = unmatched(left, found)
    with_maker = rest.filter(F.col("maker").isNotNull()).withColumn("_full", slug(F.concat_ws("-", "_slug", "maker")))
    found.append(taken(with_maker.join(right, F.col("_full") == F.col("_brand")), 3))

    rest = unmatched(rest, found[2:])
    long = rest.filter(F.length("_slug") > 5)
    found.append(taken(prefix_join(right, "_brand", long.withColumn("_p", F.concat("_slug", F.lit("-"))), "_p", 2), 4))

    rest = unmatched(rest, found[3:])
    trimmed = F.regexp_replace("_slug", "-(...|..|.|.-.|..-.|.-..)$", "")
    long = rest.filter(F.length("_slug") > 5).withColumn("_p", F.concat(trimmed, F.lit("-")))
    found.append(taken(prefix_join(right, "_brand", long, "_p", 2), 5))

    rest = unmatched(rest, found[4:]).filter(F.length("_slug") > 5)
    near = one_edit_pairs(rest, "_slug", right, "_brand")
    close = near.join(rest, "_slug").join(right, "_brand").filter(
        F.levenshtein(slug(F.col("ingredient")), slug(F.col("_ing"))) < 2)
    found.append(taken(close, 6))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.drop("_slug").withColumnRenamed("brand", "matched_brand")


#: Denied products that a reference takes along.
DENIED = 100


def interchangeable_pairs(
    entries: DataFrame, references: DataFrame, others: DataFrame, denied: DataFrame, block: int = 5000
) -> DataFrame:
    """(reference_code, other_code, kind) of interchangeable products. An entry finds its reference product
    by the slug of the reference name, and its own product by registration number, or by name slug where
    either number is missing: two equi-joins instead of one join on an OR. Denied pairs are dropped.

    There are as many pairs as references times products of a slug, so pairs are not shuffled again: a reference with one slug
    makes no pair twice, and takes up to `DENIED` denied products along. Pairs of other references are made distinct and lose
    denied ones in a join. The products of a slug are dealt into blocks of about `block`, which its references all meet.

    `entries`: reference_slug, name_slug, registration; `references`: slug, code; `others`: slug,
    registration, code, kind; `denied`: reference_code, other_code."""
    # a product takes part once per (reference, ...) combination, whatever the number of entries and of their numbers
    numbered, plain = entries.filter(F.col("registration").isNotNull()), entries.filter(F.col("registration").isNull())
    by_number = numbered.select("reference_slug", "registration").distinct().join(
        others.filter(F.col("registration").isNotNull()).select("registration", F.col("code").alias("other_code"), "kind").distinct(), "registration")
    own = others.select(F.col("slug").alias("name_slug"), "registration", F.col("code").alias("other_code"), "kind")
    no_entry_number = plain.select("reference_slug", "name_slug").distinct().join(own.drop("registration").distinct(), "name_slug")
    no_own_number = numbered.select("reference_slug", "name_slug").distinct().join(
        own.filter(F.col("registration").isNull()).drop("registration").distinct(), "name_slug")
    keep = ["reference_slug", "other_code", "kind"]
    met = by_number.select(*keep).unionByName(no_entry_number.select(*keep)).unionByName(no_own_number.select(*keep))
    met = lineage_cut(met.filter(F.col("reference_slug").isNotNull()).distinct())
    refs = references.select(F.col("slug").alias("reference_slug"), F.col("code").alias("reference_code")).distinct()
    slugs = refs.groupBy("reference_code").agg(F.count(F.lit(1)).alias("_slugs"))
    refused = denied.select("reference_code", "other_code").distinct()
    counted = refused.groupBy("reference_code").agg(F.count(F.lit(1)).alias("_n"))
    short = refused.join(counted.filter(F.col("_n") <= DENIED), "reference_code").groupBy("reference_code").agg(F.collect_set("other_code").alias("_denied"))
    refs = null_safe_join(refs, slugs, ["reference_code"]).join(counted, "reference_code", "left").join(short, "reference_code", "left")
    refs = lineage_cut(refs.withColumn("_once", (F.col("_slugs") == 1) & (F.coalesce("_n", F.lit(0)) <= DENIED)))

    def paired(some: DataFrame) -> DataFrame:
        return product_join(some, met, "reference_slug", ["other_code", "kind"], block)

    out = ["reference_code", "other_code", "kind"]
    once = paired(refs.filter("_once")).filter(~F.coalesce(F.array_contains("_denied", F.col("other_code")), F.lit(False))).select(*out)
    rest = paired(refs.filter("NOT _once")).select(*out).distinct().join(refused, ["reference_code", "other_code"], "left_anti")
    return once.unionByName(rest)


# Words after which a text of reference names is a remark, words that end one name, phrases that are no part of
# a name, and a phrase that holds a separator.
REMARK_WORDS = ["medicamento", "n/a", "referência", "similar"]
NAME_ENDS = ["genérico", "m.s", "&", ","]
NO_NAME = ["s/a", "creme e comprimidos", "- novartis"]
WITH_SLASH = {"im/iv": "im-iv"}


def reference_names(df: DataFrame, column: str) -> DataFrame:
    """Multi-valued reference names, cleaned, one per row. A text is names up to its first remark; names part at ';', '/' and
    ' e ', which also stand inside strengths and a few phrases; what follows a maker note, and strengths, are no name."""

    def before(text: Column, words: Sequence[str]) -> Column:
        """The text up to the first of the words."""
        stop = "|".join(re.escape(w) for w in words)
        return F.regexp_extract(text, rf"^(?:(?!{stop})[\s\S])*", 0)

    text = before(F.regexp_replace(F.lower(F.col(column)), r"\(.*\)", ""), REMARK_WORDS)
    for phrase, kept in [*WITH_SLASH.items(), *[(p, "") for p in NO_NAME]]:
        text = F.replace(text, F.lit(phrase), F.lit(kept))
    strength = r"\d[^;]*(?:mg/ml|mg/g)"
    parts = F.split(F.regexp_replace(text, strength, ""), "; |/| e ")
    names = F.transform(parts, lambda p: F.trim(F.regexp_replace(before(F.rtrim(p, F.lit("®")), NAME_ENDS), r"\d.*g", "")))
    return df.withColumn(column, F.explode(F.array_distinct(F.filter(names, lambda n: n != ""))))


def attached(pairs: DataFrame, guide: DataFrame) -> DataFrame:
    """(code, side, name, kind), one row each: the similars of every reference product, the references of every interchangeable
    one, and what a second source says about either side of a code. `pairs`: reference_code, reference_name, other_code,
    other_name, kind; `guide`: code, side, name, kind."""
    similars = pairs.select(F.col("reference_code").alias("code"), F.lit("similar").alias("side"), F.col("other_name").alias("name"), "kind")
    references = pairs.select(
        F.col("other_code").alias("code"), F.lit("reference").alias("side"), F.col("reference_name").alias("name"), F.lit("reference").alias("kind"))
    told = guide.select("code", "side", "name", "kind")
    return similars.unionByName(references).unionByName(told).filter("code is not null and name is not null").distinct()


def capped_lists(pairs: DataFrame, group: str | Sequence[str], item: str, limit: int) -> DataFrame:
    """Per group a JSON list of its distinct items in order, as many as fit into `limit` characters (the
    first one always), and how many there are: a presentation of `pairs`, which hold them all. The running length is computed
    in a distributed sort; only items that fit are gathered, so a list never holds more than `limit` characters."""
    keys = [group] if isinstance(group, str) else list(group)
    once = pairs.filter(F.col(item).isNotNull()).select(*keys, item).distinct().withColumn(
        "_len", F.length(F.to_json(F.array(F.col(item)))).cast("long") - 1)  # quoted item and one separator
    placed = order_positions(once, keys, [F.col(item)], total="_len")
    fits = placed.filter((F.col("running") + 1 <= limit) | (F.col("position") == 1))
    return fits.groupBy(*keys).agg(
        F.to_json(F.array_sort(F.collect_list(item))).alias("items"), F.max("group_rows").alias("available"))


def split_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two tables with the same columns, tagged both (the left row), left or right."""
    both = left.join(right.select(key), key, "left_semi").withColumn("side", F.lit("both"))
    only_left = left.join(right.select(key), key, "left_anti").withColumn("side", F.lit("left"))
    only_right = right.join(left.select(key), key, "left_anti").withColumn("side", F.lit("right"))
    return both.unionByName(only_left).unionByName(only_right)


def alternate_names(df: DataFrame, code: str, payload: str, path: str) -> DataFrame:
    """Distinct (code, name) found in a JSON column."""
    return df.select(code, F.get_json_object(payload, path).alias("name")).filter(F.trim("name") != "").distinct()


def looks_generic(name: Column, ingredient: Column) -> Column:
    """A name that starts with its ingredient (over four characters) marks a generic."""
    n, i = alnum_key(name), alnum_key(ingredient)
    return F.coalesce((F.length(i) > 4) & n.startswith(i), F.lit(False))


def first_known(values: Column, vocabulary: Sequence[str]) -> Column:
    """The first value of a list that the vocabulary holds, as a list of one; null when there is none."""
    kept = F.filter(values, lambda v: v.isin(list(vocabulary)))
    return F.when(F.size(kept) > 0, F.slice(kept, 1, 1))


def longest_leaflet(df: DataFrame, code: str, professional: str, patient: str) -> DataFrame:
    """Per code the longest professional leaflet, else the longest one for patients."""

    def longest(c: str) -> Column:
        return F.max_by(F.col(c), F.when(F.trim(c) != "", F.struct(F.length(c), F.col(c))))

    return df.groupBy(code).agg(F.coalesce(longest(professional), longest(patient)).alias("leaflet"))


def conflict_matrix(df: DataFrame, code: str, source: str, sources: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Attribute x source matrix of every code, flagged where sources disagree."""
    flat = df.select(code, source, F.inline(F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])))
    wide = flat.groupBy(code, "attribute").agg(*[
        F.max(F.when(F.col(source) == s, F.col("value"))).alias(s) for s in sources])
    values = F.array_distinct(F.array_compact(F.array(*sources)))
    return wide.withColumn("values", F.size(values)).withColumn("conflict", F.size(values) > 1)
