"""Standardisation jobs: contacts, barcodes, drug fields, invalid values, names, document texts. Each one
returns clean rows together with what it rejected or measured."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions import codes, fuzzy, pharma, text
from gondola.functions.scoring import age, age_band, sweep_nothing
from gondola.operators.kit import dealt, latest, spread_join
from gondola.session import lineage_cut


def _rejects(df: DataFrame, key: str, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(key, field, value) where a raw value is set but its clean form is not."""
    bad = F.array_compact(F.array(*[
        F.when(raw.isNotNull() & (F.trim(raw) != "") & clean.isNull(), F.struct(F.lit(f).alias("field"), raw.cast("string").alias("value")))
        for f, (raw, clean) in checks.items()]))
    return df.select(key, F.inline(bad))


def contacts(df: DataFrame, key: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Phone, tax id, e-mail, street and age band of people; and the values that could not be read.
    `df`: key, phone, tax_id, email, street, born_on."""
    df = dealt(df, key)
    years = age(F.col("born_on"), F.lit(as_of).cast("date"))
    clean = {
        "phone": text.phone(F.col("phone")), "tax_id": text.tax_id(F.col("tax_id")), "email": text.email(F.col("email")),
        "street": pharma.street_and_number(F.col("street"))}
    out = df.select(key, "born_on", *[c.alias(n) for n, c in clean.items()], years.alias("age"), age_band(years).alias("age_band"))
    return out, _rejects(df, key, {n: (F.col(n), clean[n]) for n in ("phone", "email")})


def barcodes(df: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """Rows with canonical code and validity, and the number of codes by verdict and length."""
    out = df.withColumn("canonical", codes.canonical_code(F.trim(code))).withColumn("valid", codes.valid_barcode(F.col(code)))
    return out, out.groupBy("valid", F.length(F.trim(code)).alias("length")).agg(F.count(F.lit(1)).alias("codes"))


def refresh_results(
    inputs: DataFrame, stored: DataFrame, key: str, fields: Sequence[str], rules: dict[str, Callable[[], Column]]
) -> DataFrame:
    """The result table after a run: stored rows whose input fields are unchanged (null equals null) stay,
    new and changed ones are computed, vanished ones go. `stored` holds key, the fields and the results."""
    old = stored.select(key, *[F.col(f).alias(f"_{f}") for f in fields], *rules, F.lit(True).alias("_done"))
    both = inputs.select(key, *fields).join(old, key, "left")
    same = F.col("_done")
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_{f}"))
    same = F.coalesce(same, F.lit(False))
    return both.select(
        key, *fields, *[F.when(same, F.col(n)).otherwise(rule()).alias(n) for n, rule in rules.items()], (~same).alias("computed"))


def drug_fields(inputs: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Dosage (from the field, else from the name), ingredient and forms, computed for new or changed rows
    only. `inputs`: key, name, dosage, ingredient, form; `stored`: the table of the last run."""
    return refresh_results(inputs, stored, key, ["name", "dosage", "ingredient", "form"], {
        "clean_dosage": lambda: F.coalesce(pharma.dosage(F.col("dosage")), pharma.dosage(pharma.dosage_in_name(F.col("name")))),
        "clean_ingredient": lambda: pharma.ingredient(F.col("ingredient")),
        "forms": lambda: F.array_join(pharma.forms(F.col("form")), "|")})


def invalid_sweep(df: DataFrame, exclude: Sequence[str], allow_numeric: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The frame without values that say nothing, and per column the nulls before and after."""
    clean = sweep_nothing(df, exclude, allow_numeric)

    def nulls(frame: DataFrame, name: str) -> DataFrame:
        one = frame.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in frame.columns])
        return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in frame.columns])))

    return clean, nulls(df, "nulls_before").join(nulls(clean, "nulls_after"), "column")


def _word_sets(df: DataFrame) -> DataFrame:
    """(id, words, set): the significant words of a name, and what identifies them."""
    t = df.select("id", F.array_sort(text.significant_tokens(F.col("name"))).alias("words")).filter(F.size("words") > 0)
    return t.withColumn("set", F.md5(F.array_join("words", " ")))


def set_pairs(a: DataFrame, b: DataFrame, low: float) -> DataFrame:
    """(sa, sb): pairs of word sets of two tables (set, words) that may have a Jaccard similarity of `low` or more.

    The words of a set are put in order, rarest first. Two sets of n and m words that are similar enough share c = ceil(low (n + m) / (1 + low)) words, so their
    sizes differ by a factor of 1 / low at most, and after the first word they share, at places p and q, there are c - 1 more in both: p <= n - c + 1 and
    q <= m - c + 1. Rows that meet on a word are dropped by this before they are a pair, so a word that most sets hold, last in their order, brings
    together only sets so short that this one word is enough."""
    both = a.select("set", "words").unionByName(b.select("set", "words")).dropDuplicates(["set"])
    flat = both.select("set", F.explode("words").alias("_w"))
    often = flat.groupBy("_w").agg(F.count(F.lit(1)).alias("_n"))
    # a set is as long as one name
    ordered = spread_join(flat, often, "_w").groupBy("set").agg(F.array_sort(F.collect_list(F.struct("_n", "_w"))).alias("_o"))
    size = F.size("_o")
    keep = size - F.ceil(F.lit(low) * size - 1e-9) + 1
    placed = lineage_cut(ordered.select("set", size.alias("size"), F.posexplode(F.slice("_o", F.lit(1), keep.cast("int"))).alias("at", "_r")).select(
        "set", "size", (F.col("at") + 1).alias("at"), F.col("_r._w").alias("_w")))

    def side(df: DataFrame, tag: str) -> DataFrame:
        return placed.join(df.select("set").distinct(), "set", "left_semi").select(
            F.col("_w").alias(f"w{tag}"), F.col("set").alias(f"s{tag}"), F.col("size").alias(f"n{tag}"), F.col("at").alias(f"p{tag}"))

    shared = F.ceil(F.lit(low / (1 + low)) * (F.col("na") + F.col("nb")) - 1e-9)
    close = (F.col("na") >= F.col("nb") * low - 1e-9) & (F.col("nb") >= F.col("na") * low - 1e-9)
    able = close & (F.col("pa") <= F.col("na") - shared + 1) & (F.col("pb") <= F.col("nb") - shared + 1)
    return side(a, "a").join(side(b, "b"), (F.col("wa") == F.col("wb")) & able).select("sa", "sb").distinct()


def similar_name_pairs(
    left: DataFrame, right: DataFrame, low: float = 0.2, high: float = 0.95
) -> DataFrame:
    """(left_id, right_id, similarity) of names whose significant words have a Jaccard similarity within
    [low, high). Names with the same words are one set here, so a name that many rows share is compared
    once; `set_pairs` brings sets together. `left`, `right`: id, name."""
    a, b = lineage_cut(_word_sets(left)), lineage_cut(_word_sets(right))  # read several times below
    words = a.select("set", "words").unionByName(b.select("set", "words")).dropDuplicates(["set"])
    scored = (
        set_pairs(a, b, low).join(words.select(F.col("set").alias("sa"), F.col("words").alias("wa")), "sa")
        .join(words.select(F.col("set").alias("sb"), F.col("words").alias("wb")), "sb")
        .select("sa", "sb", F.round(text.jaccard(F.col("wa"), F.col("wb")), 6).alias("similarity"))
        .filter((F.col("similarity") >= low) & (F.col("similarity") < high)))
    return (
        scored.join(a.select(F.col("id").alias("left_id"), F.col("set").alias("sa")), "sa")
        .join(b.select(F.col("id").alias("right_id"), F.col("set").alias("sb")), "sb")
        .select("left_id", "right_id", "similarity"))


def closest_terms(values: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(vocabulary, value, term): for every distinct value the vocabulary term that shares most words with
    it, then the most similar spelling (1 - edit distance / length), then the first by name. A value
    without a shared word has no row. `values`: vocabulary, value; `vocabulary`: vocabulary, term."""

    def plain(c: str) -> Column:
        return F.lower(text.unaccent(F.col(c)))

    def keyed(df: DataFrame, c: str) -> DataFrame:
        once = df.select("vocabulary", c).filter(F.trim(c) != "").distinct()
        words = F.explode(F.array_distinct(text.words(plain(c))))
        return once.withColumn("_w", words).withColumn("_key", F.concat_ws("\u0001", "vocabulary", "_w"))

    met = spread_join(keyed(values, "value").select("_key", "value"), keyed(vocabulary, "term"), "_key")
    scored = met.groupBy("vocabulary", "value", "term").agg(F.count(F.lit(1)).alias("overlap"))
    distance = F.levenshtein(plain("value"), plain("term"))
    scored = scored.withColumn(
        "ratio", F.round(1 - distance / F.greatest(F.length("value"), F.length("term")), 6))
    best = latest(scored, ["vocabulary", "value"], [F.desc("overlap"), F.desc("ratio"), F.col("term")])
    return best.select("vocabulary", "value", "term", "overlap", "ratio")


def fuzzy_terms(values: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(vocabulary, value, term, overlap, score, scorer): for every distinct value the vocabulary term that shares most words with it, then the one with the
    highest score of any of `fuzzy.SCORERS` (value without accents against the term as it is), then the earlier scorer, then the first by name. A value without a
    shared word has no row. Only the terms that share most words are scored. `values`: vocabulary, value; `vocabulary`: vocabulary, term."""

    def keyed(df: DataFrame, c: str) -> DataFrame:
        once = df.select("vocabulary", c).filter(F.trim(c) != "").distinct()
        words = F.explode(F.array_distinct(text.words(F.lower(text.unaccent(F.col(c))))))
        return once.withColumn("_w", words).select("vocabulary", c, F.concat_ws("\u0001", "vocabulary", "_w").alias("_key"))

    met = spread_join(keyed(values, "value").select("_key", "value"), keyed(vocabulary, "term"), "_key")
    shared = met.groupBy("vocabulary", "value", "term").agg(F.count(F.lit(1)).alias("overlap"))
    most = F.rank().over(Window.partitionBy("vocabulary", "value").orderBy(F.desc("overlap")))
    close = shared.withColumn("_k", most).filter("_k = 1").drop("_k")

    @F.pandas_udf("score double, scorer int")
    def best(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fuzzy.best(x, y) for x, y in zip(a, b)], columns=["score", "scorer"])

    scored = close.withColumn("_s", best(text.unaccent(F.col("value")), F.col("term"))).select("vocabulary", "value", "term", "overlap", "_s.*")
    chosen = latest(scored, ["vocabulary", "value"], [F.desc("score"), F.col("scorer"), F.col("term")])
    names = F.array(*[F.lit(n) for n in fuzzy.SCORERS])
    return chosen.withColumn("scorer", F.element_at(names, F.col("scorer") + 1))


def document_texts(
    pages: DataFrame, key: str, html: str, done: DataFrame | None = None, render: Callable[[Column], Column] = text.html_text
) -> tuple[DataFrame, DataFrame]:
    """Text of pages not processed before, flat or as `render` makes it, and the pages without any text."""
    todo = pages if done is None else pages.join(done.select(key), key, "left_anti")
    out = todo.select(key, render(F.col(html)).alias("text"))
    return out.filter("text <> ''"), out.filter("text = '' OR text IS NULL").select(key)


def most_frequent(df: DataFrame, key: str, values: str, default: str = "nao_informado") -> DataFrame:
    """Most common element of all lists of a key (first by name on ties), `default` for empty lists."""
    counts = df.select(key, F.explode(values).alias("_v")).groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_n"))
    top = counts.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_n"), F.col("_v")))).filter("_k = 1")
    return df.select(key).distinct().join(top.select(key, "_v"), key, "left").select(
        key, F.coalesce("_v", F.lit(default)).alias("most_frequent"))
