"""Association rules, recommendation attribution, substitutes, complements and their evaluation."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.kit import co_occurrence, latest, top_n
from gondola.session import lineage_cut, sized_shuffles

# Threshold tuning by density of the baskets: bound, support factor and floor, confidence
# factor and floor.
DENSITY_MODES = [
    ("conservative", 0.1, 0.1, 0.001, 0.2, 0.005),
    ("moderate", 0.01, 0.05, 0.0005, 0.1, 0.002),
    ("aggressive", 0.0, 0.01, 0.0001, 0.05, 0.001),
]
# Lower thresholds tried in turn when no rule is found: (support, confidence) factors of
# the tuned thresholds, then absolute pairs.
LADDERS = {
    "conservative": ([(0.5, 0.5), (0.2, 0.2)], [(0.001, 0.002)]),
    "moderate": ([(0.2, 0.2), (0.05, 0.1)], [(0.0005, 0.001)]),
    "aggressive": ([(0.1, 0.1), (0.01, 0.05)], [(0.0001, 0.0005), (0.00005, 0.0001)]),
}


def _tuned(density: float, transactions: int) -> list[tuple[float, float]]:
    """(support, confidence) pairs to try in turn: the ones tuned to the density, then their ladder."""
    mode, _, sf, s0, cf, c0 = next(m for m in DENSITY_MODES if density > m[1])
    support, confidence = max(s0, 2.0 / transactions, density * sf), max(c0, density * cf)
    factors, fixed = LADDERS[mode]
    return [(support, confidence), *[(support * a, confidence * b) for a, b in factors], *fixed]


def association_rules(
    lines: DataFrame, item: str, names: DataFrame, deny: str | None = None,
    thresholds: tuple[float, float] | None = None, conviction: str = "textbook", block: int = 200, rows: int | None = None,
) -> DataFrame:
    """1 -> 1 rules between items bought together: distinct items per sale, sales with two or more items,
    thresholds tuned from the density of the baskets (or given), lift above 1, at least two sales with
    both, different names, names without `deny`. `names`: item, name; `rows`: about how many lines there are, for the number of tasks.

    Only pairs can make 1 -> 1 rules, so pairs are counted directly; items below the support floor are
    dropped first, because no pair can be more frequent than its items."""
    distinct = lines.select("sale_id", item).distinct()
    sized = distinct.groupBy("sale_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k >= 2")
    with sized_shuffles(lines.sparkSession, rows):
        baskets = lineage_cut(distinct.join(sized, "sale_id"))
    counts = baskets.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    facts = counts.agg(F.sum("n").alias("entries"), F.count(F.lit(1)).alias("items")).head()  # one row
    # k rows for every sale of k items
    by_size = baskets.groupBy("_k").agg(F.count(F.lit(1)).alias("_rows"))
    total = by_size.agg(F.sum(F.expr("_rows div _k"))).head()[0] or 0
    baskets = baskets.drop("_k")
    if not total:
        steps = [(1.0, 1.0)]
    elif thresholds is not None:
        steps = [thresholds]
    else:
        steps = _tuned(facts["entries"] / (total * facts["items"]), total)
    floor = max(2.0, min(s for s, _ in steps) * total)
    pairs = co_occurrence(baskets, "sale_id", item, math.ceil(floor - 1e-9), block)

    one_way = pairs.select(F.col("item_a").alias("a"), F.col("item_b").alias("b"), "together")
    both = one_way.unionByName(pairs.select(F.col("item_b").alias("a"), F.col("item_a").alias("b"), "together"))
    rules = (
        both.join(counts.select(F.col(item).alias("a"), F.col("n").alias("with_a")), "a")
        .join(counts.select(F.col(item).alias("b"), F.col("n").alias("with_b")), "b")
        .withColumn("support", F.col("together") / F.lit(total))
        .withColumn("confidence", F.col("together") / F.col("with_a"))
        .withColumn("lift", F.col("confidence") / (F.col("with_b") / F.lit(total)))
    )
    step = F.coalesce(*[
        F.when((F.col("support") >= support - 1e-12) & (F.col("confidence") >= confidence - 1e-12), i + 1)
        for i, (support, confidence) in enumerate(steps)])
    rules = rules.withColumn("_step", step).filter("_step > 0")
    if len(steps) > 1:
        with sized_shuffles(lines.sparkSession, rows):
            rules = lineage_cut(rules)
        rules = rules.filter(F.col("_step") <= rules.agg(F.min("_step")).scalar())
    base = F.col("with_b") / F.lit(total) if conviction == "textbook" else F.col("support")
    rules = (
        rules.drop("_step")
        .withColumn("conviction", F.when(F.col("confidence") < 1, (1 - base) / (1 - F.col("confidence"))))
        .withColumn("transactions", F.lit(total).cast("long"))
        .join(names.select(F.col(item).alias("a"), F.col("name").alias("name_a")), "a")
        .join(names.select(F.col(item).alias("b"), F.col("name").alias("name_b")), "b")
        .filter((F.col("lift") > 1) & (F.col("together") >= 2) & (F.col("name_a") != F.col("name_b")))
    )
    if deny:
        rules = rules.filter(~F.contains("name_a", F.lit(deny)) & ~F.contains("name_b", F.lit(deny)))
    return rules


def category_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per sale and category: a product counts for each of its categories, once per sale. `lines`: sale_id, product_id;
    `products`: product_id, categories (list). The lists are exploded before the join, so that the sale lines meet
    (product, category) rows and are folded by sale at once."""
    flat = products.select("product_id", F.explode(F.array_distinct("categories")).alias("category")).filter(F.col("category").isNotNull())
    return lines.select("sale_id", "product_id").join(flat, "product_id").select("sale_id", "category").distinct()


def publish_rules(rules: DataFrame, required: Sequence[str], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Complete rules, one per key."""
    return latest(rules.dropna(subset=list(required)), keys, order)


def attribution(recommendations: DataFrame, cart: DataFrame, sold: DataFrame) -> DataFrame:
    """Every recommendation (message_id, basket_id, ref, rec) with whether reference and recommended
    product were in the cart and were sold, units and value sold, and its status. Cart and sale lines are
    folded into one row per (basket, product) first, so each role is one join that never multiplies rows."""
    none = F.lit(None)
    rows = cart.select("basket_id", "product_id", F.lit(True).alias("in_cart"), none.cast("bigint").alias("qty"), none.cast("decimal(16,4)").alias("net"))
    facts = rows.unionByName(
        sold.select("basket_id", "product_id", none.cast("boolean").alias("in_cart"), F.col("qty").cast("bigint").alias("qty"), F.col("net").cast("decimal(16,4)").alias("net"))
    ).groupBy("basket_id", "product_id").agg(F.max("in_cart").alias("in_cart"), F.sum("qty").alias("qty"), F.sum("net").alias("value"))
    out = recommendations.filter(F.col("ref") != F.col("rec"))
    for role in ("ref", "rec"):
        side = facts.select("basket_id", F.col("product_id").alias(role), *[F.col(c).alias(f"{role}_{c}") for c in ("in_cart", "qty", "value")])
        out = out.join(side, ["basket_id", role], "left")
    sold_rec = F.col("rec_qty").isNotNull()
    return out.select(
        "message_id", "basket_id", "ref", "rec",
        F.coalesce("ref_in_cart", F.lit(False)).alias("ref_in_cart"), F.coalesce("rec_in_cart", F.lit(False)).alias("rec_in_cart"),
        F.col("ref_qty").isNotNull().alias("ref_sold"), sold_rec.alias("rec_sold"), F.col("rec_qty").alias("qty"),
        F.round("rec_value", 2).alias("value"), F.when(sold_rec, "Converted").otherwise("Not converted").alias("status"))


def weekly_funnel(recommendations: DataFrame, baskets: DataFrame, sold: DataFrame, group: Sequence[str]) -> DataFrame:
    """Baskets and sales per week and `group`, sales with, without and by kind of recommendation. Rows are
    folded per basket, then per sale with flags, then counted: no distinct sets.
    `recommendations`: basket_id, kind; `baskets`: basket_id, opened_on, group; `sold`: basket_id, sale_id."""
    shown = recommendations.groupBy("basket_id").agg(
        F.max((F.col("kind").isNotNull()).cast("int")).alias("any"),
        F.max(F.coalesce((F.col("kind") == "ads").cast("int"), F.lit(0))).alias("ads"),
        F.max(F.coalesce((F.col("kind") == "focus").cast("int"), F.lit(0))).alias("focus"),
        F.max(F.col("kind").isNull().cast("int")).alias("blank"))
    joined = shown.join(baskets, "basket_id", "full_outer").join(
        sold.select("basket_id", "sale_id").distinct(), "basket_id", "full_outer")
    week = F.date_trunc("week", F.col("opened_on")).cast("date").alias("week")
    keys = ["week", *group]
    flags = ["any", "ads", "focus"]
    per_basket = joined.groupBy(week, *group, "basket_id", "sale_id").agg(
        *[F.max(F.coalesce(f, F.lit(0))).alias(f) for f in flags],
        F.max(F.when(F.col("any").isNull() | (F.col("blank") == 1), 1).otherwise(0)).alias("none"))
    per_sale = per_basket.filter(F.col("sale_id").isNotNull()).groupBy(*keys, "sale_id").agg(
        *[F.max(f).alias(f) for f in [*flags, "none"]])
    sales = per_sale.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sales"), F.sum("any").alias("with_any"), F.sum("none").alias("without"),
        F.sum("ads").alias("with_ads"), F.sum("focus").alias("with_focus"))
    counted = per_basket.select(*keys, "basket_id").distinct().groupBy(*keys).agg(F.count("basket_id").alias("baskets"))
    same = [counted[k].eqNullSafe(sales[k]) for k in keys]
    out = counted.join(sales, same, "left").select(
        *[counted[k] for k in keys], "baskets", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sales", "with_any", "without", "with_ads", "with_focus")])
    return out


def recommendation_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("ref", "rec").agg(F.count(F.lit(1)).alias("times"))


def top_recommended(counts: DataFrame) -> DataFrame:
    """Most often recommended products per reference, ties kept."""
    w = Window.partitionBy("ref").orderBy(F.desc("times"))
    return counts.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")


def best_per_pair(scored: DataFrame) -> DataFrame:
    """One row per (focus, rec) with its best score and the phrase that goes with it."""
    return scored.groupBy("focus", "rec").agg(
        F.max("score").alias("score"), F.max_by("phrase", F.struct("score", "phrase")).alias("phrase"))


def substitutes(prompts: DataFrame, neighbours: DataFrame, products: DataFrame, rivals: DataFrame) -> DataFrame:
    """Products to offer instead of a focus product. A prompt brings its neighbours with a preset score
    (reference names 0.9, similar names 0.8) or the neighbour's own; medicines need another brand; the best
    score per pair counts; non-medicines must share a category, medicines the ingredient and route;
    registered rivals join with score 1. One row per pair: order by score to serve.

    `prompts`: focus, prompt, preset; `neighbours`: prompt, rec, score, phrase; `products`: product_id,
    is_medicine, brand, categories, ingredient, route; `rivals`: focus, rec, phrase."""
    attributes = ["is_medicine", "brand", "categories", "ingredient", "route"]

    def described(side: str) -> DataFrame:
        return products.select(F.col("product_id").alias(side), *[F.col(a).alias(f"{side}_{a}") for a in attributes])

    met = prompts.join(neighbours, "prompt").select(
        "focus", "rec", F.coalesce("preset", "score").alias("score"), "phrase")
    both = met.join(described("focus"), "focus").join(described("rec"), "rec")
    other_brand = (
        F.col("focus_brand").isNull() | F.col("rec_brand").isNull() | (F.col("focus_brand") != F.col("rec_brand")))
    plain = ~F.col("focus_is_medicine") & ~F.col("rec_is_medicine") & F.arrays_overlap("focus_categories", "rec_categories")

    def same(a: str) -> Column:
        return F.coalesce(f"focus_{a}", F.lit("")) == F.coalesce(f"rec_{a}", F.lit(""))

    drug = F.col("focus_is_medicine") & F.col("rec_is_medicine") & other_brand & same("ingredient") & same("route")
    fits = both.filter(plain | drug).select("focus", "rec", "score", "phrase")
    named = rivals.select("focus", "rec", F.lit(1.0).alias("score"), "phrase")
    return best_per_pair(fits.unionByName(named)).filter(F.col("focus") != F.col("rec"))


def complements(
    tags: DataFrame, neighbours: DataFrame, alternatives: DataFrame, focus: DataFrame
) -> DataFrame:
    """Products that go with a focus product: neighbours of each of its tags, with their alternative codes,
    best score per pair; focus products and products with a focus alternative are left out.

    `tags`: focus, tag; `neighbours`: tag, rec, score, phrase; `alternatives`: product_id, alternative_id;
    `focus`: product_id."""
    barred = focus.select("product_id").unionByName(
        alternatives.join(focus.select(F.col("product_id").alias("alternative_id")), "alternative_id", "left_semi")
        .select("product_id")).distinct()
    allowed = neighbours.join(barred.select(F.col("product_id").alias("rec")), "rec", "left_anti")
    codes = allowed.join(alternatives.select(F.col("product_id").alias("rec"), "alternative_id"), "rec").select(
        "tag", F.col("alternative_id").alias("rec"), "score", "phrase")
    wide = allowed.select("tag", "rec", "score", "phrase").unionByName(codes)
    return best_per_pair(tags.select("focus", "tag").distinct().join(wide, "tag").select("focus", "rec", "score", "phrase"))


def publish_phrases(pairs: DataFrame, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs with their phrase, pairs whose phrase is missing)."""
    out = pairs.join(phrases, "rec", "left")
    has = F.coalesce(F.trim("phrase") != "", F.lit(False))
    return out.filter(has), out.filter(~has).drop("phrase")


def cache_key(*parts: Column) -> Column:
    return F.base64(F.unhex(F.sha2(F.concat_ws("|", *parts), 256)))


def cache_status(queries: DataFrame, entries: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """HIT when the last entry of a query's key is at most `days` old, else MISS. `queries`: key;
    `entries`: key, stored_on, seq."""
    last = latest(entries, ["key"], [F.desc("stored_on"), F.desc("seq")]).select("key", "stored_on")
    fresh = F.datediff(as_of, "stored_on") <= days
    return queries.join(last, "key", "left").withColumn(
        "state", F.when(F.coalesce(fresh, F.lit(False)), "HIT").otherwise("MISS"))


def evaluate(judged: DataFrame, segment: str) -> DataFrame:
    """Precision (relevant share of recommended) and hit rate (references with at least one relevant
    product) per segment. `judged`: ref, rec, relevant, segment."""
    per_ref = judged.groupBy(segment, "ref").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("relevant"), 1)).alias("good"))
    return per_ref.groupBy(segment).agg(
        F.sum("n").alias("pairs"), F.count(F.lit(1)).alias("refs"),
        F.round(F.sum("good") / F.sum("n"), 6).alias("precision"),
        F.round(F.count(F.when(F.col("good") > 0, 1)) / F.count(F.lit(1)), 6).alias("hit_rate"))


def category_overlap(pairs: DataFrame, categories: DataFrame) -> DataFrame:
    """Share of pairs whose products share a category. `categories`: product_id, categories."""
    both = pairs.join(categories.select(F.col("product_id").alias("ref"), F.col("categories").alias("_a")), "ref").join(
        categories.select(F.col("product_id").alias("rec"), F.col("categories").alias("_b")), "rec")
    hit = F.size(F.array_intersect("_a", "_b")) > 0
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.count(F.when(hit, 1)).alias("overlapping"),
                    F.round(F.lit(100.0) * F.count(F.when(hit, 1)) / F.count(F.lit(1)), 4).alias("share"))


def sample_keys(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """A repeatable sample of `n` keys: those with the smallest seeded hash."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    return df.select(key).distinct().orderBy(order, F.col(key)).limit(n)


def evaluation_set(pairs: DataFrame, day: Column, n: int, seed: str) -> DataFrame:
    """Distinct (ref, rec) pairs of one day for a sample of references. `pairs`: ref, rec, day."""
    once = pairs.filter(F.col("day") == day).select("ref", "rec").distinct()
    return once.join(sample_keys(once, "ref", n, seed), "ref", "left_semi")


def top_sellers(sold: DataFrame, group: Sequence[str], n: int) -> DataFrame:
    """The `n` products with the largest value of every group. `sold`: group, product_id, value."""
    return top_n(sold, group, [F.desc("value"), F.col("product_id")], n, "place")
