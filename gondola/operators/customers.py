"""Customer standardisation, purchase profiles, RFM segments and product personas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.scoring import age, age_band, first_largest, quintile
from gondola.operators.kit import column_percentiles, joined, latest
from gondola.session import lineage_cut

ADDRESS = ["zip", "street", "number", "complement", "district", "city", "state"]

# RFM segments in the order they are tried: recency range, score, score range. The score
# is the mean of frequency and value (fv), for one segment the frequency alone (f).
RFM_RULES = [
    ("Champions", (4, 5), "fv", (4, 5)),
    ("Loyal Customers", (2, 5), "fv", (3, 5)),
    ("Potential Loyalist", (3, 5), "fv", (1, 3)),
    ("New Customers", (4, 5), "fv", (0, 1)),
    ("Promising", (3, 4), "fv", (0, 1)),
    ("Customers Needing Attention", (2, 3), "fv", (2, 3)),
    ("About to Sleep", (2, 3), "fv", (0, 2)),
    ("At Risk", (0, 2), "f", (2, 5)),
    ("Can't Lose Them", (0, 1), "fv", (4, 5)),
    ("Hibernating", (1, 2), "fv", (1, 2)),
    ("Lost", (0, 2), "fv", (0, 2)),
]
RFM_OTHER = "General"


def standardise(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Address columns to one list of address structs and one line of text; account name joined in."""
    return (
        customers.withColumn("addresses", F.array(F.struct(*ADDRESS)))
        .withColumn("full_address", F.concat_ws(" ", *ADDRESS))
        .drop(*ADDRESS)
        .join(accounts, "account_id", "left")
    )


def complete_person(customers: DataFrame, side: DataFrame, as_of: str) -> DataFrame:
    """Person or company by the length of the tax id (11 or 14 digits), missing name, sex and birth date
    filled from a side table (one row per tax id), age and age band. `not-informed` is no sex."""
    digits = F.regexp_replace("tax_id", "[^0-9]", "")
    filler = side.select("tax_id", *[F.col(c).alias(f"_{c}") for c in ("name", "sex", "born_on")])
    out = customers.withColumn("tax_id", digits).join(filler, "tax_id", "left")
    for c in ("name", "sex", "born_on"):
        out = out.withColumn(c, F.coalesce(c, f"_{c}")).drop(f"_{c}")
    size = F.length("tax_id")
    out = (
        out.withColumn("sex", F.when(F.col("sex") != "not-informed", F.col("sex")))
        .withColumn("is_person", F.when(size == 11, True).when(size == 14, False))
        .withColumn("age", age(F.col("born_on"), F.lit(as_of).cast("date")))
    )
    return out.withColumn("age_band", age_band(F.col("age")))


def purchase_profile(sales: DataFrame) -> DataFrame:
    """One row per customer. Lines are folded to sales first, so that the counts need no distinct sets;
    preferred store, day and hour are modes (smallest value on ties). `sales`: customer_id, sale_id,
    basket_id, store_id, sold_on, hour, net, is_medicine."""
    per_sale = sales.groupBy("customer_id", "sale_id").agg(
        F.max("basket_id").alias("basket_id"), F.count(F.lit(1)).alias("items"), F.sum("net").alias("value"),
        F.min("sold_on").alias("first"), F.max("sold_on").alias("last"), F.sum(F.col("is_medicine").cast("int")).alias("meds"))
    totals = per_sale.groupBy("customer_id").agg(
        F.min("first").alias("first_sale"), F.max("last").alias("last_sale"), F.count(F.lit(1)).alias("sales"),
        F.countDistinct("basket_id").alias("baskets"), F.sum("items").alias("items"), F.sum("value").alias("value"),
        F.sum("meds").alias("medicines"))
    habits = sales.groupBy("customer_id").agg(
        F.mode("store_id", True).alias("store"), F.mode(F.dayofmonth("sold_on"), True).alias("day_of_month"),
        F.mode(F.dayofweek("sold_on"), True).alias("weekday"), F.mode("hour", True).alias("hour"))
    return totals.join(habits, "customer_id").select(
        "*",
        F.round(F.col("value").cast("double") / F.col("sales"), 2).alias("ticket"),
        (F.datediff("last_sale", "first_sale") / F.col("sales")).cast("int").alias("mean_interval"),
        F.round(F.col("items") / F.col("sales"), 2).alias("items_per_sale"),
        (F.col("medicines") > 0).alias("bought_medicine"),
        F.round(F.lit(100.0) * F.col("medicines") / F.col("items"), 4).alias("medicine_share"))


def rfm_segments(
    profile: DataFrame, as_of: str, recency: str = "last_sale", frequency: str = "sales", monetary: str = "ticket",
    orientation: str = "conventional",
) -> DataFrame:
    """Recency, frequency and value as quintiles (exact 20/40/60/80 cuts) and the first matching segment.
    In the conventional orientation recent, frequent and large are 5; `legacy` turns all three round."""
    base = lineage_cut(
        profile.withColumn("_r", F.datediff(F.lit(as_of).cast("date"), F.col(recency)))
        .withColumn("_f", F.col(frequency)).withColumn("_v", F.col(monetary)))
    points = {"a": 0.2, "b": 0.4, "c": 0.6, "d": 0.8}
    usual = orientation == "conventional"
    rising = {"_r": not usual, "_f": usual, "_v": usual}
    cuts = column_percentiles(base, list(rising), points)
    scores = {
        c[1:]: quintile(F.col(c), [F.lit(cuts.get(c, {}).get(p)) for p in points], up) for c, up in rising.items()}
    out = base.withColumns(scores).withColumn("fv", (F.col("f") + F.col("v")) / 2)
    segment = None
    for name, (lo, hi), score, (a, b) in RFM_RULES:
        hit = F.col("r").between(lo, hi) & F.col(score).between(a, b)
        segment = F.when(hit, name) if segment is None else segment.when(hit, name)
    return out.withColumn("segment", segment.otherwise(RFM_OTHER)).drop("_r", "_f", "_v", "fv")


def items_by_kind(sales: DataFrame, products: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """Distinct (customer, kind, product) for each condition on the product, one row each: a heavy buyer
    is many rows, never one wide list."""
    flagged = products.select("product_id", F.explode(F.array_compact(F.array(
        *[F.when(cond, F.lit(kind)) for kind, cond in kinds.items()]))).alias("kind"))
    return sales.join(flagged, "product_id").select("customer_id", "kind", "product_id").distinct()


def preferences(sales: DataFrame, key: str, groups: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """For each group (name: column, values): share of lines per value and the preferred value (largest
    share, first listed on ties, null when there is none). One pass for all groups."""
    sums, out = [], [F.col(key)]
    for name, (column, values) in groups.items():
        sums.append(F.count(column).alias(f"_{name}"))
        for v in values:
            sums.append(F.count(F.when(F.col(column) == v, 1)).alias(f"{name}_{v}"))
            share = F.when(F.col(f"_{name}") > 0, F.round(F.col(f"{name}_{v}") / F.col(f"_{name}"), 6))
            out.append(share.alias(f"{name}_{v}".lower()))
        out.append(first_largest([f"{name}_{v}" for v in values], values).alias(f"{name}_preferred"))
    return sales.groupBy(key).agg(*sums).select(*out)


def preferred_values(sales: DataFrame, key: str, column: str) -> DataFrame:
    """All values tied at the highest count, as one sorted text (bounded by the vocabulary of `column`)."""
    counts = sales.filter(F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.withColumn("_k", F.rank().over(Window.partitionBy(key).orderBy(F.desc("_n")))).filter("_k = 1")
    return best.groupBy(key).agg(
        joined(F.collect_list(F.col(column).cast("string"))).alias("preferred"), F.max("_n").alias("times"))


def product_persona(sales: DataFrame, focus: DataFrame, alternatives: DataFrame, customers: DataFrame) -> DataFrame:
    """Who buys a focus product: sales of the product and of its alternative codes (credited to it) are
    folded per (product, customer), then per product. `focus`: product_id; `alternatives`: product_id,
    alternative_id; `customers`: customer_id, age_band, sex."""
    own = sales.join(focus, "product_id", "left_semi")
    mapped = alternatives.join(focus, "product_id", "left_semi").select(
        F.col("product_id").alias("_focus"), F.col("alternative_id").alias("product_id"))
    other = sales.join(mapped, "product_id").withColumn("product_id", F.col("_focus")).drop("_focus")
    both = own.unionByName(other)
    per_sale = both.groupBy("product_id", "customer_id", "sale_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net").alias("value"), F.max("sold_on").alias("sold_on"))
    per_customer = per_sale.groupBy("product_id", "customer_id").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("lines").alias("lines"), F.sum("value").alias("value"),
        F.min("sold_on").alias("first"), F.max("sold_on").alias("last"),
        F.mode(F.dayofweek("sold_on"), True).alias("weekday"), F.mode(F.dayofmonth("sold_on"), True).alias("day"))
    ticket = F.round(F.col("value").cast("double") / F.col("sales"), 2).cast("decimal(14,2)")
    interval = (F.datediff("last", "first") / F.col("sales")).cast("int")
    return (
        per_customer.join(customers, "customer_id", "left")
        .groupBy("product_id")
        .agg(
            F.min("first").alias("first_sale"), F.max("last").alias("last_sale"),
            F.count(F.lit(1)).alias("buyers"), F.sum("sales").alias("sales"), F.sum("lines").alias("lines"),
            F.sum("value").alias("value"),
            F.mode("weekday", True).alias("weekday"), F.mode("day", True).alias("day"),
            F.round(F.sum(ticket).cast("double") / F.count(F.lit(1)), 4).alias("ticket"),
            F.round(F.sum(interval) / F.count(F.lit(1)), 4).alias("interval"),
            F.mode("age_band", True).alias("age_band"), F.mode("sex", True).alias("sex"),
            F.count(F.when(F.col("lines") == 1, 1)).alias("single_buyers"))
        .withColumn("single_share", F.round(F.lit(100.0) * F.col("single_buyers") / F.col("sales"), 4))
    )


def basket_persona(baskets: DataFrame, groups: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Per product: share of basket lines by sale type and recommendation type, with the usual value."""
    return preferences(baskets, "product_id", groups)


def family_buyers(sales: DataFrame, products: DataFrame, customers: DataFrame, term: str) -> DataFrame:
    """Customers who bought a product whose name contains `term`: the last record of each person
    (person_id) and the number of matching sales."""
    family = products.filter(F.contains(F.lower(F.col("name")), F.lit(term.lower()))).select("product_id")
    bought = sales.join(family, "product_id", "left_semi").groupBy("customer_id").agg(
        F.countDistinct("sale_id").alias("sales"))
    hits = customers.join(bought, "customer_id")
    return latest(hits, ["person_id"], [F.desc("updated_on"), F.desc("customer_id")])


def to_enrich(customers: DataFrame, done: DataFrame) -> DataFrame:
    """Natural persons with more than one basket whose record lacks name, sex or birth date or has an
    impossible age (below 0, above 105), adults or of unknown age, not looked up before."""
    a = F.col("age")
    odd = (a < 0) | (a > 105)
    incomplete = F.col("born_on").isNull() | F.col("sex").isNull() | F.col("name").isNull() | odd
    allowed = a.isNull() | (a >= 18) | odd
    wanted = customers.filter(
        F.col("tax_id").isNotNull() & (F.col("baskets") > 1) & F.col("is_person")
        & F.coalesce(incomplete, F.lit(False)) & F.coalesce(allowed, F.lit(False)))
    one = latest(wanted, ["tax_id"], [F.col("customer_id")])
    return one.join(done.select("tax_id").distinct(), "tax_id", "left_anti")
