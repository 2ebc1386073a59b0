"""Sales facts, ABC classes, stock coverage, store and product scores, calendars and store status."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.operators.kit import column_percentiles, exact_percentiles, hashed_side, latest, null_safe_join, order_positions, product_join, ranks, rows_at
from gondola.session import forget, lineage_cut, little_disk, sized_shuffles

# Localised names of weekdays (Sunday first) and months.
WEEKDAYS = ["Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado"]
MONTHS = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
          "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]


def like_patterns(patterns: Sequence[str]) -> str:
    """One regular expression for a list of LIKE patterns with leading / trailing %."""
    out = []
    for p in patterns:
        core = re.escape(p.strip("%"))
        out.append(("" if p.startswith("%") else "^") + core + ("" if p.endswith("%") else "$"))
    return "|".join(out)


def sales_facts(
    lines: DataFrame, headers: DataFrame, products: DataFrame, stores: DataFrame, customers: DataFrame, clerks: DataFrame,
    rows: int | None = None,
) -> DataFrame:
    """One row per sale line with header, product, store, customer and clerk attributes and the unit price. What belongs to a
    sale is joined with its header, of which there are fewer; the fact tables then meet on the sale, and the other dimensions follow, as hash joins
    where their size allows it. A sale without a known clerk (customer, ...) stays. `headers` holds customer_id and clerk_id; `rows`: about how many
    lines there are (many are streamed past the other sides and never sorted)."""
    sales = headers.join(hashed_side(customers, rows), "customer_id", "left").join(hashed_side(clerks, rows), "clerk_id", "left")
    return (
        lines.join(hashed_side(sales, rows), "sale_id")
        .join(hashed_side(products, rows), "product_id", "left")
        .join(stores, "store_id", "left")
        .withColumn("unit_price", F.when(F.col("qty") > 0, F.round(F.col("net").cast("double") / F.col("qty"), 4)))
    )


def basket_facts(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per sale: lines, units, value, distinct products and stores."""
    totals = lines.groupBy("sale_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("qty").alias("units"), F.sum("net").alias("value"),
        F.countDistinct("product_id").alias("products"), F.countDistinct("store_id").alias("stores"))
    return headers.join(totals, "sale_id")


def abc_by_revenue(lines: DataFrame, a: float = 0.80, b: float = 0.95) -> DataFrame:
    """Products by cumulative share of revenue (best sellers first): A up to `a`, B up to `b`, else C."""
    sold = lines.groupBy("product_id").agg(F.sum("qty").alias("qty"), F.sum("net").alias("revenue"))
    placed = order_positions(sold, [], [F.col("revenue").desc(), F.col("product_id")], total="revenue")
    share = F.col("running").cast("double") / F.col("group_total").cast("double")
    return placed.select(
        "product_id", "qty", "revenue", F.col("position").alias("place"), F.round(share, 4).alias("cumulative_share"),
        F.when(share <= a, "A").when(share <= b, "B").otherwise("C").alias("abc"))


#: Rows of one per store that are sent to all tasks.
SENT_STORES = 1 << 19


def _class_by_place(place: Column, upto_a: Column, upto_b: Column) -> Column:
    return F.when(place <= upto_a, "A").when(place <= upto_b, "B").otherwise("C")


def _descending(value: Column) -> Column:
    """What ascends as a value descends, nulls last, then with product and row."""
    return F.struct(value.isNull().alias("none"), (-value).alias("value"), F.col("product_id").alias("product_id"), F.col("_row").alias("row"))


def store_product_abc(
    listing: DataFrame, sold: DataFrame, period_days: Column, a: float = 0.2, b: float = 0.5
) -> DataFrame:
    """Every listed (account, store, product) with demand, margin, days of stock and its class by place
    in the store: A for the first `a` share of products, B up to `b`, else C; no demand, no class.

    A class is told from the rows at the limits of the store, so what is sorted and written for each order is no more than the order takes, and the listing
    itself is written once. `listing`: account_id, store_id, product_id, stock; `sold`: store_id, product_id, qty, revenue, cost."""
    margin = F.round((F.col("revenue") - F.col("cost")).cast("double") / F.when(F.col("qty") > 0, F.col("qty")).otherwise(1), 6)
    store, shares = ["account_id", "store_id"], {"a": a, "b": b}
    with little_disk(listing.sparkSession):
        sold = lineage_cut(sold.select("store_id", "product_id", "qty", margin.alias("margin")))
        base = lineage_cut(listing.join(sold, ["store_id", "product_id"], "left").select(
            *store, "product_id", "stock", "qty", "margin", F.monotonically_increasing_id().alias("_row")))
        forget(sold)
        limits = [
            rows_at(base.select(*store, value, "product_id", "_row"), store, [F.col(value).desc_nulls_last(), F.col("product_id"), F.col("_row")], shares)
            .select(*store, *[F.when(F.col(x).isNotNull(), F.struct(
                F.col(f"{x}.{value}").isNull().alias("none"), (-F.col(f"{x}.{value}")).alias("value"), F.col(f"{x}.product_id"), F.col(f"{x}._row").alias("row"))
            ).alias(f"{value}_{x}") for x in shares])
            for value in ("qty", "margin")]
        limits = lineage_cut(null_safe_join(*limits, store))
        few = limits.count() <= SENT_STORES
    rows = null_safe_join(base, F.broadcast(limits) if few else limits, store)
    daily = F.col("qty") / period_days
    none = F.lit(None).cast("string")
    return rows.select(
        *store, "product_id", "qty", F.round("margin", 4).alias("margin"),
        F.round(daily, 6).alias("daily_demand"), F.round(F.when(daily > 0, F.col("stock") / daily), 4).alias("days_of_stock"),
        F.when(F.col("qty").isNull() | (F.col("qty") == 0), none)
        .otherwise(_class_by_place(_descending(F.col("qty")), F.col("qty_a"), F.col("qty_b"))).alias("demand_abc"),
        _class_by_place(_descending(F.col("margin")), F.col("margin_a"), F.col("margin_b")).alias("margin_abc"))


def coverage_days(stock: Column, daily: Column) -> Column:
    """Days the stock lasts; null when there is stock but no sales, 0 when there is no stock."""
    return F.when(daily > 0, stock / daily).when(stock > 0, F.lit(None).cast("double")).otherwise(F.lit(0.0))


def coverage_class(days: Column, high: float = 5) -> Column:
    return F.when(days.isNull(), "No sales").when(days > high, "High").otherwise("Low")


def stock_coverage(stock: DataFrame, sold: DataFrame, products: DataFrame, period_days: int) -> DataFrame:
    """Coverage per (store, product) and per (store, brand). `stock`: latest units per (store_id,
    product_id); `sold`: lines of the period; only products with a brand count."""
    units = sold.groupBy("store_id", "product_id").agg(F.sum("qty").alias("sold"))
    per = (
        stock.join(products.filter(F.col("brand").isNotNull()).select("product_id", "brand"), "product_id")
        .join(units, ["store_id", "product_id"], "left")
        .withColumn("daily", F.coalesce(F.col("sold"), F.lit(0)) / F.lit(float(period_days)))
    )
    days = coverage_days(F.col("stock"), F.col("daily"))
    brand = per.groupBy("store_id", "brand").agg(
        F.sum("stock").alias("brand_stock"), F.sum(F.coalesce(F.col("sold"), F.lit(0))).alias("brand_sold"))
    brand = brand.withColumn(
        "brand_days", coverage_days(F.col("brand_stock"), F.col("brand_sold") / F.lit(float(period_days))))
    return (
        per.withColumn("days", days)
        .join(brand, ["store_id", "brand"])
        .select(
            "store_id", "product_id", "brand", "stock", F.round("daily", 6).alias("daily"),
            F.round("days", 4).alias("days"), coverage_class(F.col("days")).alias("class"),
            "brand_stock", F.round("brand_days", 4).alias("brand_days"),
            coverage_class(F.col("brand_days")).alias("brand_class"))
    )


def latest_stock(snapshots: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The last snapshot of every (store_id, product_id)."""
    return latest(snapshots, ["store_id", "product_id"], order)


def store_ranking(lines: DataFrame, stores: DataFrame, name: str, excluded: Sequence[str]) -> DataFrame:
    """Stores by revenue, test accounts left out by LIKE patterns on `name` (lower case)."""
    real = stores.filter(~F.lower(F.col(name)).rlike(like_patterns(excluded)))
    sold = lines.groupBy("store_id").agg(F.sum("qty").alias("qty"), F.sum("net").alias("revenue"))
    return ranks(sold.join(real, "store_id"), [], "revenue", "place")


def adherence(
    lines: DataFrame, stock: DataFrame, stores_in_scope: int = 100,
    weights: tuple[float, float, float, float] = (0.4, 0.2, 0.2, 0.2), cheap: float = 0.5, dear: float = 2.0,
) -> DataFrame:
    """Product score from stock presence, sales density, price attractiveness and margin in the
    `stores_in_scope` best-selling stores. `lines`: sale_id, store_id, product_id, qty, net, cost;
    `stock`: store_id, product_id, stock."""
    revenue = lineage_cut(lines.groupBy("store_id").agg(F.sum("net").alias("_r")))
    # stores that sell as much as the last one in scope are in scope, too; one number comes back
    least = revenue.orderBy(F.desc_nulls_last("_r")).limit(stores_in_scope).agg(F.min("_r")).head()[0]
    scope = revenue.filter(F.col("_r") >= F.lit(least)).select("store_id")
    sold = lines.join(scope, "store_id", "left_semi")
    held = stock.join(scope, "store_id", "left_semi")
    n = F.lit(scope.count())

    margin = F.avg(F.when(F.col("net") > 0, (F.col("net") - F.col("cost")).cast("double") / F.col("net").cast("double"))
                   .otherwise(0.0))
    store = sold.groupBy("store_id").agg(
        F.sum("net").alias("r"), F.countDistinct("sale_id").alias("k"), margin.alias("store_margin"))
    store = store.select("store_id", "store_margin", F.round(F.col("r").cast("double") / F.col("k"), 2).alias("ticket"))
    pair = sold.groupBy("product_id", "store_id").agg(
        F.sum("qty").alias("q"), F.sum("net").alias("r"), margin.alias("margin"))
    pair = pair.withColumn(
        "price", F.when(F.col("q") > 0, F.round(F.col("r").cast("double") / F.col("q"), 2)).otherwise(0.0))

    product = pair.groupBy("product_id").agg(F.sum("q").alias("q"), F.count(F.lit(1)).alias("selling"))
    product = product.withColumn("density", F.round(F.col("q") / F.col("selling"), 6))
    product = lineage_cut(product)  # one row per product, read for the percentile and for the scores
    p90 = F.lit(exact_percentiles(product, [], "density", {"p90": 0.9}).head()["p90"])
    presence = held.groupBy("product_id").agg(F.sum(F.when(F.col("stock") > 0, 1).otherwise(0)).alias("in_stock"))
    product = (
        product.join(presence, "product_id")
        .select(
            "product_id", (F.col("in_stock") / n).alias("s_stock"), (F.col("selling") / n).alias("f"),
            F.when(p90 > 0, F.least(F.lit(1.0), F.col("density") / p90)).otherwise(0.0).alias("d"))
    )
    ratio = F.col("price") / F.col("ticket")
    s_price = F.when(ratio <= cheap, 1.0).when(ratio >= dear, 0.0).otherwise((dear - ratio) / (dear - cheap))
    s_margin = F.when(F.col("store_margin") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("margin") / F.col("store_margin")))
                      ).otherwise(0.0)
    f = F.col("f")
    scored = pair.join(store, "store_id").join(product, "product_id").select(
        "product_id", "store_id", "s_stock", (F.col("d") * f).alias("s_volume"),
        (s_price * f).alias("s_price"), (s_margin * f).alias("s_margin"))
    parts = ["s_stock", "s_volume", "s_price", "s_margin"]
    total = sum((F.col(p) * w for p, w in zip(parts[1:], weights[1:])), F.col(parts[0]) * weights[0])
    exact = [F.round(total, 4).cast("decimal(9,4)").alias("score")] + [
        F.round(p, 4).cast("decimal(9,4)").alias(p) for p in parts]
    per_store = scored.select("product_id", *exact)
    return per_store.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("stores"),
        *[F.round(F.sum(c).cast("double") / F.count(F.lit(1)), 2).alias(c) for c in ["score", *parts]])


def store_tiers(
    sales: DataFrame, prescription: DataFrame, as_of: str, active_days: int = 35, rows: int | None = None
) -> DataFrame:
    """Store profile and size tier. Month metrics are daily averages inside a month, then averaged over
    months; a store collects one vote per measure (monthly revenue, active clerks, sales) that reaches a
    quartile: two at the upper one make G, two at the median M, one at the lower P, else PP.

    `sales`: store_id, sale_id, clerk_id, sold_on, hour, qty, net; `prescription`: product_id, rx, otc; `rows`: about how many
    sales there are, for the number of tasks.

    Sales are folded by store, sale and month first; what is counted after that are rows, and only few rows are left."""
    month = F.year("sold_on") * 12 + F.month("sold_on")
    folded = sales.groupBy("store_id", "sale_id", month.alias("month")).agg(
        F.sum("net").alias("revenue"), F.min("sold_on").alias("first"), F.max(F.dayofmonth(F.last_day("sold_on"))).alias("days"))
    monthly = folded.groupBy("store_id", "month").agg(
        F.sum("revenue").alias("revenue"), F.count("sale_id").alias("sales"), F.max("days").alias("days"))
    revenue = F.col("revenue").cast("double")
    averaged = monthly.groupBy("store_id").agg(
        F.round(F.avg(F.round(revenue / F.col("days"), 2)), 2).alias("daily_revenue"),
        F.round(F.avg(F.round(revenue / F.col("sales"), 2)), 2).alias("ticket"),
        F.round(F.sum("revenue").cast("double") / F.count(F.lit(1)), 2).alias("monthly_revenue"))
    as_of_day = F.lit(as_of).cast("date")
    totals = folded.groupBy("store_id", "sale_id").agg(F.min("first").alias("first")).groupBy("store_id").agg(
        F.count("sale_id").alias("sales"), F.min("first").alias("first"))
    active = sales.filter(F.datediff(as_of_day, "sold_on") <= active_days).groupBy("store_id").agg(
        F.countDistinct("clerk_id").alias("clerks"))
    totals = totals.join(active, "store_id", "left").select(
        "store_id", F.coalesce("clerks", F.lit(0)).alias("clerks"), "sales",
        F.floor(F.months_between(as_of_day, F.col("first"))).cast("long").alias("tenure_months"))
    peak = latest(
        sales.groupBy("store_id", "hour").agg(F.sum("qty").alias("_q")), ["store_id"], [F.desc("_q"), F.col("hour")]
    ).select("store_id", F.col("hour").alias("peak_hour"))
    mix = (
        sales.select("store_id", "product_id").distinct().join(prescription, "product_id")
        .groupBy("store_id")
        .agg(F.round(F.count_if("rx") / F.count(F.lit(1)), 2).alias("rx_share"),
             F.round(F.count_if("otc") / F.count(F.lit(1)), 2).alias("otc_share"))
    )
    out = totals.join(averaged, "store_id").join(peak, "store_id").join(mix, "store_id", "left")
    measures = ["monthly_revenue", "clerks", "sales"]
    with sized_shuffles(out.sparkSession, rows):
        out = lineage_cut(out)  # one row per store, read once per measure below
    cuts = column_percentiles(out, measures, {"q1": 0.25, "q2": 0.5, "q3": 0.75})

    def votes(q: str) -> Column:
        return sum((F.when(F.col(m) >= F.lit(cuts.get(m, {}).get(q)), 1).otherwise(0) for m in measures), F.lit(0))

    tier = F.when(votes("q3") >= 2, "G").when(votes("q2") >= 2, "M").when(votes("q1") >= 1, "P").otherwise("PP")
    return out.withColumn("tier", tier)


def calendar(spark: SparkSession, first: Column, last: Column, span: DataFrame | None = None) -> DataFrame:
    """One row per day with localised names. `span` may carry the one row that `first` / `last` refer to."""
    days = (span if span is not None else spark.range(1)).select(
        F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias("day"))
    weekday, month = F.dayofweek("day"), F.month("day")
    weekend = weekday.isin(1, 7)
    return days.select(
        "day", F.year("day").alias("year"), month.alias("month"), F.dayofmonth("day").alias("day_of_month"),
        F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), weekday).alias("weekday_name"),
        F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month).alias("month_name"),
        weekday.alias("weekday"), F.quarter("day").alias("quarter"), F.weekofyear("day").alias("week"),
        F.concat(F.lit("Semana "), F.weekofyear("day").cast("string")).alias("week_name"),
        weekend.alias("is_weekend"), (~weekend).alias("is_business_day"))


def campaign_dimension(own: DataFrame, rivals: DataFrame, campaign_stores: DataFrame) -> DataFrame:
    """(campaign, store, product): the campaign's own products and their rivals, in every store of the
    campaign, with a composite key. All inputs share `campaign`. There are as many rows as stores times products of a campaign; neither its stores
    nor its products are held or listed by one task."""
    both = own.withColumn("kind", F.lit("campaign")).unionByName(rivals.withColumn("kind", F.lit("rival"))).distinct()
    return product_join(campaign_stores, both, "campaign", ["product_id", "kind"]).withColumn(
        "store_product", F.concat_ws("|", F.col("store_id").cast("string"), F.col("product_id").cast("string")))


def account_status(accounts: DataFrame, stores: DataFrame) -> DataFrame:
    """Account status from the status of its stores: no stores, any active, all churned, else the most
    common status other than churn (ties by name). Columns account_id, current / store_id, status."""
    churned = F.col("status").startswith("churn")
    flags = stores.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("stores"), F.bool_or(F.col("status") == "active").alias("any_active"),
        F.bool_and(churned).alias("all_churned"))
    common = latest(
        stores.filter(~churned).groupBy("account_id", "status").agg(F.count(F.lit(1)).alias("_n")),
        ["account_id"], [F.desc("_n"), F.col("status")],
    ).select("account_id", F.col("status").alias("common"))
    out = accounts.join(flags, "account_id", "left").join(common, "account_id", "left")
    status = (
        F.when(F.col("stores").isNull(), "no_stores").when(F.col("any_active"), "active")
        .when(F.col("all_churned"), "churn").otherwise(F.col("common")))
    return out.select(
        "account_id", "current", F.coalesce(F.col("stores"), F.lit(0)).alias("stores"), status.alias("status")
    ).withColumn("changed", ~F.col("current").eqNullSafe(F.col("status")))


def clerk_activity(clerks: DataFrame, sellers: DataFrame, retired: str) -> DataFrame:
    """Clerks with their new active flag: a recent seller whose name does not contain `retired`."""
    seen = sellers.select("clerk_id").distinct().withColumn("_sold", F.lit(True))
    now = F.col("_sold").isNotNull() & ~F.col("name").contains(retired)
    return clerks.join(seen, "clerk_id", "left").withColumn("active", now).drop("_sold")


def transitions(clerks: DataFrame) -> DataFrame:
    return clerks.groupBy("was_active", "active").agg(F.count(F.lit(1)).alias("clerks"))


def silent_stores(sold: DataFrame, shown: DataFrame, stores: DataFrame) -> DataFrame:
    """Stores with units sold but no recommendations shown in the period. `sold`, `shown`: store_id, n."""
    a = sold.groupBy("store_id").agg(F.sum("n").alias("sold"))
    b = shown.groupBy("store_id").agg(F.sum("n").alias("shown"))
    return a.join(b, "store_id", "left").join(stores, "store_id").filter(F.coalesce(F.col("shown"), F.lit(0)) == 0)


def stock_snapshot(stock: DataFrame, own: DataFrame, rivals: DataFrame, taken_on: Column) -> DataFrame:
    """Stock rows of campaign products and their rivals, stamped with day and month (the partition
    column of the snapshot table)."""
    scope = own.select("product_id", F.lit("campaign").alias("kind")).unionByName(
        rivals.select("product_id", F.lit("rival").alias("kind"))).distinct()
    return stock.join(scope, "product_id").withColumn("taken_on", taken_on).withColumn(
        "month", F.date_format(taken_on, "yyyy-MM"))


def availability(stock: DataFrame, scope: DataFrame) -> DataFrame:
    """(product_id, account_id, store_id, stores): one row per in-scope product and store that holds it, with the number of
    such stores. A product in every store is as many rows, and its count is made of partial counts."""
    inside = stock.filter(F.col("stock") > 0).join(scope.select("product_id").distinct(), "product_id", "left_semi")
    held = inside.select("product_id", "account_id", "store_id").distinct()
    return held.join(held.groupBy("product_id").agg(F.count(F.lit(1)).alias("stores")), "product_id")


def weekly_units(lines: DataFrame, missions: DataFrame) -> DataFrame:
    """Units, value and sales of mission products by mission, product and week."""
    return lines.join(missions, "product_id").groupBy(
        "mission", "product_id", F.date_trunc("week", F.col("sold_on")).cast("date").alias("week")
    ).agg(F.sum("qty").alias("units"), F.sum("net").alias("value"), F.countDistinct("sale_id").alias("sales"))
