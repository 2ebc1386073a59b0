"""Campaign settlements, bonuses, prizes and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.kit import hashed_side, latest, order_positions, top_n
from gondola.session import lineage_cut


def unsettled(invoices: DataFrame, settled: DataFrame, rows: int | None = None) -> DataFrame:
    """Invoice lines of (account_id, invoice) pairs not settled before. `rows`: about how many lines there are."""
    pairs = settled.select("account_id", "invoice").distinct()
    return invoices.join(hashed_side(pairs, rows), ["account_id", "invoice"], "left_anti")


def combo_days(lines: DataFrame, rules: DataFrame, first: str, last: str, back_days: int = 7) -> DataFrame:
    """Best combo of every account and day on which all brands of a combo reach their units within the
    day and the `back_days` before it. `rules`: combo, priority, brand, units, discount (a fraction);
    `lines`: account_id, day, brand, qty, net.

    A day's brand total counts towards that day and the `back_days` after it, so the sliding totals are a
    grouped sum that combines map-side, and rules meet totals on the brand, not by a cross join."""
    daily = lineage_cut(  # one row per account, brand and day, read twice
        lines.groupBy("account_id", "brand", "day").agg(F.sum("qty").alias("qty"), F.sum("net").alias("net")))
    days = daily.select("account_id", "day").distinct()
    slid = (
        daily.join(rules.select("brand").distinct(), "brand", "left_semi")
        .withColumn("_own", F.col("day"))
        .withColumn("day", F.explode(F.sequence(F.col("day"), F.date_add("day", back_days))))
        .filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    )
    same = F.col("_own") == F.col("day")
    totals = slid.groupBy("account_id", "day", "brand").agg(
        F.sum("qty").alias("qty_7d"), F.sum("net").alias("net_7d"),
        F.coalesce(F.sum(F.when(same, F.col("qty"))), F.lit(0)).alias("qty_day"),
        F.coalesce(F.sum(F.when(same, F.col("net"))), F.lit(0)).alias("net_day"),
    ).join(days, ["account_id", "day"], "left_semi")
    needed = rules.groupBy("combo").agg(F.count(F.lit(1)).alias("_needed"))
    met = totals.join(rules, "brand").groupBy("account_id", "day", "combo", "priority").agg(
        F.count(F.when(F.col("qty_7d") >= F.col("units"), 1)).alias("_met"),
        F.count(F.when(F.col("qty_day") >= F.col("units"), 1)).alias("_met_day"),
        F.round(F.sum(F.col("net_7d") * F.col("discount")), 2).alias("cash_7d"),
        F.round(F.sum(F.col("net_day") * F.col("discount")), 2).alias("cash_day"))
    valid = met.join(needed, "combo").filter(F.col("_met") == F.col("_needed")).withColumn(
        "day_alone", F.col("_met_day") == F.col("_needed"))
    return latest(valid, ["account_id", "day"], [F.desc("priority"), F.col("combo")]).select(
        "account_id", "day", "combo", "cash_7d", "cash_day", "day_alone")


def combo_cashback(days: DataFrame, cool_down: int = 7) -> DataFrame:
    """Walks the qualifying days of an account in order: the first one pays the sliding total; a later one
    pays it when `cool_down` days have passed since the last payment, else it pays its own day when that
    day alone meets the combo. An account holds at most one entry per calendar day, so the walk is a fold
    over a list that the calendar bounds."""
    paid = "array<struct<day:date,combo:string,cashback:decimal(18,2)>>"
    entries = days.groupBy("account_id").agg(F.array_sort(F.collect_list(F.struct(
        "day", "combo", F.col("cash_7d").cast("decimal(18,2)").alias("cash_7d"),
        F.col("cash_day").cast("decimal(18,2)").alias("cash_day"), "day_alone"))).alias("_days"))

    def step(acc: Column, d: Column) -> Column:
        rested = acc["last"].isNull() | (F.datediff(d["day"], acc["last"]) >= cool_down)
        amount = F.when(rested, d["cash_7d"]).otherwise(d["cash_day"])
        entry = F.struct(d["day"].alias("day"), d["combo"].alias("combo"), amount.alias("cashback"))
        pays = rested | d["day_alone"]
        return F.struct(
            F.when(pays, d["day"]).otherwise(acc["last"]).alias("last"),
            F.when(pays, F.concat(acc["paid"], F.array(entry)).cast(paid)).otherwise(acc["paid"]).alias("paid"))

    start = F.struct(F.lit(None).cast("date").alias("last"), F.array().cast(paid).alias("paid"))
    walked = entries.select("account_id", F.explode(F.aggregate("_days", start, step)["paid"]).alias("p"))
    return walked.select("account_id", "p.day", "p.combo", "p.cashback")


def pix_cashback(lines: DataFrame, discounts: DataFrame, first: str, last: str) -> DataFrame:
    """Cashback per (account, product, day) of the period: net value times the product's discount %. Lines of products without a discount
    are left out before anything is summed."""
    period = lines.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).join(
        discounts.select("product_id"), "product_id", "left_semi")
    bought = period.groupBy("account_id", "product_id", "day").agg(
        F.sum("qty").alias("units"), F.round(F.sum("net"), 2).alias("value"), F.countDistinct("invoice").alias("invoices"))
    return bought.join(discounts, "product_id").withColumn(
        "cashback", F.round(F.col("value") * F.col("discount") / F.lit(100).cast("decimal(5,2)"), 2))


def day_prices(lines: DataFrame, keys: Sequence[str], day: str = "sold_on") -> DataFrame:
    """Unit price per key and day; a busy key has one row per calendar day."""
    return lines.groupBy(*keys, day).agg(
        F.round(F.sum("net").cast("double") / F.sum("qty"), 2).alias("price"))


def price_drops(prices: DataFrame, keys: Sequence[str], day: str = "sold_on") -> DataFrame:
    """First day on which the price fell below that of the day sold before."""
    w = Window.partitionBy(*keys).orderBy(day)
    fell = prices.withColumn("_before", F.lag("price").over(w)).filter(F.col("price") < F.col("_before"))
    return fell.groupBy(*keys).agg(F.min(day).alias("first_drop"))


def reimbursement(
    sales: DataFrame, stock_prices: DataFrame, first: str, last: str, cap: float = 20.0, tells_price: Column | None = None
) -> DataFrame:
    """Refund of consumer discounts. The original price is the last one before the campaign, else the
    first one in it, else the oldest stock price; the discount is capped and the refund never negative. Lines for
    which `tells_price` does not hold (returns, say) are refunded, but set no price; without any price a line has no refund.
    `sales`: account_id, store_id, product_id, sale_id, sold_on, qty, net; `stock_prices`: store_id,
    product_id, price, taken_on."""
    keys = ["account_id", "store_id", "product_id"]
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    telling = sales if tells_price is None else sales.filter(tells_price)
    prices = lineage_cut(day_prices(telling, keys).filter("price is not null"))  # one row per key and day, read three times
    before = prices.filter(F.col("sold_on") < start).groupBy(*keys).agg(
        F.max_by("price", "sold_on").alias("p1"), F.max("sold_on").alias("d1"))
    inside = prices.filter(F.col("sold_on").between(start, end))
    after = inside.groupBy(*keys).agg(F.min_by("price", "sold_on").alias("p2"), F.min("sold_on").alias("d2"))
    asked = sales.filter(F.col("sold_on").between(start, end)).select(*keys).distinct()
    stock = stock_prices.groupBy("store_id", "product_id").agg(
        F.min_by("price", "taken_on").alias("p3"), F.min("taken_on").alias("d3"))
    refs = (
        asked.join(after, keys, "left").join(before, keys, "left").join(stock, ["store_id", "product_id"], "left")
        .join(price_drops(inside, keys), keys, "left")
        .select(
            *keys, "first_drop", F.coalesce("p1", "p2", "p3").alias("original"),
            F.when(F.col("p1").isNotNull(), "sale_before").when(F.col("p2").isNotNull(), "sale_inside")
            .when(F.col("p3").isNotNull(), "stock").alias("source"),
            F.when(F.col("p1").isNotNull(), F.col("d1")).when(F.col("p2").isNotNull(), F.col("d2"))
            .otherwise(F.col("d3")).alias("source_day"))
    )
    unit = F.round(F.col("net").cast("double") / F.col("qty"), 2)
    pct = F.round((F.col("original") - F.col("unit")) / F.col("original") * 100, 2)
    refund = F.round(F.col("original") * (F.col("capped") / 100), 2)
    return (
        sales.filter(F.col("sold_on").between(start, end)).join(refs, keys)
        .withColumn("unit", unit).withColumn("pct", pct)
        .withColumn("capped", F.when(F.col("pct").isNotNull(), F.least(F.col("pct"), F.lit(float(cap)))))
        .withColumn("unit_refund", refund)
        .withColumn("refund", F.when(F.col("unit_refund").isNotNull(), F.greatest(
            F.round(F.col("unit_refund") * F.col("qty"), 2), F.lit(0.0))))
    )


def manager_bonus(levels: DataFrame, stores: DataFrame, rules: DataFrame, managers: DataFrame) -> DataFrame:
    """Premium of each manager: clerks of a store that reached the required level (3 and up while the
    store is onboarding, 5 when active) are counted, the best rule reached is kept, and its premium is split
    among the managers of the store (a store without managers keeps it whole).

    `levels`: clerk_id, store_id, level, updated_at, seq; `rules`: status, clerks, premium; `managers`:
    store_id, manager_id."""
    now = latest(levels, ["clerk_id"], [F.desc("updated_at"), F.desc("seq")]).join(stores, "store_id")
    good = now.filter(((F.col("status") == "onboarding") & (F.col("level") >= 3))
                      | ((F.col("status") == "active") & (F.col("level") == 5)))
    by_level = good.groupBy("store_id", "status", "level").agg(F.count(F.lit(1)).alias("n"))
    counted = by_level.groupBy("store_id", "status").agg(
        F.sum("n").alias("clerks"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.col("level").cast("string"), F.col("n").cast("string")))), "|")
        .alias("by_level"))
    reached = counted.join(rules.withColumnRenamed("clerks", "required"), "status").filter(
        F.col("clerks") >= F.col("required"))
    best = reached.groupBy("store_id", "status", "clerks", "by_level").agg(F.max("premium").alias("premium"))
    heads = managers.select("store_id", "manager_id").distinct()
    shared = best.join(heads.groupBy("store_id").agg(F.count(F.lit(1)).alias("managers")), "store_id", "left")
    split = F.coalesce(F.round(F.col("premium") / F.col("managers"), 2), F.col("premium"))
    return shared.withColumn("bonus", split).join(heads, "store_id", "left")


def clerk_prizes(ledger: DataFrame, rounds: DataFrame, missions: DataFrame, since: str, per_unit: int = 100) -> DataFrame:
    """Prize per round, clerk and kind of mission: coins per mission turned into money, missions without
    a prize left out, whole money units. `ledger`: clerk_id, mission, round_id, coins; `rounds`: round_id,
    started_on; `missions`: mission, kind."""
    won = (
        ledger.join(missions, "mission").join(rounds, "round_id")
        .groupBy("started_on", "kind", "mission", "clerk_id").agg(F.sum("coins").alias("coins"))
        .filter((F.col("started_on") >= F.lit(since).cast("date")) & (F.col("coins") > 0))
    )
    return won.groupBy("started_on", "kind", "clerk_id").agg(
        F.floor(F.sum("coins") / per_unit).cast("long").alias("prize"), F.count(F.lit(1)).alias("missions")
    ).withColumn("week", F.weekofyear("started_on"))


def coins_up_to(level: Column, per_level: Sequence[Column]) -> Column:
    """Coins unlocked from level 1 up to `level` (levels outside the range are limited to it)."""
    amounts = F.array(*[F.coalesce(c, F.lit(0)) for c in per_level])
    upto = F.least(F.greatest(F.coalesce(level, F.lit(0)), F.lit(0)), F.lit(len(per_level)))
    return F.aggregate(F.slice(amounts, F.lit(1), upto), F.lit(0).cast("long"), lambda a, x: a + x)


def clerk_coins(progress: DataFrame, per_level: Sequence[str]) -> DataFrame:
    """Unlocked and potential coins of every clerk over all missions. `progress`: clerk_id, mission,
    level and one column of coins per level."""
    columns = [F.col(c) for c in per_level]
    return progress.groupBy("clerk_id").agg(
        F.sum(coins_up_to(F.col("level"), columns)).alias("unlocked"),
        F.sum(coins_up_to(F.lit(len(per_level)), columns)).alias("potential"))


def leaderboard(players: DataFrame, top_level: int = 5, size: int = 10, coins_per_unit: int = 100) -> DataFrame:
    """Weekly board per (account, mission): all players at the top level, filled up to `size` with the
    best of the others (points, then name, then id), ranked, one JSON line per player. Lines stay rows, so
    a mission with very many top players is no wide list. `players`: account_id, mission, player_id, name,
    level, points, coins (distinct on the first three)."""
    group = ["account_id", "mission"]
    best = players.filter(F.col("level") == top_level)
    counts = best.groupBy(*group).agg(F.count(F.lit(1)).alias("_top"))
    others = players.filter((F.col("level") != top_level) & (F.col("coins") > 0))
    order = [F.desc("points"), F.col("name"), F.col("player_id")]
    fill = (
        top_n(others, group, order, size, "_k").join(counts, group, "left")
        .filter(F.col("_k") <= size - F.coalesce(F.col("_top"), F.lit(0))).drop("_k", "_top")
    )
    ranked = order_positions(best.unionByName(fill), group, order).withColumnRenamed("position", "place")
    prize = F.when(F.col("coins") == 0, "-").otherwise(
        F.concat(F.lit("R$ "), F.floor(F.col("coins") / coins_per_unit).cast("string")))
    return ranked.withColumn("line", F.to_json(F.struct("place", "name", "level", prize.alias("prize")))).drop("group_rows")


def campaign_margin(
    lines: DataFrame, products: DataFrame, stores: DataFrame, as_of: str, target_roas: float, budget: float = 0.20
) -> DataFrame:
    """Weekly sales of campaign products in campaign stores with the spend that meets a target return, if
    it stays within the budget share of sales, the margin after coins, and the return. Closed weeks only.
    `lines`: store_id, product_id, sold_on, qty, net, coins; `products`: product_id, campaign; `stores`: store_id, campaign.

    A line meets the campaigns of its product, then those of its store: the stores of a campaign are never paired with all its products."""
    week = F.date_trunc("week", F.col("sold_on")).cast("date")
    weekly = lines.join(products, "product_id").join(stores, ["store_id", "campaign"]).groupBy(week.alias("week"), "campaign", "product_id").agg(
        F.sum("qty").alias("qty"), F.sum("net").cast("double").alias("value"), F.sum("coins").alias("coins"))
    spend = F.col("value") / F.lit(float(target_roas))
    allowed = (F.col("value") > 0) & (spend <= F.lit(float(budget)) * F.col("value"))
    return (
        weekly.filter(F.date_add("week", 6) < F.lit(as_of).cast("date"))
        .withColumn("spend", F.when(allowed, spend).otherwise(0.0))
        .withColumn("margin", F.round(F.col("spend") - F.col("coins"), 2))
        .withColumn("roas", F.when(F.col("spend") > 0, F.round(F.col("value") / F.col("spend"), 2)).otherwise(0.0))
    )
