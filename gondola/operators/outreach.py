"""Message eligibility, rounds, reach and adoption, CRM hierarchy checks and sync plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.kit import latest, top_n

# Fixed value: messages allowed within 24 hours.
DAILY_CAP = 10_000


def remaining_capacity(messages: DataFrame, since: Column, cap: int = DAILY_CAP) -> Column:
    """Messages that may still be sent: the cap less the real messages at or after `since`."""
    sent = messages.filter(~F.col("is_test") & (F.col("sent_at") >= since)).agg(F.count(F.lit(1)).alias("n")).scalar()
    return F.greatest(F.lit(cap) - sent, F.lit(0))


def send_list(
    candidates: DataFrame, messages: DataFrame, round_start: Column, day_ago: Column, cap: int = DAILY_CAP
) -> DataFrame:
    """Who gets a level message now, in sending order: per level the best mission of a clerk, clerks who had
    that message since the round started left out, one per phone; higher levels first, then those whose last
    message is longest ago, up to the remaining capacity.

    `candidates`: clerk_id, phone, level, kind, mission, premium; `messages`: clerk_id, kind, sent_at, is_test."""
    real = messages.filter(~F.col("is_test"))
    best = latest(candidates, ["level", "clerk_id"], [F.desc("premium"), F.col("mission")])
    had = real.filter(F.col("sent_at") >= round_start).select("clerk_id", "kind").distinct()
    fresh = best.join(had, ["clerk_id", "kind"], "left_anti")
    last = real.groupBy("clerk_id").agg(F.max("sent_at").alias("last_sent"))
    ready = latest(fresh.join(last, "clerk_id", "left"), ["level", "phone"], [F.asc_nulls_first("last_sent"), F.col("clerk_id")])
    order = [F.desc("level"), F.asc_nulls_first("last_sent"), F.col("clerk_id")]
    # never more than `cap` rows from here on
    numbered = ready.orderBy(*order).limit(cap).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    return numbered.filter(F.col("place") <= remaining_capacity(messages, day_ago, cap))


def report_audience(progress: DataFrame, coins: DataFrame, people: DataFrame, top_level: int = 5) -> DataFrame:
    """Clerks for the daily report with their coins: without those at the top level in every mission, with
    all contact fields, one per phone. `progress`: clerk_id, mission, level; `coins`: clerk_id, unlocked,
    potential; `people`: clerk_id, name, phone."""
    reached = progress.filter(F.col("level") > 0)
    done = reached.groupBy("clerk_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("level") == top_level, 1)).alias("t")).filter("n = t")
    left = reached.select("clerk_id").distinct().join(done, "clerk_id", "left_anti")
    full = left.join(coins, "clerk_id").join(people, "clerk_id").dropna(subset=["unlocked", "potential", "name", "phone"])
    return latest(full, ["phone"], [F.col("clerk_id")])


def recent_sales(sales: DataFrame, focus: DataFrame, accounts: DataFrame, since: Column) -> DataFrame:
    """Sales of focus products in chosen accounts since a moment. `sales`: product_id, account_id, sold_at."""
    return sales.filter(F.col("sold_at") >= since).join(focus, "product_id", "left_semi").join(accounts, "account_id", "left_semi")


def assign_rounds(records: DataFrame, day: str, rounds: DataFrame) -> DataFrame:
    """Records with the round(s) their day falls into. Rounds are laid out as days and meet records on the
    day, so no interval join is needed. `rounds`: round_id, started_on, ended_on (inclusive)."""
    days = rounds.select("round_id", F.explode(F.sequence("started_on", "ended_on")).alias(day))
    return records.join(days, day)


def current_and_previous(rounds: DataFrame, as_of: Column) -> DataFrame:
    """The round of a day and the last one that ended before it, as rows tagged current / previous."""
    now = rounds.filter((as_of >= F.col("started_on")) & (as_of <= F.col("ended_on"))).orderBy("started_on", "round_id").limit(1)
    before = rounds.filter(F.col("ended_on") < as_of).orderBy(F.desc("ended_on"), "round_id").limit(1)
    return now.withColumn("which", F.lit("current")).unionByName(before.withColumn("which", F.lit("previous")))


def participation(previous: DataFrame, current: DataFrame, missions: DataFrame) -> DataFrame:
    """(clerk_id, mission) seen in either round for missions still active, with the current points and level
    (0 without any). `previous`, `current`: clerk_id, mission, points, level, updated_at, seq."""
    keys = ["clerk_id", "mission"]

    def last(df: DataFrame) -> DataFrame:
        return latest(df.filter(F.col("clerk_id").isNotNull()), keys, [F.desc_nulls_last("updated_at"), F.desc("seq")])

    now = last(current)
    everyone = last(previous).select(*keys).unionByName(now.select(*keys)).distinct().join(missions.select("mission"), "mission", "left_semi")
    return everyone.join(now.select(*keys, "points", "level"), keys, "left").na.fill(0, ["points", "level"])


def reach(messages: DataFrame, people: DataFrame) -> DataFrame:
    """One row: distinct clerks reached, opted in, registered, and the reach in percent."""
    got = messages.filter(~F.col("is_test")).agg(F.countDistinct("clerk_id").alias("n")).scalar()
    base = people.agg(F.count(F.when(F.col("opted_in"), 1)).alias("opted_in"), F.count(F.lit(1)).alias("registered"))
    return base.withColumn("reached", got).withColumn(
        "reach", F.when(F.col("opted_in") > 0, F.round(F.col("reached") / F.col("opted_in") * 100, 2)).otherwise(0.0))


def opt_outs(messages: DataFrame, people: DataFrame) -> DataFrame:
    """Clerks who opted out with the messages they had had."""
    had = messages.filter(~F.col("is_test")).groupBy("clerk_id").agg(F.count(F.lit(1)).alias("messages"), F.max("sent_at").alias("last_sent"))
    return people.filter(~F.col("opted_in")).select("clerk_id").join(had, "clerk_id", "left")


def error_rates(messages: DataFrame, errors: DataFrame, by: str) -> DataFrame:
    """Errors per value of `by` with their share of all errors and of all attempts."""
    sent = messages.filter(~F.col("is_test")).agg(F.count(F.lit(1)).alias("n")).scalar()
    real = errors.filter(~F.col("is_test"))
    failed = real.agg(F.count(F.lit(1)).alias("n")).scalar()
    n = F.col("errors")
    return real.groupBy(by).agg(F.count(F.lit(1)).alias("errors")).select(
        by, "errors", F.when(failed > 0, F.round(n / failed * 100, 4)).otherwise(0.0).alias("share_of_errors"),
        F.when(sent + failed > 0, F.round(n / (sent + failed) * 100, 4)).otherwise(0.0).alias("error_rate"))


def messages_per_clerk(messages: DataFrame) -> DataFrame:
    per = messages.filter(~F.col("is_test")).groupBy("clerk_id").agg(F.count(F.lit(1)).alias("messages"))
    return per.groupBy("messages").agg(F.count(F.lit(1)).alias("clerks"))


def adoption(people: DataFrame) -> DataFrame:
    """Adoption per store and over all (store_id null): distinct clerks, those who joined, those active in
    the last 30 days, and the adoption rate. Rows are folded to (store, clerk) and to clerks first, so no
    distinct sets are counted. `people`: store_id, clerk_id, joined, active."""
    flags = [F.max(F.col(c).cast("int")).alias(c) for c in ("joined", "active")]
    pairs = people.groupBy("store_id", "clerk_id").agg(*flags)
    clerks = pairs.groupBy("clerk_id").agg(F.max("joined").alias("joined"), F.max("active").alias("active"))

    def count(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("clerks"), F.sum("joined").alias("joined"), F.sum("active").alias("active"))

    every = count(clerks).select(F.lit(None).cast(people.schema["store_id"].dataType).alias("store_id"), "clerks", "joined", "active")
    return count(pairs, "store_id").unionByName(every).withColumn("adoption", F.round(F.col("joined") / F.col("clerks") * 100, 2))


def orphans(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents without children and children without a parent. `parents`: id; `children`: id, parent_id."""
    alone = parents.select("id").join(children.select(F.col("parent_id").alias("id")), "id", "left_anti")
    lost = children.filter(F.col("parent_id").isNull()).select("id")
    return alone.withColumn("kind", F.lit("parent")).unionByName(lost.withColumn("kind", F.lit("child")))


def sync_plan(rows: DataFrame, known: DataFrame, key: str, since: Column) -> DataFrame:
    """Rows changed since the last sync with what to do: update known ones, report the others."""
    changed = rows.filter(F.col("updated_on") > since)
    return changed.join(known.select(key).distinct().withColumn("_k", F.lit(True)), key, "left").withColumn(
        "action", F.when(F.col("_k"), "update").otherwise("report")).drop("_k")


def common_state(stores: DataFrame) -> DataFrame:
    """Most common state of an account's stores (first by name on ties)."""
    counts = stores.filter(F.trim("state") != "").groupBy("account_id", "state").agg(F.count(F.lit(1)).alias("n"))
    return top_n(counts, ["account_id"], [F.desc("n"), F.col("state")], 1).select("account_id", "state")

