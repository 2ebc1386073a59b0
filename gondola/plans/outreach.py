"""Messaging and CRM analytics over the driver's tables: event users are clerks, event types missions and
message kinds, weeks rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.operators import incentives
from gondola.operators import outreach as op
from gondola.plans import inputs as src
from gondola.plans.incentives import _M, _PROGRESS, _UNLOCKED, _progress
from gondola.plans.inputs import FEED, SALES, STORES, r
from gondola.plans.registry import query

_NOW, _DAY = 1706572800000000, 86400000000  # 2024-01-30 in microseconds, one day
_MSG = "msg AS (SELECT user_id AS clerk_id, event_type AS kind, at_us AS sent_at, k < 10 AS is_test FROM feed WHERE event_type IN ('view', 'error', 'click'))"


def _messages(t):
    return src.feed(t).filter(F.col("event_type").isin("view", "error", "click")).select(
        F.col("user_id").alias("clerk_id"), F.col("event_type").alias("kind"), F.col("at_us").alias("sent_at"), (F.col("k") < 10).alias("is_test"))


@query("d113_send_list", f"""
WITH {_PROGRESS}, {_MSG}, c AS (SELECT clerk_id, '55' || (clerk_id // 2) AS phone, level, CASE WHEN level > 2 THEN 'view' ELSE 'error' END AS kind, mission, points AS premium FROM pr WHERE level > 0),
rm AS (SELECT * FROM msg WHERE NOT is_test),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level, clerk_id ORDER BY premium DESC, mission) AS k1 FROM c) WHERE k1 = 1),
f AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM rm WHERE rm.clerk_id = b.clerk_id AND rm.kind = b.kind AND sent_at >= {_NOW - 3 * _DAY})),
l AS (SELECT clerk_id, max(sent_at) AS last_sent FROM rm GROUP BY 1),
p AS (SELECT * FROM (SELECT f.*, last_sent, row_number() OVER (PARTITION BY level, phone ORDER BY last_sent ASC NULLS FIRST, clerk_id) AS k2 FROM f LEFT JOIN l USING (clerk_id)) WHERE k2 = 1),
z AS (SELECT *, CAST(row_number() OVER (ORDER BY level DESC, last_sent ASC NULLS FIRST, clerk_id) AS INTEGER) AS place FROM p)
SELECT clerk_id, phone, level, kind, mission, place FROM z WHERE place <= 400 - (SELECT count(*) FROM rm WHERE sent_at >= {_NOW - _DAY})""")
def send_list(t):
    progress = _progress(t).filter("level > 0")
    candidates = progress.select(
        "clerk_id", F.expr("'55' || (clerk_id div 2)").alias("phone"), "level", F.when(F.col("level") > 2, "view").otherwise("error").alias("kind"), "mission",
        F.col("points").alias("premium"))
    return op.send_list(candidates, _messages(t), F.lit(_NOW - 3 * _DAY), F.lit(_NOW - _DAY), 400).select("clerk_id", "phone", "level", "kind", "mission", "place")


@query("d125_report_audience", f"""
WITH {_PROGRESS}, re AS (SELECT * FROM pr WHERE level > 0), dn AS (SELECT clerk_id FROM re GROUP BY 1 HAVING count(*) = count(*) FILTER (level = 5)),
co AS (SELECT clerk_id, CAST(sum({_UNLOCKED}) AS BIGINT) AS unlocked, CAST(sum({' + '.join(f'coalesce({m}, 0)' for m in _M)}) AS BIGINT) AS potential FROM pr GROUP BY 1),
x AS (SELECT DISTINCT re.clerk_id, unlocked, potential, '55' || (re.clerk_id % 90) AS phone FROM re JOIN co USING (clerk_id) WHERE re.clerk_id NOT IN (FROM dn) AND re.clerk_id % 7 <> 0)
SELECT clerk_id, unlocked, potential, phone FROM (SELECT *, row_number() OVER (PARTITION BY phone ORDER BY clerk_id) AS k FROM x) WHERE k = 1""")
def report_audience(t):
    progress = _progress(t)
    coins = incentives.clerk_coins(progress, _M)
    people = progress.select("clerk_id").distinct().selectExpr("clerk_id", "CASE WHEN clerk_id % 7 <> 0 THEN 'n' END AS name", "'55' || (clerk_id % 90) AS phone")
    return op.report_audience(progress, coins, people).select("clerk_id", "unlocked", "potential", "phone")


@query("d126_recent_sales", f"""
WITH {FEED} SELECT event_id, user_id % 25 AS account_id, k AS product_id FROM feed WHERE event_type = 'purchase' AND at_us >= (SELECT max(at_us) FROM feed) - {2 * _DAY}
AND k IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') AND user_id % 25 IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""")
def recent_sales(t):
    f = src.feed(t)
    sales = f.filter("event_type = 'purchase'").select("event_id", (F.col("user_id") % 25).alias("account_id"), F.col("k").alias("product_id"), F.col("at_us").alias("sold_at"))
    since = f.agg((F.max("at_us") - F.lit(2 * _DAY)).alias("s")).scalar()
    focus = t.part.filter("p_type = 'PROMO'").select(F.col("p_partkey").cast("int").alias("product_id"))
    accounts = t.nation.filter("n_regionkey < 3").select(F.col("n_nationkey").cast("long").alias("account_id"))
    return op.recent_sales(sales, focus, accounts, since).select("event_id", "account_id", "product_id")


_ROUNDS = "rounds AS (SELECT i AS round_id, DATE '2024-01-01' + CAST(i * 7 AS INTEGER) AS started_on, DATE '2024-01-01' + CAST(i * 7 + 5 AS INTEGER) AS ended_on FROM (SELECT DISTINCT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS i FROM events))"


def _rounds(t):
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7)
    base = F.lit("2024-01-01").cast("date")
    return t.events.select(week.alias("round_id")).distinct().select(
        "round_id", F.date_add(base, (F.col("round_id") * 7).cast("int")).alias("started_on"), F.date_add(base, (F.col("round_id") * 7 + 5).cast("int")).alias("ended_on"))


@query("d114_assign_rounds", f"WITH {FEED}, {_ROUNDS} SELECT round_id, user_id, count(*) AS events FROM feed JOIN rounds ON day BETWEEN started_on AND ended_on GROUP BY 1, 2")
def assign_rounds(t):
    return op.assign_rounds(src.feed(t).select("user_id", "day"), "day", _rounds(t)).groupBy("round_id", "user_id").agg(F.count(F.lit(1)).alias("events"))


@query("d114_current_and_previous", f"""
WITH {_ROUNDS} SELECT round_id, started_on, ended_on, 'current' AS which FROM rounds WHERE DATE '2024-01-17' BETWEEN started_on AND ended_on
UNION ALL SELECT round_id, started_on, ended_on, 'previous' FROM rounds WHERE ended_on = (SELECT max(ended_on) FROM rounds WHERE ended_on < DATE '2024-01-17')""")
def current_and_previous(t):
    return op.current_and_previous(_rounds(t), F.lit("2024-01-17").cast("date"))


_POINTS = "pts AS (SELECT user_id AS clerk_id, event_type AS mission, date_diff('day', DATE '2024-01-01', day) // 7 AS round_id, CAST(k AS BIGINT) AS points, k % 6 AS level, row_number() OVER (PARTITION BY user_id, event_type, date_diff('day', DATE '2024-01-01', day) // 7 ORDER BY at_us DESC, event_id DESC) AS z FROM feed)"


@query("d115_participation", f"""
WITH {FEED}, {_POINTS}, pv AS (SELECT * FROM pts WHERE round_id = 1 AND z = 1), cu AS (SELECT * FROM pts WHERE round_id = 2 AND z = 1),
e AS (SELECT clerk_id, mission FROM pv UNION SELECT clerk_id, mission FROM cu)
SELECT e.*, coalesce(points, 0) AS points, coalesce(level, 0) AS level FROM e LEFT JOIN cu USING (clerk_id, mission) WHERE mission <> 'signup'""")
def participation(t):
    pts = src.feed(t).select(
        F.col("user_id").alias("clerk_id"), F.col("event_type").alias("mission"), F.floor(F.datediff("day", F.lit("2024-01-01").cast("date")) / 7).alias("round_id"),
        F.col("k").cast("long").alias("points"), (F.col("k") % 6).alias("level"), F.col("at_us").alias("updated_at"), F.col("event_id").alias("seq"))
    missions = pts.filter("mission <> 'signup'").select("mission").distinct()
    return op.participation(pts.filter("round_id = 1"), pts.filter("round_id = 2"), missions)


_PEOPLE = "people AS (SELECT DISTINCT user_id AS clerk_id, user_id % 5 <> 0 AS opted_in FROM feed)"


def _people(t):
    return src.feed(t).select(F.col("user_id").alias("clerk_id"), (F.col("user_id") % 5 != 0).alias("opted_in")).distinct()


@query("d116_reach", f"""
WITH {FEED}, {_MSG}, {_PEOPLE}, x AS (SELECT count(*) FILTER (opted_in) AS opted_in, count(*) AS registered, (SELECT count(DISTINCT clerk_id) FROM msg WHERE NOT is_test) AS reached FROM people)
SELECT *, CASE WHEN opted_in > 0 THEN {r('reached / opted_in * 100', 2)} ELSE 0 END AS reach FROM x""")
def reach(t):
    return op.reach(_messages(t), _people(t))


@query("d116_opt_outs", f"""
WITH {FEED}, {_MSG}, {_PEOPLE}, h AS (SELECT clerk_id, count(*) AS messages, max(sent_at) AS last_sent FROM msg WHERE NOT is_test GROUP BY 1)
SELECT clerk_id, messages, last_sent FROM people LEFT JOIN h USING (clerk_id) WHERE NOT opted_in""")
def opt_outs(t):
    return op.opt_outs(_messages(t), _people(t))


@query("d116_error_rates", f"""
WITH {FEED}, {_MSG}, e AS (SELECT k % 4 AS cause, k < 10 AS is_test FROM feed WHERE event_type = 'error'), s AS (SELECT count(*) AS sent FROM msg WHERE NOT is_test), f AS (SELECT count(*) AS failed FROM e WHERE NOT is_test)
SELECT cause, count(*) AS errors, {r('count(*) / max(failed) * 100', 4)} AS share_of_errors, {r('count(*) / max(sent + failed) * 100', 4)} AS error_rate FROM e, s, f WHERE NOT is_test GROUP BY 1""")
def error_rates(t):
    errors = src.feed(t).filter("event_type = 'error'").select((F.col("k") % 4).alias("cause"), (F.col("k") < 10).alias("is_test"))
    return op.error_rates(_messages(t), errors, "cause")


@query("d116_messages_per_clerk", f"WITH {FEED}, {_MSG}, p AS (SELECT clerk_id, count(*) AS messages FROM msg WHERE NOT is_test GROUP BY 1) SELECT messages, count(*) AS clerks FROM p GROUP BY 1")
def messages_per_clerk(t):
    return op.messages_per_clerk(_messages(t))


@query("d117_adoption", f"""
WITH {SALES}, x AS (SELECT store_id, customer_id AS clerk_id, max(priority = '1-URGENT') AS joined, max(sold_on >= DATE '2001-05-01') AS active FROM sales GROUP BY 1, 2),
y AS (SELECT store_id, clerk_id, joined, active FROM x UNION ALL SELECT NULL, clerk_id, max(joined), max(active) FROM x GROUP BY 2)
SELECT store_id, count(*) AS clerks, count(*) FILTER (joined) AS joined, count(*) FILTER (active) AS active, {r('count(*) FILTER (joined) / count(*) * 100', 2)} AS adoption FROM y GROUP BY 1""")
def adoption(t):
    people = src.sales(t).select(
        "store_id", F.col("customer_id").alias("clerk_id"), (F.col("priority") == "1-URGENT").alias("joined"),
        (F.col("sold_on") >= F.lit("2001-05-01").cast("date")).alias("active"))
    return op.adoption(people)


@query("d118_orphans", """
SELECT 'n' || n_nationkey AS id, 'parent' AS kind FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey // 2 * 2 FROM supplier WHERE s_suppkey % 7 <> 0)
UNION ALL SELECT 's' || s_suppkey, 'child' FROM supplier WHERE s_suppkey % 7 = 0""")
def orphans(t):
    children = t.supplier.selectExpr("'s' || s_suppkey AS id", "CASE WHEN s_suppkey % 7 <> 0 THEN 'n' || s_nationkey div 2 * 2 END AS parent_id")
    return op.orphans(t.nation.selectExpr("'n' || n_nationkey AS id"), children)


@query("d119_sync_plan", """
SELECT c_custkey, c_name, CASE WHEN c_nationkey < 20 THEN 'update' ELSE 'report' END AS action FROM customer WHERE c_custkey % 30 > 12""")
def sync_plan(t):
    rows = t.customer.select("c_custkey", "c_name", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 30).cast("int")).alias("updated_on"))
    out = op.sync_plan(rows, t.customer.filter("c_nationkey < 20").select("c_custkey"), "c_custkey", F.lit("2024-01-13").cast("date"))
    return out.select("c_custkey", "c_name", "action")


@query("d119_common_state", f"""
WITH {STORES}, c AS (SELECT account_id, 'S' || (store_id % 4) AS state, count(*) AS n FROM stores WHERE store_id % 4 <> 3 GROUP BY 1, 2)
SELECT account_id, arg_min(state, (-n, state)) AS state FROM c GROUP BY 1""")
def common_state(t):
    return op.common_state(src.stores(t).selectExpr("account_id", "CASE WHEN store_id % 4 = 3 THEN ' ' ELSE 'S' || (store_id % 4) END AS state"))
