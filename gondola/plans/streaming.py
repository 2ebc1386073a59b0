"""Streams over the events file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.plans.registry import query
from gondola.streaming import incremental as op
from gondola.streaming.merge_on_read import MergeTable, run_merge
from gondola.streaming.sessions import SessionTable, run_sessions


def _stream(t) -> DataFrame:
    """The events table as a stream, with a plain timestamp. Written as a pattern, because a stream takes a
    plain path for a folder only, and the table may be a single file."""
    raw = t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parque[t]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _micros(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.unix_micros(c) for c in columns})


@query("k01_deduplicated_ingest", "SELECT event_id, user_id, event_type FROM events")
def deduplicated_ingest(t):
    twice = _stream(t).withColumn("_copy", F.explode(F.sequence(F.lit(0), (F.col("event_id") % 3 == 0).cast("int"))))
    rows = op.deduplicated(twice, "event_id", "ts").select("event_id", "user_id", "event_type")
    return op.run_append(rows, op.work_folder(t.spark, "ingest"))


@query("k02_weekly_funnel", """
SELECT epoch_us(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')) AS window_start, event_type, count(*) AS rows, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def weekly_funnel(t):
    rows = _stream(t).withColumn("amount", F.col("value").cast("decimal(12,2)"))
    out = op.run_update(op.tumbling_counts(rows, "ts", "7 days", ["event_type"], "amount"), op.work_folder(t.spark, "funnel"), ["window_start", "event_type"])
    return _micros(out, "window_start").withColumn("total", F.col("total").cast("double"))


@query("k03_sliding_totals", """
WITH x AS (SELECT user_id % 20 AS account, CAST(value AS DECIMAL(12,2)) AS v, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase'),
y AS (SELECT account, v, unnest(generate_series(1, 7)) AS i, d FROM x)
SELECT epoch_us(CAST(d + CAST(i AS INTEGER) AS TIMESTAMP)) AS window_end, account, count(*) AS rows, CAST(sum(v) AS DOUBLE) AS total FROM y GROUP BY 1, 2""")
def sliding_totals(t):
    rows = _stream(t).filter("event_type = 'purchase'").select("ts", (F.col("user_id") % 20).alias("account"), F.col("value").cast("decimal(12,2)").alias("v"))
    out = op.run_update(op.sliding_totals(rows, "ts", "7 days", "1 day", ["account"], "v"), op.work_folder(t.spark, "sliding"), ["window_end", "account"])
    return _micros(out, "window_end").withColumn("total", F.col("total").cast("double"))


_COOL_DOWN = """
WITH RECURSIVE d AS (SELECT DISTINCT user_id AS account, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'), s AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY day) AS i FROM d),
w AS (SELECT account, i, day, day AS last, true AS paid FROM s WHERE i = 1 UNION ALL SELECT s.account, s.i, s.day, CASE WHEN s.day - w.last >= 7 THEN s.day ELSE w.last END, s.day - w.last >= 7 FROM w JOIN s ON s.account = w.account AND s.i = w.i + 1)
SELECT account, day AS paid_on FROM w WHERE paid"""


@query("k04_cool_down", _COOL_DOWN)
def cool_down(t):
    rows = _stream(t).filter("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("day"))
    return op.run_append(op.pay_with_cool_down(rows, "user_id", "day"), op.work_folder(t.spark, "cooldown"))


@query("k04_expiring_cool_down", _COOL_DOWN)
def expiring_cool_down(t):
    """The same with state that ends with the cool-down."""
    rows = _stream(t).filter("event_type = 'purchase'").select("user_id", "ts", F.to_date("ts").alias("day"))
    return op.run_append(op.pay_with_cool_down(rows, "user_id", "day", at="ts"), op.work_folder(t.spark, "timers"))


@query("k05_capacity_left", """
WITH x AS (SELECT date_trunc('hour', ts) AS h FROM events WHERE event_type = 'view'), y AS (SELECT h + to_hours(CAST(unnest(generate_series(1, 24)) AS INTEGER)) AS e FROM x)
SELECT epoch_us(e) AS window_end, count(*) AS sent, greatest(60 - count(*), 0) AS "left" FROM y GROUP BY 1""")
def capacity_left(t):
    rows = _stream(t).filter("event_type = 'view'").select("ts")
    out = op.run_update(op.capacity_left(rows, "ts", 60), op.work_folder(t.spark, "capacity"), ["window_end"])
    return _micros(out, "window_end")


_LATEST = """
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, epoch_us(max(ts)) AS ts FROM events GROUP BY 1"""


@query("k06_merge_on_read", _LATEST)
def latest_merge(t):
    """Batches append deltas, readers merge them."""
    folder, columns = op.work_folder(t.spark, "merge"), ["user_id", "event_type", "value", "ts", "event_id"]
    rows = _stream(t).select(*columns)
    table = MergeTable(t.spark, f"{folder}/table", rows.schema, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return _micros(run_merge(rows, table, f"{folder}/state"), "ts").drop("event_id")


@query("k06_latest_upsert", _LATEST)
def latest_upsert(t):
    columns = ["user_id", "event_type", "value", "ts", "event_id"]
    rows = _stream(t).select(*columns)
    empty = t.events.limit(0).withColumn("ts", F.col("ts").cast("timestamp")).select(*columns)
    out = op.run_upsert(rows, op.work_folder(t.spark, "upsert"), ["user_id"], [F.desc("ts"), F.desc("event_id")], empty)
    return _micros(out, "ts").drop("event_id")


@query("k07_sessions", """
WITH s AS (SELECT *, CASE WHEN lag(ts) OVER o IS NULL OR ts - lag(ts) OVER o >= INTERVAL 2 DAY THEN 1 ELSE 0 END AS opens FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no FROM (SELECT user_id, event_id, ts, value, CASE WHEN row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1 THEN max(opens) OVER (PARTITION BY user_id, ts) ELSE 0 END AS opens FROM s)),
g AS (SELECT user_id, no, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, count(*) AS rows, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM n GROUP BY 1, 2)
SELECT user_id, started, ended, rows, total, ended + 172800000000 <= (SELECT epoch_us(max(ts)) FROM events) - 86400000000 AS closed FROM g""")
def sessions(t):
    """Visits of customers: less than two days between events, a day of tolerance for late ones."""
    day = 86_400_000_000
    rows = _stream(t).select("user_id", "ts", "value")
    table = SessionTable(rows, op.work_folder(t.spark, "sessions"), "user_id", "ts", F.col("value").cast("decimal(12,2)"), 2 * day, day)
    return run_sessions(rows, table).select(
        F.col("key").alias("user_id"), F.col("start").alias("started"), F.col("last").alias("ended"), "rows", F.col("total").cast("double").alias("total"), "closed")
