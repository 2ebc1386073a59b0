"""Incremental jobs as Structured Streaming queries. Every stream writes to the shared checkpoint folder
and runs over what is there now (`availableNow`); a scheduled rerun with the same folder goes on where the
last one ended."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime, time, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.operators.contracts import upsert
from gondola.operators.kit import latest
from gondola.session import checkpoint_folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one stream under the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/streams/{name}-{uuid.uuid4().hex}"


def run_append(stream: DataFrame, folder: str) -> DataFrame:
    """Appends final rows to a parquet table (exactly once) and reads it back."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", f"{folder}/table").option("checkpointLocation", f"{folder}/state").start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")


def run_update(stream: DataFrame, folder: str, keys: Sequence[str]) -> DataFrame:
    """Keeps the rows every batch changed and reads the last state per key. A batch writes to a folder of its
    own, so a batch that is run again after a failure replaces itself."""

    spark = stream.sparkSession
    nothing = spark.createDataFrame([], stream.schema)
    nothing.write.mode("overwrite").parquet(f"{folder}/table/batch=-1")  # a table even before the first batch

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write).outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/state").start())
    query.awaitTermination()
    table = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).option("basePath", f"{folder}/table").parquet(f"{folder}/table")
    return latest(table, keys, [F.desc("batch")]).drop("batch")


def run_upsert(
    stream: DataFrame, folder: str, keys: Sequence[str], order: Sequence[Column], empty: DataFrame, parts: int = 64
) -> DataFrame:
    """Merges every batch into a table of `parts` parts by key hash. Batch n reads the last version below n of the parts it
    touches and writes them as version n, so a batch that runs again after a failure replaces itself and other parts stay
    as they are. What is current is found in the folder, so a rerun without new data returns the same table."""
    spark = stream.sparkSession
    table = f"{folder}/table"
    layout = T.StructType([*empty.schema.fields, T.StructField("_version", T.LongType()), T.StructField("_part", T.IntegerType())])
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
    empty.write.mode("overwrite").parquet(f"{table}/_version=-1/_part=0")  # a table even before the first batch

    def current(below: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Rows of the newest version of each part; at most one folder per part is read."""
        held = spark.read.schema(layout).option("basePath", table).parquet(table).select("_version", "_part").distinct()
        if below is not None:
            held = held.filter(F.col("_version") < below)
        if only is not None:
            held = held.filter(F.col("_part").isin(list(only)))
        newest = held.groupBy("_part").agg(F.max("_version").alias("v")).collect()
        paths = [f"{table}/_version={r['v']}/_part={r['_part']}" for r in newest]
        return spark.read.schema(empty.schema).parquet(*paths) if paths else empty

    def merge(batch: DataFrame, number: int) -> None:
        touched = [r[0] for r in batch.select(part).distinct().collect()]
        merged = upsert(current(number, touched), batch.select(*empty.columns), keys, order)
        merged.withColumn("_part", part).write.mode("overwrite").partitionBy("_part").parquet(f"{table}/_version={number}")

    query = (
        stream.writeStream.foreachBatch(merge).outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{folder}/state").start())
    query.awaitTermination()
    return current()


def deduplicated(stream: DataFrame, key: str, at: str, overlap: str = "1 day") -> DataFrame:
    """Rows of feeds that overlap: a key is taken once within the overlap."""
    return stream.withWatermark(at, overlap).dropDuplicatesWithinWatermark([key])


def tumbling_counts(stream: DataFrame, at: str, width: str, by: Sequence[str], value: str, late: str = "1 day") -> DataFrame:
    """Rows and total of `value` per tumbling window and `by`."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *by, "rows", "total")


def sliding_totals(stream: DataFrame, at: str, width: str, step: str, by: Sequence[str], value: str, late: str = "1 day") -> DataFrame:
    """The same for windows that overlap."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width, step).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total")).select(F.col("w.end").alias("window_end"), *by, "rows", "total")


def capacity_left(stream: DataFrame, at: str, cap: int, width: str = "24 hours", step: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Messages left under the cap for every hour, from the messages of the `width` before it."""
    sent = stream.withWatermark(at, late).groupBy(F.window(at, width, step).alias("w")).agg(F.count(F.lit(1)).alias("sent"))
    return sent.select(F.col("w.end").alias("window_end"), "sent", F.greatest(F.lit(cap) - F.col("sent"), F.lit(0)).alias("left"))


def cool_down(days: int, expires: bool = False) -> Callable:
    """State function for `pay_with_cool_down`: keeps the day of the last payment per account; where it `expires`, until the cool-down is over and
    no earlier row can come."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen: set[date] = set()
        for pdf in batches:  # at most one entry per calendar day is kept
            seen.update(pdf["day"])
        last = date.fromordinal(state.get[0]) if state.exists else None
        paid = []
        for day in sorted(seen):
            if last is None or day >= last + timedelta(days=days):
                paid.append(day)
                last = day
        if paid:
            state.update((last.toordinal(),))
        if expires and last is not None:
            # a timer has to lie behind the watermark: the state of an account that could be paid again anyway goes with the next one
            over = int(datetime.combine(last + timedelta(days=days), time(), timezone.utc).timestamp() * 1000)
            state.setTimeoutTimestamp(max(over, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"account": [key[0]] * len(paid), "paid_on": paid})

    return step


def pay_with_cool_down(stream: DataFrame, account: str, day: str, days: int = 7, at: str | None = None, late: str = "1 day") -> DataFrame:
    """(account, paid_on): the first qualifying day of an account and every later one at least `days` after
    the last payment. Days up to the last payment that arrive late change nothing. With `at`, the UTC time of an event (`day` is its date), rows that are
    more than `late` behind are left out, and the state of an account goes when the watermark is past its cool-down; without, it stays."""
    schema = f"account {stream.schema[account].dataType.simpleString()}, paid_on date"
    if at is None:
        return stream.select(F.col(account).alias("account"), F.col(day).alias("day")).groupBy("account").applyInPandasWithState(
            cool_down(days), schema, "last int", "append", "NoTimeout")
    timed = stream.select(F.col(account).alias("account"), F.col(day).alias("day"), F.col(at).alias("at")).withWatermark("at", late)
    return timed.groupBy("account").applyInPandasWithState(cool_down(days, True), schema, "last int", "append", "EventTimeTimeout")
