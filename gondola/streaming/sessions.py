"""Sessions of keys on a stream, with rows that come too late set aside.

A session of a key is a run of rows of which each lies less than `gap` after one before it. Batches merge with the sessions that are still
open: a session is closed for good when the watermark (the latest time seen, less `late`) has passed its last row by the gap, because every row
that is still taken is newer than that. What is kept between batches is the open sessions alone. Rows behind the watermark of the
batches before theirs go to a table of their own; nothing is dropped.

Rows of a key that share a slot of `gap` width always share a session, so they are summed before the shuffle, and what a task sorts for one
key is at most one row per slot of the calendar, however many rows the key has. Every batch writes folders of its own number, so
a batch that is run again after a failure replaces itself.

Defined results: rows without a time are late (they have no place in a session); a null key is a key; a null value counts as 0;
repeated rows count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged_sessions(parts: DataFrame, gap: int) -> DataFrame:
    """(key, start, last, rows, total) of whole sessions from parts of the same columns; times and `gap` in microseconds."""
    order = Window.partitionBy("key").orderBy("start", "last", "rows", "total")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") - before >= gap), 1).otherwise(0)
    numbered = parts.withColumn("_opens", opens).withColumn(
        "_no", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("key", "_no").agg(
        F.min("start").alias("start"), F.max("last").alias("last"), F.sum("rows").alias("rows"), F.sum("total").alias("total")).drop("_no").select(
        "key", "start", "last", "rows", F.col("total").cast(parts.schema["total"].dataType).alias("total"))


def slots(rows: DataFrame, key: str, at: str, value: Column, gap: int) -> DataFrame:
    """Rows with a time, summed per key and slot of `gap` width; parts for `merged_sessions`."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    plain = rows.filter(F.col(at).isNotNull()).select(F.col(key).alias("key"), micros.alias("at"), F.coalesce(value, F.lit(0)).alias("value"))
    return plain.groupBy("key", F.floor(F.col("at") / F.lit(gap)).alias("_slot")).agg(
        F.min("at").alias("start"), F.max("at").alias("last"), F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total")).drop("_slot")


class SessionTable:
    """Sessions below `folder`: `closed` and `open` ones and `late` rows by batch, and a `mark` (the latest time seen) per batch."""

    def __init__(self, stream: DataFrame, folder: str, key: str, at: str, value: Column, gap: int, late: int):
        self.spark, self.folder, self.key, self.at, self.value, self.gap, self.late = stream.sparkSession, folder, key, at, value, gap, late
        self.rows = stream.schema
        self.total = T.DecimalType(38, 2)
        key_type = stream.schema[key].dataType
        self.sessions = T.StructType([
            T.StructField("key", key_type), T.StructField("start", T.LongType()), T.StructField("last", T.LongType()),
            T.StructField("rows", T.LongType()), T.StructField("total", self.total)])
        self.marks = T.StructType([T.StructField("mark", T.LongType())])
        for name, schema in (("closed", self.sessions), ("open", self.sessions), ("late", self.rows), ("mark", self.marks)):
            # a table even before the first batch
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/{name}/batch=-1")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.folder}/{name}"
        layout = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(layout).option("basePath", path).parquet(path)

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch}")

    def merge(self, batch: DataFrame, number: int) -> None:
        micros = F.unix_micros(F.col(self.at).cast("timestamp"))
        before = self._read("mark", self.marks).filter(F.col("batch") < number).agg(F.max("mark")).first()[0]
        is_late = F.col(self.at).isNull() if before is None else F.col(self.at).isNull() | (micros < before - self.late)
        self._write(batch.filter(is_late), "late", number)
        # a batch without any time keeps the mark
        self._write(batch.agg(F.max(micros).alias("mark")).select(F.greatest("mark", F.lit(before).cast("long")).alias("mark")), "mark", number)
        mark = self.spark.read.schema(self.marks).parquet(f"{self.folder}/mark/batch={number}").first()[0]
        new = slots(batch.filter(~is_late), self.key, self.at, self.value, self.gap).withColumn("total", F.col("total").cast(self.total))
        merged = merged_sessions(self.open(number).unionByName(new), self.gap)
        over = F.lit(False) if mark is None else F.col("last") + self.gap <= mark - self.late
        path = f"{self.folder}/merged/batch={number}"
        # written once, so that closed and open sessions are of one reading
        merged.withColumn("over", over).write.mode("overwrite").partitionBy("over").parquet(path)
        again = self.spark.read.schema(T.StructType([*self.sessions.fields, T.StructField("over", T.BooleanType())])).parquet(path)
        self._write(again.filter("over").drop("over"), "closed", number)
        self._write(again.filter("not over").drop("over"), "open", number)

    def open(self, below: int) -> DataFrame:
        """Sessions that were open after the last batch before `below`."""
        held = self._read("mark", self.marks).filter(F.col("batch") < below).agg(F.max("batch")).first()[0]
        return self.spark.read.schema(self.sessions).parquet(f"{self.folder}/open/batch={-1 if held is None else held}")

    def closed(self) -> DataFrame:
        return self._read("closed", self.sessions).drop("batch")

    def late_rows(self) -> DataFrame:
        return self._read("late", self.rows).drop("batch")

    def current(self) -> DataFrame:
        """All sessions as of now, `closed` or not."""
        return self.closed().withColumn("closed", F.lit(True)).unionByName(self.open(2**62).withColumn("closed", F.lit(False)))


def run_sessions(stream: DataFrame, table: SessionTable) -> DataFrame:
    """Takes in what the stream holds now and returns the sessions; a rerun with the same folder goes on where the last one ended."""
    query = (
        stream.writeStream.foreachBatch(table.merge).outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{table.folder}/state").start())
    query.awaitTermination()
    return table.current()
