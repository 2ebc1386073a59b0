"""A keyed table that streams merge into without rewriting it.

A batch appends one delta: its last row per key. Readers merge the base with the deltas that are not folded into it; of a key the row of the latest batch counts.
Compaction runs between batches. Many small deltas become one; once the deltas hold `ratio` times the bytes of the base, all is rewritten as a new base, whose number of
files follows its size. So a batch writes in proportion to itself, and the rewriting, spread over the batches in between, is a constant factor of what came in.

    <folder>/base/<n>       all batches up to n
    <folder>/delta/<a>-<n>  the batches from a to n

What counts is found in the folder: of bases the latest that was written whole, of deltas those behind it that no longer one covers. A batch that runs again after a
failure writes its delta anew, or nothing where it was folded in already. The base and the deltas before the last two compactions are dropped, so a reader has until then."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.operators.kit import latest


@dataclass
class MergeTable:
    """A table of `schema` with unique `keys`; `order` chooses among rows of one key in one batch."""

    spark: SparkSession
    folder: str
    schema: T.StructType
    keys: Sequence[str]
    order: Sequence[Column]
    ratio: float = 0.5
    part_bytes: int = 128 << 20
    most_deltas: int = 16

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self, name: str):
        path = self._path(name)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _whole(self, kind: str) -> list[str]:
        """Names of what was written to the end."""
        fs, path = self._files(kind)
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return [n for n in names if fs.exists(self._path(f"{kind}/{n}/_SUCCESS"))]

    def _bytes(self, *names: str) -> int:
        out = 0
        for name in names:
            fs, path = self._files(name)
            out += fs.getContentSummary(path).getLength()
        return out

    def base(self) -> int | None:
        """The last batch that the base holds."""
        return max(map(int, self._whole("base")), default=None)

    def deltas(self) -> list[tuple[int, int]]:
        """The deltas behind the base, in order, without those that a longer one covers."""
        base = self.base()
        found = sorted((tuple(map(int, n.split("-"))) for n in self._whole("delta")), key=lambda d: (d[0], -d[1]))
        out: list[tuple[int, int]] = []
        for first, last in found:
            if (base is None or last > base) and (not out or last > out[-1][1]):
                out.append((first, last))
        return out

    def _merged(self, base: int | None, deltas: Sequence[tuple[int, int]]) -> DataFrame:
        """The latest row per key, with its batch."""
        layout = T.StructType([*self.schema.fields, T.StructField("_batch", T.LongType())])
        paths = [f"{self.folder}/delta/{a}-{n}" for a, n in deltas]
        if base is not None:
            paths.append(f"{self.folder}/base/{base}")
        if not paths:
            return self.spark.createDataFrame([], layout)
        rows = self.spark.read.schema(layout).parquet(*paths)
        # a base alone has one row per key
        return rows if base is not None and not deltas else latest(rows, self.keys, [F.desc("_batch")])

    def read(self) -> DataFrame:
        return self._merged(self.base(), self.deltas()).drop("_batch")

    def append(self, batch: DataFrame, number: int) -> None:
        """Adds a batch, unless it was folded in before."""
        base = self.base()
        if (base is not None and number <= base) or any(a < n and a <= number <= n for a, n in self.deltas()):
            return
        rows = latest(batch.select(*self.schema.fieldNames()), self.keys, self.order).withColumn("_batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.folder}/delta/{number}-{number}")

    def compact(self) -> str:
        """Folds deltas together, or into a new base, where it is due; tells which (`delta`, `base` or nothing)."""
        base, deltas = self.base(), self.deltas()
        if not deltas:
            return ""
        held = self._bytes(*[f"delta/{a}-{n}" for a, n in deltas])
        whole = self._bytes(f"base/{base}") if base is not None else 0
        last = deltas[-1][1]
        if held >= self.ratio * whole:
            rows = self._merged(base, deltas).repartition(max(1, math.ceil((held + whole) / self.part_bytes)), *self.keys)
            rows.write.mode("overwrite").parquet(f"{self.folder}/base/{last}")
            if base is not None:
                self._drop([f"base/{n}" for n in self._whole("base") if int(n) < base])
                self._drop([f"delta/{n}" for n in self._whole("delta") if int(n.split("-")[1]) <= base])
            return "base"
        if len(deltas) >= self.most_deltas:
            covered = [n for n in self._whole("delta") if tuple(map(int, n.split("-"))) not in deltas]
            parts = max(1, math.ceil(held / self.part_bytes))
            self._merged(None, deltas).repartition(parts, *self.keys).write.mode("overwrite").parquet(
                f"{self.folder}/delta/{deltas[0][0]}-{last}")
            self._drop([f"delta/{n}" for n in covered])
            return "delta"
        return ""

    def _drop(self, names: Sequence[str]) -> None:
        for name in names:
            fs, path = self._files(name)
            fs.delete(path, True)


def run_merge(stream: DataFrame, table: MergeTable, state: str) -> DataFrame:
    """Merges every batch of a stream into `table`, and reads it; `state` is the stream's own folder."""

    def write(batch: DataFrame, number: int) -> None:
        table.append(batch, number)
        table.compact()

    query = (
        stream.writeStream.foreachBatch(write).outputMode("append").trigger(availableNow=True).option("checkpointLocation", state).start())
    query.awaitTermination()
    return table.read()
