"""Readers for the landing formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines that must match the schema; a malformed line stops the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def json_files(spark: SparkSession, path: str, schema: T.StructType | str, glob: str = "*.json") -> DataFrame:
    """One JSON document per file, in any folder below `path`."""
    return (
        spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .option("multiLine", "true").json(path))


def json_pages(spark: SparkSession, path: str, page: str, items: Column, glob: str = "*.json") -> DataFrame:
    """Whole-file JSON pages to one row per item, with the file they came from. `page` is the schema of a
    page, `items` the list inside `page`."""
    text = (
        spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
        .withColumn("file", F.input_file_name()))
    parsed = text.select("file", F.from_json("value", page).alias("page"))
    return parsed.select("file", F.explode(items).alias("item")).select("file", "item.*")


def pipe_csv(spark: SparkSession, path: str, schema: T.StructType | str, encoding: str = "UTF-8") -> DataFrame:
    """Pipe-delimited files with a header; files of a rolling window repeat rows, which count once."""
    return spark.read.schema(schema).option("sep", "|").option("header", "true").option("encoding", encoding).csv(path).dropDuplicates()


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest partition; the scan is pruned to it."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def jdbc(
    spark: SparkSession, url: str, source: str, properties: dict[str, str],
    split: tuple[str, int, int, int] | None = None, fetch: int = 10_000,
) -> DataFrame:
    """A table or (in parentheses, with an alias) a query of an operational database. `split` (column, lower,
    upper, partitions) reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=source, fetchsize=str(fetch), **properties)
    if split:
        column, lower, upper, parts = split
        reader = reader.options(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts))
    return reader.load()
