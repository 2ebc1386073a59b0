"""Named queries over a folder of tables, each with (where SQL can say it) an equivalent statement."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def line_rows(self) -> int:
        """Number of sale lines, from the footers of the files."""
        return self.lineitem.count()

    region = cached_property(lambda self: self.read("region"))
    nation = cached_property(lambda self: self.read("nation"))
    customer = cached_property(lambda self: self.read("customer"))
    supplier = cached_property(lambda self: self.read("supplier"))
    part = cached_property(lambda self: self.read("part"))
    orders = cached_property(lambda self: self.read("orders"))
    lineitem = cached_property(lambda self: self.read("lineitem"))
    events = cached_property(lambda self: self.read("events"))
    documents = cached_property(lambda self: self.read("documents"))
    embeddings = cached_property(lambda self: self.read("embeddings"))
    pages = cached_property(lambda self: self.read("pages"))
    benchmark = cached_property(lambda self: self.read("benchmark"))
    labels = cached_property(lambda self: self.read("labels"))
    conversations = cached_property(lambda self: self.read("conversations"))


def query(key: str, sql: str | None = None):
    """Registers `fn(tables) -> DataFrame` under `key`."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[key] = sql
        return fn

    return register
