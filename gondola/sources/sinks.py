"""Writers: tables, partitions, JSON, database batches, rows for a vector store."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_table(df: DataFrame, name: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str, mode: str = "overwrite") -> None:
    """A catalog table of which every task reads one bucket of `keys`, sorted by them, so that tables of as many buckets join and group by these keys
    without a shuffle. Files lie in `path`."""
    keys = list(keys)
    # a file per bucket: rows are brought to where their bucket is written
    spread = df.repartition(buckets, *keys)
    spread.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)


def save_partitions(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append") -> None:
    """Append to, or replace only the touched partitions of, a partitioned folder. Rows are spread by their
    partition columns and a hash, so a large partition is written by several tasks."""
    spread = df.repartition(*[F.col(c) for c in partition_by], F.pmod(F.xxhash64(*df.columns), F.lit(8)))
    spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def save_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], update: Sequence[str] | None = None) -> str:
    """INSERT ... ON CONFLICT DO UPDATE; by default all columns but the keys, id and created are updated."""
    changed = list(update) if update is not None else [c for c in columns if c not in {*keys, "id", "created"}]
    action = "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in changed) if changed else "DO NOTHING"
    marks = ", ".join(["%s"] * len(columns))
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({marks}) ON CONFLICT ({', '.join(keys)}) {action}"


def insert_statement(table: str, columns: Sequence[str]) -> str:
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join(['%s'] * len(columns))})"


def write_batches(df: DataFrame, connect: Callable, statement: str, size: int = 1000) -> None:
    """Sends rows in batches, every task over a connection of its own. `connect` returns a DB-API
    connection; with an upsert statement a repeated task changes nothing."""

    def send(rows: Iterator) -> None:
        connection = connect()
        try:
            cursor = connection.cursor()
            it = iter(rows)
            while batch := [tuple(r) for r in islice(it, size)]:
                cursor.executemany(statement, batch)
                connection.commit()
        finally:
            connection.close()

    df.foreachPartition(send)


def vector_rows(
    df: DataFrame, filters: Sequence[str], flags: dict[str, str], key: str, text_limits: dict[str, int] | None = None,
    row_limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows ready for a vector store, keys of rows too large for it): filter columns trimmed and lower case, flags that are true
    only when the source is false (null is not). What the store cannot hold is an explicit contract of its caller: `text_limits`
    cuts the named columns (the key "" stands for all other texts), `row_limit` sets rows aside whose JSON without the uncut
    text columns is longer. Without them nothing is cut or set aside."""
    limits = text_limits or {}
    out: list[Column] = []
    uncut = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType) and f.name in filters:
            c = F.transform(c, lambda x: F.lower(F.trim(x)))
        elif isinstance(f.dataType, T.StringType):
            c = F.lower(F.trim(c)) if f.name in filters else c
            limit = limits.get(f.name, limits.get(""))
            if limit:
                c = F.substring(c, 1, limit)
            elif limits:
                uncut.append(f.name)
        out.append(c.alias(f.name))
    rows = df.select(*out).withColumns({n: F.coalesce(~F.col(source), F.lit(False)) for n, source in flags.items()})
    if row_limit is None:
        return rows, rows.filter(F.lit(False)).select(key)
    small = F.length(F.to_json(F.struct(*[c for c in rows.columns if c not in uncut]))) <= row_limit
    return rows.filter(small), rows.filter(~small).select(key)


def guarded_updates(updates: DataFrame, existing: DataFrame, key: str, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(updates to send, a report): updates of keys the target has and that meet all rules; the report counts
    sent, unknown and broken updates."""
    known = existing.select(key).distinct().withColumn("_known", F.lit(True))
    ok = F.lit(True)
    for rule in rules.values():
        ok = ok & F.coalesce(rule, F.lit(False))
    marked = updates.join(known, key, "left").withColumn(
        "_state", F.when(F.col("_known").isNull(), "unknown").when(ok, "sent").otherwise("broken"))
    return marked.filter("_state = 'sent'").drop("_known", "_state"), marked.groupBy(F.col("_state").alias("state")).agg(
        F.count(F.lit(1)).alias("updates"))
