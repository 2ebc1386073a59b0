"""What the text operators share: column choices, row functions over Arrow batches, labelled samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Fixed value: the pattern of one word, for Spark and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as empty text (remainder 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def map_texts(
    df: DataFrame, columns: Sequence[str], schema: str, fn: Callable[[list[str]], dict[str, Sequence]], text: str = "text"
) -> DataFrame:
    """`columns` of `df` unchanged, plus what `fn` makes of each Arrow batch of texts (null: empty). `schema` (DDL) names
    the new columns. No column of `df` other than the chosen ones leaves the scan."""
    kept = [F.col(c) for c in columns]
    chosen = df.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = T.StructType(chosen.drop("__text").schema.fields + T.StructType.fromDDL(schema).fields)
    names = list(columns)
    added = [f.name for f in out.fields[len(names):]]
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            new = fn(batch.column("__text").to_pylist())
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(names))]
            columns += [pa.array(new[a], type=arrow.field(a).type) for a in added]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return chosen.mapInArrow(run, out)


def map_batches(df: DataFrame, schema: str, fn: Callable[[dict[str, list]], dict[str, Sequence]]) -> DataFrame:
    """Rows of `schema` (DDL) that `fn` makes of each Arrow batch of `df`, given and returned as lists by column. For
    sums that shrink a batch before it is shuffled."""
    out = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(batch.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled documents for which `usable` (over doc_id) holds, chosen by
    a hash of the id, so that reruns agree. Only ids, at most `rows`, are broadcast; exact copies of a text with the same label
    count once, so that a large group of copies does not outweigh the rest."""
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & usable)
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id", "label")
        .limit(rows)
    )
    return (
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .dropDuplicates(["text", "label"])
    )
