"""From raw documents to a training mix, in five stages: quality, near copies, benchmark leaks, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before it kept. All but the last return the
columns of `documents` (whatever they are; only doc_id, text, source and n_chars are looked at). `run` writes each result
as Parquet in the shared checkpoint folder and reads it again for the next stage.

Defined results: null texts count as empty, rows with null ids or sources pass through like others, of repeated rows one
stays (near copies), empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import leaks, private, quality
from gondola.llm.mixing import mix
from gondola.llm.simhash import one_of_each
from gondola.session import lineage_cut

#: Documents scoring less are rejected.
QUALITY = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the documents at hand."""
    score = quality.scorer(quality.train(docs, _table(spark, sf_dir, "labels")))
    return docs.filter(score(F.col("text")) >= QUALITY)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: that with the smallest id."""
    return one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return docs.filter(~leaks.leaked(_table(spark, sf_dir, "benchmark"), F.col("text")))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and the length of the text brought up to date."""
    out = private.hidden(docs, private.learn(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_each),
    ("leaks", keep_clean),
    ("private", hide_personal_data),
    ("mix", mix_sources),
]

#: A trained classifier, connected components and learned patterns cannot be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = lineage_cut(docs)
    return docs
