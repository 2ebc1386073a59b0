"""The registered queries of the text operators: thin, over whole tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.llm import language_model, leaks, licences, manifest, private, quality, resampling, sql, token_files, toxicity
from gondola.llm.line_rules import line_rules
from gondola.llm.mixing import mix
from gondola.llm.repeats import without_repeats
from gondola.llm.simhash import hex_digits, near_copies
from gondola.session import table_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(key: str, statement: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if statement:
            ORACLES[key] = statement
        return fn

    return register


@query("op1_simhash")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", hex_digits(found["fp"]).alias("fingerprint"), "component_id")


@query("op2_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_mix_sources", sql.MIX)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


@query("op4_private")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return private.found(docs, private.learn(docs))


@query("op5_repeats")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"), bodies=False)


@query("op6_leaks", sql.LEAKS)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_licences", sql.licences(licences.TEMPLATES))
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


@query("op8_line_rules", sql.LINE_RULES)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules(table(spark, folder, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_language_model")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scored(table(spark, folder, "documents"))


@query("op11_resampling", sql.RESAMPLING)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_token_files")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(
        table(spark, folder, "documents"), f"{table_folder(spark)}/{uuid.uuid4().hex}", public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op13_manifest", sql.manifest())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.proofs(table(spark, folder, "documents"))
