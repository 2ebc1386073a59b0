"""Question-answer pairs and fine-tuning datasets from chat payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.kit import latest

MESSAGES = "struct<messages:array<struct<content:string,role:string>>>"
ANSWERS = "array<struct<answer:string>>"

# Requests that are no questions of users, and the answer given when nothing was found.
SYSTEM_REQUEST = "VANNA"
DEFAULT_ANSWER = "Sou uma atendente virtual"


def question_answers(
    payloads: DataFrame, denied_request: str = SYSTEM_REQUEST, denied_response: str = DEFAULT_ANSWER
) -> DataFrame:
    """Last user question of every successful request with each of its answers. `payloads`: request_id,
    chat_date, status_code, request, response (JSON texts)."""
    asked = F.filter(F.from_json("request", MESSAGES)["messages"], lambda m: m["role"] == "user")
    ok = (F.col("status_code") == 200) & ~F.contains("response", F.lit(denied_response)) & ~F.contains("request", F.lit(denied_request))
    return (
        payloads.filter(ok)
        .withColumn("_asked", asked).filter(F.size("_asked") > 0)
        .select("request_id", "chat_date", F.element_at("_asked", -1)["content"].alias("question"),
                F.explode(F.from_json("response", ANSWERS)).alias("_a"))
        .select("request_id", "chat_date", "question", F.col("_a.answer").alias("answer"))
    )


def fresh_questions(pairs: DataFrame, rejected: DataFrame, since: Column) -> DataFrame:
    """The last answer of every question, without answers users rejected, newer than the last run.
    `pairs`: request_id, chat_date, question, answer; `rejected`: answer."""
    one = latest(pairs, ["question"], [F.desc("chat_date"), F.desc("request_id"), F.col("answer")])
    bad = rejected.select(F.md5("answer").alias("_k")).distinct()
    kept = one.withColumn("_k", F.md5("answer")).join(bad, "_k", "left_anti").drop("_k")
    return kept.filter(since.isNull() | (F.col("chat_date") > since))


def tuning_lines(payloads: DataFrame) -> DataFrame:
    """(request_id, line): one JSON line per conversation that alternates between user and model, in the
    shape {"contents":[{"role":..,"parts":[{"text":..}]}]}. The assistant is called model, system messages
    are dropped, the answer is appended; conversations with two messages in a row of one role are left
    out."""
    base = payloads.select(
        "request_id", F.from_json("request", MESSAGES)["messages"].alias("_m"),
        F.element_at(F.from_json("response", ANSWERS), 1)["answer"].alias("_answer"))
    talk = F.transform(
        F.filter("_m", lambda m: m["role"] != "system"),
        lambda m: F.struct(F.when(m["role"] == "assistant", "model").otherwise(m["role"]).alias("role"), m["content"].alias("text")))
    whole = F.concat(F.col("_talk"), F.array(F.struct(F.lit("model").alias("role"), F.col("_answer").alias("text"))))
    out = base.filter(F.trim("_answer") != "").withColumn("_talk", talk).filter(F.size("_talk") > 0).withColumn("_whole", whole)
    roles = F.transform("_whole", lambda m: m["role"])
    repeated = F.exists(
        F.zip_with(F.slice(roles, F.lit(1), F.size(roles) - 1), F.slice(roles, F.lit(2), F.size(roles) - 1),
                   lambda a, b: a == b), lambda same: same)
    contents = F.transform("_whole", lambda m: F.struct(
        m["role"].alias("role"), F.array(F.struct(m["text"].alias("text"))).alias("parts")))
    return out.filter(~repeated).select("request_id", F.to_json(F.struct(contents.alias("contents"))).alias("line"))


def split_holdout(lines: DataFrame, key: str, size: int, seed: str) -> DataFrame:
    """Adds `part`: `size` rows with the smallest seeded hash are validation, the rest training."""
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    held = lines.select(key).orderBy(order, F.col(key)).limit(size).withColumn("_held", F.lit(True))
    return lines.join(held, key, "left").withColumn(
        "part", F.when(F.col("_held"), "validation").otherwise("training")).drop("_held")


def topics(pairs: DataFrame, default_answer: str) -> DataFrame:
    """Topic tag before '> ' in the question, and whether the answer is the default one."""
    tag = F.when(F.contains("question", F.lit("> ")), F.trim(F.substring_index("question", ">", 1))).otherwise("no_tag")
    return pairs.withColumn("topic", tag).withColumn("is_default", F.contains(F.lower("answer"), F.lit(default_answer.lower())))


def merge_payloads(stored: DataFrame, files: DataFrame, content: Sequence[str]) -> DataFrame:
    """Stored payloads plus those of the files that are new by content (null equals null)."""
    key = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in content]))
    new = files.withColumn("_k", key).dropDuplicates(["_k"])
    return stored.unionByName(new.join(stored.select(key.alias("_k")), "_k", "left_anti").drop("_k").select(*stored.columns))

