"""Quality rules over lines that repeat across documents.

Lines are normalised and hashed, distinct documents are counted per host and line, lines over the limit are removed,
and documents of which too little stays are rejected. Texts are read once; what follows works on line hashes only.
Everything is DataFrame expressions.

Defined results: a null text has no line and no word; a null host is a host of its own; null ids are allowed; repeated
rows are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import WORD
from gondola.session import lineage_cut

#: Blanks that separate words, and the characters that count as symbols.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def measures(docs: DataFrame, host: str) -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and `lines`: (hash of the normalised
    line, its words) of every line that has a word."""
    df = docs.select("doc_id", F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("words", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    df = df.withColumn("with_words", F.filter(F.split("text", "\n"), lambda x: F.trim(F.translate(x, BLANKS, " ")) != ""))
    df = df.withColumn("grams", F.expr(
        "if(size(words) < 3, array(), transform(sequence(0, size(words) - 3),"
        " i -> xxhash64(words[i], words[i + 1], words[i + 2])))").cast("array<bigint>"))
    # equal windows become neighbours; texts without a repeated window, most of them, are not sorted
    df = df.withColumn("sorted", F.expr(
        "if(size(array_distinct(grams)) = size(grams), array(),"
        " sort_array(transform(grams, (h, i) -> struct(h as h, i as i))))").cast("array<struct<h:bigint,i:int>>"))
    df = df.withColumn("twice", F.expr(
        "if(size(sorted) = 0, array(), transform(filter(sequence(0, size(sorted) - 1), j ->"
        " (j > 0 and sorted[j].h = sorted[greatest(j - 1, 0)].h) or"
        " (j < size(sorted) - 1 and sorted[j].h = sorted[least(j + 1, size(sorted) - 1)].h)), j -> sorted[j].i))").cast("array<int>"))
    removed = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    return df.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        removed.cast("long").alias("n_symbols"),
        (F.size("with_words") - F.size(F.array_distinct("with_words"))).cast("long").alias("n_dup_lines"),
        F.expr("size(array_distinct(flatten(transform(twice, p -> array(p, p + 1, p + 2)))))").cast("long").alias("n_repeat_words"),
        F.transform("with_words", lambda x: F.struct(
            F.xxhash64(normalised(x)).alias("line"), F.regexp_count(x, F.lit(WORD)).alias("words"))).alias("lines"),
    )


def normalised(line: Column) -> Column:
    """Lower case, one blank between words, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), BLANK_RUN, " "))


def line_rules(
    docs: DataFrame, host: str = "source", share: float = 0.05, at_least: int = 20, limit: int = 200, line_words: int = 3, keep_share: float = 0.3,
    min_words: int = 50, max_repeated: int = 50,
) -> DataFrame:
    """Every document once, with its measures, `n_line_words` (words in removed lines), `base_failed` and `kept`.

    A line is removed when more than `share` of the documents of its host, and more than `at_least`, hold it; lines of `line_words` words or more also
    when more than `limit` documents of the host hold them, however large the host is. A document
    is rejected when it fails the base rules (under `min_words` words, or over `max_repeated` percent of words in
    repeated windows) or when less than `keep_share` of its words stay."""
    rows = lineage_cut(measures(docs, host).withColumn("row", F.monotonically_increasing_id()))
    key = F.coalesce(F.concat(F.lit("="), F.col("host")), F.lit("")).alias("host_key")  # null is a host, too
    hosts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("host_docs"))
    held = rows.select(key, F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    counted = held.groupBy("host_key", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > min(at_least, limit))
    by_share = ((F.col("docs") > at_least) & (F.col("docs") > F.col("host_docs") * share)).alias("by_share")
    common = counted.join(hosts, "host_key").select("host_key", "line", by_share, (F.col("docs") > limit).alias("by_limit")).filter("by_share or by_limit")
    lines = rows.select("row", key, F.explode("lines").alias("x")).select("row", "host_key", F.col("x.line"), F.col("x.words"))
    over = F.col("by_share") | (F.col("words") >= line_words)
    lost = lines.join(common, ["host_key", "line"]).filter(over).groupBy("row").agg(F.sum("words").alias("lost"))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated)
    stays = (F.col("n_words") - F.col("n_line_words")) >= F.col("n_words") * keep_share
    return (
        rows.drop("lines").join(lost, "row", "left")
        .withColumn("n_line_words", F.coalesce("lost", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed).withColumn("kept", ~failed & stays)
        .drop("row", "lost", "host")
    )
