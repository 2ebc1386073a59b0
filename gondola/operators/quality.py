"""Product quality scores, data profiling metrics and rule reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.operators.kit import joined


def says(df: DataFrame, column: str) -> Column:
    """1 when a field is filled: text that is not blank, 'null' or '[]'; a list with elements; any other
    value that is not null."""
    kind, c = df.schema[column].dataType.typeName(), F.col(column)
    if kind == "array":
        full = c.isNotNull() & (F.size(c) > 0)
    elif kind == "string":
        full = c.isNotNull() & (c != "") & (F.lower(c) != "null") & (F.trim(c) != "[]")
    else:
        full = c.isNotNull()
    return F.when(full, 1).otherwise(0)


def quality_score(
    df: DataFrame, columns: Sequence[str], vocabularies: dict[str, Sequence[str]], segment: Column,
    critical: tuple[Sequence[str], Sequence[str]],
) -> DataFrame:
    """Score, completeness, compliance, tier and offending columns per row, in one projection. A column
    weighs 2 when critical for the row's segment (`critical`: inside, outside), else 1. Columns with a
    vocabulary earn half for being filled and half for holding a vocabulary value."""
    earned, weight, full, good = F.lit(0.0), F.lit(0), F.lit(0), F.lit(0)
    outside, missing = [], []
    for c in columns:
        w = F.when(segment, 2 if c in critical[0] else 1).otherwise(2 if c in critical[1] else 1)
        f = says(df, c)
        full, weight = full + f, weight + w
        if c in vocabularies:
            ok = F.when((f == 1) & F.col(c).isin(list(vocabularies[c])), 1).otherwise(0)
            good, earned = good + ok, earned + w * (f * 0.5 + ok * 0.5)
            outside.append(F.when((f == 1) & (ok == 0), F.lit(c)))
        else:
            earned = earned + w * f
        missing.append(F.when((w == 2) & (f == 0), F.lit(c)))
    n = len(vocabularies)
    out = df.withColumns({
        "quality": F.round(earned / weight * 100, 2), "completeness": F.round(full / len(columns) * 100, 2),
        "compliance": F.round(good / n * 100, 2) if n else F.lit(100.0),
        "filled": full, "compliant": good,
        "outside_vocabulary": joined(F.array_compact(F.array(*outside))) if outside else F.lit(""),
        "missing_critical": joined(F.array_compact(F.array(*missing))),
    })
    q = F.col("quality")
    return out.withColumn(
        "tier", F.when(q >= 80, "excellent").when(q >= 60, "good").when(q >= 40, "fair").otherwise("poor"))


def quality_metrics(
    df: DataFrame, segment: str, unique: Sequence[str], complete: Sequence[str], rules: dict[str, Column]
) -> DataFrame:
    """Long metrics table (segment, entity, instance, metric, value): share of key values that occur once,
    share of non-null values, share of rows that meet a rule. Keys are counted in a shuffle of their own;
    the rest is one aggregation per segment."""
    rows = F.count(F.lit(1))
    parts = [("Completeness", c, F.count(c) / rows) for c in complete] + [
        ("Compliance", name, F.count(F.when(ok, 1)) / rows) for name, ok in rules.items()]
    wide = df.groupBy(segment).agg(*[v.alias(f"m{i}") for i, (_, _, v) in enumerate(parts)])
    unpivoted = wide.select(segment, F.inline(F.array(*[
        F.struct(F.lit(inst).alias("instance"), F.lit(metric).alias("metric"), F.round(f"m{i}", 6).alias("value"))
        for i, (metric, inst, _) in enumerate(parts)])))
    once = df.groupBy(segment, *unique).agg(F.count(F.lit(1)).alias("n")).groupBy(segment).agg(
        F.lit(",".join(unique)).alias("instance"), F.lit("Uniqueness").alias("metric"),
        F.round(F.count(F.when(F.col("n") == 1, 1)) / F.sum("n"), 6).alias("value"))
    return unpivoted.unionByName(once).withColumn("entity", F.lit("column"))


def integrity(df: DataFrame, key: str, violations: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
    """One row: violations per rule, duplicate keys, further counts, and whether all passed. Duplicates come
    from the number of distinct keys."""
    hits = [F.count(F.when(v, 1)).alias(n) for n, v in violations.items()]
    out = df.agg(
        F.count(key).alias("total"), F.countDistinct(key).alias("distinct_keys"), *hits,
        *[F.count(F.when(v, 1)).alias(n) for n, v in counts.items()])
    passed = F.col("total") == F.col("distinct_keys")
    for n in violations:
        passed = passed & (F.col(n) == 0)
    return out.withColumn("duplicates", F.col("total") - F.col("distinct_keys")).withColumn("passed", passed)


def require(result: DataFrame) -> DataFrame:
    """Stops the job when an integrity row did not pass."""
    return result.filter(F.when(F.col("passed"), True).otherwise(F.raise_error(F.lit("integrity check failed")).cast("boolean")))


def rule_violations(df: DataFrame, rules: dict[str, Column], by: str) -> DataFrame:
    """Violating rows per rule and value of `by`."""
    hit = F.explode(F.array_compact(F.array(*[F.when(v, F.lit(n)) for n, v in rules.items()])))
    return df.withColumn("rule", hit).groupBy("rule", by).agg(F.count(F.lit(1)).alias("rows"))


def outside_reference(df: DataFrame, reference: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per row of `df` that the reference also describes: the columns where the reference has a value but
    ours is not among the values the reference uses anywhere."""

    def flat(frame: DataFrame) -> DataFrame:
        return frame.select(key, F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))

    named = flat(reference).filter(F.col("value").isNotNull())
    known = named.select("column", "value").distinct()
    ours = flat(df).join(named.select(key, "column"), [key, "column"], "left_semi")
    bad = ours.filter(F.col("value").isNotNull()).join(known, ["column", "value"], "left_anti")
    lists = bad.groupBy(key).agg(joined(F.collect_list("column"), ", ").alias("invalid_columns"))
    return df.select(key).join(reference.select(key), key, "left").join(lists, key, "left").withColumn(
        "invalid_columns", F.coalesce("invalid_columns", F.lit("")))
