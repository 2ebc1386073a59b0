"""Table contracts, keyed upserts, incremental appends and checkpoints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.operators.kit import joined, latest

BLANK = ["", "[]", "()", "{}"]


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, filled rows, distinct values and both shares. Columns are unpivoted to (column,
    value) and counted, which combines map-side; no wide distinct sets are built."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns]))
    counted = df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))
    says = F.col("value").isNotNull() & ~F.trim("value").isin(BLANK)
    per = counted.groupBy("column").agg(
        F.sum("n").alias("total"), F.sum(F.when(says, F.col("n")).otherwise(0)).alias("completeness"),
        F.count("value").alias("uniqueness"))
    return per.select(
        "*", F.round(F.col("completeness") / F.col("total"), 4).alias("completeness_share"),
        F.round(F.col("uniqueness") / F.col("total"), 4).alias("uniqueness_share"))


def sketch_profile(df: DataFrame, batch: Column, precision: int = 14) -> DataFrame:
    """(column, batch, total, completeness, distinct, quantiles): what to store of a batch so that profiles merge. `distinct` is a HyperLogLog sketch of
    2 ** precision registers, `quantiles` a KLL sketch of the values that are numbers. Sketches are made map-side; no value is shuffled."""
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                 (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in df.columns]))
    says = F.col("value").isNotNull() & ~F.trim("value").isin(BLANK)
    return df.select(batch.alias("batch"), pairs).groupBy("column", "batch").agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(says, 1)).alias("completeness"),
        # by hash: the sketch of texts leaves out the empty one
        F.hll_sketch_agg(F.when(F.col("value").isNotNull(), F.xxhash64("value")), F.lit(precision)).alias("distinct"),
        F.when(F.count("number") > 0, F.kll_sketch_agg_double("number")).alias("quantiles"))


def merged_profile(stored: DataFrame, points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all stored batches: rows, filled rows, about how many distinct values (to 3 % or so), and about the quantiles of numbers. Reads
    sketches only; one list of them per column, as long as there are batches."""
    merge = F.reduce(F.slice("q", 2, F.greatest(F.size("q") - 1, F.lit(0))), F.get("q", F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b))
    return (
        stored.groupBy("column").agg(
            F.sum("total").alias("total"), F.sum("completeness").alias("completeness"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("uniqueness"), F.collect_list("quantiles").alias("q"))
        .withColumn("_k", F.when(F.size("q") > 0, merge))
        .withColumn("quantiles", F.when(F.col("_k").isNotNull(), F.array(*[F.kll_sketch_get_quantile_double("_k", F.lit(float(p))) for p in points])))
        .drop("q", "_k"))


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Differences from the contract: columns added or removed, and over the data, per column of another
    type, values that cannot be cast, and nulls where the contract allows none. One pass over the data."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in contract}
    counts, notes = [], []
    for name in sorted(set(have) | set(want)):
        if name not in want or name not in have:
            issue, count = ("added" if name not in want else "removed"), F.count(F.lit(1))
        elif have[name] != want[name]:
            issue = "type"
            count = F.count(F.when(F.col(name).isNotNull() & F.col(name).try_cast(want[name]).isNull(), 1))
        else:
            issue, count = "", None
        if count is not None:
            notes.append((name, issue, want.get(name), have.get(name)))
            counts.append(count)
        if name in have and name in want and not contract[name].nullable:
            notes.append((name, "null", want[name], have[name]))
            counts.append(F.count(F.when(F.col(name).isNull(), 1)))
    if not notes:
        return df.sparkSession.createDataFrame([], "column string, issue string, wanted string, found string, rows bigint")
    one = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)])
    rows = F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(i).alias("issue"), F.lit(w).cast("string").alias("wanted"),
                 F.lit(f).cast("string").alias("found"), F.col(f"c{k}").alias("rows"))
        for k, (n, i, w, f) in enumerate(notes)])
    return one.select(F.inline(rows)).filter((F.col("rows") > 0) | F.col("issue").isin("added", "removed"))


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns, in its order and types. A value that cannot be cast, or a null in a
    required column, stops the job."""
    out = []
    for f in contract.fields:
        kind = f.dataType.simpleString()
        cast = F.col(f.name).try_cast(f.dataType)
        bad = F.col(f.name).isNotNull() & cast.isNull()
        if not f.nullable:
            bad = bad | F.col(f.name).isNull()
        stop = F.raise_error(F.lit(f"column {f.name} does not hold {kind}")).cast(f.dataType)
        out.append(F.when(bad, stop).otherwise(cast).alias(f.name))
    return df.select(*out)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column],
    update: Sequence[str] | None = None, insert: Sequence[str] | None = None,
) -> DataFrame:
    """The target after a keyed merge: of several source rows per key the first in `order` counts; matched
    rows take the `update` columns of the source (all but the keys by default, nulls included), new keys
    are inserted with the `insert` columns."""
    update = set(update if update is not None else [c for c in target.columns if c not in keys])
    insert = set(insert if insert is not None else target.columns)
    one = latest(source, keys, order)
    new = one.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in one.columns if c not in keys], F.lit(True).alias("_new"))
    both = target.withColumn("_old", F.lit(True)).join(new, list(keys), "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        given = F.col(f"_new_{c}") if c in one.columns else F.lit(None).cast(target.schema[c].dataType)
        on_match = given if c in update and c in one.columns else F.col(c)
        on_insert = given if c in insert else F.lit(None).cast(target.schema[c].dataType)
        out.append(F.when(F.col("_new").isNull(), F.col(c)).when(F.col("_old").isNull(), on_insert).otherwise(on_match).alias(c))
    return both.select(*out)


def regression_gate(new: DataFrame, previous: DataFrame, flags: Sequence[str], ratio: float = 0.5) -> DataFrame:
    """Per flag and side (true / false): rows now and before, and whether at least `ratio` of the previous
    count is still there."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        sides = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).alias("side")) for c in flags])
        flat = df.select(F.inline(sides)).filter(F.col("side").isNotNull())
        return flat.groupBy("flag", "side").agg(F.count(F.lit(1)).alias(name))

    both = counts(previous, "before").join(counts(new, "now"), ["flag", "side"], "full_outer").na.fill(0, ["before", "now"])
    return both.withColumn("passed", F.col("now") >= F.col("before") * ratio)


def incremental(existing: DataFrame, incoming: DataFrame, key: str, day: str, overlap_days: int = 1) -> DataFrame:
    """Rows to append: from `overlap_days` before the newest existing day on, without keys already there. An
    empty table takes everything."""
    since = existing.agg(F.date_sub(F.max(day), overlap_days)).scalar()
    recent = incoming.filter(since.isNull() | (F.col(day) >= since))
    return recent.join(existing.select(key), key, "left_anti")


def only_new(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `new` whose keys are not in `existing`."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def last_success(runs: DataFrame) -> DataFrame:
    """Checkpoint of every job: its last successful run. `runs`: job, run_id, started_at, state."""
    done = latest(runs.filter(F.col("state") == "success"), ["job"], [F.desc("started_at"), F.desc("run_id")])
    return done.select("job", F.col("run_id").alias("last_run"), F.col("started_at").alias("since"))


def keep_stamp(new: DataFrame, old: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """`new` with the old `stamp` wherever no other column changed (null equals null)."""
    compared = [c for c in new.columns if c not in keys and c != stamp and c in old.columns]
    before = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in [*compared, stamp]], F.lit(True).alias("_known"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in compared], F.lit(True))
    out = new.join(before, list(keys), "left").withColumn(
        stamp, F.when(F.col("_known") & same, F.col(f"_old_{stamp}")).otherwise(F.col(stamp)))
    return out.select(*new.columns)


def history_and_latest(
    history: DataFrame, current: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> tuple[DataFrame, DataFrame]:
    """The append-only history and the merged latest table after a batch."""
    return history.unionByName(batch), upsert(current, batch, keys, order)


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the broken rules)."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    marked = df.withColumn("reasons", joined(broken))
    return marked.filter("reasons = ''").drop("reasons"), marked.filter("reasons <> ''")
