"""Building blocks shared by the operators, each safe for a key that holds a large part of
all rows.

* `latest` / `top_n`: `row_number() <= constant` windows. Spark plans a group limit before the
  shuffle, so each map task sends at most that many rows per key.
* `order_positions`: exact position and running total inside groups of any size, from a range
  partitioning and per-slice offsets; no group is ever sorted in one task.
* `rows_at`: the rows at shares of a group of any size, without placing all others.
* `exact_percentiles`: order statistics on counted distinct values, built on `order_positions`.
* `spread_join`: many-to-many equi-join whose heavy partitions adaptive execution splits on both sides; neither side is
  broadcast, since the size of rows that were exploded is estimated as that of the rows before.
* `product_join`: every row of a key with every other, by blocks, with tasks by the rows of the result.
* `hashed_side`: the smaller side of a join with many rows, held as a hash table so that those need no sort.
* `co_occurrence`: pair counts inside baskets; a wide basket is split into blocks of items.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.session import MOST_TASKS, forget, lineage_cut, tasks_for


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on `keys` in which null matches null; the keys of the left side are kept."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_right_{k}")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """First `n` rows of every key in a total order."""
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.filter(F.col("_rn") <= n)
    return kept.withColumnRenamed("_rn", rank) if rank else kept.drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in a total order."""
    return top_n(df, keys, order, 1)


def order_positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    total: str | None = None,
) -> DataFrame:
    """Adds `position` (1-based), `group_rows` and, when `total` names a numeric column, `running`
    (inclusive running sum) and `group_total`. `order` must be a total order inside a group.

    Rows are range-partitioned on (group, order), which splits a large group over many slices. The
    slice number is written down with the rows (checkpoint) because it is read twice: once to sort
    inside a slice and once to sum up the slices before it."""
    sliced = lineage_cut(
        df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_slice", F.spark_partition_id())
    )
    inside = Window.partitionBy(*group, "_slice").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = sliced.withColumn("_at", F.row_number().over(inside))
    sums = [F.count(F.lit(1)).alias("_rows")]
    if total:
        rows = rows.withColumn("_sum", F.sum(total).over(so_far))
        sums.append(F.sum(total).alias("_total"))
    # one row per slice and group: slices + groups rows at most
    slices = sliced.groupBy(*group, "_slice").agg(*sums)
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = slices.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).withColumn(
        "group_rows", F.sum("_rows").over(whole)
    )
    if total:
        offsets = offsets.withColumn("_total_before", F.sum("_total").over(earlier)).withColumn(
            "group_total", F.sum("_total").over(whole)
        )
    joined = null_safe_join(rows, offsets.drop("_rows", "_total"), [*group, "_slice"])
    out = joined.withColumn("position", F.col("_at") + F.col("_before"))
    if total:
        out = out.withColumn("running", F.when(F.col("_total_before").isNull(), F.col("_sum")).otherwise(
            F.coalesce(F.col("_sum"), F.lit(0)) + F.col("_total_before")))
    return out.drop("_slice", "_at", "_before", "_sum", "_total_before")


def rows_at(df: DataFrame, group: Sequence[str], order: Sequence[Column], shares: dict[str, float]) -> DataFrame:
    """One row per group, as a table: for each of `shares` the row (a struct of the other columns) at place ceil(share * rows of the group), or the last one
    if there are fewer; null for place 0. `order` must be a total order inside a group.

    Rows are range-partitioned and sorted as in `order_positions`, and numbered where they are; from one row per slice and group follow the numbers of
    the rows asked for, so no row is shuffled to be placed."""
    rest = [c for c in df.columns if c not in group]
    ordered = [*[F.col(g) for g in group], *order]
    sliced = lineage_cut(df.repartitionByRange(*ordered).sortWithinPartitions(*ordered).withColumn("_at", F.monotonically_increasing_id()))
    # one row per slice and group: slices + groups rows at most
    slices = sliced.groupBy(*group, F.shiftright("_at", 33).alias("_slice")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).withColumn("_n", F.sum("_rows").over(Window.partitionBy(*group)))
    places = F.array(*[F.struct(F.lit(name).alias("_name"), F.least(F.ceil(F.col("_n") * share), F.col("_n")).alias("_place")) for name, share in shares.items()])
    wanted = offsets.select("_first", "_before", "_rows", F.inline(places)).filter(
        (F.col("_place") > F.col("_before")) & (F.col("_place") <= F.col("_before") + F.col("_rows")))
    wanted = wanted.select("_name", (F.col("_first") + F.col("_place") - F.col("_before") - 1).alias("_at"))
    own = F.struct(*rest)
    found = lineage_cut(sliced.join(wanted, "_at").groupBy(*group).agg(*[F.max(F.when(F.col("_name") == name, own)).alias(name) for name in shares]))
    forget(sliced)
    return found


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, points: dict[str, float]
) -> DataFrame:
    """Linear-interpolated percentiles per group (one row per group; one row in all when `group` is
    empty). Equal values are counted first, so a value shared by most rows is one row here."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = order_positions(counted, group, [F.col(value)], total="_n")
    first, last = F.col("running") - F.col("_n"), F.col("running") - 1
    out, names = [], []
    for name, p in points.items():
        spot = F.lit(float(p)) * (F.col("group_total") - 1)
        for tag, at in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            out.append(F.max(F.when((first <= at) & (at <= last), F.col(value))).alias(f"_{tag}_{name}"))
        out.append(F.max(spot - F.floor(spot)).alias(f"_part_{name}"))
        names.append(name)
    wide = placed.groupBy(*group).agg(*out)
    return wide.select(
        *group,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in names
        ],
    )


def column_percentiles(df: DataFrame, columns: Sequence[str], points: dict[str, float]) -> dict[str, dict[str, float]]:
    """Exact percentiles of several numeric columns, found in one pass; one row per column comes back."""
    flat = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])))
    rows = exact_percentiles(flat, ["column"], "value", points).collect()
    return {r["column"]: {p: r[p] for p in points} for r in rows}


def spread_join(many: DataFrame, few: DataFrame, on: str) -> DataFrame:
    """Inner many-to-many join on `on`, in which keys may be heavy on either side or both. Both sides are read once and shuffled
    once; adaptive execution then splits a partition that came out too large on either side and pairs the
    splits (`spark.sql.adaptive.skewJoin.enabled`, which has to stay on). Rows with a null key meet nothing."""
    return many.filter(F.col(on).isNotNull()).hint("merge").join(few.filter(F.col(on).isNotNull()).hint("merge"), on)


#: Rows of a product of groups that a task lists.
TASK_PAIRS = 5_000_000


def product_join(left: DataFrame, right: DataFrame, key: str, dealt_by: Sequence[str], block: int = 5000) -> DataFrame:
    """Inner join on `key` whose result is large though its sides are small, as all rows of a key meet. The right rows of a key are dealt into blocks of
    about `block` by a hash of `dealt_by`, and its left rows meet them all, so a task holds a block at a time; and there are as many tasks as list TASK_PAIRS rows
    each, which adaptive execution would merge by the few bytes that they read."""
    sizes = right.groupBy(key).agg(F.count(F.lit(1)).alias("_right")).join(left.groupBy(key).agg(F.count(F.lit(1)).alias("_left")), key)
    # one number
    tasks = math.ceil((sizes.agg(F.sum(F.col("_left").cast("double") * F.col("_right"))).first()[0] or 0) / TASK_PAIRS)
    blocks = right.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    a = left.join(blocks, key).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    b = right.join(blocks, key).withColumn("_block", F.pmod(F.xxhash64(*dealt_by), F.col("_blocks")).cast("int")).drop("_blocks")
    if tasks > 1:
        tasks = max(min(MOST_TASKS, tasks), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        a, b = (x.repartition(tasks, key, "_block") for x in (a, b))
    return a.hint("merge").join(b.hint("merge"), [key, "_block"]).drop("_block")


def hashed_side(few: DataFrame, rows: int | None) -> DataFrame:
    """`few` as the side of a join with about `rows` rows: where these need more tasks than the session has, each task holds its part of `few` as a hash
    table and the many rows stream past it, unsorted; adaptive execution still splits heavy keys of theirs. Else the planner chooses."""
    return few.hint("shuffle_hash") if tasks_for(few.sparkSession, rows) else few


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The same rows dealt over the tasks of a shuffle: a small file of many rows is one or two tasks otherwise, however much work a row takes."""
    return df.repartition(F.xxhash64(key))


def co_occurrence(lines: DataFrame, basket: str, item: str, least: int = 1, block: int = 200) -> DataFrame:
    """(item_a < item_b, together): number of baskets that hold both, for every pair in at least `least` baskets. `lines` is
    distinct on (basket, item).

    Items in fewer baskets than `least` cannot be in such a pair and are dropped first. The items of a basket are dealt into
    blocks of about `block` by hash, and pairs are listed per pair of blocks, so no task lists more than block * block
    pairs of one key, however wide the basket. The result does not depend on `block`."""
    if least > 1:
        often = lines.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least)
        lines = lines.join(often, item, "left_semi")
    wide = lines.groupBy(basket).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    dealt = (
        lines.join(wide, basket).withColumn("_own", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int"))
        .withColumn("_met", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(basket, "_own", F.col(item).alias("_item"), F.least("_own", "_met").alias("_low"), F.greatest("_own", "_met").alias("_high"))
    )
    left = dealt.filter("_own = _low").select(basket, "_low", "_high", F.col("_item").alias("_a"))
    right = dealt.filter("_own = _high").select(basket, "_low", "_high", F.col("_item").alias("_b"))
    pairs = left.join(right, [basket, "_low", "_high"]).filter((F.col("_low") < F.col("_high")) | (F.col("_a") < F.col("_b")))
    counted = pairs.groupBy(F.least("_a", "_b").alias("item_a"), F.greatest("_a", "_b").alias("item_b")).agg(
        F.count(F.lit(1)).alias("together"))
    return counted.filter(F.col("together") >= least) if least > 1 else counted


def contains_join(
    texts: DataFrame, key: str, text: str, terms: DataFrame, term: str, gram: int = 3, sent: int = 1 << 22
) -> DataFrame:
    """(key, term) for every term that occurs inside a text, as `text LIKE '%term%'` would say. Instead
    of comparing every text with every term, both sides meet on a short character sequence: a term by
    its first `gram` characters, a text by each such sequence it holds; hits are then verified.

    Distinct terms of up to `sent` bytes in all are sent to the texts, which stay where they are; more terms and the
    sequences of the texts are shuffled. The texts and their sequences are never broadcast."""
    anchors = (
        terms.select(F.col(term)).filter(F.length(term) > 0).distinct()
        .withColumn("_gram", F.substring(term, 1, gram))
    )
    # one row per length that anchors have, `gram` at most
    sizes = anchors.groupBy(F.length("_gram").alias("n")).agg(F.sum(F.octet_length(term) + 32).alias("bytes")).collect()
    lengths = sorted(r["n"] for r in sizes)

    def pieces(n: int) -> Column:
        """Every run of `n` characters of the text."""
        runs = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(F.col(text), i, F.lit(n)))
        return F.when(F.length(text) >= n, runs).otherwise(F.array().cast("array<string>"))

    sized = [pieces(n) for n in lengths] or [F.array().cast("array<string>")]
    grams = F.explode(F.array_distinct(F.concat(*sized))).alias("_gram")
    inside = F.contains(F.col(text), F.col(term))
    if sum(r["bytes"] for r in sizes) <= sent:
        # a text holds the sequence of a term once
        return texts.filter(F.col(key).isNotNull()).select(key, text, grams).join(F.broadcast(anchors), "_gram").filter(inside).select(key, term)
    met = spread_join(texts.select(key, grams), anchors, "_gram").select(key, term).distinct()
    return spread_join(met, texts.select(key, text), key).filter(inside).select(key, term)


def joined(values: Column, sep: str = "|") -> Column:
    """A set of strings as one sorted, separated text."""
    return F.array_join(F.array_sort(values), sep)


def filled(df: DataFrame, column: str) -> Column:
    """1 when the value says something: not null, not blank, not an empty list."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(column)
    if kind == "array":
        return F.when(c.isNotNull() & (F.size(c) > 0), 1).otherwise(0)
    if kind == "string":
        return F.when(c.isNotNull() & (F.trim(c) != ""), 1).otherwise(0)
    return F.when(c.isNotNull(), 1).otherwise(0)


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    """100 * part / whole, 0 when the whole is 0."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, digits)).otherwise(F.lit(0.0))


def ranks(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds RANK() over (group, value descending), ties sharing a rank, without sorting a group in one
    task: distinct values are counted, placed, and joined back."""
    counted = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = order_positions(counted, group, [F.col(value).desc_nulls_last()], total="_n")
    places = placed.select(*group, value, (F.col("running") - F.col("_n") + 1).alias(name))
    return null_safe_join(df, places, [*group, value])


def prefix_join(texts: DataFrame, text: str, prefixes: DataFrame, prefix: str, shortest: int = 1) -> DataFrame:
    """Pairs of rows in which `text` starts with `prefix`: a text offers its beginnings of the lengths that prefixes have
    (from `shortest` characters on) and meets equal prefixes, instead of being compared with every prefix."""
    # one number per length of a prefix
    lengths = sorted(r[0] for r in prefixes.select(F.length(prefix)).distinct().collect() if r[0] is not None and r[0] >= shortest)
    offered = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(text))
    starts = texts.withColumn("_start", F.explode(F.transform(offered, lambda n: F.substr(F.col(text), F.lit(1), n))))
    return spread_join(starts, prefixes.withColumn("_start", F.col(prefix)), "_start").drop("_start")


def one_edit_pairs(left: DataFrame, a: str, right: DataFrame, b: str) -> DataFrame:
    """Distinct (a, b) text pairs at edit distance 0 or 1. Texts that differ by one edit share the text
    itself or one text with a character left out, so both sides meet on those variants."""

    def variants(df: DataFrame, c: str) -> DataFrame:
        text = F.col(c)
        cut = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(
            F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, F.length(text))))
        return df.select(c).filter(F.length(text) > 0).distinct().withColumn(
            "_variant", F.explode(F.array_distinct(F.concat(F.array(text), cut))))

    met = spread_join(variants(left, a), variants(right, b), "_variant").select(a, b).distinct()
    return met.filter(F.levenshtein(a, b) < 2)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): connected components of an undirected edge list, named by their smallest node.
    Every round hands the smaller label across each edge, to the node and to the root of its label, and
    then shortens label chains, so the number of rounds grows with the logarithm of the longest chain; it
    ends when no label moves (labels only ever shrink). Labels are written down once per round (checkpoint)."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u") != F.col("v"))
    both = lineage_cut(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = lineage_cut(both.select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node")))
    while True:
        at_u = labels.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        at_v = labels.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        seen = both.join(at_u, "u").join(at_v, "v").filter(F.col("lv") < F.col("lu"))
        offers = seen.select(F.explode(F.array("u", "lu")).alias("node"), F.col("lv").alias("offer"))
        best = offers.groupBy("node").agg(F.min("offer").alias("offer"))
        moved = labels.join(best, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("offer", "label")).alias("label"))
        roots = moved.select(F.col("node").alias("label"), F.col("label").alias("root"))
        after = lineage_cut(moved.join(roots, "label").select("node", "old", F.col("root").alias("label")))
        labels = after.select("node", "label")
        if after.filter(F.col("old") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")
