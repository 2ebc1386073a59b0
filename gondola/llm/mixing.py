"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots, each a block of equally many words of one source. Slot times are van der Corput points:
the points of [0, 1) are cut by the cumulative weights of the sources, and a slot belongs to the source in whose part
its point lies. Points with m bits are the bit reversals of 0 .. 2**m - 1, so the part of a source is a run of
consecutive integers and its slots are the reversed bits of that run: every source gets exactly the number of slots
it needs, spread evenly over the mix, without a range join. Slots are ranked per source; the documents of a source lie
shuffled on one line of words, cut into blocks, and the slot of rank r takes block r modulo the number of blocks.

Everything is DataFrame expressions. The two running totals (words before a document, slots before a slot) are sums
over slices, in two levels, plus the rows of one slice, so a source that holds most of the rows is never sorted in one task.
Joins of exploded rows are asked to merge: their size is guessed from the few rows before the explosion, and a broadcast
chosen by that guess would grow with the corpus.

Defined results: null or empty texts have size 0 and are taken 0 times; a null source is a source of its own, last in
order; null ids are allowed; repeated rows are separate documents, which follow each other on the line; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import WORD
from gondola.session import lineage_cut

#: Slots of one source that are listed or ranked together.
CHUNK = 1 << 14


def sized(docs: DataFrame, source: str = "source") -> DataFrame:
    """(doc_id, source, size, place): words of each text, and the shuffled order of documents."""
    return docs.select(
        "doc_id",
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), "text").cast("binary")).alias("place"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """(source, source_no, source_size, target): `weights`, repeating over the sources in order of code points (null
    last), share all words; no target exceeds `limit` times its source, and the excess is shared again by weight. One
    row per source, so the windows here see as many rows as there are sources.

    The sources that end at their limit are those with the smallest limit per weight: in that order, a source is at its
    limit when what is left for it and all later ones, shared by weight, would exceed it."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), F.col("source_no") % len(weights) + 1)
    rows = (
        per.withColumn("source_no", F.row_number().over(order) - 1)
        .withColumn("weight", pick.cast("long"))
        .withColumn("most", F.col("source_size") * limit)
    )
    by_room = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before, onward = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    full = left * F.col("weight") >= F.col("most") * F.sum("weight").over(onward)
    rows = rows.withColumn("full", full)
    shared = F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(everything)
    part = shared / F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    return rows.select(
        "source", "source_no", "source_size",
        F.when(F.col("full"), F.col("most").cast("double")).otherwise(part * F.col("weight")).alias("target"))


def _reversed(value: Column, bits: int) -> Column:
    """The lowest `bits` bits of a value, in reverse order."""
    swaps = ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF))
    for n, mask in swaps:
        high = F.shiftrightunsigned(value, n).bitwiseAND(F.lit(mask))
        value = F.shiftleft(value.bitwiseAND(F.lit(mask)), n).bitwiseOR(high)
    value = F.shiftleft(value, 32).bitwiseOR(F.shiftrightunsigned(value, 32))
    return F.shiftrightunsigned(value, 64 - bits) if bits else F.lit(0).cast("long")


def planned(targets: DataFrame, block: int) -> DataFrame:
    """Adds what each source needs: `blocks` on its line, `last` words of an unfinished pass, `slots`."""
    size, words = F.col("source_size"), F.floor(F.col("target") + 0.5).cast("long")
    whole = F.when(size > 0, F.floor(words / size)).otherwise(0).cast("long")
    blocks = F.ceil(size / block).cast("long")
    last = (words - whole * size).cast("long")
    return targets.withColumn("blocks", blocks).withColumn("last", last).withColumn(
        "slots", whole * blocks + F.ceil(last / block).cast("long"))


def _ahead(rows: DataFrame, value: Column) -> DataFrame:
    """(source_no, broad, slice, before): the sum of `value` over the slices of a source before each slice. Slices are summed
    within broad slices, and broad slices within the source, so no window holds all slices of a source."""
    fine = rows.groupBy("source_no", "broad", "slice").agg(F.sum(value).alias("n"))
    coarse = fine.groupBy("source_no", "broad").agg(F.sum("n").alias("n"))
    so_far = (Window.unboundedPreceding, -1)
    by_broad = Window.partitionBy("source_no").orderBy("broad").rowsBetween(*so_far)
    by_slice = Window.partitionBy("source_no", "broad").orderBy("slice").rowsBetween(*so_far)
    ahead = coarse.select("source_no", "broad", F.coalesce(F.sum("n").over(by_broad), F.lit(0)).alias("ahead"))
    inside = fine.withColumn("inside", F.coalesce(F.sum("n").over(by_slice), F.lit(0))).drop("n")
    return inside.join(ahead.hint("merge"), ["source_no", "broad"]).select(
        "source_no", "broad", "slice", (F.col("ahead") + F.col("inside")).alias("before"))


def schedule(targets: DataFrame, block: int = 256) -> DataFrame:
    """(at, source_no, rank, block_no, words): the slots of the mix, in the order of `at`. `targets` as `source_targets`
    gives them; it is read three times and should be a table."""
    plan = planned(targets, block)
    # one row: the number of slots decides the number of bits
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    bits = max(0, (total - 1).bit_length())
    chunk_bits = max(0, bits - CHUNK.bit_length() + 1)
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    parts = plan.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0))).filter(F.col("slots") > 0)
    runs = parts.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    start = F.col("run") * CHUNK
    listed = runs.repartition("source_no", "run").withColumn(
        "point", F.explode(F.sequence(start, F.least(start + CHUNK, F.col("slots")) - 1)))
    slots = listed.withColumn("at", _reversed(F.col("first") + F.col("point"), bits)).withColumn(
        "slice", F.shiftright("at", bits - chunk_bits)).withColumn("broad", F.shiftright("slice", chunk_bits // 2))
    inside = Window.partitionBy("source_no", "broad", "slice").orderBy("at")
    ranked = slots.withColumn("in_slice", F.row_number().over(inside)).join(
        _ahead(slots, F.lit(1)).hint("merge"), ["source_no", "broad", "slice"])
    rank = F.col("before") + F.col("in_slice") - 1
    number = F.col("rank") % F.col("blocks")
    whole = F.least(F.lit(block), F.col("source_size") - number * block)
    words = F.when((F.col("rank") == F.col("slots") - 1) & (F.col("last") > 0), F.col("last") - number * block).otherwise(whole)
    return ranked.withColumn("rank", rank).select(
        "at", "source_no", "rank", number.alias("block_no"), words.cast("long").alias("words"), (words < whole).alias("cut"))


def placed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Lines of equal documents (same source, id, text): `copies` of them follow each other on the line of their source from `start` on, the
    words that lie before them. Copies are folded before the sort, so that a row repeated very often is one row of it."""
    folded = sizes.groupBy("source", "doc_id", "size", "place").agg(F.count(F.lit(1)).alias("copies"))
    numbered = folded.join(targets, folded["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    numbered = numbered.withColumn("slice", F.substring("place", 1, 4)).withColumn("broad", F.substring("place", 1, 2))
    words = F.col("size") * F.col("copies")
    inside = Window.partitionBy("source_no", "broad", "slice").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        numbered.withColumn("upto", F.sum(words).over(inside))
        .join(_ahead(numbered, words).hint("merge"), ["source_no", "broad", "slice"])
        .withColumn("start", F.col("before") + F.col("upto") - words).drop("slice", "broad", "place", "upto", "before")
    )


def unfolded(lines: DataFrame) -> DataFrame:
    """One row per document from `placed` lines, each with its own `start`; long runs of copies are listed by several tasks."""
    few = lines.filter(F.col("copies") <= CHUNK).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    runs = lines.filter(F.col("copies") > CHUNK).withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK)))).repartition("source_no", "start", "doc_id", "run")
    begin = F.col("run") * CHUNK
    many = runs.withColumn("copy", F.explode(F.sequence(begin, F.least(begin + CHUNK, F.col("copies")) - 1))).drop("run")
    return few.unionByName(many).withColumn("start", F.col("start") + F.col("copy") * F.col("size")).drop("copy", "copies")


def mix(
    docs: DataFrame, source: str = "source", weights: Sequence[int] = (1, 2, 3), limit: int = 3, block: int = 256
) -> DataFrame:
    """Every document once: doc_id, source, size, source_size, target, taken (words that the scheduled slots take from
    it, repeats counted), first_slot (the place `at` in the mix of the first slot that takes words from it; null if none does). Each source takes
    its target, rounded to a word."""
    sizes = lineage_cut(sized(docs, source))
    targets = lineage_cut(source_targets(sizes, weights, limit))
    cut = F.col("cut")
    used = schedule(targets, block).groupBy("source_no", "block_no").agg(
        F.count(F.when(~cut, 1)).alias("times"), F.max(F.when(cut, F.col("words")).otherwise(0)).alias("part"),
        F.min(F.when(~cut, F.col("at"))).alias("whole_at"), F.min(F.when(cut, F.col("at"))).alias("part_at"))
    rows = lineage_cut(unfolded(lineage_cut(placed(sizes, targets))))
    end = F.col("start") + F.col("size")
    pieces = rows.filter(F.col("size") > 0).withColumn(
        "block_no", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    low = F.greatest(F.col("start"), F.col("block_no") * block)
    over = F.least(end, (F.col("block_no") + 1) * block) - low
    in_part = F.greatest(F.lit(0), F.least(end, F.col("block_no") * block + F.col("part")) - low)
    taken = pieces.join(used.hint("merge"), ["source_no", "block_no"]).select(
        "source_no", "start", (over * F.col("times") + in_part).alias("taken"),
        F.least("whole_at", F.when(in_part > 0, F.col("part_at"))).alias("at"))
    # a document with words is alone at its start on the line of its source
    taken = taken.groupBy("source_no", "start").agg(F.sum("taken").alias("taken"), F.min("at").alias("first_slot"))
    taken = taken.withColumn("some", F.lit(True))
    out = rows.withColumn("some", F.col("size") > 0).join(taken, ["source_no", "start", "some"], "left")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")
