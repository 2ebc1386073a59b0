"""SimHash near-dedup with multi-index hashing.

A text becomes a 64-bit fingerprint of its word shingles. Two texts are linked when their fingerprints differ in few
bits, and classes are the connected components of these links.

Links between distinct fingerprints are found with two tables, one per 32-bit segment: of two fingerprints that differ
in at most two bits, one segment differs in at most one. So each fingerprint looks up, per segment, its own value and the
values one bit away (only upward, 0 to 1: the partner looks from the other side), and complete distances verify what the
tables return. A table value shared by very many fingerprints (near copies of one long text) would return all
their pairs; there the lookup is narrowed by the small ball of the other segment: fingerprints within one bit of
the same point are within two bits of each other, and such a point has at most 65 of them, which are linked to the smallest
one. Both ways give the same classes, and no list of pairs grows with the square of a group.

Defined results: a null or empty text has fingerprint zero and is linked like any other; rows with a null id take part, and a
class of null ids only has a null component; repeated rows have one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import map_texts
from gondola.operators.kit import components
from gondola.session import lineage_cut

SEED = 42
#: The bits of every byte value, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BYTE_OF = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, ends, at = b" ".join(words), [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends[:-shingle]]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])]
    values = np.array(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    # how often each byte value stands at each of the eight places, then how often each bit is set
    counts = np.bincount((values + BYTE_OF).ravel(), minlength=2048).reshape(8, 256)
    ones = (counts @ BITS).ravel() * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, columns: Sequence[str] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """The chosen columns and `fp`, a long."""
    return map_texts(docs, columns, "fp bigint", lambda texts: {"fp": [fingerprint(t, shingle) for t in texts]})


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, most_bits: int = 2, crowded: int = 64) -> DataFrame:
    """(a, b): links between the distinct fingerprints `fp`, of at most `most_bits` (0, 1 or 2) differing bits, that connect what
    all such links connect. Table values held by more than `crowded` fingerprints are looked up by the narrowed key;
    the classes do not depend on it."""
    if most_bits not in (0, 1, 2):
        raise ValueError("two segments with balls of one bit find up to two differing bits")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    entries = fps.select("fp", F.inline(F.array(
        F.struct(F.lit(0).alias("segment"), low.alias("value"), high.alias("other")),
        F.struct(F.lit(1).alias("segment"), high.alias("value"), low.alias("other")))))
    upward = F.expr("filter(transform(sequence(0, 31), i -> value | shiftleft(1L, i)), v -> v != value)")
    crowd = lineage_cut(
        entries.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > crowded)
        .select("segment", "value"))
    looked = entries.select("segment", F.col("fp").alias("a"), F.col("value").alias("own"), F.col("other"),
                            F.explode(F.concat(F.array("value"), upward)).alias("value"))
    table = entries.select("segment", "value", F.col("fp").alias("b"))
    # the size of the exploded side is guessed too low for a broadcast to be chosen by it
    met = looked.join(table.join(crowd, ["segment", "value"], "left_anti").hint("merge"), ["segment", "value"]).filter(
        ((F.col("own") != F.col("value")) | (F.col("a") < F.col("b"))) & (_distance("a", "b") <= most_bits))
    # crowded values: those at the value bring the ball around their other segment, those one bit away only that segment
    ball = F.expr("array_append(transform(sequence(0, 31), i -> other ^ shiftleft(1L, i)), other)")
    near = looked.join(crowd, ["segment", "value"]).withColumn(
        "point", F.explode(F.when(F.col("own") == F.col("value"), ball).otherwise(F.array("other"))))
    hub = F.min("a").over(Window.partitionBy("segment", "value", "point"))
    narrowed = near.select("a", hub.alias("b")).filter((F.col("a") != F.col("b")) & (_distance("a", "b") <= most_bits))
    return met.select("a", "b").unionByName(narrowed).distinct()


def near_copies(
    docs: DataFrame, columns: Sequence[str] = ("doc_id",), shingle: int = 3, most_bits: int = 2, crowded: int = 64
) -> DataFrame:
    """The chosen columns (`doc_id` among them), `fp`, and `component_id`: the smallest id of the class."""
    marked = lineage_cut(fingerprints(docs, columns, shingle))
    least = lineage_cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(least.select("fp"), most_bits, crowded), "a", "b")
    named = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    named = lineage_cut(named.select("fp", "least", "root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(lowest, "root").select("fp", "component_id")
    return marked.join(classes, "fp")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """The documents of `docs`, all columns, one of each class: that with the smallest id (null ids last). Of several rows with this id, the one whose text has the
    smallest hash stays, and of rows with the same id and text the one with the smallest hashes of all columns, so the choice does not depend on
    partitions. Columns of any name are kept as they are."""
    tag = "_"
    while any(c.startswith(tag) for c in docs.columns):
        tag += "_"
    id_, copy, again, chosen_ = f"{tag}id", f"{tag}copy", f"{tag}again", f"{tag}chosen"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), copy: F.xxhash64("text")})
    marks = near_copies(hashed, ["doc_id", id_, copy], shingle, most_bits)
    # a class of null ids only has no component id: its rows are told apart by fingerprint
    marks = marks.withColumn("component_id", F.coalesce(F.col("component_id").cast("string"), hex_digits(F.col("fp"))))
    first = F.row_number().over(Window.partitionBy("component_id").orderBy(F.col("doc_id").asc_nulls_last(), copy))
    chosen = marks.withColumn(chosen_, first).filter(F.col(chosen_) == 1).select(id_, copy)
    of_equal = Window.partitionBy(id_, copy).orderBy(F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))
    return (
        hashed.join(chosen.distinct(), [id_, copy])
        .withColumn(again, F.row_number().over(of_equal)).filter(F.col(again) == 1).select(*columns)
    )
