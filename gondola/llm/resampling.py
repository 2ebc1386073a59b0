"""Importance resampling towards a target distribution of hashed n-grams.

Documents and target texts become bags of n-grams in a fixed number of buckets. A bucket gains by how much more often the target
uses it; a document weighs as much as its n-grams gain on average, and documents are drawn without replacement by adding Gumbel noise
made from their ids (the highest sums are a sample by weight).

N-grams are interned in an open-addressed NumPy table, some megabytes of text at a time: the xxhash64 value of every occurrence probes
the table, all occurrences at once and step by step; equal values are verified byte by byte, and those that differ probe on. A slot
holds the bucket (so the crc32 of an n-gram is computed once per table) and a count, and every occurrence keeps the id of its slot. Counting
adds up the count slots by bucket; weighing gathers the gains of the slots along the ids of the occurrences.

Texts are scanned twice and never shuffled; a task sends one row per bucket. Gains, one number per bucket, go to all tasks.
Ranks come from a range partitioning, so that no task sorts all documents.

Defined results: words are lower-cased for A-Z only; a null or empty text has no feature and weight 0; a null id counts as empty text and is
last among equal scores; repeated rows are documents of their own with the same score; an empty table, or an empty target, is counted
as such (all its buckets are 0); other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_batches, map_texts
from gondola.operators.kit import order_positions
from gondola.session import lineage_cut

#: Characters of text whose n-grams share a table.
TABLE_CHARS = 4 << 20
#: A-Z to a-z; all other ASCII characters but letters and digits to blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
HEADS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(FOLD).split()


def grams_of(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to `longest` words."""
    out = list(words)
    for k in range(2, longest + 1):
        out += [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
    return out


class Bytes:
    """Byte strings in one buffer, compared eight bytes at a time."""

    def __init__(self, items: list[bytes]):
        self.size = np.fromiter(map(len, items), dtype=np.int64, count=len(items))
        self.start = np.cumsum(self.size) - self.size
        joined = b"".join([*items, bytes(8)])
        self.eight = np.ndarray((len(joined) - 7,), dtype="<u8", buffer=joined, strides=(1,))

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = self.size[a] == self.size[b]
        rest, at = np.flatnonzero(out), 0
        while len(rest):
            i, j = a[rest], b[rest]
            left = self.size[i] - at
            differ = ((self.eight[self.start[i] + at] ^ self.eight[self.start[j] + at]) & HEADS[np.minimum(left, 8)]) != 0
            out[rest[differ]] = False
            rest, at = rest[~differ & (left > 8)], at + 8
        return out


class Table:
    """N-grams interned: `slot` of every occurrence, and by slot the `owner` (an occurrence, or -1), the `bucket` and the `count`."""

    def __init__(self, grams: list[bytes], buckets: int, keys: np.ndarray | None = None):
        n = len(grams)
        size = 1 << max(3, (2 * n - 1).bit_length())
        if keys is None:
            keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), dtype=np.uint64, count=n)
        body = Bytes(grams)
        self.owner = np.full(size, -1, dtype=np.int64)
        self.slot = (keys & np.uint64(size - 1)).astype(np.int64)
        open_ = np.arange(n)
        while len(open_):
            at = self.slot[open_]
            free = self.owner[at] < 0
            self.owner[at[free]] = open_[free]  # of several that want a slot, one gets it
            holder = self.owner[at]
            match = keys[holder] == keys[open_]
            doubt = np.flatnonzero(match & (holder != open_))
            match[doubt] = body.equal(holder[doubt], open_[doubt])
            open_ = open_[~match]
            self.slot[open_] = (self.slot[open_] + 1) & (size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        for s in np.flatnonzero(self.owner >= 0).tolist():
            self.bucket[s] = zlib.crc32(grams[self.owner[s]]) % buckets


def tables(texts: list[str], longest: int, buckets: int) -> Iterator[tuple[Table, list[int], list[int]]]:
    """(table, words, n-grams) of neighbouring texts that together have about TABLE_CHARS characters."""
    grams: list[bytes] = []
    words: list[int] = []
    sizes: list[int] = []
    chars = 0
    for t in texts:
        own = words_of(t)
        found = grams_of(own, longest)
        grams += found
        words.append(len(own))
        sizes.append(len(found))
        chars += len(t)
        if chars >= TABLE_CHARS:
            yield Table(grams, buckets), words, sizes
            grams, words, sizes, chars = [], [], [], 0
    if words:
        yield Table(grams, buckets), words, sizes


def bucket_counts(docs: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many n-grams fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for table, _, _ in tables(b.column(0).to_pylist(), longest, buckets):
                np.add.at(total, table.bucket, table.count)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    # one row per bucket at most
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier the target uses a bucket, rounded down."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n))))
        for a, b in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id, seed: str) -> int:
    """Thousandths of a Gumbel variate that depends on the seed and the id only."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, longest: int, seed: str) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(texts):
        gain = shared.value
        words, sizes, weights = [], [], []
        for table, n_words, n in tables(texts, longest, len(gain)):
            value = gain[table.bucket][table.slot]
            ends = np.cumsum([0, *n])
            upto = np.concatenate([[0], np.cumsum(value)])
            n = np.array(n, dtype=np.int64)
            weights.append(np.where(n > 0, (upto[ends[1:]] - upto[ends[:-1]]) // np.maximum(n, 1), 0))
            words += n_words
            sizes.append(n)
        return {"n_words": words, "n_features": np.concatenate(sizes), "weight": np.concatenate(weights)}

    rows = map_texts(docs, ["doc_id"], "n_words long, n_features long, weight long", weigh)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def add(batch):
        made = [noise(i, seed) for i in batch["doc_id"]]
        return {**batch, "score": [w + x for w, x in zip(batch["weight"], made)]}

    return map_batches(rows, f"doc_id {kind}, n_words long, n_features long, weight long, score long", add)


def resampled(
    docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024"
) -> DataFrame:
    """All documents: doc_id, n_features, weight, score, and `rank` of those drawn: `percent` of the documents with at least `least_words` words, by
    the highest scores. `docs`: doc_id, text; `target`: text."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = lineage_cut(weighed(docs, gain, longest, seed).withColumn("row", F.monotonically_increasing_id()))
    # equal rows, however many, are told apart by their number and so spread over slices
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")]
    placed = order_positions(rows.filter(F.col("n_words") >= least_words), [], order)
    drawn = F.col("position") <= F.floor(F.col("group_rows") * percent / 100)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(drawn, F.col("position")).cast("long").alias("rank"))
    return ranked.unionByName(rows.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank")))
