"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item leaks into a document that contains at least `threshold` of its word shingles, wherever they stand. Items are short and
documents may be long, so comparing sketches of both would miss leaks. Instead an item keeps its smallest hash values, as
many as make a miss impossible: of n shingles, a document with t n of them holds at least one of any n - ceil(t n) + 1, so also one
of the smallest ones. Items are partitioned by size (powers of two); a partition is only searched for documents with enough
shingles for its smallest item. Hits are verified by exact containment on word tuples.

The items are the stated query set: they go to the tasks in blocks of at most `block_items`, and each block is one pass
over whole documents without a shuffle.

Items shorter than a shingle are partitioned by their number of words, and each such partition is searched with shingles of that length, so a short item
is found wherever it stands in a long document.

Defined results: words are lower-cased for A-Z only; an item of fewer words than a shingle is one shingle, its whole sequence; null or empty items match nothing, null or empty documents hold nothing; equal items (id and text) count once, other
repeated ids and all repeated documents are searched each on their own; empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_texts

FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    """One MinHash permutation: a fixed shuffle of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash values of the runs of `width` words that are all known."""
    if len(ids) < width:
        return np.zeros(0, dtype=np.uint64)
    count = len(ids) - width + 1
    known = ids >= 0
    good = np.ones(count, dtype=bool)
    for k in range(width):
        good &= known[k:k + count]
    starts = np.flatnonzero(good)
    value = np.zeros(len(starts), dtype=np.uint64)
    for k in range(width):
        value = (value + ids[starts + k].astype(np.uint64) + np.uint64(1)) * FACTOR
    return _mixed(value)


def _tuples(ids, width: int) -> set[tuple]:
    return set(zip(*[ids[k:] for k in range(width)]))


@dataclass
class Part:
    """Items of one size partition: the words of a shingle, the least number of shingles a document needs, and sorted signature values with
    their item."""

    width: int
    least: int
    values: np.ndarray
    owners: np.ndarray


@dataclass
class Search:
    """One block of items, ready to be looked for."""

    threshold: float
    shingle: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    ids: list = field(default_factory=list)
    widths: list[int] = field(default_factory=list)
    shingles: list[frozenset] = field(default_factory=list)
    parts: list[Part] = field(default_factory=list)

    def needed(self, n: int) -> int:
        """How many of n shingles a document must hold."""
        return max(1, int(np.ceil(round(self.threshold * n, 9))))

    def found(self, text: str | None) -> list[dict]:
        """item_id, shared and shingles of every item that the text contains."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        by_width: dict[int, np.ndarray] = {}
        hits: set[int] = set()
        for part in self.parts:
            if len(words) - part.width + 1 < part.least:
                continue
            if part.width not in by_width:
                by_width[part.width] = np.unique(_windows(ids, part.width))
            values = by_width[part.width]
            if len(values):
                at = np.minimum(np.searchsorted(part.values, values), len(part.values) - 1)
                for value in values[part.values[at] == values]:
                    a, b = np.searchsorted(part.values, value), np.searchsorted(part.values, value, side="right")
                    hits.update(part.owners[a:b].tolist())
        if not hits:
            return []
        listed = ids.tolist()
        held = {w: _tuples(listed, w) for w in {self.widths[i] for i in hits}}
        shared = {i: len(self.shingles[i] & held[self.widths[i]]) for i in hits}
        return [
            {"item_id": self.ids[i], "shared": n, "shingles": len(self.shingles[i])}
            for i, n in sorted(shared.items()) if n >= self.needed(len(self.shingles[i]))
        ]


def search(items: list[tuple], threshold: float = 0.8, shingle: int = 5) -> Search:
    """Prepares distinct (item_id, text) rows."""
    out = Search(threshold, shingle)
    sizes: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = defaultdict(list)
    for item_id, text in sorted(set(items), key=lambda r: (str(r[0]), r[1] or "")):
        words = words_of(text)
        if not words:
            continue
        ids = [out.vocabulary.setdefault(w, len(out.vocabulary)) for w in words]
        width = min(shingle, len(ids))
        held = frozenset(_tuples(ids, width))
        n = len(held)
        signature = np.unique(_windows(np.array(ids, dtype=np.int64), width))[: n - out.needed(n) + 1]
        sizes[width, n.bit_length()].append((len(out.ids), signature))
        out.ids.append(item_id)
        out.widths.append(width)
        out.shingles.append(held)
    for (width, bits), members in sorted(sizes.items()):
        values = np.concatenate([s for _, s in members])
        owners = np.concatenate([np.full(len(s), i) for i, s in members])
        order = np.argsort(values, kind="stable")
        out.parts.append(Part(width, out.needed(1 << (bits - 1)), values[order], owners[order]))
    return out


def blocks(benchmark: DataFrame, threshold: float, shingle: int, block_items: int) -> Iterator[Search]:
    """The items in blocks. At most about `block_items` of them are on the driver at once."""
    items = benchmark.select("item_id", "text")
    count = max(1, -(-items.count() // block_items))
    for k in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).distinct().collect()
        yield search([(r["item_id"], r["text"]) for r in rows], threshold, shingle)


def hits(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, shingle: int = 5, block_items: int = 50_000
) -> DataFrame:
    """(doc_id, item_id, shared, shingles, containment) for every document and item it contains."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for ready in blocks(benchmark, threshold, shingle, block_items):
        rows = map_texts(
            docs, ["doc_id"], f"found array<struct<item_id {kind}, shared int, shingles int>>",
            lambda texts, ready=ready: {"found": [ready.found(t) for t in texts]})
        rows = rows.select("doc_id", F.inline("found"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("containment", F.col("shared") / F.col("shingles"))


def _holds_any(ready: Search):
    """A column function: text -> whether it contains an item of the block."""

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(ready.found(t)) for t in texts], dtype=bool)

    return run


def leaked(benchmark: DataFrame, text: Column, threshold: float = 0.8, shingle: int = 5, block_items: int = 50_000) -> Column:
    """A boolean column: whether a text contains any item."""
    out = F.lit(False)
    for ready in blocks(benchmark, threshold, shingle, block_items):
        out = out | _holds_any(ready)(text)
    return out
