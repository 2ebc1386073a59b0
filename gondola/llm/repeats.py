"""Removal of repeated passages with a run-length index.

A byte goes when a string of `window` bytes that covers it also starts anywhere else, in its own document or another.

1. Anchors bring equal strings together: of every `window` bytes, the 64-byte piece with the smallest hash value is an anchor, so equal
   strings have equal anchors, and all strings around an anchor lie in a segment of a fixed size. Anchors that occur once are dropped:
   what is left is near the repeated part of the corpus.
2. Equal segments are one class. A class that occurs twice is repeated throughout, and its places are marked at once.
3. What remains are anchors with several classes, some of which occur once: near copies, and the ends of shared passages. One place of each class, all
   that shares an anchor together, goes to an index: the Burrows-Wheeler transform of the segments, compressed to runs, with suffixes sampled
   at the run ends. Matching statistics are streamed over the text from these samples: the match with the neighbouring suffix is compared byte
   by byte only at a run end, and inside a run it shrinks by one with every byte. Where they reach `window`, the match is marked.
4. An anchor with so many classes that no task should index them (`most_bytes`) is resolved by counting its strings by hash.

Texts are read whole, as UTF-8 bytes; they move twice: to cut out the segments, and to meet their marks.

Defined results: a null or empty text has no byte and keeps nothing; null ids and repeated rows are documents like others (repeated texts of
`window` bytes or more lose everything); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_batches
from gondola.session import lineage_cut

WINDOW = 200
CHUNK = 1 << 20
LOW = np.uint64(CHUNK - 1)
MULTIPLIERS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def piece(window: int) -> int:
    """Bytes of an anchor: the greatest power of two up to a third of the window, 64 at most."""
    return min(64, 1 << max(0, (window // 3).bit_length() - 1))


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash values of all pieces: two neighbours of half the size are combined again and again."""
    h = data.astype(np.uint64) + np.uint64(1)
    width = 1
    for m in MULTIPLIERS:
        if width == size:
            break
        h = h[:-width] * np.uint64(m) + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every `span` neighbours, from running minima of blocks."""
    n = len(h)
    full = np.concatenate([h, np.full(-n % span, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, span)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - span + 1], ahead[span - 1:n])


def anchors(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(places, hash values): for every `window` bytes the leftmost piece of the smallest hash."""
    size = piece(window)
    span = window - size + 1
    data = np.frombuffer(text, dtype=np.uint8)
    places, values = [], []
    # long texts in chunks that share a window, so that each window lies in one
    for start in range(0, max(1, len(data) - window + 1), CHUNK - window):
        part = data[start:start + CHUNK]
        if len(part) < window:
            break
        h = _hashes(part, size)
        keyed = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
        at = np.unique(_least(keyed, span) & LOW).astype(np.int64)
        places.append(at + start)
        values.append(h[at])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(values)[first]


def segments(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, list[int], np.ndarray]:
    """(anchors, segments, places) of a text: the hash of each anchor piece, the hash of all bytes that share a window with it, and
    where it is."""
    reach, size = window - piece(window), piece(window)
    place, value = anchors(text, window)
    digest = xxhash.xxh3_64_intdigest
    around = [digest(text[max(0, p - reach):p + size + reach], min(reach, p)) - (1 << 63) for p in place.tolist()]
    return value.view(np.int64), around, place


#: Masks of the first k of eight bytes.
HEADS = np.array([(1 << 64) - (1 << (64 - 8 * k)) for k in range(8)], dtype=np.uint64)


def _first_of_equal(ordered: np.ndarray) -> np.ndarray:
    """For each of some sorted values, the place of the first equal one."""
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def suffix_array(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes of several strings in order; `left`: bytes from each place to the end of its string. Ends are smaller than
    all bytes, and earlier ends smaller than later ones. Ranks of doubled length are sorted until all differ or the
    longest string is covered."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((n,), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)
    held = np.minimum(left, 7)
    # seven bytes and how many of them are there: an end is smaller than a zero byte
    key = (words & HEADS[held]) | held.astype(np.uint64)
    order = np.argsort(key).astype(np.int32)  # a bucket is far below 2 GB, and small numbers are gathered faster
    rank = np.empty(n, dtype=np.int32)
    rank[order] = _first_of_equal(key[order])
    depth, longest = 7, int(left.max())
    while True:
        # only places that share their rank are sorted on; a rank is the first place of its group in the order
        sorted_rank = rank[order]
        shared = np.concatenate([sorted_rank[1:] == sorted_rank[:-1], [False]])
        shared[1:] |= shared[:-1].copy()
        spots = np.flatnonzero(shared)
        if not len(spots):
            return order
        at = order[spots]
        if depth >= longest:  # equal to their ends, which are in the order of places
            order[spots] = at[np.lexsort((at, rank[at]))]
            return order
        after = np.where(left[at] > depth, rank[np.minimum(at + depth, n - 1)] + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + after
        within = np.argsort(key)
        order[spots] = at[within]
        rank[at[within]] = spots[_first_of_equal(key[within])]
        depth *= 2


def common_length(data: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at `a` and at `b` share, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(16, dtype=np.uint8)])
    words = np.ndarray((len(data) + 8,), dtype="<u8", buffer=padded.tobytes(), strides=(1,))
    most = np.minimum(left[a], left[b])
    out = np.zeros(len(a), dtype=np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        x = words[a[active] + out[active]] ^ words[b[active] + out[active]]
        same = x == 0
        differ = active[~same]
        low = x[~same] & (~x[~same] + np.uint64(1))  # the lowest differing bit tells the first differing byte
        out[differ] += np.log2(low.astype(np.float64)).astype(np.int64) // 8
        active = active[same]
        out[active] += 8
        active = active[out[active] < most[active]]
    return np.minimum(out, most)


def matching_statistics(strings: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, starts): for every byte of the joined strings, how long the longest string is that begins there and at another place,
    too; and where each string starts."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), starts
    which = np.repeat(np.arange(len(sizes)), sizes)
    left = (starts[which + 1] - np.arange(n)).astype(np.int32)
    order = suffix_array(data, left)
    # the transform: the byte before each suffix; the end before a first byte equals nothing
    before = np.where(order == starts[which[order]], -1 - which[order], data[order - 1].astype(np.int64))
    heads = np.concatenate([[0], 1 + np.flatnonzero(before[1:] != before[:-1])])
    # sampled run ends: the first suffix of each run with its neighbour, the last suffix of the run above
    sampled = order[heads[1:]]
    lengths = common_length(data, left, sampled, order[heads[1:] - 1])
    known = np.full(n, -1, dtype=np.int64)
    known[sampled] = lengths
    known[order[0]] = 0
    # streamed in text order: from one sample to the next, the match with the suffix above shrinks by one per byte
    place = np.arange(n)
    last = np.maximum.accumulate(np.where(known >= 0, place, -1))
    above = np.maximum(known[last] - (place - last), 0)
    below = np.zeros(n, dtype=np.int64)
    below[order[:-1]] = above[order[1:]]
    return np.maximum(above, below), starts


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def repeated(strings: Sequence[bytes], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """For each string, the spans covered by windows that occur twice in all strings together."""
    statistics, starts = matching_statistics(strings)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        out.append(_merged([(i, j - 1 + window) for i, j in _runs(statistics[a:b] >= window)]))
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), and what identifies a text: its hash and its bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"), F.octet_length(text).alias("bytes"))


def _places(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, segment, key, bytes, place, n) of all anchors that occur more than once; n counts rows with the same text."""

    def count(batch):
        seen = np.concatenate([np.zeros(0, dtype=np.uint64), *[anchors(t.encode(), window)[1] for t in batch["text"]]])
        values, n = np.unique(seen.view(np.int64), return_counts=True)
        return {"anchor": values, "n": n}

    often = map_batches(texts.select("text"), "anchor long, n long", count).groupBy("anchor").agg(F.sum("n").alias("n"))
    names = ("anchor", "segment", "key", "bytes", "place", "n")

    def listed(batch):
        times: dict = {}
        for t, key, size in zip(batch["text"], batch["key"], batch["bytes"]):
            times[key, size] = (times.get((key, size), (0, t))[0] + 1, t)
        found = [segments(t.encode(), window) for _, t in times.values()]
        lengths = [len(s) for _, s, _ in found]
        columns = [np.concatenate([f[0] for f in found]), [s for f in found for s in f[1]]]
        for values in ([k for k, _ in times], [b for _, b in times], None, [n for n, _ in times.values()]):
            columns.append(np.concatenate([f[2] for f in found]) if values is None else np.repeat(values, lengths))
        return dict(zip(names, columns))

    rows = map_batches(
        texts.filter(F.col("bytes") >= window).select("text", "key", "bytes"),
        "anchor long, segment long, key long, bytes int, place int, n long", listed)
    # a table, so that both sides of the join are shuffled for it alone and its heavy partitions can be split
    again = lineage_cut(often.filter("n > 1").select("anchor"))
    met = lineage_cut(rows.join(again, "anchor"))
    return met.groupBy("anchor", "segment", "key", "bytes", "place").agg(F.sum("n").alias("n"))


def marks(docs: DataFrame, window: int = WINDOW, bucket_bytes: int = 1 << 20, most_bytes: int = 1 << 22) -> DataFrame:
    """(key, bytes, spans): the spans to remove of each text, unmerged. `bucket_bytes`: bytes that are indexed together,
    about; `most_bytes`: from there on the strings of one anchor are counted by hash instead."""
    size = piece(window)
    reach = window - size
    texts = _keyed(docs)
    places = lineage_cut(_places(texts, window))
    first = F.greatest(F.lit(0), F.col("place") - reach)
    last = F.least(F.col("bytes"), F.col("place") + size + reach)
    classes = lineage_cut(places.groupBy("anchor", "segment").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "bytes", "place")).alias("at")))
    again = classes.filter("n > 1").select("anchor", "segment")
    at_once = places.join(again, ["anchor", "segment"]).filter(last - first >= window).select(
        "key", "bytes", first.alias("a"), last.alias("b"))

    # anchors with several classes, one of which occurs once: one place of each class
    alone = F.count(F.when(F.col("n") == 1, 1)).alias("alone")
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes"), alone).filter("classes > 1 and alone > 0")
    needed = lineage_cut(classes.join(several, "anchor").select("anchor", "classes", "at.*"))
    width = window + reach
    total = needed.agg(F.count(F.lit(1))).first()[0] * width
    buckets = max(1, -(-total // bucket_bytes))
    needed = needed.select(
        "key", "bytes", first.cast("int").alias("a"), last.cast("int").alias("b"),
        F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"), (F.col("classes") * width > most_bytes).alias("crowded"))
    wanted = needed.groupBy("key", "bytes").agg(F.collect_list(F.struct("bucket", "crowded", "a", "b")).alias("wanted"))
    one = texts.groupBy("key", "bytes").agg(F.min(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("id"))
    chosen = texts.withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).join(
        one.join(wanted, ["key", "bytes"]), ["key", "bytes", "id"])

    def cut_out(batch):
        out: dict[str, list] = {"key": [], "bytes": [], "pieces": []}
        for t, key, n, spans in zip(batch["text"], batch["key"], batch["bytes"], batch["wanted"]):
            raw, by = t.encode(), {}
            for s in spans:
                by.setdefault((s["crowded"], s["bucket"]), []).append((s["a"], s["b"]))
            out["key"].append(key)
            out["bytes"].append(n)
            out["pieces"].append([
                {"bucket": bucket, "crowded": crowded, "a": a, "body": raw[a:b]}
                for (crowded, bucket), x in by.items() for a, b in _merged([s for s in x if s[1] - s[0] >= window])])
        return out

    pieces = map_batches(
        chosen.select("text", "key", "bytes", "wanted"),
        "key long, bytes int, pieces array<struct<bucket long, crowded boolean, a int, body binary>>", cut_out)
    pieces = lineage_cut(pieces.select("key", "bytes", F.inline("pieces")))

    def index(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["key", "bytes", "a"]).sort_values(["key", "bytes", "a"])
        found = repeated([bytes(x) for x in rows["body"]], window)
        out = [(key, n, a + i, a + j) for (key, n, a), spans in zip(
            rows[["key", "bytes", "a"]].itertuples(index=False, name=None), found) for i, j in spans]
        return pd.DataFrame(out, columns=["key", "bytes", "a", "b"])

    indexed = pieces.filter("not crowded").groupBy("bucket").applyInPandas(index, "key long, bytes int, a int, b int")

    def strings(batch):
        out: dict[str, list] = {n: [] for n in ("h", "g", "key", "bytes", "a")}
        for key, n, a, body in zip(batch["key"], batch["bytes"], batch["a"], batch["body"]):
            for i in range(len(body) - window + 1):
                digest = xxhash.xxh3_128_intdigest(body[i:i + window])
                out["h"].append((digest >> 64) - (1 << 63))
                out["g"].append((digest & (2**64 - 1)) - (1 << 63))
                out["key"].append(key)
                out["bytes"].append(n)
                out["a"].append(a + i)
        return out

    counted = map_batches(
        pieces.filter("crowded").select("key", "bytes", "a", "body"), "h long, g long, key long, bytes int, a int", strings)
    counted = lineage_cut(counted.distinct())
    twice = counted.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "g")
    by_hash = counted.join(twice, ["h", "g"]).select("key", "bytes", "a", (F.col("a") + window).alias("b"))

    every = at_once.unionByName(indexed).unionByName(by_hash)
    return every.distinct().groupBy("key", "bytes").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def without_repeats(
    docs: DataFrame, window: int = WINDOW, bucket_bytes: int = 1 << 20, most_bytes: int = 1 << 22, bodies: bool = True
) -> DataFrame:
    """All documents: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and `kept`, the bytes that stay (`bodies`: False leaves
    that column out, and the bytes where they are)."""
    found = marks(docs, window, bucket_bytes, most_bytes)
    rows = _keyed(docs).join(found, ["key", "bytes"], "left").select("doc_id", "text", "spans")
    body = ["kept"] if bodies else []

    def remove(batch):
        out: dict[str, list] = {n: [] for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *body)}
        for doc_id, t, spans in zip(batch["doc_id"], batch["text"], batch["spans"]):
            raw = t.encode()
            runs = _merged([(s["a"], s["b"]) for s in spans or []])
            ends = [0, *[x for run in runs for x in run], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
            out["doc_id"].append(doc_id)
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(kept))
            out["n_spans"].append(len(runs))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if bodies:
                out["kept"].append(kept)
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows, ", ".join([f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string", *[f"{n} binary" for n in body]]), remove)
