"""A hierarchical Pitman-Yor language model, counted and sampled with Spark.

Restaurants: the parent serves single tokens over a uniform base; every word is a context with a restaurant of its own,
which serves what follows that word, and all of them send a customer to the shared parent whenever a new table opens.
Training counts every token and every pair of the corpus. Seats are then sampled by Gibbs sweeps: given the tables of all
others, the customers of a dish are seated anew, each at a new table with a weight of (theta + d T) times the parent's
probability of the dish; then the parent seats the customers that all contexts sent. After a burn-in, the predictive
parameters are averaged over the sweeps, and the averaged probabilities score all documents.

Every word is a dish and a context, and every pair counts, however rare; the tables of words and pairs stay in Spark. A pair seen once has
one table whatever is drawn, so only pairs seen again are sampled. What travels to the tasks is a hot head, on which the result does not depend
(but for the draws, which follow the numbers of words): words of at least one in `hot_words` tokens and pairs of at least one in `hot_pairs` (so at most that many). Texts are
tokenised once, in chunks of `chunk_tokens` tokens (or one document more). A chunk sends each of its distinct pairs once to the part of the pair's hash (at least `slices` parts, of `slice_tokens` training
tokens each on average), where pairs are counted and where the chunk's place of each is kept; when the seats are sampled, the parts answer the chunks by place, and so do parts of
the words for each word of a chunk that is not hot. A pair that comes once needs no answer where its own chunk holds it. So a task holds a chunk or a part, and a table goes as soon as what was made of it is
written. Words are known by number: hot ones by their place, others by a hash of `number_bits` bits; words that share a hash
(N words make about N * N / 2^64 such pairs: five for ten thousand million words) are numbered by place like the hot ones, so no two words are taken for one. `word_share`, `context_share` and `pair_share` make a smaller model on request (0: everything).

Defined results: null or empty texts consist of the end token; null ids count as empty text for the fold; repeated rows are scored
(and counted) each on their own; without training rows every probability is one (a vocabulary of nothing but the unknown word).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gondola.llm.common import remainder
from gondola.session import few_rows_at_once, few_rows_in_a_group, forget, lineage_cut, little_disk, sized_shuffles

#: The end token; no word is empty.
END = b""


def tokens(text: str) -> list[bytes]:
    return [*text.encode("utf-8", "replace").lower().split(), END]


@dataclass(frozen=True)
class Settings:
    word_share: float = 0.0
    context_share: float = 0.0
    pair_share: float = 0.0
    hot_words: int = 500_000
    hot_pairs: int = 2_000_000
    discount: float = 0.7
    strength: float = 2.0
    parent_discount: float = 0.6
    parent_strength: float = 5.0
    burn_in: int = 1
    sweeps: int = 3
    one_by_one: int = 48
    number_bits: int = 63
    slices: int = 4
    slice_tokens: int = 1_000_000
    chunk_tokens: int = 1_000_000


def uniform(keys: np.ndarray, step: int, seed: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on key, step and seed only, so that retried tasks seat alike."""
    x = keys.astype(np.uint64) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64) + np.uint64((seed + 1) * 0xD1B54A32D192ED03 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, keys: np.ndarray, seed: int, one_by_one: int = 48) -> np.ndarray:
    """Tables after seating `customers` of each dish one after another; `fresh` is the weight of a new table. From
    `one_by_one` customers on, seats are drawn for runs of customers, each as long as what sits already, by a
    normal draw around the expected number of new tables."""
    tables = (customers > 0).astype(np.float64)
    for i in range(1, one_by_one):
        open_ = customers > i
        if not open_.any():
            return tables
        k = np.flatnonzero(open_)
        chance = fresh[k] / (i - discount * tables[k] + fresh[k])
        tables[k] += uniform(keys[k], i, seed) < chance
    at, step = float(one_by_one), one_by_one
    while (customers > at).any():
        k = np.flatnonzero(customers > at)
        upto = np.minimum(customers[k], 2 * at)
        low, high = at - discount * tables[k] + fresh[k], upto - discount * tables[k] + fresh[k]
        mean = fresh[k] * np.log(np.maximum(high / low, 1.0))
        u, v = uniform(keys[k], step, seed), uniform(keys[k], step + 1, seed)
        normal = np.sqrt(-2 * np.log(np.maximum(u, 1e-300))) * np.cos(2 * np.pi * v)
        # a mean of less than 1 is drawn as whether any table opens
        new = np.where(mean < 1, (u < mean).astype(float), np.maximum(np.round(mean + normal * np.sqrt(mean)), 0))
        tables[k] += np.minimum(new, upto - at)
        at, step = 2 * at, step + 2
    return tables


def _seated(customers: str, fresh, key: str, discount: float, seed: int, one_by_one: int):
    """A column of tables, sampled."""

    @F.pandas_udf("double")
    def run(c: pd.Series, a: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series(seat(c.to_numpy(np.float64), a.to_numpy(np.float64), discount, k.to_numpy(np.int64), seed, one_by_one))

    return run(F.col(customers).cast("double"), fresh.cast("double"), F.col(key))


@dataclass
class Model:
    """What the tasks need: numbers of hot words, their parent probabilities, the back-off weight of each (1 where it is no
    context), and the averaged share of each hot pair, by sorted pair number. `bits`: of the numbers of other words."""

    ids: dict[bytes, int]
    counts: np.ndarray
    parent: np.ndarray
    back_off: np.ndarray
    pairs: np.ndarray
    shares: np.ndarray
    total: int
    distinct: int
    unknown: float
    bits: int


def number(word: bytes, bits: int) -> int:
    """The number of a word without a place: negative."""
    return -1 - (xxhash.xxh3_64_intdigest(word) >> (64 - bits))


def numbers(words: list[bytes], ids: dict[bytes, int], bits: int) -> np.ndarray:
    x = np.fromiter(map(ids.get, words, repeat(-1)), dtype=np.int64, count=len(words))
    for i in np.flatnonzero(x < 0).tolist():
        x[i] = number(words[i], bits)
    return x


def packed(values: np.ndarray, up: bool = False) -> bytes:
    """Numbers as bytes, those of the same significance side by side, because tables and shuffles compress them better so. `up`: they ascend, and their steps are kept."""
    values = np.diff(values, prepend=values.dtype.type(0)) if up else values
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpacked(data: bytes, kind: type, up: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(kind).reshape(-1)
    return np.cumsum(values, dtype=kind) if up else values


class Places(dict):
    """Places of words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


#: A chunk: some documents' ids, whether they train and how many tokens they have; its words, how often each comes in training, and the place of every token's word, packed.
CHUNK = "chunk long, counted array<boolean>, lens array<long>, words array<binary>, times array<long>, x binary"


def chunked(rows: DataFrame, size: int) -> DataFrame:
    """Documents (text, counted, and doc_id where there is one) as tokens, in chunks of `size` tokens or one document more."""
    ids = [T.StructField("ids", T.ArrayType(rows.schema["doc_id"].dataType))] if "doc_id" in rows.columns else []
    out = T.StructType(T.StructType.fromDDL(CHUNK).fields + ids)
    arrow = to_arrow_schema(out)

    def made(chunk: int, places: Places, x: list, counted: list, docs: list) -> pa.RecordBatch:
        lens = [len(v) for v in x]
        every = np.concatenate(x)
        times = np.bincount(every[np.repeat(counted, lens)], minlength=len(places))
        values = [chunk, counted, lens, list(places), times, packed(every), docs]
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, arrow)], schema=arrow)

    def run(batches):
        first, at = TaskContext.get().partitionId() << 32, 0
        places, x, counted, docs, held = Places(), [], [], [], 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist() if ids else repeat(None)
            for t, c, d in zip(batch.column("text").to_pylist(), batch.column("counted").to_pylist(), doc_ids):
                toks = tokens(t)
                x.append(np.fromiter(map(places.__getitem__, toks), dtype=np.int32, count=len(toks)))
                counted.append(c)
                docs.append(d)
                held += len(toks)
                if held >= size:
                    yield made(first + at, places, x, counted, docs)
                    places, x, counted, docs, held, at = Places(), [], [], [], 0, at + 1
        if x:
            yield made(first + at, places, x, counted, docs)

    return rows.mapInArrow(run, out)


def chunk_cut(rows: DataFrame, size: int) -> DataFrame:
    """`chunked` as a table, of which a task writes and reads a few chunks at once, however many it has."""
    with few_rows_in_a_group(rows.sparkSession):
        return lineage_cut(chunked(rows, size))


def flat(column, kind: type, up: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of packed ones, one row after the other, and how many each row has."""
    each = [unpacked(v, kind, up) for v in column.to_pylist()]
    return np.concatenate([np.zeros(0, kind), *each]), np.array([len(v) for v in each], dtype=np.int64)


def listed(values: np.ndarray, sizes: np.ndarray, up: bool = False) -> pa.Array:
    """A column of packed numbers, `sizes` in each row."""
    ends = np.cumsum(sizes)
    return pa.array([packed(values[a:b], up) for a, b in zip(ends - sizes, ends)], pa.binary())


def batch_of(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """`rows` rows of `schema`; columns that are not given are null, single values hold for all rows."""
    def whole(f):
        v = columns.get(f.name)
        return v if isinstance(v, pa.Array) else pa.nulls(rows, f.type) if v is None else pa.array(np.broadcast_to(v, rows), f.type)

    return pa.RecordBatch.from_arrays([whole(f) for f in schema], schema=schema)


def mixed(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A hash of each pair of numbers."""
    x = w.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) + u.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grouped(u: np.ndarray, w: np.ndarray, hash_=mixed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order in which equal pairs are neighbours and hashes ascend, where in it each pair starts, and the hashes in it."""
    h = hash_(u, w)

    def starts(order):
        new = np.ones(len(u), dtype=bool)
        new[1:] = (np.diff(u[order]) != 0) | (np.diff(w[order]) != 0)
        return new

    order = np.argsort(h, kind="stable")
    new = starts(order)
    if (new[1:] & (np.diff(h[order]) == 0)).any():
        # pairs that share a hash
        order = np.lexsort((w, u, h))
        new = starts(order)
    return order, np.flatnonzero(new), h[order]


def before(x: np.ndarray, lens: np.ndarray, end: int) -> np.ndarray:
    """What comes before each token: the end, for the first of a document."""
    u = np.empty_like(x)
    u[1:] = x[:-1]
    u[np.cumsum(lens) - lens] = end
    return u


@dataclass
class Chunk:
    """A row of `chunked` with its words numbered, and its distinct pairs: their order, starts, hashes and times in training."""

    number: int
    counted: np.ndarray
    lens: np.ndarray
    keys: np.ndarray
    x: np.ndarray
    u: np.ndarray
    order: np.ndarray
    starts: np.ndarray
    hashes: np.ndarray
    n: np.ndarray


def chunks(batch, ids: dict[bytes, int], bits: int) -> Iterator[Chunk]:
    for i in range(batch.num_rows):
        words, lens, counted = (batch.column(c)[i].values for c in ("words", "lens", "counted"))
        words, lens, counted = words.to_pylist(), lens.to_numpy(), counted.to_numpy(zero_copy_only=False).astype(bool)
        x = unpacked(batch.column("x")[i].as_py(), np.int32)
        keys = numbers(words, ids, bits)
        # every document has an end
        u = before(x, lens, words.index(END))
        order, starts, hashes = grouped(keys[u], keys[x])
        n = np.add.reduceat(np.repeat(counted, lens)[order].astype(np.int64), starts)
        yield Chunk(batch.column("chunk")[i].as_py(), counted, lens, keys, x, u, order, starts, hashes[starts], n)


#: Pairs by part. Kind PAIRS: (u, w, n) of those to sample. ASKED: packed places `asked` among the pairs of a chunk, of the pairs `at` those places of PAIRS. ONCE: places in a
#: chunk of pairs that another chunk has once. ONES: (u, w) of all other pairs.
PAIRS, ASKED, ONCE, ONES = range(4)
DEALT = "part int, kind int, chunk long, u array<long>, w array<long>, n array<long>, at binary, asked binary"


def pair_counts(rows: DataFrame, shared: Broadcast, parts: int, least: int, hot: float, ask: bool, bits: int) -> DataFrame:
    """The pairs of all chunks, counted: a chunk sends each of its pairs once to one of `parts` parts. Pairs of at least `least` are to be sampled. `ask`: whether the chunks'
    places are kept (but of pairs of hot words with `hot` or more, which the tasks will know), or else the pairs that come once."""
    sent = T.StructType.fromDDL("part int, chunk long, start long, u binary, w binary, n binary")
    sent_arrow, out_arrow = to_arrow_schema(sent), to_arrow_schema(T.StructType.fromDDL(DEALT))

    def send(batches):
        for batch in batches:
            for c in chunks(batch, shared.value, bits):
                first = c.order[c.starts]
                u, w, n = c.keys[c.u[first]], c.keys[c.x[first]], c.n
                if not ask:
                    u, w, n, c.hashes = u[n > 0], w[n > 0], n[n > 0], c.hashes[n > 0]
                part = (((c.hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
                own, start, sizes = np.unique(part, return_index=True, return_counts=True)
                lists = {k: listed(v, sizes) for k, v in (("u", u), ("w", w), ("n", n))}
                yield batch_of(sent_arrow, len(own), part=own, chunk=c.number, start=start, **lists)

    def count(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        (u, sizes), (w, _), (n, _) = (flat(table.column(c), np.int64) for c in "uwn")
        order, starts, _ = grouped(u, w)
        total = np.add.reduceat(n[order], starts)
        pu, pw = u[order[starts]], w[order[starts]]
        of = np.empty(len(u), dtype=np.int64)
        of[order] = np.repeat(np.arange(len(starts)), np.diff([*starts, len(u)]))
        sampled = total >= least
        at = np.cumsum(sampled) - 1
        one = lambda kind, **lists: batch_of(out_arrow, 1, part=part, kind=kind, **{k: pa.array([v], out_arrow.field(k).type) for k, v in lists.items()})
        out = [one(PAIRS, u=pu[sampled], w=pw[sampled], n=total[sampled])]
        if not ask:
            once = (total > 0) & ~sampled
            return pa.Table.from_batches([*out, one(ONES, u=pu[once], w=pw[once])])
        chunk = table.column("chunk").to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(u)) - np.repeat(np.cumsum(sizes) - sizes - table.column("start").to_numpy(), sizes)
        known = sampled & ~((pu >= 0) & (pw >= 0) & (total >= hot))
        for kind, those in ((ASKED, known[of]), (ONCE, ((total > 0) & ~sampled)[of] & (n == 0))):
            each = np.bincount(row[those], minlength=len(sizes))
            lists = {"asked": listed(place[those].astype(np.int32), each, True)}
            if kind == ASKED:
                lists["at"] = listed(at[of[those]].astype(np.int32), each, True)
            out.append(batch_of(out_arrow, len(sizes), part=part, kind=kind, chunk=chunk, **lists))
        return pa.Table.from_batches(out)

    return rows.drop("times").mapInArrow(send, sent).groupBy("part").applyInArrow(count, DEALT)


def of_words(pairs: DataFrame, words: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """`pairs` joined by number with `words`: hot ones, at most hot_words, by a broadcast, so that no frequent word makes a large group; the many pairs of others
    are not sorted but stream past their words."""
    hot = pairs.filter(F.col(name) >= 0).join(F.broadcast(words.filter(F.col(name) >= 0)), name, how)
    return hot.unionByName(pairs.filter(F.col(name) < 0).join(words.filter(F.col(name) < 0).hint("shuffle_hash"), name, how))


@dataclass
class Tables:
    """What stays in Spark: `words` (word, key, n, parent, room, back) of all words, `pairs` (u, w, n, t) of all pairs with their averaged tables,
    and `sampled` (part, at, u, w, n, t) of those that were sampled, with their part and place there."""

    words: DataFrame
    pairs: DataFrame
    sampled: DataFrame


def train(docs: DataFrame, settings: Settings = Settings(), counted: Column | None = None) -> tuple[Model, DataFrame]:
    """The model, and (word, n, parent) of every training token. `docs`: text; `counted`: which rows train, all by default."""
    model, tables = trained(docs, settings, counted)
    return model, tables.words.filter("n > 0").select("word", "n", "parent")


def trained(docs: DataFrame, s: Settings, counted: Column | None = None) -> tuple[Model, Tables]:
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), (F.lit(True) if counted is None else counted).alias("counted"))
    with little_disk(docs.sparkSession):
        made = chunk_cut(rows, s.chunk_tokens)
        model, tables, _ = _trained(made, s, False)
        forget(made)
    return model, tables


def parts_of(s: Settings, total: int) -> int:
    """Parts that pairs and words are dealt to, for `total` training tokens."""
    return s.slices * max(1, math.ceil(total / (s.slices * s.slice_tokens)))


def _trained(made: DataFrame, s: Settings, ask: bool) -> tuple[Model, Tables, DataFrame]:
    """The model of some chunks, its tables, and the pairs by part. `ask`: for `pair_counts`; the table of pairs then lacks those that come once."""
    spark = made.sparkSession
    key = F.pandas_udf(lambda words: pd.Series([number(w, s.number_bits) for w in words], dtype="int64"), "long")
    counts = made.select(F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("n")))).groupBy("word").agg(F.sum("n").alias("n"))
    counts = lineage_cut(counts.select("word", key("word").alias("key"), "n"))
    shared = counts.groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter("words > 1")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct"), F.count(F.lit(1)).alias("words")).first()
    total, distinct = sums["total"], sums["distinct"]
    # hot_words at most, and the few words that share a hash, numbered by rank
    often = counts.filter(F.col("n") >= max(1, total / s.hot_words)).select("word", "n")
    often = often.union(counts.join(shared, "key", "left_semi").select("word", "n")).distinct().orderBy(F.desc("n"), "word").toPandas()
    ids = {bytes(w): i for i, w in enumerate(often["word"])}
    n = often["n"].to_numpy(np.int64)
    places = spark.createDataFrame(pd.DataFrame({"word": often["word"], "place": np.arange(len(n), dtype=np.int64)}), "word binary, place long")
    words = counts.join(F.broadcast(places), "word", "left").select("word", F.coalesce("place", "key").alias("key"), "n")
    is_context = F.col("n") >= max(1, s.context_share * total, s.word_share * total)
    smaller = bool(s.word_share or s.context_share or s.pair_share)
    parts = parts_of(s, total)
    with few_rows_at_once(spark):
        dealt = lineage_cut(pair_counts(
            made, spark.sparkContext.broadcast(ids), parts, 1 if smaller else 2, max(1, total / s.hot_pairs), ask, s.number_bits))
    pairs = dealt.filter(F.col("kind") == PAIRS).select("part", F.posexplode(F.arrays_zip("u", "w", "n")).alias("at", "pair")).select("part", "at", "pair.*")
    if smaller:
        pairs = pairs.filter(F.col("n") >= s.pair_share * total)
        pairs = pairs.join(words.filter(is_context).select(F.col("key").alias("u")), "u", "left_semi")
        pairs = lineage_cut(pairs.join(words.filter(F.col("n") >= s.word_share * total).select(F.col("key").alias("w")), "w", "left_semi"))
    # a word is a context as often as it is a token; what it has beside the sampled pairs are pairs that come once
    held = pairs.groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("sampled"))
    words = words.join(held, "key", "left").fillna(0, ["sampled"]).withColumn("held", F.col("sampled") if smaller else F.col("n"))
    words = counted_words = lineage_cut(words.withColumn("ones", F.col("held") - F.col("sampled")).drop("sampled"))
    forget(counts)
    none = F.lit(0.0)
    known = words.filter("n > 0").select("key", "n", "ones", F.xxhash64("word").alias("draw"), none.alias("kept"), none.alias("again"))

    base = 1.0 / (distinct + 1)
    seated = pairs.withColumn("t", F.lit(1.0)).withColumn("ts", F.lit(0.0))
    parent_tables = float(distinct)
    parents, last, chances = None, None, []
    for sweep in range(s.burn_in + s.sweeps):
        # the parent seats one customer for each table of a context, and one for each token outside the pairs of the model
        sent = seated.select(F.col("w").alias("key"), (F.col("n") - F.col("t")).alias("kept"))
        rooms = seated.select(F.col("u").alias("key"), F.col("t").alias("again"))
        fresh = F.lit((s.parent_strength + s.parent_discount * parent_tables) * base)
        # one shuffle of sums by word; only a word's own row has what is known of it
        served = known.unionByName(sent, allowMissingColumns=True).unionByName(rooms, allowMissingColumns=True)
        served = served.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", "ones", "draw", "kept", "again")]).select(
            "key", "draw", (F.col("n") - F.col("kept")).alias("k"), (F.col("ones") + F.col("again")).alias("tables"))
        served = lineage_cut(served.withColumn("t", _seated("k", fresh, "draw", s.parent_discount, 2 * sweep, s.one_by_one)).select("key", "k", "t", "tables"))
        mass = served.agg(F.coalesce(F.sum("k"), F.lit(0.0)).alias("k"), F.coalesce(F.sum("t"), F.lit(0.0)).alias("t")).first()
        parent_tables = mass["t"]
        whole = s.parent_strength + mass["k"]
        rest = (s.parent_strength + s.parent_discount * mass["t"]) / whole * base
        chance = served.select("key", ((F.col("k") - F.col("t") * s.parent_discount) / whole + rest).alias("p"), "tables")
        # every context seats the customers of its dishes anew, given the tables of its other dishes and the parent
        ready = of_words(of_words(seated, chance.select(F.col("key").alias("u"), "tables"), "u"), chance.select(F.col("key").alias("w"), "p"), "w")
        ready = ready.withColumn("weight", (s.strength + s.discount * (F.col("tables") - F.col("t"))) * F.col("p")).withColumn("draw", F.xxhash64("u", "w"))
        drawn = ready.withColumn("t", _seated("n", F.col("weight"), "draw", s.discount, 2 * sweep + 1, s.one_by_one))
        kept = F.col("ts") + F.col("t") if sweep >= s.burn_in else F.col("ts")
        with sized_shuffles(spark, sums["words"]):
            # a task holds its words hashed
            seated = lineage_cut(drawn.select("part", "at", "u", "w", "n", "t", kept.alias("ts")))
        if last is not None:
            forget(last)
        last = seated
        if sweep < s.burn_in:
            forget(served)
        else:
            chances.append(served)
            chance = chance.select("key", "p", F.lit(rest).alias("unknown"))
            parents = chance if parents is None else parents.unionByName(chance)
    parents = parents.groupBy("key").agg(F.avg("p").alias("parent"), F.avg("unknown").alias("unknown"))
    averaged = seated.select("part", "at", "u", "w", "n", (F.col("ts") / s.sweeps).alias("t"))
    rooms = averaged.groupBy(F.col("u").alias("key")).agg(F.sum("t").alias("again"))
    room = F.col("n") + F.lit(s.strength)
    tables = F.col("ones") + F.coalesce("again", F.lit(0.0))
    back = F.when(is_context, 1 - (F.col("held") - tables * s.discount) / room).otherwise(F.lit(1.0))
    words = lineage_cut(words.join(rooms, "key", "left").join(parents, "key", "left").select(
        "word", "key", "n", "parent", "unknown", room.alias("room"), back.alias("back")))
    for table in (counted_words, *chances, *[pairs] * smaller):
        forget(table)
    pairs = averaged.drop("part", "at")
    if not ask:
        ones = dealt.filter(F.col("kind") == ONES).select(F.inline(F.arrays_zip("u", "w")))
        pairs = pairs.unionByName(ones.withColumn("n", F.lit(1).cast("long")).withColumn("t", F.lit(1.0)))
    # hot_words and hot_pairs rows at most come back
    hot = words.filter("key >= 0").orderBy("key").select("parent", "back", "room").toPandas()
    got = pairs.filter(is_hot(s, total)).toPandas()
    at = got["u"].to_numpy(np.int64)
    keys = at * max(len(n), 1) + got["w"].to_numpy(np.int64)
    share = (got["n"].to_numpy(np.float64) - s.discount * got["t"].to_numpy(np.float64)) / hot["room"].to_numpy(np.float64)[at]
    order = np.argsort(keys)
    unknown = words.agg(F.max("unknown")).first()[0]
    model = Model(
        ids, n, hot["parent"].to_numpy(np.float64), hot["back"].to_numpy(np.float64), keys[order], share[order], total, distinct,
        1.0 if unknown is None else float(unknown), s.number_bits)
    return model, Tables(words.drop("unknown"), pairs, averaged), dealt


def is_hot(s: Settings, total: int) -> Column:
    return (F.col("u") >= 0) & (F.col("w") >= 0) & (F.col("n") >= max(1, total / s.hot_pairs))


#: What a chunk is told, packed. Kind WORD: n, parent and back of the words at places `asked` of the chunk. PAIR: what the pairs at those places have of their own, times `room`.
#: ONE: the places of pairs that another chunk has once.
WORD, PAIR, ONE = range(3)
TOLD = "chunk long, kind int, asked binary, a binary, b binary, c binary"


def word_asks(made: DataFrame, ids: Broadcast, parts: int, bits: int) -> DataFrame:
    """What the chunks ask of the words without a place: each once for each of its words, by part."""
    sent = T.StructType.fromDDL("part int, chunk long, asked binary, keys binary")
    sent_arrow = to_arrow_schema(sent)

    def ask(batches):
        for batch in batches:
            for chunk, names in zip(batch.column("chunk").to_pylist(), batch.column("words")):
                keys = numbers(names.values.to_pylist(), ids.value, bits)
                asked = np.flatnonzero(keys < 0)
                part = (-1 - keys[asked]) % parts
                order = np.argsort(part, kind="stable")
                own, sizes = np.unique(part, return_counts=True)
                yield batch_of(sent_arrow, len(own), part=own, chunk=chunk, asked=listed(asked[order].astype(np.int32), sizes, True),
                               keys=listed(keys[asked][order], sizes))

    return made.select("chunk", "words").mapInArrow(ask, sent)


def word_answers(asks: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """TOLD of the words that chunks asked for."""
    told = to_arrow_schema(T.StructType.fromDDL(TOLD))

    def answer(asks: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column("key").to_numpy()
        order = np.argsort(keys)
        wanted, sizes = flat(asks.column("keys"), np.int64)
        at = order[np.searchsorted(keys, wanted, sorter=order)] if len(wanted) else wanted
        values = {k: listed(known.column(c).to_numpy()[at], sizes) for k, c in (("a", "n"), ("b", "parent"), ("c", "back"))}
        return pa.Table.from_batches([batch_of(
            told, asks.num_rows, chunk=asks.column("chunk").to_numpy(), kind=WORD, asked=asks.column("asked").combine_chunks(), **values)])

    known = words.filter("key < 0").select(F.pmod(-1 - F.col("key"), F.lit(parts)).cast("int").alias("part"), "key", F.col("n").cast("double").alias("n"), "parent", "back")
    return asks.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(answer, TOLD)


def pair_answers(dealt: DataFrame, sampled: DataFrame, discount: float) -> DataFrame:
    """TOLD of the sampled pairs that chunks asked for."""
    told = to_arrow_schema(T.StructType.fromDDL(TOLD))

    def answer(asks: pa.Table, known: pa.Table) -> pa.Table:
        at, sizes = flat(asks.column("at"), np.int32, True)
        places = known.column("at").to_numpy()
        own = np.full(max(at.max(initial=-1), places.max(initial=-1)) + 1, np.nan)
        own[places] = known.column("own").to_numpy()
        own = own[at]
        there = ~np.isnan(own)
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[there], minlength=len(sizes))
        return pa.Table.from_batches([batch_of(
            told, asks.num_rows, chunk=asks.column("chunk").to_numpy(), kind=PAIR,
            asked=listed(flat(asks.column("asked"), np.int32, True)[0][there], sizes, True), a=listed(own[there], sizes))])

    asks = dealt.filter((F.col("kind") == ASKED) & (F.length("at") > 0)).select("part", "chunk", "at", "asked")
    known = sampled.select("part", "at", (F.col("n") - F.col("t") * discount).alias("own"))
    return asks.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(answer, TOLD)


def scored(docs: DataFrame, fold: int = 7, held_out: int = 2, settings: Settings = Settings()) -> DataFrame:
    """All documents: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    with little_disk(docs.sparkSession):
        return _scored(docs, fold, held_out, settings)


def _scored(docs: DataFrame, fold: int, held_out: int, s: Settings) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), fold) != held_out).alias("counted"), F.coalesce("text", F.lit("")).alias("text"))
    made = chunk_cut(rows, s.chunk_tokens)
    model, tables, dealt = _trained(made, s, True)
    shared, ids = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(model.ids)
    room = float(model.total + model.distinct + 1)
    # in a model of everything, a pair that training texts of the chunk have and that nobody answers comes once
    alone = 0.0 if s.word_share or s.context_share or s.pair_share else 1 - s.discount
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(
        "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])
    arrow = to_arrow_schema(out)

    def run(left: pa.Table, told: pa.Table) -> pa.Table:
        m = shared.value
        width = max(len(m.ids), 1)
        [batch] = left.combine_chunks().to_batches()
        [c] = chunks(batch, m.ids, m.bits)
        n, parent, back = np.zeros(len(c.keys)), np.full(len(c.keys), np.nan), np.ones(len(c.keys))
        often = c.keys >= 0
        n[often], parent[often], back[often] = (v[c.keys[often]] for v in (m.counts, m.parent, m.back_off))
        own = np.where(c.n > 0, alone, 0.0)
        kind = told.column("kind").to_numpy()
        for k, values in ((WORD, (n, parent, back)), (PAIR, (own,)), (ONE, ())):
            rows = told.filter(pa.array(kind == k))
            at, _ = flat(rows.column("asked"), np.int32, True)
            for v, name in zip(values, "abc"):
                v[at], _ = flat(rows.column(name), np.float64)
            if k == ONE:
                own[at] = 1 - s.discount
        parent[np.isnan(parent)] = m.unknown
        # p by pair, then by token
        first = c.order[c.starts]
        u, w = c.u[first], c.x[first]
        share = own / (n[u] + s.strength)
        if len(m.pairs):
            both = np.flatnonzero((c.keys[u] >= 0) & (c.keys[w] >= 0))
            key = c.keys[u[both]] * width + c.keys[w[both]]
            at = np.minimum(np.searchsorted(m.pairs, key), len(m.pairs) - 1)
            found = m.pairs[at] == key
            share[both[found]] = m.shares[at[found]]
        logs = np.empty(len(c.x))
        logs[c.order] = np.repeat(np.log10(back[u] * parent[w] + share), np.diff([*c.starts, len(c.x)]))
        starts = np.cumsum(c.lens) - c.lens
        total = lambda v: np.add.reduceat(v, starts)
        columns = [batch.column("ids")[0].values, pa.array(~c.counted), pa.array(c.lens), pa.array(total((n > 0)[c.x].astype(np.int64))),
                   pa.array(np.full(len(c.lens), m.total)), pa.array(total(np.log10((n + 1) / room)[c.x])), pa.array(total(logs))]
        return pa.Table.from_arrays([v.cast(f.type) for v, f in zip(columns, arrow)], schema=arrow)

    parts = parts_of(s, model.total)
    # chunks go to Python a few at a time, the many words of a part do not
    with few_rows_at_once(spark):
        asks = lineage_cut(word_asks(made, ids, parts, s.number_bits))
    told = lineage_cut(word_answers(asks, tables.words, parts))
    for table in (asks, tables.words):
        forget(table)
    once = dealt.filter((F.col("kind") == ONCE) & (F.length("asked") > 0)).select("chunk", F.lit(ONE).alias("kind"), "asked")
    more = lineage_cut(pair_answers(dealt, tables.sampled, s.discount).unionByName(once, allowMissingColumns=True))
    for table in (tables.sampled, dealt):
        forget(table)
    every = told.unionByName(more)
    result = lineage_cut(made.drop("times").groupBy("chunk").cogroup(every.groupBy("chunk")).applyInArrow(run, out))
    for table in (made, told, more):
        forget(table)
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
