"""A clustered index for nearest neighbours by cosine: trained cells, inverted lists stored by cell, multi-probe search with exact scores.

Cell centres are trained on a bounded sample (spherical k-means); every vector of the corpus is then put into the list of its nearest centre. A query
visits the lists of its nearest centres, `probes` of them, and what it meets is scored exactly. How many probes a recall takes is measured, not guessed
(`probes_for`): a sample of the corpus asks the whole index. With `certain`, a second round visits every list that may still hold one of the k
best, by the list's angular radius and the k-th score of the first round, and the result is exact. Where that is more than `RUNS` lists a query, as with vectors
that form no clusters, neighbouring lists are taken as one, `RUNS` of them in all, and a query is copied once for each of these that it must visit.

The number of cells grows with the square root of the corpus; centres, counts and radii (one row per cell, `MOST_CELLS` at most) are what the driver and
the tasks hold. A long list is scored in blocks, and a list that many queries visit in chunks of queries, so neither ends in one task."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.operators.kit import top_n
from gondola.operators.vectors import _matrix, multiplier
from gondola.session import lineage_cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_CELLS = 4096
#: Numbers of the sample that the driver holds (64 MB), and vectors of it per cell.
SAMPLE_VALUES, PER_CELL = 1 << 23, 64
#: Copies of a query that the second round of a certain search makes at most, and the numbers and rows of a block there.
RUNS, BLOCK_VALUES, BLOCK_ROWS = 8, 1 << 22, 1 << 16
#: Scores are rounded to nine digits.
ROUNDING = 2e-9


@dataclass
class Index:
    """`lists`: (id, vector, [family], cell) sorted by cell; by cell the centre, the number of vectors and the largest angle to the centre."""

    lists: DataFrame
    centres: np.ndarray
    counts: np.ndarray
    radius: np.ndarray
    family: bool


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1.0)


def trained(sample: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """At most `cells` unit centres of the distinct rows of a sample; an emptied cell stays where it was."""
    rows = np.unique(unit(sample), axis=0)
    centres = rows[np.linspace(0, len(rows) - 1, min(cells, len(rows))).astype(int)]
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        order = np.argsort(near, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], near[order][1:] != near[order][:-1]]))
        moved = centres.copy()
        moved[near[order][starts]] = unit(np.add.reduceat(rows[order], starts, axis=0))
        if np.allclose(moved, centres, atol=1e-12):
            break
        centres = moved
    return centres


def build(corpus: DataFrame, cells: int | None = None, rounds: int = 8) -> Index:
    """The index over all of `corpus` (id, vector, and `family` where it has one). `cells`: the square root of the corpus by default, `MOST_CELLS` at
    most. The centres learn from at most PER_CELL vectors per cell, and SAMPLE_VALUES numbers, chosen by a hash of the id."""
    family = "family" in corpus.columns
    base = corpus.select("id", F.col("vector").cast("array<double>").alias("vector"), *(["family"] if family else []))
    facts = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    cells = max(1, min(MOST_CELLS, cells or math.ceil(math.sqrt(facts["n"]))))
    rows = max(1, min(PER_CELL * cells, SAMPLE_VALUES // max(1, facts["width"] or 1)))
    sample = base.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(rows).select("vector").toArrow().column("vector")
    centres = trained(_matrix(sample), cells, rounds) if facts["n"] else np.zeros((1, 1))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                cos = np.clip(_matrix(part.column("vector")) @ centres.T, -1.0, 1.0)
                near = cos.argmax(axis=1)
                angle = np.arccos(cos[np.arange(len(near)), near])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(near.astype(np.int32)), pa.array(angle)], [*part.schema.names, "cell", "angle"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    placed = lineage_cut(base.mapInArrow(place, f"{fields}, cell int, angle double"))
    counts, radius = np.zeros(len(centres), dtype=np.int64), np.full(len(centres), -10.0)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect():  # one row per cell
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    # stored by cell, a large one over several files: a search reads the parts that hold its cells
    lists = placed.drop("angle").repartitionByRange("cell", F.xxhash64("id")).sortWithinPartitions("cell", "id")
    return Index(lineage_cut(lists), centres, counts, radius, family)


def merged(index: Index, runs: int) -> np.ndarray:
    """The run of each list: lists whose centres lie side by side, cut into `runs` of about as many vectors."""
    toward = index.centres @ index.centres[int(index.counts.argmax())]
    order = np.argsort(toward, kind="stable")
    held = np.cumsum(index.counts[order])
    run = np.empty(len(order), dtype=np.int32)
    run[order] = np.minimum((held - index.counts[order] / 2) * runs // max(1, held[-1]), runs - 1)
    return run


def visits(
    index: Index, asked: DataFrame, probes: int, again: bool = False, floor: float = -1.0, run: np.ndarray | None = None, tally: bool = False
) -> DataFrame:
    """`asked` (query, vector, ...) once for every cell it visits: the `probes` nearest ones that are not empty; or, `again`, all that may
    hold a score of at least the query's `least`, or `floor`. With `run`, once for every run of such cells; with `tally`, only their number per batch, `n`."""
    centres, radius = index.centres, index.radius
    full = np.flatnonzero(index.counts)
    probes = min(probes, len(full))
    # the cells, or the runs and which cells are theirs
    place = full if run is None else np.unique(run[full])
    member = None if run is None else (run[full][:, None] == place).astype(np.float32)
    if not len(full):
        return asked.limit(0).select(F.lit(0).cast("long").alias("n")) if tally else asked.limit(0).withColumn("cell", F.lit(0))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                angle = np.arccos(np.clip(_matrix(part.column("vector")) @ centres[full].T, -1.0, 1.0))
                if again:
                    least = np.maximum(part.column("least").to_numpy(zero_copy_only=False).astype(float), floor)[:, None]
                    best = np.cos(np.maximum(angle - radius[full], 0.0))
                    wanted = best >= least - ROUNDING
                else:
                    wanted = np.zeros(angle.shape, dtype=bool)
                    np.put_along_axis(wanted, np.argsort(angle, axis=1, kind="stable")[:, :probes], True, axis=1)
                if tally:
                    yield pa.RecordBatch.from_arrays([pa.array([int(wanted.sum())], pa.int64())], ["n"])
                    continue
                row, cell = np.nonzero(wanted if run is None else wanted.astype(np.float32) @ member > 0)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(place[cell].astype(np.int32))], [*part.schema.names, "cell"])

    if tally:
        return asked.mapInArrow(visit, "n long")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema)
    return lineage_cut(asked.mapInArrow(visit, f"{fields}, cell int"))


def scored(
    index: Index, visiting: DataFrame, k: int, floor: float, corpus_rows: int, query_rows: int, run: np.ndarray | None = None
) -> tuple[DataFrame, int]:
    """((query, id, score) of the best rows of every visited block, number of vector pairs that are multiplied). `run`: what `visiting` calls a
    cell is a run of lists."""
    spark = visiting.sparkSession
    held, lists = index.counts, index.lists
    if run is not None:
        held = np.bincount(run, weights=index.counts).astype(np.int64)
        of = F.broadcast(spark.createDataFrame([(i, int(r)) for i, r in enumerate(run)], "cell int, run int"))
        lists = lists.join(of, "cell").drop("cell").withColumnRenamed("run", "cell")
    # one row per cell
    seen = {r["cell"]: r["n"] for r in visiting.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(c, max(1, math.ceil(int(held[c]) / corpus_rows)), math.ceil(n / query_rows)) for c, n in sorted(seen.items())]
    plan = F.broadcast(spark.createDataFrame(rows, "cell int, blocks int, chunks int"))
    lists = lists.filter(F.col("cell").isin([c for c, _, _ in rows])).join(plan, "cell")
    left = lists.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = visiting.join(plan, "cell").withColumn("chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    kinds = {n: t for n, t in [*index.lists.dtypes, *visiting.dtypes]}
    pair, extra = ["cell", "block", "chunk"], ["family"] if index.family else []
    out = left.select(*pair, "id", "vector", *extra).groupBy(*pair).cogroup(right.select(*pair, "query", "vector", *extra).groupBy(*pair)).applyInArrow(
        multiplier(k, floor, index.family), f"query {kinds['query']}, id {kinds['id']}, score double")
    return out, sum(n * int(held[c]) for c, n in seen.items())


def search(
    index: Index, queries: DataFrame, k: int, probes: int, floor: float = -1.0, certain: bool = False, corpus_rows: int = 8192, query_rows: int = 1024
) -> DataFrame:
    """(query, id, score): up to `k` vectors per query, not below `floor`; of those in the `probes` nearest lists, or of all where `certain`. An index with
    families leaves pairs of the same family out. `queries`: query, vector, and `family` where the index has one."""
    return _search(index, queries, k, probes, floor, certain, corpus_rows, query_rows)[0]


def _search(index, queries, k, probes, floor=-1.0, certain=False, corpus_rows=8192, query_rows=1024) -> tuple[DataFrame, int]:
    asked = queries.select("query", F.col("vector").cast("array<double>").alias("vector"), *(["family"] if index.family else []))
    order = [F.desc("score"), F.col("id")]
    first, pairs = scored(index, visits(index, asked, probes), k, floor, corpus_rows, query_rows)
    best = top_n(first, ["query"], order, k)
    if not certain:
        return best, pairs
    best = lineage_cut(best)
    reached = best.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    left = asked.join(reached, "query", "left").withColumn("least", F.coalesce("least", F.lit(-1.0)))
    total, wanted = asked.count(), visits(index, left, probes, True, floor, tally=True).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    run = None
    if wanted > RUNS * total:
        # a query is copied RUNS times at most; blocks grow with the corpus, up to what a task holds
        run = merged(index, RUNS)
        most = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, index.centres.shape[1])))
        corpus_rows = max(corpus_rows, min(most, math.ceil(int(index.counts.sum()) / RUNS)))
        query_rows = max(query_rows, min(most, math.ceil(total / RUNS)))
    # what the first round found is among what the second visits
    more, further = scored(index, visits(index, left, probes, True, floor, run).drop("least"), k, floor, corpus_rows, query_rows, run)
    return top_n(more, ["query"], order, k), pairs + further


def probes_for(index: Index, k: int, recall: float = 0.95, sample: int = 64) -> int:
    """The least number of probes that finds a share of `recall` of the `k` nearest neighbours of `sample` vectors of the corpus itself (which ask
    the whole index; at most sample * (k + 1) rows come back)."""
    asked = index.lists.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit(3)), "id").limit(sample).withColumnRenamed("id", "query").drop("cell")
    asked = lineage_cut(asked)
    cells = len(index.centres)
    found = search(index, asked, k + 1, cells).filter(F.col("query") != F.col("id"))  # without the vector itself
    hits = found.join(index.lists.select("id", "cell"), "id").select("query", "cell").collect()
    angle = {r["query"]: unit(np.array([r["vector"]], dtype=float)) @ index.centres.T for r in asked.collect()}
    full = index.counts > 0
    # how many lists are nearer than that of the hit
    ranks = []
    for r in hits:
        cos = angle[r["query"]][0]
        ranks.append(int(((cos > cos[r["cell"]]) & full).sum()) + 1)
    return sorted(ranks)[max(0, math.ceil(recall * len(ranks)) - 1)] if ranks else cells
