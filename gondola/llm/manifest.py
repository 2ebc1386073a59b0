"""A Merkle manifest of a dataset, as a log in postorder, with inclusion proofs.

Every row is a leaf. The leaves of a group (a language) form a tree in the order of their ids, whose every `width` consecutive nodes have a parent; the roots of
the groups, in order, form the tree above. H is SHA-256 over the hex digits of the children.

Builders take aligned runs of `width ** levels` leaves and append the nodes of their subtree to the log in the order in which they are complete,
which is postorder. So the place of a node needs no search: before leaf i stand i leaves and floor(i / width) + floor(i / width**2) + ... inner
nodes, and a node of level h is h places after its last leaf (`position`). An aligned subtree is one stretch of the log, written as one row. The roots of
the subtrees are the leaves of the next tier, and so on, until every tree has its root; a billion rows make four tiers.

Proofs go back down: the siblings of a subtree root are addressed in its stretch by their positions, and what is above comes with the stretch
one tier up, so each stretch meets one row, and no path is gathered for more than one subtree at a time. The last tier folds leaf and siblings to the root.

Texts are hashed where they are scanned; what moves is a row of ids and digests. Places in a tree come from a range partitioning (`kit.order_positions`), so a
group that holds most rows is spread over all tasks.

Defined results: null values count as `-`; a null group is a group of its own, first; null ids are first, equal ids are ordered by their leaf, and a null
id counts as empty text where ids are chosen for tampering; repeated rows are leaves of their own; an empty table has no row and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gondola.llm.common import remainder
from gondola.operators.kit import order_positions
from gondola.session import lineage_cut

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a digest.
SIZE = 32


def joined(digests: Sequence[str]) -> str:
    """H over hex digests."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(leaves: int, width: int) -> int:
    """Levels above the leaves of a tree."""
    h, nodes = 0, leaves
    while nodes > 1:
        h, nodes = h + 1, -(-nodes // width)
    return h


def position(level: int, index: int, leaves: int, width: int) -> int:
    """The place in the log of a tree of the node `index` of a level."""
    last = min((index + 1) * width**level, leaves) - 1
    place, before = last + level, last // width
    while before:
        place, before = place + before, before // width
    return place


def stretch(digests: Sequence[str], first: int, leaves: int, width: int, levels: int) -> list[str]:
    """The nodes of an aligned subtree that begins at leaf `first` of a tree of `leaves`, in the order in which they are complete; at
    most `levels` levels above the leaves."""
    top = min(levels, height(leaves, width))
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(top + 1)]
    for leaf, digest in enumerate(digests, first):
        waiting[0].append(digest)
        log.append(digest)
        for level in range(top):
            if leaf + 1 < leaves and (leaf + 1) % width ** (level + 1):
                break
            node = joined(waiting[level])
            waiting[level] = []
            waiting[level + 1].append(node)
            log.append(node)
    return log


def siblings(first: int, leaf: int, leaves: int, width: int, levels: int) -> list[tuple[int, list[int]]]:
    """For every level of the stretch from leaf `first` on: the place of the leaf's ancestor in its run, and where in the stretch the run's nodes are."""
    start = position(0, first, leaves, width)
    out, index, nodes = [], leaf, leaves
    for level in range(min(levels, height(leaves, width))):
        run = range(index - index % width, min(index - index % width + width, nodes))
        out.append((index % width, [position(level, i, leaves, width) - start for i in run]))
        index, nodes = index // width, -(-nodes // width)
    return out


def split(raw: bytes) -> list[str]:
    return [raw[i:i + SIZE].hex() for i in range(0, len(raw), SIZE)]


# A path, as bytes: for each level the place in the run, the number of its nodes, and their digests.
def packed(path: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(bytes([place, len(run)]) + bytes.fromhex("".join(run)) for place, run in path)


def unpacked(raw: bytes) -> list[tuple[int, list[str]]]:
    out, at = [], 0
    while at < len(raw):
        place, n = raw[at], raw[at + 1]
        out.append((place, split(raw[at + 2:at + 2 + n * SIZE])))
        at += 2 + n * SIZE
    return out


def fold(node: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a node and its siblings give."""
    for place, run in path:
        node = joined([*run[:place], node, *run[place + 1:]])
    return node


def others(path: list[tuple[int, list[str]]]) -> str:
    """The siblings of a path, from left to right, level by level."""
    return "".join(x for place, run in path for i, x in enumerate(run) if i != place)


def value(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: dict[str, Column]) -> Column:
    """The digest of a row, as bytes."""
    return F.unhex(F.sha2(F.concat(*[value(c) for c in values.values()]), 256))


def leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", every: int = 3) -> DataFrame:
    """(doc_id, tree, digest, changed, row): `tree` names the group (null: no name), `changed` is the leaf after the text's A-Z were lower-cased, in the rows
    whose id's crc32 `every` divides, where that makes another leaf."""
    values = {c: F.col(c) for c in columns}
    lowered = {c: F.translate(c, UPPER, LOWER) if c == "text" else v for c, v in values.items()}
    tampered = (remainder(F.col("doc_id"), every) == 0) & F.col("text").rlike("[A-Z]")
    return docs.select(
        "doc_id", F.col(group).cast("string").alias("tree"), leaf(values).alias("digest"),
        F.when(tampered, leaf(lowered)).alias("changed"), F.monotonically_increasing_id().alias("row"))


def numbered(rows: DataFrame, order: Sequence[Column], group: Sequence[str]) -> DataFrame:
    """Adds `i`, the place of a leaf in its tree, and `n`, the leaves of the tree."""
    placed = order_positions(rows, group, order)
    return placed.withColumn("i", F.col("position") - 1).withColumnRenamed("group_rows", "n").drop("position")


@dataclass
class Forest:
    """The log of some trees: per tier a table (tree, part, n, nodes, ...) of stretches, and the roots (tree, root)."""

    tiers: list[DataFrame]
    roots: DataFrame
    width: int
    levels: int


def built(rows: DataFrame, width: int, levels: int, kept: Sequence[str] = ()) -> DataFrame:
    """One row per aligned run of `rows` (tree, i, n, digest, and columns to keep as arrays in the order of the leaves)."""
    span = width**levels
    kept_fields = [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in kept]
    out = T.StructType([
        T.StructField("tree", T.StringType()), T.StructField("part", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("nodes", T.BinaryType()), *kept_fields])
    arrow = to_arrow_schema(out)

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        first, n = table["i"][0].as_py(), table["n"][0].as_py()
        log = stretch([x.hex() for x in table["digest"].to_pylist()], first, n, width, levels)
        row = [[table["tree"][0].as_py()], [first // span], [n], [bytes.fromhex("".join(log))], *[[table[c].to_pylist()] for c in kept]]
        return pa.Table.from_arrays([pa.array(v, type=f.type) for v, f in zip(row, arrow)], schema=arrow)

    chosen = rows.select("tree", "i", "n", "digest", *kept, F.floor(F.col("i") / span).alias("_part"))
    return chosen.groupBy("tree", "_part").applyInArrow(build, out)


def grown(rows: DataFrame, width: int, levels: int, kept: Sequence[str] = ()) -> Forest:
    """All tiers over the leaves `rows`; `kept` columns stay with the lowest one."""
    span = width**levels
    tiers, roots = [], None
    while True:
        tier = lineage_cut(built(rows, width, levels, () if tiers else kept))
        tiers.append(tier)
        tops = tier.select("tree", F.col("part").alias("i"), F.ceil(F.col("n") / span).alias("n"), F.substring("nodes", -SIZE, SIZE).alias("digest"))
        whole = tops.filter("n = 1").select("tree", F.col("digest").alias("root"))
        roots = whole if roots is None else roots.unionByName(whole)
        rows = tops.filter("n > 1")
        # whether any tree goes on
        if rows.isEmpty():
            return Forest(tiers, roots, width, levels)


def with_paths(forest: Forest, above: DataFrame) -> DataFrame:
    """The lowest tier with `path`, the path from the root of each stretch upwards, and the other columns of `above` (tree, path, ...), which has a row for
    every tree."""
    span, width, levels = forest.width**forest.levels, forest.width, forest.levels
    carried = [c for c in above.columns if c not in ("tree", "path")]
    below = None
    for tier in reversed(forest.tiers):
        # null names meet null names
        tops = tier.filter(F.col("n") <= span).join(above.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        ready = tops
        if below is not None:
            inner = tier.filter(F.col("n") > span).join(below, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_i")))
            ready = ready.unionByName(inner.drop("_tree", "_i"))
        if tier is forest.tiers[0]:
            return ready
        out = T.StructType([
            T.StructField("_tree", T.StringType()), T.StructField("_i", T.LongType()), T.StructField("path", T.BinaryType()),
            *[above.schema[c] for c in carried]])
        below = ready.select("tree", "part", "n", "nodes", "path", *carried).mapInArrow(_children(out, span, width, levels, carried), out)
    raise ValueError("a forest has a tier")


def _children(out: T.StructType, span: int, width: int, levels: int, carried: Sequence[str]):
    """For a stretch the paths of all its leaves."""
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                first, nodes = r["part"] * span, split(r["nodes"])
                rows = []
                for i in range(first, min(first + span, r["n"])):
                    own = [(place, [nodes[k] for k in run]) for place, run in siblings(first, i, r["n"], width, levels)]
                    rows.append({"_tree": r["tree"], "_i": i, "path": packed(own) + r["path"], **{c: r[c] for c in carried}})
                yield pa.RecordBatch.from_pylist(rows, arrow)

    return run


def manifest(
    docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", every: int = 3, width: int = 8, levels: int = 3
) -> tuple[Forest, Forest, DataFrame]:
    """(the trees of the groups, the tree of their roots, its leaves). The lowest tier of the first keeps ids and changed leaves. The last is a
    table (group, i, n, digest), one row per group."""
    rows = lineage_cut(leaves(docs, columns, group, every))
    # rows with equal ids and leaves, however many, are told apart by their number and so spread over slices
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")]
    groups = grown(numbered(rows, order, ["tree"]), width, levels, ("doc_id", "changed"))
    tops = numbered(groups.roots.select(F.col("tree").alias("group"), F.col("root").alias("digest")), [F.col("group").asc_nulls_first()], [])
    tops = lineage_cut(tops)
    return groups, grown(tops.withColumn("tree", F.lit("")), width, levels, ("group",)), tops


def proofs(
    docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", every: int = 3, width: int = 8, levels: int = 3
) -> DataFrame:
    """All documents: doc_id, leaf, subroot, root, proof_sha256 (of all siblings on the way to the root), folded_root (from the changed leaf, where
    there is one), verified."""
    groups, top, _ = manifest(docs, columns, group, every, width, levels)
    kind = docs.schema["doc_id"].dataType
    root = top.roots.select("tree", F.expr("X''").alias("path"), "root")
    # the stretches of the tree of groups become one row per group: its path and its root
    span = width**levels
    out = T.StructType([T.StructField("tree", T.StringType()), T.StructField("path", T.BinaryType()), T.StructField("subroot", T.BinaryType()),
                        T.StructField("root", T.BinaryType())])
    arrow = to_arrow_schema(out)

    def of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                first, nodes, rows = r["part"] * span, split(r["nodes"]), []
                for k, name in enumerate(r["group"]):
                    own = [(place, [nodes[x] for x in run]) for place, run in siblings(first, first + k, r["n"], width, levels)]
                    digest = bytes.fromhex(nodes[position(0, first + k, r["n"], width) - position(0, first, r["n"], width)])
                    rows.append({"tree": name, "path": packed(own) + r["path"], "subroot": digest, "root": r["root"]})
                yield pa.RecordBatch.from_pylist(rows, arrow)

    above = lineage_cut(with_paths(top, root).mapInArrow(of_groups, out))
    ready = with_paths(groups, above)
    result = T.StructType([
        T.StructField("doc_id", kind), *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
        T.StructField("verified", T.BooleanType())])
    of_result = to_arrow_schema(result)

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                first, nodes, path = r["part"] * span, split(r["nodes"]), unpacked(r["path"])
                subroot, root, upper = r["subroot"].hex(), r["root"].hex(), others(path)
                known: dict[str, str] = {}  # roots by what a stretch folds to
                made = {f.name: [] for f in of_result}
                for x, (doc_id, changed) in enumerate(zip(r["doc_id"], r["changed"])):
                    levels_ = siblings(first, first + x, r["n"], width, levels)
                    own = [(place, [nodes[i] for i in run]) for place, run in levels_]
                    mine = own[0][1][own[0][0]] if own else nodes[0]
                    node = fold(mine if changed is None else changed.hex(), own)
                    if node not in known:
                        known[node] = fold(node, path)
                    row = (doc_id, mine, subroot, root, hashlib.sha256((others(own) + upper).encode()).hexdigest(), known[node], known[node] == root)
                    for name, v in zip(made, row):
                        made[name].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in of_result], schema=of_result)

    return ready.select("part", "n", "nodes", "path", "subroot", "root", "doc_id", "changed").mapInArrow(prove, result)
