import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.llm import manifest as op

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(row):
    return h("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS)


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes, width):
    """(root, siblings of each node, as (left, right) lists)."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, above = [], []
        for k in range(0, len(nodes), width):
            run = nodes[k:k + width]
            for j in range(len(run)):
                for i in owners[k + j]:
                    paths[i].append((run[:j], run[j + 1:]))
            up.append(h(run))
            above.append([i for o in owners[k:k + width] for i in o])
        nodes, owners = up, above
    return nodes[0], paths


def fold(node, path):
    for left, right in path:
        node = h([*left, node, *right])
    return node


def plain(rows, width=8):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], width) for g in names}
    if not names:
        return []
    root, tops = climb([trees[g][0] for g in names], width)
    out = []
    for g, top in zip(names, tops):
        for (_, _, own, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            key = "" if r["doc_id"] is None else str(r["doc_id"])
            node = leaf(r | {"text": lower(r["text"])}) if zlib.crc32(key.encode()) % 3 == 0 else own
            folded = fold(node, path + top)
            out.append((r["doc_id"], own, trees[g][0], root, h(x for a, b in path + top for x in a + b), folded, folded == root))
    return out


def table(spark, rows):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("source", "lang")],
                           T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame([tuple(r[c] for c in FIELDS) for r in rows], schema)


def row(doc_id, text, lang="en", source="a"):
    return {"doc_id": doc_id, "source": source, "lang": lang, "n_chars": None if text is None else len(text), "text": text}


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def rows_of(n, langs=("en", "de", None)):
    return [row(i * 31 % 1009, f"Text {i} É{'' if i % 2 else 'x'}", langs[i * i % 7 % len(langs)], None if i % 11 == 0 else "s") for i in range(n)]


@pytest.mark.parametrize("n, levels", [(1, 3), (73, 1), (73, 3), (700, 2)])
def test_same_as_plain_trees(spark, n, levels):
    rows = rows_of(n)
    assert found(op.proofs(table(spark, rows).repartition(3), levels=levels)) == sorted(plain(rows), key=str)


def test_other_width_and_many_groups(spark):
    rows = [row(i, f"Text {i}", f"l{i % 37}") for i in range(200)]
    assert found(op.proofs(table(spark, rows), width=3, levels=2)) == sorted(plain(rows, 3), key=str)


def test_defined_cases(spark):
    """Nulls in every column, empty and very long texts, repeated rows, one hot group."""
    rows = [row(None, None, None, None), row(None, "A", "en"), row(4, "", ""), row(5, "Ab " * 100_000), row(6, None)]
    rows += [row(7, "Same", "hot")] * 600 + [row(7, "Other", "hot")] + [row(i, "x", "hot") for i in range(100)]
    assert found(op.proofs(table(spark, rows))) == sorted(plain(rows), key=str)


def test_empty_table(spark):
    assert op.proofs(table(spark, [])).collect() == []


def test_clashing_columns(spark):
    rows = rows_of(90)
    df = table(spark, rows)
    for name in ("tree", "digest", "changed", "row", "i", "n", "nodes", "part", "path", "root", "position", "_slice"):
        df = df.withColumn(name, F.lit(1))
    assert found(op.proofs(df)) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 63, 64, 65, 200, 513])
def test_positions_are_those_of_the_log(leaves):
    """The closed form gives every node of the log its place, and stretches are parts of it."""
    width = 8
    digests = [f"{i:064x}" for i in range(leaves)]
    log = op.stretch(digests, 0, leaves, width, 20)
    level = digests
    for k in range(op.height(leaves, width) + 1):
        assert [log[op.position(k, i, leaves, width)] for i in range(len(level))] == level
        if len(level) > 1:
            level = [op.joined(level[i:i + width]) for i in range(0, len(level), width)]
    assert len(level) == 1 and op.position(op.height(leaves, width), 0, leaves, width) == len(log) - 1
    for first in range(0, leaves, 64):
        part = op.stretch(digests[first:first + 64], first, leaves, width, 2)
        start = op.position(0, first, leaves, width)
        assert log[start:start + len(part)] == part


def test_one_changed_letter_is_found(spark):
    rows = [row(i, "lower only" if i != 24 else "Upper", "en") for i in range(50)]
    bad = [r["doc_id"] for r in op.proofs(table(spark, rows)).filter("not verified").collect()]
    assert bad == ([24] if zlib.crc32(b"24") % 3 == 0 else [])
