import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm.quality import FEATURES, _shallow_tree, features, fit, scored, train

FOLDER = "/root/testdata/sf0.01"


def ranks_well(scores, labels):
    """Area under the ROC curve by counting pairs."""
    one, zero = scores[labels == 1], scores[labels == 0]
    return np.mean([(one > z).mean() + 0.5 * (one == z).mean() for z in zero])


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = scored(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(rows) > 50
    assert ranks_well(rows["score"].to_numpy(), rows["quality"].to_numpy()) > 0.97
    assert (rows["predicted"] == rows["quality"]).mean() > 0.95
    assert rows["score"].between(0, 1).all()


def test_a_pair_table_learns_what_single_features_cannot():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    single, paired = fit(x, y, pairs=0), fit(x, y, pairs=1)
    assert paired.pairs == [(0, 1)]
    assert ((paired.score(x) > 0.5) == y).mean() > 0.9 > ((single.score(x) > 0.5) == y).mean()


@pytest.mark.parametrize("text", ["", " \n\t", "a", "\n" * 5000, "word " * 50_000, "é𝒳\x00", "!!!"])
def test_features_are_finite(text):
    assert len(features(text)) == len(FEATURES) and np.isfinite(features(text)).all()


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "some words"), (4, "x " * 20_000)]
    docs = documents(rows).withColumn("score", F.lit("clash")).withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (4, None, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    out = scored(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    empty = spark.createDataFrame([], labels.schema)
    assert {r["score"] for r in scored(docs, empty).collect()} == {0.5}
    assert scored(documents([]), labels).collect() == []


def test_training_is_bounded_and_repeatable(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    a, b = train(docs, labels, 100), train(docs.repartition(7), labels.repartition(3), 100)
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables))


def test_scores_are_added_up_table_entries(spark):
    """Every score of the query again, by walking over the edges of every table."""
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = train(docs, labels)
    assert len(model.pairs) == 8 and len(model.tables) == len(FEATURES)

    def plain(text):
        x = features(text or "")
        total = model.base
        for f, table in enumerate(model.tables):
            total += table[sum(1 for e in model.edges[f] if e <= x[f])]
        for (a, b), table in zip(model.pairs, model.pair_tables):
            total += table[sum(1 for e in model.coarse[a] if e <= x[a])][sum(1 for e in model.coarse[b] if e <= x[b])]
        return 1 / (1 + math.exp(-total))

    expected = {r["doc_id"]: plain(r["text"]) for r in docs.select("doc_id", "text").collect()}
    got = scored(docs, labels).collect()
    assert len(got) == len(expected)
    for r in got:
        assert abs(r["score"] - expected[r["doc_id"]]) < 1e-9 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_a_shallow_tree_takes_the_best_cuts():
    """Both cuts against trying every place."""
    rng = np.random.default_rng(11)

    def worth(g, h):
        return g.sum() ** 2 / (h.sum() + 5.0)

    def cut(g, h):
        return max(((worth(g[:i], h[:i]) + worth(g[i:], h[i:]) - worth(g, h), -i) for i in range(1, len(g))), default=(0.0, 0))

    for _ in range(200):
        g, h = rng.normal(size=rng.integers(2, 12)), rng.random(12)
        h = h[: len(g)] + 0.01
        gain, at = cut(g, h)
        expected = np.zeros(len(g))
        if gain > 0:
            pieces = [slice(0, -at), slice(-at, len(g))]
            again = [cut(g[p], h[p]) for p in pieces]
            k = int(again[1][0] > again[0][0])
            if again[k][0] > 0:
                middle = pieces[k].start - again[k][1]
                pieces[k : k + 1] = [slice(pieces[k].start, middle), slice(middle, pieces[k].stop)]
            for p in pieces:
                expected[p] = g[p].sum() / (h[p].sum() + 5.0)
        assert np.allclose(_shallow_tree(g, h, 5.0), expected)
