import random

import numpy as np
from pyspark.sql import functions as F

from gondola.llm.toxicity import Detector, scored, segments, token_scores, tokens, train, units
from tests.llm.test_quality import ranks_well

FOLDER = "/root/testdata/sf0.01"


def plain_segments(values):
    """By the definition: split off a segment of the greatest total, then go on left and right of it."""

    def inside(a, b):
        best = max(((sum(values[i:j]), i - j, -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        i = -best[2]
        j = i - best[1]
        return [*inside(a, i), (i, j), *inside(j, b)]

    return inside(0, len(values))


def test_segments_are_all_maximal_ones():
    rng = random.Random(1)
    for _ in range(300):
        values = [rng.choice([-5, -3, -2, -1, 1, 2, 4, 7]) + rng.random() / 1000 for _ in range(rng.randrange(18))]
        found = segments(values)
        assert [(a, b) for a, b, _ in found] == plain_segments(values)
        assert all(abs(s - sum(values[a:b])) < 1e-9 for a, b, s in found)


def test_only_tokens_that_surely_differ_are_scored():
    scores = token_scores({b"bad": 50, b"the": 500, b"rare": 1}, {b"the": 50_000, b"bad": 5, b"rare": 90}, 5_000, 500_000)
    assert set(scores) == {b"bad"} and scores[b"bad"] > 2
    assert list(units(b"abcdef")) == [b"abcdef", b"abcd-", b"abcde-"]


def test_passages_are_found_where_they_are():
    found = Detector({b"vile": 5.0, b"nasty": 4.0}, -0.5, 0.1, 1.0)
    text = "calm " * 40 + "vile, NASTY vile " + "calm " * 40
    assert [(a, b) for a, b, _ in found.read(text)[1]] == [(40, 43)] and found.read("calm " * 40) == (-10.0, [])
    assert tokens("Été, A-b_3!") == ["Été".encode(), b"a", b"b", b"3"]


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.01", "0.1")  # about a tenth of the labelled texts are toxic
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert ranks_well(rows["score"].to_numpy(), rows["toxic"].to_numpy()) > 0.95
    clean, toxic = rows[rows["toxic"] == 0], rows[rows["toxic"] == 1]
    assert clean["predicted"].mean() < 0.03 and toxic["predicted"].mean() > 0.9


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "vile words"), (5, "x " * 20_000)]
    docs = documents(rows).withColumn("score", F.lit("clash")).withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, None), (77, 0, 0)], "doc_id long, quality int, toxic int")
    out = scored(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 and r["passages"] == 0 for r in out)
    assert {r["score"] for r in scored(docs, spark.createDataFrame([], labels.schema)).collect()} == {0.0}
    assert scored(documents([]), labels).collect() == []


def test_training_is_repeatable(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    a, b = train(docs, labels, 300), train(docs.repartition(7), labels.repartition(3), 300)
    assert a.scores == b.scores and np.isclose([a.k, a.rate, a.slope, a.offset], [b.k, b.rate, b.slope, b.offset]).all()
