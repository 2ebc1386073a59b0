import random

import pytest
from pyspark.sql import functions as F

from gondola.llm.leaks import hits, leaked, search


def grams(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def plain_hits(text, items, threshold=0.8):
    out = []
    for item_id, body in sorted(set(items), key=str):
        width = min(5, len((body or "").split()))
        own, held = (grams(body, width), grams(text, width)) if width else ((), ())
        if own and len(own & held) >= threshold * len(own) - 1e-9:
            out.append((item_id, len(own & held), len(own)))
    return sorted(out, key=str)


def test_search_is_exact():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 15, 40])))) for i in range(120)]
    items += [(200, None), (201, ""), (7, items[7][1]), (7, "another text with the same id here"), (None, "w1 w2 w3 w4 w5 w6")]
    ready = search(items)
    for _ in range(400):
        parts = []
        for _ in range(rng.randrange(5)):
            body = (rng.choice(items)[1] or "").split()
            cut = rng.randrange(3) if rng.random() < 0.6 else 0  # loses a few words at the end
            parts += body[: len(body) - cut] + [rng.choice(words)] * rng.randrange(3)
        text = " ".join(parts).title()
        got = sorted(((h["item_id"], h["shared"], h["shingles"]) for h in ready.found(text)), key=str)
        assert got == plain_hits(text, items)


@pytest.mark.parametrize("block_items", [2, 50_000])
def test_rows_and_defined_cases(spark, documents, block_items):
    item = "one two three four five six seven eight nine ten"
    items = [(1, item), (1, item), (2, "tiny item"), (None, "five words make one shingle"), (4, None), (5, " ")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    rows = [(1, f"before {item.upper()} after " + "x " * 30_000), (1, "nothing"), (2, "tiny item"), (3, "a tiny item"), (None, item), (6, None), (7, "")]
    docs = documents(rows).withColumn("item_id", F.lit("clash")).withColumn("found", F.lit(0))
    got = sorted(((r["doc_id"], r["item_id"], r["shared"], r["shingles"], r["containment"]) for r in hits(docs, benchmark, block_items=block_items).collect()), key=str)
    assert got == [(1, 1, 6, 6, 1.0), (2, 2, 1, 1, 1.0), (3, 2, 1, 1, 1.0), (None, 1, 6, 6, 1.0)]
    flagged = docs.filter(leaked(benchmark, F.col("text"), block_items=block_items)).collect()
    assert sorted((r["doc_id"] for r in flagged), key=str) == [1, 2, 3, None]
    assert hits(documents([]), benchmark).collect() == [] and hits(docs, benchmark.limit(0)).collect() == []
