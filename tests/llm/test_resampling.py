import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gondola.llm import resampling as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def grams(text, longest):
    words = WORD.findall(lower(text or ""))
    return [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)


def plain(docs, target, longest=1, buckets=10_000, percent=10, least=20, seed="2024"):
    """The rows of the operator, one document after another. `docs`: (id, text)."""
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s = Counter(bucket(g) for _, t in docs for g in grams(t, longest)[0])
    t = Counter(bucket(g) for x in target for g in grams(x, longest)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found, words = grams(text, longest)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return Counter(tuple(r[:5]) for r in rows)


def found(df):
    return Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect())


def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)] + ["É", "naïve", "日本", "X1", "a"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 60))) + "!.") for i in range(200)]
    return docs, [" ".join(rng.choice(words[:60], 40)) for _ in range(20)]


@pytest.mark.parametrize("longest", [1, 3])
def test_same_as_one_after_another(spark, documents, longest):
    docs, target = corpus()
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert found(op.resampled(documents(docs).repartition(5), goal, longest)) == plain(docs, target, longest)


def test_defined_cases(spark, documents):
    """Nulls, empty and very long texts, words of every length, ties and repeated rows."""
    long = " ".join(f"word{i % 977}" for i in range(150_000))
    same = " ".join(["Same"] * 25)
    docs = [(1, None), (2, ""), (3, " \t\n--"), (4, "ab" * 5000), (5, long), (None, same), (None, same), (None, None), *[(7, same)] * 40, (8, same)]
    goal = spark.createDataFrame([("same word1 word2",), (None,)], "text string")
    assert found(op.resampled(documents(docs), goal)) == plain(docs, ["same word1 word2"])


def test_empty_tables(spark, documents):
    goal = spark.createDataFrame([], "text string")
    docs = [(1, " ".join(["x"] * 30)), (2, "y")]
    assert found(op.resampled(documents(docs), goal)) == plain(docs, [])
    assert op.resampled(documents([]), goal).collect() == []


def test_other_columns_do_not_matter(spark, documents):
    docs, target = corpus()
    df = documents(docs)
    for name in ("row", "score", "rank", "weight", "bucket", "n", "_slice", "position"):
        df = df.withColumn(name, df["lang"])
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    assert found(op.resampled(df, goal)) == plain(docs, target)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.binary(min_size=1, max_size=20), max_size=40), st.integers(0, 3))
def test_table_keeps_different_grams_apart(grams, bits):
    """Also where all hash values collide."""
    keys = np.array([zlib.crc32(g) & ((1 << bits) - 1) for g in grams], dtype=np.uint64)
    table = op.Table(grams, 1000, keys)
    owners = [grams[table.owner[s]] for s in table.slot]
    assert owners == grams
    times = Counter(grams)
    assert [table.count[s] for s in table.slot] == [times[g] for g in grams]
    assert [table.bucket[s] for s in table.slot] == [zlib.crc32(g) % 1000 for g in grams]


def test_texts_in_small_tables(monkeypatch, spark, documents):
    docs, target = corpus()
    monkeypatch.setattr(op, "TABLE_CHARS", 50)
    made = [(t.slot.shape[0], w, n) for t, w, n in op.tables([x for _, x in docs], 1, 10)]
    assert sum(n for n, _, _ in made) == sum(sum(s) for _, _, s in made) and len(made) > 50
    assert [x for _, w, _ in made for x in w] == [grams(t, 1)[1] for _, t in docs]
