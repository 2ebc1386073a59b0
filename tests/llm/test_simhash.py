import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from gondola.llm.simhash import fingerprint, hex_digits, links, near_copies, one_of_each
from gondola.operators.kit import components


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {f: find(f) for f in fps}


TEXTS = ["", None, " \t\n", "one", "One two", "one two three", "a b c d e f g", "A B C D E F G", "a a a a a a a", "é É x y z w",
         "word " * 3000, "b\x0bc\x0cd\re", "𝒳 𝒴 𝒵 ñ"]


def test_fingerprint_is_the_definition():
    for t in TEXTS:
        assert fingerprint(t or "") & (2**64 - 1) == plain_fingerprint(t)


@pytest.mark.parametrize("crowded", [0, 3, 10_000])
def test_links_connect_what_brute_force_connects(spark, crowded):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(25)]
    fps = {0, 2**64 - 1}
    for b in base:
        at = b
        for _ in range(rng.randrange(12)):
            for _ in range(rng.randrange(1, 4)):
                at ^= 1 << rng.randrange(64)
            fps.add(at)
    hub = rng.getrandbits(64)  # a crowded neighbourhood
    fps |= {hub ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    found = {r["node"]: r["component"] for r in components(links(df, 2, crowded), "a", "b").collect()}
    expected = plain_components(signed)
    assert {f: found.get(f, f) for f in signed} == expected


def test_classes_and_defined_cases(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, "a b c d e f g"), (100, "a b c d e f g"), (None, "zz yy xx ww"), (None, None)]
    found = near_copies(documents(rows).withColumn("fp", F.lit(1)).withColumn("text_", F.lit(2)))
    got = sorted(((r["doc_id"], r["component_id"], r["h"]) for r in found.withColumn("h", hex_digits(F.col("fp"))).collect()), key=str)
    assert len(got) == len(rows)
    by_id = {d: c for d, c, _ in got if d is not None}
    assert by_id[0] == by_id[1] == by_id[2] == 0 and by_id[6] == by_id[7] == by_id[100] == 6
    assert all(len(h) == 16 for *_, h in got) and {h for d, _, h in got if d == 0} == {"0" * 16}
    assert sorted([c for d, c, _ in got if d is None], key=str) == [0, None]
    kept = one_of_each(documents(rows)).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([0, 3, 4, 5, 6, 8, 9, 10, 11, 12, None], key=str)
    assert near_copies(documents([])).collect() == [] and one_of_each(documents([])).collect() == []


def test_one_of_equal_rows_is_the_same_under_every_partitioning(documents):
    rows = [(1, "the same text in all of these rows", f"s{i}") for i in range(6)] + [(2, "quite another text with other words here", "x")]
    df = documents(rows).withColumn("__copy", F.lit("mine")).withColumn("__id", F.lit(7)).withColumn("_x", F.lit(None).cast("string"))
    kept = {tuple(sorted(map(str, one_of_each(df.repartition(n, "source")).collect()))) for n in (1, 2, 5)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2
    out = one_of_each(df)
    assert out.columns == df.columns and out.select("__copy", "__id").distinct().collect() == [("mine", 7)]
