import math

import pytest
from pyspark.sql import functions as F

from gondola.llm.mixing import mix, planned, schedule, sized, source_targets
from tests.llm.test_pipeline import plain_mix

TEXTS = ["one two three", "", None, "a b\x0bc d  e", "x " * 997, "y z " * 40]


def table(documents, n=60):
    rows = [(i, TEXTS[i % len(TEXTS)], ["b", "a", None, "tiny", "ß"][(i * i) % 5]) for i in range(n)]
    rows += [(1000, "one two", "tiny"), (1000, "one two", "tiny"), (None, "three four five", "a")]
    return documents(rows)


@pytest.mark.parametrize("block", [1, 7, 256])
def test_taken_is_the_repeated_line(documents, block):
    docs = table(documents, 60).filter("doc_id is not null and doc_id < 1000")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    got = {r["doc_id"]: r["taken"] for r in mix(docs, block=block).collect()}
    assert got == plain_mix(rows)


def test_targets_limits_and_defined_cases(documents):
    docs = table(documents).withColumn("size", F.lit("clash")).withColumn("place", F.lit(1)).withColumn("start", F.lit(2))
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"]
        by.setdefault(r["source"], []).append(r)
    for some in by.values():
        assert sum(r["size"] for r in some) == some[0]["source_size"]
        assert sum(r["taken"] for r in some) == math.floor(some[0]["target"] + 0.5)
    assert abs(sum(s[0]["target"] for s in by.values()) - sum(r["size"] for r in rows)) < 1e-6
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, rows)) == sorted(map(key, mix(docs.repartition(5)).collect()))
    assert mix(documents([])).collect() == [] and [r["taken"] for r in mix(documents([(1, None), (2, "")])).collect()] == [0, 0]


@pytest.mark.parametrize("block", [7, 64])
def test_first_slot_is_where_the_schedule_first_takes_a_document(spark, documents, block):
    docs = table(documents, 80).filter("doc_id is not null and doc_id < 1000")
    slots = sorted((r["at"], r["source_no"], r["block_no"], r["words"]) for r in schedule(source_targets(sized(docs)), block).collect())
    number = {s: i for i, s in enumerate(sorted({r["source"] for r in docs.collect()}, key=lambda s: (s is None, s or "")))}
    lines = {}
    for r in sorted(sized(docs).collect(), key=lambda r: (r["place"], r["doc_id"])):
        lines.setdefault(number[r["source"]], []).extend([r["doc_id"]] * r["size"])
    expected = {}
    for at, source, no, words in slots:
        for d in lines[source][no * block : no * block + words]:
            expected.setdefault(d, at)
    assert {r["doc_id"]: r["first_slot"] for r in mix(docs, block=block).collect() if r["first_slot"] is not None} == expected


def test_very_long_texts_and_very_many_copies(documents, monkeypatch):
    docs = documents([(1, "w " * 300_000, "a"), (2, "v", "a")] + [(7, "x y z", "b")] * 500 + [(8, "u " * 50, "c")])
    expected = sorted(tuple(r) for r in mix(docs).collect())
    assert len(expected) == 503 and sum(x[5] for x in expected if x[1] == "b") == math.floor(expected[2][4] + 0.5)
    monkeypatch.setattr("gondola.llm.mixing.CHUNK", 16)
    assert sorted(tuple(r) for r in mix(docs).collect()) == expected


def test_schedule_is_a_low_discrepancy_sequence(spark, documents):
    targets = source_targets(sized(table(documents, 300)))
    block = 16
    plan = {r["source_no"]: r for r in planned(targets, block).collect()}
    slots = sorted((r["at"], r["source_no"], r["rank"], r["block_no"], r["words"]) for r in schedule(targets, block).collect())
    total = sum(r["slots"] for r in plan.values())
    assert len(slots) == total == len({a for a, *_ in slots})
    seen = dict.fromkeys(plan, 0)
    for i, (_, source, rank, number, words) in enumerate(slots, 1):
        assert rank == seen[source] and number == rank % plan[source]["blocks"] and 0 < words <= block
        seen[source] += 1
        # every beginning of the mix holds nearly the right share of each source
        assert all(abs(seen[s] - i * r["slots"] / total) <= 2 + math.log2(total) for s, r in plan.items())
    assert seen == {s: r["slots"] for s, r in plan.items()}
