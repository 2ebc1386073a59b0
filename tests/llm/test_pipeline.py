import math
from hashlib import md5

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from gondola.llm import quality
from gondola.llm.private import base_spans, masked
from tests.llm.test_leaks import plain_hits
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.01"


def plain_mix(rows):
    """doc_id -> taken, by repeating each source's shuffled line of words up to its target."""
    sizes = {d: len((text or "").encode().split()) for d, text, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s))
    total = {s: sum(sizes[d] for d, _, x in rows if x == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    full: set = set()
    while True:  # reshare what exceeds three times a source until nothing does
        rest = sum(total.values()) - sum(3 * total[s] for s in full)
        part = rest / max(1, sum(weight[s] for s in sources if s not in full))
        over = {s for s in sources if s not in full and part * weight[s] >= 3 * total[s]}
        if not over:
            break
        full |= over
    out = {}
    for s in sources:
        target = 3 * total[s] if s in full else part * weight[s]
        left = math.floor(target + 0.5)
        line = sorted((md5(f"{d}:{text}".encode()).hexdigest(), d) for d, text, x in rows if x == s)
        out |= {d: 0 for _, d in line}
        while left > 0:
            for _, d in line:
                take = min(left, sizes[d])
                out[d] += take
                left -= take
    return out


def test_stages_against_brute_force(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in quality.scored(documents, labels).filter("predicted = 1").collect()}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect() if r["doc_id"] in good]
    prints = {d: plain_fingerprint(t) for d, t, _ in rows}
    roots, first = plain_components(set(prints.values())), {}
    for d in sorted(prints):
        first.setdefault(roots[prints[d]], d)
    rows = [r for r in rows if r[0] in set(first.values())]
    rows = [r for r in rows if not plain_hits(r[1], items)]
    rows = [(d, masked(t, base_spans(t)), s) for d, t, s in rows]  # no pattern is sure in these texts
    got = {r["doc_id"]: r["taken"] for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == plain_mix(rows)


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, None, None), (1, None, None, None), (None, "", "a", 0), (3, "word " * 20_000, "a", 5), (4, "Fine text, with words.", None, 2)],
])
def test_defined_cases(spark, tmp_path, rows):
    names = ["doc_id", "text", "source", "n_chars", "score", "fp", "size", "__text"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    full = [(*r, "x", 1, 2, "y") for r in rows]
    table = pa.table({n: pa.array([r[i] for r in full], k) for i, (n, k) in enumerate(zip(names, kinds))})
    pq.write_table(table, tmp_path / "documents.parquet")
    for name in ("labels", "benchmark"):
        pq.write_table(pq.read_table(f"{FOLDER}/{name}.parquet").slice(0, 0), tmp_path / f"{name}.parquet")
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names and docs.schema == spark.read.parquet(str(tmp_path / "documents.parquet")).schema, name
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # the three texts without words are one class; of repeated rows one stays
    assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == ([1, 3, 4] if rows else [])
    assert all(r["taken"] <= 3 * r["size"] for r in out)


def test_masking_takes_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = corpus_pipeline.hide_personal_data(spark, docs, FOLDER).collect()
    assert len(after) == len(before) and all(r["n_chars"] == len(r["text"]) and not base_spans(r["text"]) for r in after)
    assert sum(before[r["doc_id"]] != r["text"] for r in after) > 10


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "leaks", "private", "mix"]
