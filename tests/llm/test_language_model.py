import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import language_model
from gondola.llm.language_model import END, Settings, scored, seat, tokens, train, trained

FOLDER = "/root/testdata/sf0.01"


def plain_base(rows):
    """(held_out, n_tokens, n_known, N, base_score) per row, by the definition."""

    def toks(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]

    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(t for h, (_, text) in zip(held, rows) if not h for t in toks(text))
    n, v = sum(c.values()), len(c)
    return [(h, len(x), sum(c[t] > 0 for t in x), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in x))
            for h, x in ((h, toks(text)) for h, (_, text) in zip(held, rows))]


def test_base_columns_and_better_than_base_on_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = {d: e for (d, _), e in zip(rows, plain_base(rows))}
    # shares that leave many words and pairs out, so that the join is used
    got = scored(docs, settings=Settings(word_share=2e-5, context_share=1e-4, pair_share=1e-5)).collect()
    assert len(got) == len(rows)
    for r in got:
        h, n, known, total, base = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and math.isfinite(r["score"]) and r["score"] < 0
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.98


@pytest.mark.parametrize("settings", [Settings(), Settings(word_share=0.01, context_share=0.05, pair_share=0.02)])
def test_probabilities_sum_to_one(spark, documents, settings):
    text = "the cat sat on the mat and the dog sat on the cat " * 3
    model, words = train(documents([(i, text + "x" * i) for i in range(9)]), settings)
    every = {bytes(r["word"]): r["parent"] for r in words.collect()}
    assert abs(sum(every.values()) + model.unknown - 1) < 1e-9
    width = len(model.ids)
    share = dict(zip(model.pairs.tolist(), model.shares))
    for u, i in model.ids.items():
        back = model.back_off[i]
        seen = sum(share.get(i * width + j, 0.0) for j in range(width))
        assert abs(seen + back - 1) < 1e-9 and 0 < back <= 1, u
    assert END in every


def test_seats():
    rng_keys = np.arange(4000)
    one = seat(np.full(4000, 1.0), np.full(4000, 0.5), 0.5, rng_keys, 0)
    assert (one == 1).all() and (seat(np.zeros(3), np.ones(3), 0.5, np.arange(3), 0) == 0).all()
    # two customers: a second table with chance a / (1 - d + a)
    two = seat(np.full(4000, 2.0), np.full(4000, 0.5), 0.5, rng_keys, 1)
    assert abs(two.mean() - 1.5) < 0.04
    # seating in runs agrees with one by one
    slow = seat(np.full(4000, 300.0), np.full(4000, 2.0), 0.3, rng_keys, 2, 400)
    fast = seat(np.full(4000, 300.0), np.full(4000, 2.0), 0.3, rng_keys, 3, 48)
    assert abs(slow.mean() - fast.mean()) < 0.25 and (fast <= 300).all()
    assert (seat(np.full(9, 50.0), np.ones(9), 0.5, np.arange(9), 7) == seat(np.full(9, 50.0), np.ones(9), 0.5, np.arange(9), 7)).all()


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "some words"), (4, "x " * 20_000), (5, "Some WORDS here")]
    docs = documents(rows).withColumn("n", F.lit(1)).withColumn("word", F.lit("clash"))
    got = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in scored(docs).collect())
    assert got == sorted((n, k, round(b, 6)) for _, n, k, _, b in plain_base(rows))
    assert scored(documents([])).collect() == []
    only_held = [(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in scored(documents(only_held)).collect())
    assert tokens(" A\tb\x0bÉ ") == [b"a", b"b", "É".encode(), END]


def test_rare_pairs_count_and_the_hot_head_changes_nothing(documents):
    rare = "heron lagoon"
    docs = documents([(i, f"the cat sat on the mat number {i} and the dog " * 20) for i in range(60)] + [(100 + i, f"{rare} w{i}") for i in range(8)])
    model, tables = trained(docs, Settings(hot_words=30, hot_pairs=20))
    assert 0 < len(model.ids) <= 30 and 0 < len(model.pairs) <= 20
    key = {bytes(r["word"]): r["key"] for r in tables.words.collect()}
    pairs = {(r["u"], r["w"]): r["n"] for r in tables.pairs.collect()}
    assert pairs[key[b"heron"], key[b"lagoon"]] == 8 and pairs[key[b"lagoon"], key[b"w3"]] == 1
    few, every = (sorted((r["doc_id"], r["n_known"], r["base_score"], r["score"]) for r in scored(docs, settings=s).collect())
                  for s in (Settings(hot_words=30, hot_pairs=20), Settings(hot_words=30)))
    assert all(a[:2] == b[:2] and np.allclose(a[2:], b[2:], rtol=1e-9) for a, b in zip(few, every))
    # a pair far below the former shares is predicted from its context
    by_id = {r["doc_id"]: r["score"] for r in scored(documents(
        [(i, "the cat sat on the mat " * 20_000) for i in range(12)] + [(50 + i, rare) for i in range(6)] + [(90 + i, "lagoon heron") for i in range(1)])).collect()}
    assert by_id[50] > by_id[90] + 1


def test_registered_settings_predict_held_out_texts_better_than_the_base(spark):
    """All words and pairs: perplexity of the held-out documents, and every score again from the tables, token by token."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r["doc_id"]: r for r in scored(docs).collect()}
    held = [r for r in got.values() if r["held_out"]]
    n = sum(r["n_tokens"] for r in held)
    model, base = (10 ** (-sum(r[c] for r in held) / n) for c in ("score", "base_score"))
    assert model < 0.3 * base
    settings = Settings()
    counted = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7) != 2
    learned, tables = trained(docs.select("text", "doc_id"), settings, counted)
    words = {bytes(r["word"]): r for r in tables.words.collect()}
    pairs = {(r["u"], r["w"]): (r["n"], r["t"]) for r in tables.pairs.collect()}
    for r in docs.filter("doc_id % 7 < 2").select("doc_id", "text").collect():
        total, before = 0.0, words[END]
        for token in tokens(r["text"] or ""):
            w = words[token]
            p = before["back"] * (learned.unknown if w["parent"] is None else w["parent"])
            count, seats = pairs.get((before["key"], w["key"]), (0, 0.0))
            total += math.log10(p + (count - settings.discount * seats) / before["room"] if count else p)
            before = w
        assert abs(total - got[r["doc_id"]]["score"]) < 1e-6 * abs(total)


def test_words_that_share_a_hash_stay_apart(documents):
    """Four hashes for about eighty words: all that clash are numbered by place, those of held-out texts alone too."""
    rows = [(i, f"the cat sat on w{i} and v{i % 7} by w{i * 3}") for i in range(40)] + [(None, ""), (99, None)]
    docs = documents(rows)
    few = Settings(hot_words=5, hot_pairs=5, number_bits=2)
    expected = sorted((h, n, k, total, round(b, 6)) for h, n, k, total, b in plain_base(rows))
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    got = [(*(r[c] for c in names), round(r["base_score"], 6)) for r in scored(docs, settings=few).collect()]
    assert any(h for h, *_ in expected) and sorted(got) == expected
    model, tables = trained(docs, few)
    keys = [r["key"] for r in tables.words.collect()]
    assert len(set(keys)) == len(keys) and len(model.ids) > 5
    parents = tables.words.filter("n > 0").agg(F.sum("parent")).first()[0]
    assert abs(parents + model.unknown - 1) < 1e-9


def test_past_steps_leave_the_disk_and_slices_change_nothing(spark, documents, monkeypatch):
    rows = [(i, f"the cat sat on w{i % 9} and v{i % 7} by w{i * 3} " * (1 + i % 3)) for i in range(60)] + [(None, ""), (99, None), (100, "sat the sat the")]
    docs, made = documents(rows), []
    cut = language_model.lineage_cut

    def kept(df):
        made.append(cut(df))
        return made[-1]

    monkeypatch.setattr(language_model, "lineage_cut", kept)
    trained(docs, Settings())
    # words, pairs and the last seats; counts and earlier sweeps are gone
    left = [t for t in made if Path(t.inputFiles()[0].removeprefix("file:")).exists()]
    assert len(made) > 8 and len(left) == 3
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    few, one = (sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in scored(docs, settings=s).collect())
                for s in (Settings(hot_pairs=5, slices=3, slice_tokens=1), Settings(hot_pairs=5)))
    assert few == one and len(few) == len(rows)


def test_tasks_hold_a_chunk_and_chunks_change_nothing(documents):
    """Tokens and pairs are held for `chunk_tokens` tokens or one document more, not for a batch of documents."""
    rows = [(i, f"the cat sat on w{i % 9} and v{i % 7} by w{i * 3} " * (1 + i % 3)) for i in range(60)] + [(None, ""), (99, None), (100, "sat the sat the")]
    docs = documents(rows)
    made = language_model.chunked(docs.select("text", F.lit(True).alias("counted")).fillna(""), 40).select("lens").collect()
    assert len(made) > 15 and all(sum(r["lens"][:-1]) < 40 for r in made)
    assert sorted(n for r in made for n in r["lens"]) == sorted(len(tokens(t or "")) for _, t in rows)
    few, one = (sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in scored(docs, settings=s).collect())
                for s in (Settings(hot_words=5, hot_pairs=5, chunk_tokens=40), Settings(hot_words=5, hot_pairs=5)))
    assert few == one and len(few) == len(rows)


def test_pairs_that_share_a_hash_stay_apart():
    rng = np.random.default_rng(1)
    u, w = rng.integers(-9, 9, 2000), rng.integers(-9, 9, 2000)
    for hash_ in (language_model.mixed, lambda u, w: (u + w).astype(np.uint64) % np.uint64(5)):
        order, starts, h = language_model.grouped(u, w, hash_)
        assert (np.diff(h.astype(np.float64)) >= 0).all() and len(starts) == len(set(zip(u.tolist(), w.tolist())))
        assert Counter(zip(u.tolist(), w.tolist())) == Counter(dict(zip(zip(u[order[starts]].tolist(), w[order[starts]].tolist()), np.diff([*starts, len(u)]).tolist())))
