import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm.repeats import anchors, matching_statistics, piece, repeated, without_repeats


def plain(texts, window):
    """(n_bytes, n_removed, n_spans, sha256 of what stays) of each text, from counting all windows."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - window + 1):
            if seen[r[i:i + window]] > 1:
                gone[i:i + window] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(bool(len(r)) and gone[0])
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_matching_statistics_by_definition():
    rng = random.Random(6)
    for alphabet in ("ab", "abcd\x00", "aé"):
        for _ in range(60):
            strings = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25))).encode() for _ in range(rng.randrange(1, 6))]
            strings += [rng.choice(strings)] * rng.randrange(2)
            got, starts = matching_statistics(strings)
            suffixes = [(k, i, s[i:]) for k, s in enumerate(strings) for i in range(len(s))]
            for (k, i, x), m in zip(suffixes, got.tolist()):
                best = max((next((n for n in range(min(len(x), len(y))) if x[n] != y[n]), min(len(x), len(y)))
                            for q, j, y in suffixes if (q, j) != (k, i)), default=0)
                assert m == best
            assert starts[-1] == sum(map(len, strings))


def test_every_window_has_its_anchor():
    rng = random.Random(8)
    for window in (12, 24, 200):
        text = "".join(rng.choice("abc ") for _ in range(3000)).encode() + b"xy" * 300
        where = set(anchors(text, window)[0].tolist())
        assert all(any(p in where for p in range(i, i + window - piece(window) + 1)) for i in range(len(text) - window + 1))
        value = dict(zip(*[x.tolist() for x in anchors(text, window)]))
        later = dict(zip(*[x.tolist() for x in anchors(b"other " * 9 + text, window)]))
        inner = [p for p in value if window <= p < len(text) - window]
        assert all(later[p + 54] == value[p] for p in inner)


def test_long_texts_are_cut_into_chunks():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 1000).astype(np.uint8).tobytes()
    text = rng.integers(97, 123, (1 << 20) - 500).astype(np.uint8).tobytes() + passage + b"z" + rng.integers(97, 123, 300_000).astype(np.uint8).tobytes()
    ours, theirs = dict(zip(*[x.tolist() for x in anchors(text)])), dict(zip(*[x.tolist() for x in anchors(passage)]))
    assert all(ours.get((1 << 20) - 500 + p) == v for p, v in theirs.items()) and len(ours) < len(text) / 50


def texts_with_repeats(rng, alphabet, n, passages):
    words = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [words(rng.randrange(10, 90)) for _ in range(passages)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(words(rng.randrange(40)) if rng.random() < 0.5 else rng.choice(shared))
        out.append("".join(parts))
    out += [rng.choice(out) for _ in range(n // 5)]
    for _ in range(n // 4):  # near copies
        t = list(rng.choice(out))
        for _ in range(rng.randrange(1, 3)):
            if t:
                t[rng.randrange(len(t))] = rng.choice(alphabet)
        out.append("".join(t))
    return out


@pytest.mark.parametrize("alphabet, crowd, bucket", [("abcdefgh é", 1 << 22, 1 << 20), ("ab", 1 << 22, 700), ("abcdefgh é", 60, 500), ("abc", 300, 900)])
def test_against_brute_force(documents, alphabet, crowd, bucket):
    rng = random.Random(len(alphabet) + crowd)
    texts = texts_with_repeats(rng, alphabet, 60, 6) + ["ab" * 100, None, "", None, "x" * 300]
    docs = documents(list(enumerate(texts))).withColumn("key", F.lit("clash")).withColumn("bytes", F.lit(1)).withColumn("a", F.lit(2))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in without_repeats(docs, 24, bucket, crowd).collect()}
    expected = dict(enumerate(plain(texts, 24)))
    assert got == expected
    assert any(0 < e[1] < e[0] for e in expected.values())


def test_defined_cases(documents):
    body = "".join(random.Random(3).choice("abcdefgh") for _ in range(500))
    rows = [(1, body), (1, body), (None, body[100:299]), (None, None), (4, ""), (5, body[50:250] + "tail"), (6, "z " * 20_000)]
    got = sorted((tuple(r[n] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in without_repeats(documents(rows)).collect()))
    assert got == sorted(plain([t for _, t in rows], 200))
    assert without_repeats(documents([])).collect() == []
    assert repeated([b"", b""]) == [[], []]


def test_bodies_are_what_the_hash_is_of(documents):
    docs = documents([(1, "a" * 500), (2, "short"), (3, None), (4, "x" + "a" * 300)])
    whole = {r["doc_id"]: r for r in without_repeats(docs).collect()}
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in whole.values())
    plain = without_repeats(docs, bodies=False)
    assert "kept" not in plain.columns
    assert {r["doc_id"]: r for r in without_repeats(docs).drop("kept").collect()} == {r["doc_id"]: r for r in plain.collect()}
