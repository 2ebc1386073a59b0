import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gondola.llm import token_files as op

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, text):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, 0]


def plain(docs, path=BPE):
    """(id, start, ids) one document after another, null ids first."""
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = ids_of(path, text)
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def found(df):
    rows = sorted(df.collect(), key=lambda r: r["start"])
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in rows)
    return [(r["doc_id"], r["start"], np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist()) for r in rows]


def texts(n, seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Beta,", "don't", "naïve", "日本語", "x" * 60, "\n\n", "  ", "7-8", "été!", "🙂", "'s", "_"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(n)]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "files")


@pytest.mark.parametrize("n, shard_bytes", [(47, 1), (307, 2000), (307, 64 << 20)])
def test_round_trip(spark, documents, folder, n, shard_bytes):
    docs = [(i * 7 % n, t) for i, t in enumerate(texts(n))]
    files = op.write(documents(docs).repartition(6), folder, BPE, shard_bytes=shard_bytes)
    assert found(op.read(files)) == plain(docs)


def test_other_tokenizer_and_end(spark, documents, folder):
    docs = list(enumerate(texts(30)))
    files = op.write(documents(docs), f"file://{folder}", WORDS)
    assert found(op.read(files)) == plain(docs, WORDS)


def test_defined_cases(spark, documents, folder):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    odd = ["a\xa0 b", "a\n \xa0\n b", "<|endoftext|> x", "\x1c!a", "　 　x"]
    docs = [(1, None), (2, ""), (3, long), (None, "null id"), (9, "same"), (9, "same"), (9, "other"), *[(20 + i, t) for i, t in enumerate(odd)]]
    got = found(op.read(op.write(documents(docs), folder, BPE)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])  # noqa: E731  rows of one id are in the order of a hash
    assert sorted([(a, 0, c) for a, _, c in got], key=key) == sorted([(a, 0, c) for a, _, c in plain(docs)], key=key)
    assert [a for a, _, _ in got] == [a for a, _, _ in plain(docs)]
    assert [s for _, s, _ in got] == np.cumsum([0, *[len(c) for _, _, c in got]])[:-1].tolist()


def test_empty_table(spark, documents, folder):
    assert op.read(op.write(documents([]), folder, BPE)).collect() == []


def test_clashing_columns_and_text_ids(spark, documents, folder):
    df = documents([(i, t) for i, t in enumerate(texts(40))])
    for name in ("row", "tie", "frame", "n_tokens", "path", "start"):
        df = df.withColumn(name, df["lang"])
    df = df.withColumn("doc_id", df["doc_id"].cast("string"))
    rows = op.read(op.write(df, folder, BPE), "string").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(str(i) for i in range(40))
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == sorted(str(i) for i in range(40))


def test_short_access_and_dictionary(spark, documents, folder):
    docs = list(enumerate(texts(2000)))
    files = op.write(documents(docs).coalesce(1), folder, BPE).collect()
    assert sum(f["docs"] for f in files) == 2000
    want = dict((a, c) for a, _, c in plain(docs))
    for f in files:
        one = op.TokenFile(f["path"])
        assert one.name != op.NO_DICTIONARY
        for k in (0, len(one) // 2, len(one) - 1):
            assert one.ids(k).tolist() == want[one.index["doc_id"][k].as_py()]
        one.close()
    # another dictionary under the name in the header is noticed
    place = next(op.opened(folder)[0].get_file_info([f"{folder}/{one.name.hex()}.dictionary"]).__iter__()).path
    with open(place, "r+b") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="another dictionary"):
        op.TokenFile(files[0]["path"])
    with open(files[0]["path"], "r+b") as f:
        f.truncate(100)
    with pytest.raises(ValueError, match="not a whole file"):
        op.TokenFile(files[0]["path"])


def test_pieces_are_encoded_as_in_their_text():
    rng = random.Random(1)
    parts = [" ", "  ", "\n", " \n", "\t", "a", "Abc", "'s", "'", "!", "é", "1", "23", "\r\n", "日本", "’", "🙂", "_", "''", "´", "²", "ß,", "×", "\xa0", " "]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    with open(BPE, encoding="utf-8") as f:
        encoder = op.Encoder(f.read())
    assert encoder.in_pieces
    whole = Tokenizer.from_file(BPE)
    assert [np.frombuffer(x, dtype=encoder.kind).tolist() for x in encoder.encode(made)] == [
        whole.encode(t, add_special_tokens=False).ids for t in made]


def test_query_digest(spark):
    from gondola.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = {(a, s, len(c), zlib.crc32(np.array(c, dtype="<u4").tobytes())) for a, s, c in plain(docs)}
    rows = QUERIES["op12_token_files"](spark, folder).collect()
    assert {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(docs)
