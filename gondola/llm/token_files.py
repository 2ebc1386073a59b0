"""Token ids in binary files: one zstandard dictionary for all, every document compressed on its own.

A dictionary is trained on serialized id arrays of a bounded sample of documents and kept beside the files under its hash. Texts are
encoded and compressed where they are scanned, once; only the small frames are then sorted by id into files. A file holds

    header   magic, bytes of one id, SHA-256 of the dictionary (zeros: none)
    frames   of each document, in order: its ids, little-endian, as one zstandard frame with the shared dictionary
    index    Arrow stream of (doc_id, offset, n_tokens), one row per document
    footer   place and length of the index, magic

so that a short document is read with its own frame only (`TokenFile.ids`). Tasks write files of about `shard_bytes` under names of their own
and report them; the manifest, a table that Spark commits, names those that count, so repeated tasks of lost executors leave
at most files that nobody reads. Files lie in a shared folder: a local path all machines mount, or a store that pyarrow opens.

The tokenizer is never trained here; its file is a parameter. Byte-level BPE without a normalizer splits a text at places that are
known beforehand, whatever is around them; there texts are cut into pieces, and the library encodes each different piece once per
worker (at most `KNOWN` are kept). Texts with blanks outside ASCII or with a special token, and other tokenizers, are encoded whole.

Defined results: a null or empty text has no id but the end; ids ascend with null ids first; equal ids (repeated rows) are separate documents, by the
hash of their text, then as they were read; an empty table gives no file and an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from gondola.llm.common import map_batches, map_texts
from gondola.session import lineage_cut

MAGIC = b"IDFILE1\n"
HEAD = len(MAGIC) + 1 + 32
FOOT = 16 + len(MAGIC)
NO_DICTIONARY = bytes(32)
#: Pieces a worker remembers, and the length up to which it does.
KNOWN, SHORT = 1 << 20, 48
#: Bytes of ids that are handed on together.
CHUNK = 16 << 20

# A piece ends before the last of a run of blanks that something follows, and between letters and ASCII punctuation.
BLANK, FULL = r"[ \t\n\r\x0b\x0c]", r"[^ \t\n\r\x0b\x0c]"
LETTER = "[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ]"
PIECE = re.compile(rf"{BLANK}?{LETTER}+(?=[!-/:-@\[-`{{-~])|{BLANK}?{FULL}+(?:{BLANK}+(?!{FULL}))?|{BLANK}+(?!{FULL})")
#: Letters with or without a blank before them, and how byte-level vocabularies write bytes: printable ones as themselves, others from 256 on.
WORD = re.compile(f" ?{LETTER}+")
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
#: What some definition of a blank holds besides those of ASCII.
OTHER_BLANKS = "".join(map(chr, [
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))


class Encoder:
    """Texts to serialized ids with the tokenizer of a specification (the text of its file)."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(spec)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        facts = json.loads(spec)
        before = facts.get("pre_tokenizer") or {}
        self.in_pieces = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not facts.get("normalizer") and not facts.get("post_processor") and facts["model"]["type"] == "BPE")
        self.special = [t["content"] for t in facts.get("added_tokens") or [] if t["content"]]
        self.odd = re.compile(f"[{OTHER_BLANKS}]")
        self.known = Known(self)

    def serialized(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in made]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, serialized."""
        plain = [self.in_pieces and not self.odd.search(t) and not any(x in t for x in self.special) for t in texts]
        whole = iter(self.serialized([t for t, p in zip(texts, plain) if not p]))
        ids_of = self.known.__getitem__
        return [b"".join(map(ids_of, PIECE.findall(t))) if p else next(whole) for t, p in zip(texts, plain)]


class Known(dict):
    """Serialized ids by piece; what is not there is encoded, and kept while there is room."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.model = encoder, encoder.tokenizer.model

    def __missing__(self, piece: str) -> bytes:
        if WORD.fullmatch(piece):  # one token before merging, so that the merges alone are left to do
            tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(BYTES))
            ids = np.array([t.id for t in tokens], dtype=self.encoder.kind).tobytes()
        else:
            ids = self.encoder.serialized([piece])[0]
        if len(self) < KNOWN and len(piece) <= SHORT:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _encoder(spec: str) -> Encoder:
    return Encoder(spec)


@lru_cache(maxsize=4)
def _dictionary(raw: bytes, level: int) -> zstandard.ZstdCompressionDict | None:
    if not raw:
        return None
    made = zstandard.ZstdCompressionDict(raw)
    made.precompute_compress(level=level)
    return made


def name_of(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else NO_DICTIONARY


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def train_dictionary(docs: DataFrame, spec: str, size: int = 1 << 16, rows: int = 500, level: int = 3) -> bytes:
    """A dictionary of up to `size` bytes, from the ids of `rows` texts of up to 64 KB, chosen by hash, in pieces of 2 KB of which `8 * rows`
    come to the driver (8 MB by default). Too few texts give none."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    few = docs.filter(F.octet_length("text") <= 1 << 16).select(F.xxhash64("doc_id", "text").alias("h"), "text").orderBy("h", "text").limit(rows)

    def cut(batch):
        ids = _encoder(shared.value).encode(batch["text"])
        found = [(h, k, x[k:k + 2048]) for h, x in zip(batch["h"], ids) for k in range(0, len(x), 2048)]
        return {n: [f[i] for f in found] for i, n in enumerate(("h", "k", "piece"))}

    pieces = map_batches(few, "h long, k int, piece binary", cut).orderBy(F.xxhash64("h", "k"), "piece").limit(8 * rows).collect()
    try:
        return zstandard.train_dictionary(size, [bytes(r["piece"]) for r in pieces], level=level).as_bytes()
    except zstandard.ZstdError:  # the library wants several times the dictionary's size
        return b""


def frames(docs: DataFrame, spec: str, dictionary: bytes, end: int, level: int) -> DataFrame:
    """(doc_id, tie, row, n_tokens, frame): every document encoded, its end id appended, and compressed."""
    shared = docs.sparkSession.sparkContext.broadcast((spec, dictionary))
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"), "text")

    def run(texts):
        text_of, raw = shared.value
        encoder = _encoder(text_of)
        shut = np.array([end], dtype=encoder.kind).tobytes()
        press = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(raw, level))
        ids = [x + shut for x in encoder.encode(texts)]
        return {"n_tokens": [len(x) // encoder.kind.itemsize for x in ids], "frame": [press.compress(x) for x in ids]}

    return map_texts(rows, ["doc_id", "tie", "row"], "n_tokens long, frame binary", run)


def write(
    docs: DataFrame, folder: str, tokenizer: str, end: int = 0, level: int = 3, dictionary_rows: int = 500, shard_bytes: int = 64 << 20
) -> DataFrame:
    """Writes `docs` (doc_id, text) into `folder` in ascending order of ids, with the tokenizer in the file `tokenizer`. Returns the manifest: (part, shard,
    path, docs, tokens, bytes, start), one row per file; `start` counts the ids of all files before. Names of earlier files in the folder are never taken."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    itemsize = Encoder(spec).kind.itemsize
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    dictionary = train_dictionary(docs, spec, rows=dictionary_rows, level=level)
    disk, place = opened(folder)
    disk.create_dir(place, recursive=True)
    name = name_of(dictionary)
    if dictionary:
        with disk.open_output_stream(f"{place}/{name.hex()}.dictionary") as f:
            f.write(dictionary)
    made = lineage_cut(frames(docs, spec, dictionary, end, level))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    index_of = to_arrow_schema(made.select("doc_id", F.col("row").alias("offset"), "n_tokens").schema)
    out = T.StructType.fromDDL("part int, shard int, path string, docs long, tokens long, bytes long")
    arrow = to_arrow_schema(out)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        ids: list[pa.Array] = []
        counts: list[pa.Array] = []
        size = 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.ids"
            offsets = np.cumsum([HEAD, *map(len, held)])[:-1]
            index = pa.Table.from_arrays(
                [pa.chunked_array(ids), pa.array(offsets, pa.int64()), pa.chunked_array(counts)], schema=index_of)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, index_of) as w:
                w.write_table(index)
            tail = sink.getvalue().to_pybytes()
            fs, at = opened(path)
            with fs.open_output_stream(at) as f:
                f.write(MAGIC + bytes([itemsize]) + name)
                for x in held:
                    f.write(x)
                f.write(tail + (HEAD + size).to_bytes(8, "little") + len(tail).to_bytes(8, "little") + MAGIC)
            tokens = sum(c.to_numpy().sum() for c in counts)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "shard": shard, "path": path, "docs": len(held), "tokens": int(tokens), "bytes": HEAD + size + len(tail) + FOOT}], arrow)

        for b in batches:
            body, first = b.column("frame"), 0
            for i in range(b.num_rows):
                x = body[i].as_py()
                held.append(x)
                size += len(x)
                if size >= shard_bytes or i == b.num_rows - 1:
                    ids.append(b.column("doc_id").slice(first, i + 1 - first).cast(index_of.field(0).type))
                    counts.append(b.column("n_tokens").slice(first, i + 1 - first))
                    first = i + 1
                if size >= shard_bytes:
                    yield flush()
                    held, ids, counts, size, shard = [], [], [], 0, shard + 1
        if held:
            yield flush()

    spread = made.repartitionByRange(*order).sortWithinPartitions(*order)
    files = lineage_cut(spread.select("doc_id", "n_tokens", "frame").mapInArrow(put, out))
    # one row per file, each of about shard_bytes
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


class TokenFile:
    """One file: its index, and the ids of single documents."""

    def __init__(self, path: str):
        fs, self.at = opened(path)
        self.file = fs.open_input_file(self.at)
        head = self.file.read_at(HEAD, 0)
        tail = self.file.read_at(FOOT, self.file.size() - FOOT)
        if head[: len(MAGIC)] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"not a whole file of token ids: {path}")
        self.kind = np.dtype(f"<u{head[len(MAGIC)]}")
        self.name = head[len(MAGIC) + 1:]
        place, length = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:16], "little")
        self.index = pa.ipc.open_stream(self.file.read_at(length, place)).read_all()
        self.edges = np.append(self.index["offset"].to_numpy(), place)
        raw = b""
        if self.name != NO_DICTIONARY:
            with fs.open_input_file(f"{os.path.dirname(self.at)}/{self.name.hex()}.dictionary") as f:
                raw = f.read()
            if name_of(raw) != self.name:
                raise ValueError(f"another dictionary than {path} was written with")
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)

    def __len__(self) -> int:
        return self.index.num_rows

    def ids(self, k: int) -> np.ndarray:
        """The ids of the document at place `k`; only its frame is read."""
        a, b = int(self.edges[k]), int(self.edges[k + 1])
        return np.frombuffer(self.press.decompress(self.file.read_at(b - a, a)), dtype=self.kind)

    def runs(self, most: int) -> Iterator[tuple[int, list[bytes]]]:
        """(place of the first, serialized ids) of neighbouring documents, whose frames and ids take about `most` bytes."""
        width, counts = self.kind.itemsize, self.index["n_tokens"].to_numpy()
        a = 0
        while a < len(self):
            b, size = a, 0
            while b < len(self) and (b == a or size < most):
                size += int(counts[b]) * width
                b += 1
            low = int(self.edges[a])
            body = memoryview(self.file.read_at(int(self.edges[b]) - low, low))
            yield a, [self.press.decompress(body[int(self.edges[k]) - low:int(self.edges[k + 1]) - low]) for k in range(a, b)]
            a = b

    def close(self) -> None:
        self.file.close()


def read(manifest: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files: `ids` as little-endian unsigned 32-bit integers, `start` the
    ids of all documents before it. Every file is read by one task."""
    files = manifest.agg(F.count(F.lit(1))).first()[0]
    out = T.StructType.fromDDL(f"doc_id {id_type}, start long, n_tokens long, ids binary")
    arrow = to_arrow_schema(out)

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                f = TokenFile(path)
                counts = f.index["n_tokens"].to_numpy()
                starts = start + np.cumsum(counts) - counts
                for first, found in f.runs(CHUNK):
                    here = slice(first, first + len(found))
                    bodies = [np.frombuffer(x, dtype=f.kind).astype("<u4").tobytes() for x in found]
                    yield pa.RecordBatch.from_arrays([
                        f.index["doc_id"].slice(first, len(found)).combine_chunks().cast(arrow.field(0).type),
                        pa.array(starts[here]), pa.array(counts[here]), pa.array(bodies, pa.binary())], schema=arrow)
                f.close()

    return manifest.select("path", "start").repartition(max(1, min(files, 20_000)), "path").mapInArrow(get, out)
