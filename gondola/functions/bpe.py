"""Byte-pair tokens of a published vocabulary: texts cut at a number of tokens.

The vocabulary is a file of ranks (a line per token: its bytes in base64, its rank); its place is a parameter. A text is split into words by the
vocabulary's pattern; in a word, the neighbours whose union has the lowest rank are joined until no union is a token. Words that were merged before are
looked up. Cutting reads a text only as far as its budget goes."""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed value: how byte-level vocabularies of the first generation split texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a worker remembers, and the bytes up to which it does.
KNOWN, SHORT = 1 << 18, 64


class Vocabulary:
    def __init__(self, lines: bytes, pattern: str = PATTERN):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.words = regex.compile(pattern)
        self.known: dict[bytes, tuple[int, ...]] = {}

    def merged(self, word: bytes) -> tuple[int, ...]:
        """The tokens of a word. Candidate unions wait in a heap, so long words take n log n steps."""
        if word in self.ranks:
            return (self.ranks[word],)
        ends = list(range(1, len(word) + 1))  # where the part that starts here ends; 0 once it was joined to the left
        before = list(range(-1, len(word) - 1))
        waiting = [(self.ranks[word[i:i + 2]], i, i + 2) for i in range(len(word) - 1) if word[i:i + 2] in self.ranks]
        heapq.heapify(waiting)
        while waiting:
            _, start, end = heapq.heappop(waiting)
            middle = ends[start]
            # the union is stale once either part has grown or gone
            if not middle or middle >= len(word) or ends[middle] != end:
                continue
            ends[start], ends[middle] = end, 0
            if end < len(word):
                before[end] = start
                if (rank := self.ranks.get(word[start:ends[end]])) is not None:
                    heapq.heappush(waiting, (rank, start, ends[end]))
            left = before[start]
            if left >= 0 and (rank := self.ranks.get(word[left:end])) is not None:
                heapq.heappush(waiting, (rank, left, end))
        return tuple(self.ranks[word[i:e]] for i, e in enumerate(ends) if e)

    def parts(self, text: str) -> Iterator[tuple[int, ...]]:
        """The tokens of a text, word by word."""
        for m in self.words.finditer(text):
            word = m.group().encode()
            found = self.known.get(word)
            if found is None:
                found = self.merged(word)
                if len(self.known) < KNOWN and len(word) <= SHORT:
                    self.known[word] = found
            yield found

    def encode(self, text: str) -> list[int]:
        return [t for part in self.parts(text) for t in part]

    def decode(self, tokens: list[int]) -> str:
        """The text of some tokens; a letter that is cut in two becomes the replacement sign."""
        return b"".join(self.tokens[t] for t in tokens).decode("utf-8", "replace")

    def cut(self, text: str, budget: int) -> str:
        """The first `budget` tokens of a text; shorter texts stay as they are."""
        taken: list[int] = []
        for part in self.parts(text):
            taken += part
            if len(taken) > budget:
                return self.decode(taken[:budget])
        return text


@lru_cache(maxsize=2)
def _vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(lines, pattern)


def token_budget(df: DataFrame, text: Column, budget: int, vocabulary: str, pattern: str = PATTERN) -> Column:
    """`text` of `df` cut after `budget` tokens of the vocabulary in the file `vocabulary`; null stays null. The vocabulary travels with the query."""
    with open(vocabulary, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        known = _vocabulary(shared.value, pattern)
        return pd.Series([None if t is None else known.cut(t, budget) for t in texts], dtype=object)

    return run(text)
