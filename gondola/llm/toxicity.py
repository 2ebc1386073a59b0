"""Toxic passages by maximum-scoring segments.

Tokens, and their beginnings of four characters and more (languages that build words from parts), get the log-odds of toxic
against other labelled texts, with an informative Dirichlet prior (pooled frequencies plus a flat half). Only those that differ
surely and by much keep a score, one standard error below the estimate; all other tokens share a small negative one. One
linear scan per text then finds every maximal segment of positive total. By the extreme-value law of such totals, a text of n
tokens is expected to hold K n exp(-lambda S) segments of total S by chance; a passage is significant when that
expectation is low. A text's score is the logistic of a fit on the evidence of its significant passages, -log of that
expectation, over labelled texts that were left out of the counts.

Training uses a bounded, documented number of labelled rows. Spark counts in how many texts each token occurs; only tokens
of at least `least` toxic texts (a fixed number) come back. Scoring reads every whole text once, without a shuffle.

Defined results: a null or empty text has no passage and the score of a text without evidence; null ids and repeated rows are
scored like others; without labelled rows of both kinds all scores are 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import labelled_sample, map_batches, map_texts, remainder
from gondola.session import lineage_cut

#: Lower case for A-Z, a blank for ASCII characters that are neither letters nor digits; other characters stay.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(FOLD).split()


def units(word: bytes) -> Iterator[bytes]:
    """A token and its beginnings of 4 to 8 bytes, marked as such."""
    yield word
    for k in range(4, min(len(word), 9)):
        yield word[:k] + b"-"


@dataclass
class Detector:
    """Scores of tokens and beginnings, the score of other tokens, K and lambda of the extreme-value law, the logistic fit."""

    scores: dict[bytes, float]
    other: float = -0.05
    k: float = 0.1
    rate: float = 1.0
    slope: float = 0.0
    offset: float = -math.inf
    significant: float = 0.05
    known: dict[bytes, float] = field(default_factory=dict)

    def values(self, words: list[bytes]) -> list[float]:
        """The score of each token: the greatest of the token and its beginnings. Values are remembered, up to a
        size, because most tokens come again."""
        if len(self.known) > 200_000:
            self.known.clear()
        known, out = self.known, []
        for w in words:
            v = known.get(w)
            if v is None:
                v = known[w] = max((self.scores[u] for u in units(w) if u in self.scores), default=self.other)
            out.append(v)
        return out

    def expected(self, total: float, n: int) -> float:
        """How many segments of at least this total chance puts into n tokens."""
        return self.k * n * math.exp(-self.rate * total)

    def read(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The evidence of a text, and its significant passages: (first token, token after the last, total). Evidence is the sum
        of -log expectation over these passages, at most 60; without one, how far the best segment falls short, down to -10."""
        words = tokens(text)
        found = segments(self.values(words))
        if not found:
            return -10.0, []
        strong = [x for x in found if self.expected(x[2], len(words)) < self.significant]
        values = [-math.log(max(self.expected(x[2], len(words)), 1e-300)) for x in (strong or found)]
        if strong:
            return min(60.0, sum(values)), strong
        return max(-10.0, max(values) + math.log(self.significant)), []

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        if self.offset == -math.inf:
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -50, 50)))


def segments(values: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence, in one linear pass: (start, end, total), disjoint and in order. Each positive
    value opens a candidate, known by the running totals before and after it. The last candidate that begins at a lower total
    is joined with it if it also ends at a lower one. Candidates remember that predecessor, so the search skips those that
    cannot be it."""
    kept: list[tuple[int, int, float, float, int]] = []  # start, end, total before, total after, predecessor
    total = 0.0
    for i, v in enumerate(values):
        if v <= 0:
            total += v
            continue
        start, before, after = i, total, total + v
        total = after
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= after:
                break
            start, before, at = kept[j][0], kept[j][2], j
            j = kept[j][4]
            del kept[at:]
        kept.append((start, i + 1, before, after, j))
    return [(a, b, after - before) for a, b, before, after, _ in kept]


def token_scores(
    toxic: dict[bytes, int], clean: dict[bytes, int], n_toxic: int, n_clean: int,
    strength: float = 500.0, flat: float = 0.5, sure: float = 4.0, least: float = 1.5,
) -> dict[bytes, float]:
    """Log-odds less one standard error, of the tokens whose log-odds exceed `sure` standard errors and which then keep at least
    `least`. `strength` pseudo-counts are spread like the pooled counts, `flat` more go to every token."""
    scores = {}
    for w, y in toxic.items():
        x = clean.get(w, 0)
        prior = strength * (x + y) / (n_toxic + n_clean) + flat
        odds = math.log((y + prior) / (n_toxic + strength - y)) - math.log((x + prior) / (n_clean + strength - x))
        error = math.sqrt(1 / (y + prior) + 1 / (x + prior))
        if odds > sure * error and odds - error > least:
            scores[w] = odds - error
    return scores


def _held(sample: DataFrame, wanted: set[bytes] | None = None) -> tuple[DataFrame, int]:
    """(unit, n): in how many texts each unit occurs, of the wanted ones if given; and the sum over texts of distinct tokens."""

    def count(batch):
        bags = [set(tokens(t)) for t in batch["text"]]
        seen = Counter(u for bag in bags for u in {u for w in bag for u in units(w)} if wanted is None or u in wanted)
        return {"unit": [None, *seen], "n": [sum(map(len, bags)), *seen.values()]}

    rows = map_batches(sample.select("text"), "unit binary, n long", count).groupBy("unit").agg(F.sum("n").alias("n"))
    rows = lineage_cut(rows)
    total = rows.filter("unit is null").first()
    return rows.filter("unit is not null"), total["n"] if total else 0


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, fold: int = 4, held_out: int = 2, least: int = 3
) -> Detector:
    """A detector from at most `sample_rows` labelled documents outside the held-out fold: two thirds are counted, one
    third calibrates."""
    usable = remainder(F.col("doc_id"), fold) != held_out
    sample = lineage_cut(labelled_sample(docs, labels, "toxic", usable, sample_rows))
    counted = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(3)) != 0
    toxic_texts = sample.filter(counted & (F.col("label") == 1))
    rows, n_toxic = _held(toxic_texts)
    toxic = {bytes(r["unit"]): r["n"] for r in rows.filter(F.col("n") >= least).collect()}
    rows, n_clean = _held(sample.filter(counted & (F.col("label") != 1)), set(toxic))
    if not n_toxic or not n_clean:
        return Detector({})
    clean = {bytes(r["unit"]): r["n"] for r in rows.collect()}
    found = Detector(token_scores(toxic, clean, n_toxic, n_clean))

    def best(texts):
        made = [(len(ws), max([s for *_, s in segments(found.values(ws))], default=0.0)) for ws in map(tokens, texts)]
        return {"n": [n for n, _ in made], "best": [b for _, b in made]}

    # a length and a best total for each text of the calibration third: sample_rows rows at most
    third = sample.filter(~counted)
    calm = map_texts(third.filter("label != 1"), ["label"], "n int, best double", best).filter("n > 0").collect()
    found.rate = rate(found, clean, n_clean)
    spread = sum(r["n"] * math.exp(-min(found.rate * r["best"], 700)) for r in calm)
    found.k = min(max(len(calm) / spread if spread else 0.1, 1e-6), 1e6)
    return calibrated(found, third)


def rate(found: Detector, clean: dict[bytes, int], n_clean: int) -> float:
    """lambda: the positive root of E[exp(lambda s)] = 1 over the tokens of clean texts. (K is then the maximum-likelihood value
    for the best totals S of clean texts of n tokens, whose K n exp(-lambda S) is exponentially distributed with mean 1.)"""
    share = np.array([max(clean.get(w, 0), 0.5) / n_clean for w in found.scores] or [0.0])
    value = np.array(list(found.scores.values()) or [0.0])
    rest = max(1 - share.sum(), 1e-9)
    low, high = 1e-3, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        total = float((share * np.exp(np.minimum(mid * value, 700))).sum() + rest * math.exp(mid * found.other))
        low, high = (mid, high) if total < 1 else (low, mid)
    return (low + high) / 2


def calibrated(found: Detector, sample: DataFrame) -> Detector:
    """Fits slope and offset of the logistic on the evidence of the calibration third, by Newton steps with a small ridge."""
    rows = map_texts(sample, ["label"], "e double", lambda ts: {"e": [found.read(t)[0] for t in ts]}).collect()
    x = np.array([[r["e"], 1.0] for r in rows], dtype=float).reshape(len(rows), 2)
    y = np.array([float(r["label"] == 1) for r in rows])
    if not len(y) or y.min() == y.max():
        return found
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * w[:, None]).T @ x + np.diag([0.05, 0.05]), x.T @ (y - p) - 0.05 * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    found.slope, found.offset = float(max(beta[0], 0.0)), float(beta[1])
    return found


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 4, held_out: int = 2) -> DataFrame:
    """All documents: doc_id, held_out, score, predicted, and `passages`, the number of significant ones."""
    found = train(docs, labels, fold=fold, held_out=held_out)

    def run(texts):
        seen = [found.read(t) for t in texts]
        return {"score": found.probability(np.array([e for e, _ in seen])), "passages": [len(p) for _, p in seen]}

    ids = docs.select("doc_id", (remainder(F.col("doc_id"), fold) == held_out).alias("held_out"), "text")
    rows = map_texts(ids, ["doc_id", "held_out"], "score double, passages int", run)
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
