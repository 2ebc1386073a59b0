"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of shape features (word and character statistics; never language, source or id). Features are cut
into bins at quantiles. Training goes round the features again and again; each visit fits a shallow tree (two cuts) to the
gradient of the log loss over the bins of that one feature and adds a small part of it to the feature's lookup table. Then the
pairs of features that explain most of what is left get tables of their own, over two coarser bins at once. A score is the sum of
looked-up table entries, through the logistic function.

Training uses a bounded, documented number of labelled rows (`sample_rows`); its features and bins come from Spark, the tables from
numpy on that sample. Scoring reads every whole text once, without a shuffle.

Defined results: a null or empty text has features of zero and a score like any other; null ids and repeated rows are scored
like others; without labelled rows of both kinds the score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import labelled_sample, map_texts, remainder

FEATURES = (
    "words", "chars_per_word", "upper", "symbols", "digits", "stops", "shouts", "joins", "distinct", "top_word", "neighbours",
    "windows", "same_lines", "words_per_line", "words_per_stop", "short", "beyond_ascii", "title", "worst_part",
)
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))


def features(text: str) -> tuple[float, ...]:
    """The shape of one text, in the order of FEATURES; shares unless named otherwise."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    size = len(raw)

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(map(eq, words, words[1:]))
    windows = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 1
    stops = sum(map(raw.count, (b".", b"?")))
    # junk may fill only a part of a long text: the least varied stretch of 100 words
    worst = min((len(set(words[i:i + 100])) / len(words[i:i + 100]) for i in range(0, max(1, n - 49), 100)), default=1.0)
    letters = share(UPPER) + share(LOWER)
    return (
        float(np.log1p(n)),
        (size - n) / n,
        share(UPPER) / letters if letters else 0.0,
        share(b"#*$%&|<>") * size / n,
        share(b"0123456789"),
        share(b".,;:?") * size / n,
        share(b"!") * size / n,
        share(b"|/\\_=+-") * size / n,
        len(counts) / n,
        max(counts.values()) / n,
        same / n,
        1 - windows / max(1, n - 2),
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        float(np.log1p(n / (stops + 1))),
        sum(1 for w in words if len(w) < 4) / n,
        sum(raw.count(x) for x in (b"\xc3", b"\xc5")) / size,
        sum(map(bytes.istitle, words)) / n,
        worst,
    )


@dataclass
class Additive:
    """Bin edges per feature, a lookup table per feature and per pair of features, and the base score."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: one table entry per feature and pair, added up."""
        total = np.full(len(rows), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], rows[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[_bins(self.coarse, rows, a), _bins(self.coarse, rows, b)]
        return 1 / (1 + np.exp(-total))


def _bins(edges: Sequence[np.ndarray], rows: np.ndarray, f: int) -> np.ndarray:
    return np.searchsorted(edges[f], rows[:, f], side="right")


def _cuts(rows: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g / (h + ridge)


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = left_g**2 / (left_h + ridge) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """The values a tree of two levels gives to the bins: one cut, then the better side cut again."""
    values = np.full(len(g), 0.0)
    gain, at = _best_cut(g, h, ridge)
    if gain <= 0:
        return values
    pieces = [(0, at), (at, len(g))]
    again = [_best_cut(g[a:b], h[a:b], ridge) for a, b in pieces]
    side = int(again[1][0] > again[0][0])
    if again[side][0] > 0:
        a, b = pieces[side]
        pieces[side:side + 1] = [(a, a + again[side][1]), (a + again[side][1], b)]
    for a, b in pieces:
        values[a:b] = _leaf(g[a:b].sum(), h[a:b].sum(), ridge)
    return values


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and bin values of the best tree with one cut on either axis of a pair."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)

    def sums(x):
        c = x.cumsum(0).cumsum(1)
        a = c[:-1, :-1]
        top, left = c[:-1, -1:], c[-1:, :-1]
        return np.stack([a, top - a, left - a, c[-1, -1] - top - left + a])

    gs, hs = sums(g), sums(h)
    gain = (gs**2 / (hs + ridge)).sum(0) - g.sum() ** 2 / (h.sum() + ridge)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    leaf = _leaf(gs[:, i, j], hs[:, i, j], ridge)
    values = np.empty(g.shape)
    values[:i + 1, :j + 1], values[:i + 1, j + 1:], values[i + 1:, :j + 1], values[i + 1:, j + 1:] = leaf
    return float(gain[i, j]), values


def fit(
    rows: np.ndarray, labels: np.ndarray, bins: int = 48, pair_bins: int = 12, rounds: int = 120, pair_rounds: int = 40,
    pairs: int = 8, rate: float = 0.2, ridge: float = 5.0,
) -> Additive:
    """Fits the tables. Rounds visit the features in a fixed order, so the same rows give the same model."""
    count, ones = len(labels), float(labels.sum()) if len(labels) else 0.0
    share = (ones + 0.5) / (count + 1.0)
    width = rows.shape[1] if count else len(FEATURES)
    if not count or ones in (0.0, float(count)):
        return Additive([np.zeros(0)] * width, float(np.log(share / (1 - share))), [np.zeros(1)] * width)
    edges, coarse = _cuts(rows, bins), _cuts(rows, pair_bins)
    model = Additive(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges], coarse)
    at = [_bins(edges, rows, f) for f in range(width)]
    total = np.full(count, model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return labels - p, np.maximum(p * (1 - p), 1e-9)

    for _ in range(rounds):
        for f in range(width):
            g, h = slopes()
            size = len(model.tables[f])
            step = rate * _shallow_tree(np.bincount(at[f], g, size), np.bincount(at[f], h, size), ridge)
            model.tables[f] += step
            total += step[at[f]]
    small = [_bins(coarse, rows, f) for f in range(width)]
    shapes = [len(c) + 1 for c in coarse]

    def grids(a, b, g, h):
        flat, shape = small[a] * shapes[b] + small[b], (shapes[a], shapes[b])
        return tuple(np.bincount(flat, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    g, h = slopes()
    ranked = sorted(combinations(range(width), 2), key=lambda p: -_quadrants(*grids(*p, g, h), ridge)[0])
    model.pairs = ranked[:pairs]
    model.pair_tables = [np.zeros((shapes[a], shapes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            step = rate * _quadrants(*grids(a, b, *slopes()), ridge)[1]
            model.pair_tables[k] += step
            total += step[small[a], small[b]]
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, fold: int = 5) -> Additive:
    """A model from at most `sample_rows` labelled documents outside the held-out fold."""
    sample = labelled_sample(docs, labels, "quality", remainder(F.col("doc_id"), fold) != 0, sample_rows)
    # one array of numbers per sampled row comes back: sample_rows * len(FEATURES) numbers at most
    got = map_texts(sample, ["label"], "x array<double>", lambda texts: {"x": [features(t) for t in texts]}).collect()
    got.sort(key=lambda r: (r["label"], r["x"]))
    rows = np.array([r["x"] for r in got], dtype=float).reshape(len(got), len(FEATURES))
    return fit(rows, np.array([r["label"] for r in got], dtype=float))


def scorer(model: Additive):
    """A column function: text -> score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([features(t or "") for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.score(rows))

    return score


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fold: int = 5, text: str = "text") -> DataFrame:
    """All documents: doc_id, held_out, score, predicted."""
    score: Column = scorer(train(docs, labels, fold=fold))(F.col(text))
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), fold) == 0).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
