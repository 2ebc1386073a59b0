"""Similarity of two spellings, 0 to 100, by the longest common subsequence.

    ratio             twice the common subsequence over both lengths
    partial           the best ratio of the shorter text with a window of the longer one
    token_sort        ratio of the words in order
    token_set         of the common words, and these with the rest of either side
    weighted          the best of these, each scaled by how much it presumes of texts of unequal length
    quick             ratio, 0 for empty texts

The subsequence is found bit by bit in parallel: a text is one integer with a bit per character, and a step per character of the other text updates all of them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def masks(text: str) -> dict[str, int]:
    """For every character the bits of its places."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def common(a: dict[str, int], width: int, b: str) -> int:
    """The length of the longest common subsequence of a text, as masks, and another."""
    full = (1 << width) - 1
    free = full
    for c in b:
        if m := a.get(c):
            taken = free & m
            free = ((free + taken) | (free - taken)) & full
    return width - free.bit_count()


def _share(matched: int, lengths: int) -> float:
    return 200.0 * matched / lengths if lengths else 100.0


def ratio(a: str, b: str) -> float:
    return _share(common(masks(a), len(a), b), len(a) + len(b))


def partial(a: str, b: str) -> float:
    """Windows are as long as the shorter text; those over an end of the longer one are cut."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = _windows(a, b)
    return max(best, _windows(b, a)) if len(a) == len(b) and best < 100 else best


def _windows(a: str, b: str) -> float:
    n, own, best = len(a), masks(a), 0.0
    for end in range(1, len(b) + n):
        window = b[max(0, end - n):end]
        # a window whose last (over the right end: first) character is not in the text is no better than its neighbour
        edge = window[-1] if end <= len(b) else window[0]
        if edge in own and _share(min(n, len(window)), n + len(window)) > best:
            best = max(best, _share(common(own, n, window), n + len(window)))
            if best == 100:
                break
    return best


def _sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sort(a: str, b: str) -> float:
    return ratio(_sorted(a), _sorted(b))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = x & y, " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and not (left and right):
        return 100.0
    shared = len(" ".join(sorted(both)))
    gap = 1 if both else 0
    with_left, with_right = shared + gap + len(left), shared + gap + len(right)
    # what the rests have in common, with the common words in front of both
    apart = len(left) + len(right) - 2 * common(masks(left), len(left), right)
    best = 100.0 * (1 - apart / (with_left + with_right))
    if both:
        best = max(best, _share(shared, shared + with_left), _share(shared, shared + with_right))
    return best


def partial_tokens(a: str, b: str) -> float:
    """The better of the partial ratios of the sorted words and of the words that the texts do not share; 100 where they share any."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    if x & y:
        return 100.0
    return max(partial(_sorted(a), _sorted(b)), partial(" ".join(sorted(x)), " ".join(sorted(y))))


def quick(a: str, b: str) -> float:
    return ratio(a, b) if a and b else 0.0


def weighted(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if longer < 1.5:
        return max(plain, 0.95 * token_sort(a, b), 0.95 * token_set(a, b))
    scale = 0.9 if longer < 8 else 0.6
    return max(plain, scale * partial(a, b), 0.95 * scale * partial_tokens(a, b))


SCORERS = {"ratio": ratio, "partial": partial, "token_sort": token_sort, "token_set": token_set, "weighted": weighted, "quick": quick}


def best(a: str, b: str) -> tuple[float, int]:
    """(score, number of the scorer): the highest score of all, by the first scorer that gives it."""
    top = (-1.0, 0)
    for i, scorer in enumerate(SCORERS.values()):
        score = round(scorer(a, b), 9)
        if score > top[0]:
            top = (score, i)
            if score >= 100:
                break
    return top
