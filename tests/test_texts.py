"""Byte pairs, fuzzy scorers and page lines against plain versions."""

import random
import time
from functools import lru_cache
from html.parser import HTMLParser

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gondola.functions import bpe, fuzzy, html
from gondola.operators import standardise as op

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache
def vocabulary():
    with open(RANKS, "rb") as f:
        return bpe.Vocabulary(f.read())


def plain_merge(word, ranks):
    """The neighbours of lowest rank, the first of them, are joined again and again."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(deadline=None, max_examples=200)
@given(st.binary(min_size=1, max_size=40) | st.text("abcdeht inrs", min_size=1, max_size=60).map(str.encode))
def test_merges(word):
    known = vocabulary()
    want = [known.ranks[word]] if word in known.ranks else plain_merge(word, known.ranks)
    assert list(known.merged(word)) == want


def test_every_document_round_trips_and_equals_the_library(spark):
    known = vocabulary()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.ranks, special_tokens={})
    texts = [r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    for t in [*texts, "naïve 日本 🙂\n\n x  ", "<|endoftext|>"]:
        ids = known.encode(t)
        assert known.decode(ids) == t and ids == library.encode_ordinary(t)
        assert known.cut(t, 100) == (t if len(ids) <= 100 else library.decode(ids[:100]))


def test_long_word_takes_little_time():
    start = time.perf_counter()
    word = "".join(random.Random(1).choice("abcdefgh") for _ in range(200_000))
    assert vocabulary().decode(vocabulary().encode(word)) == word
    assert time.perf_counter() - start < 30


def test_token_budget_column(spark):
    df = spark.createDataFrame([(1, "one two three four"), (2, None), (3, ""), (4, "🙂🙂")], "id int, t string")
    got = {r["id"]: r["c"] for r in df.select("id", bpe.token_budget(df, F.col("t"), 3, RANKS).alias("c")).collect()}
    assert got[1] == "one two three" and got[2] is None and got[3] == "" and got[4].endswith("�")


# --- scorers ----------------------------------------------------------------------------------------


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            row[j + 1], last = (last + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


def dp_ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def dp_partial(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    pairs = [(a, b), (b, a)] if len(a) == len(b) else [(a, b)] if len(a) < len(b) else [(b, a)]
    return max(dp_ratio(s, t[max(0, e - len(s)):e]) for s, t in pairs for e in range(1, len(t) + len(s)))


def dp_best(a, b):
    def order(x):
        return " ".join(sorted(x))

    x, y = a.split(), b.split()
    both, left, right = set(x) & set(y), set(x) - set(y), set(y) - set(x)
    if not x or not y:
        token_set = 0.0
    elif both and not (left and right):
        token_set = 100.0
    else:
        head = order(both) + (" " if both else "")
        lengths = 2 * len(head) + len(order(left)) + len(order(right))
        token_set = 100 * (1 - (len(order(left)) + len(order(right)) - 2 * lcs(order(left), order(right))) / lengths)
        if both:
            token_set = max(token_set, dp_ratio(order(both), head + order(left)), dp_ratio(order(both), head + order(right)))
    sort = dp_ratio(order(x), order(y))
    partial_tokens = 0.0 if not x or not y else 100.0 if both else max(dp_partial(order(x), order(y)), dp_partial(order(set(x)), order(set(y))))
    weighted = 0.0
    if a and b:
        longer = max(len(a), len(b)) / min(len(a), len(b))
        scale = 0.9 if longer < 8 else 0.6
        more = [0.95 * sort, 0.95 * token_set] if longer < 1.5 else [scale * dp_partial(a, b), 0.95 * scale * partial_tokens]
        weighted = max(dp_ratio(a, b), *more)
    scores = [dp_ratio(a, b), dp_partial(a, b), sort, token_set, weighted, dp_ratio(a, b) if a and b else 0.0]
    scores = [round(s, 9) for s in scores]
    return max(scores), scores.index(max(scores)), scores


names = st.text("ab c", max_size=14) | st.text("Alphbet ", max_size=20)


@settings(deadline=None, max_examples=400)
@given(names, names)
def test_scorers(a, b):
    top, first, scores = dp_best(a, b)
    assert [round(s(a, b), 9) for s in fuzzy.SCORERS.values()] == scores
    assert fuzzy.best(a, b) == (top, first)


def test_known_spellings(spark):
    """Fixed cases of the blueprint, and the choice among ties."""
    terms = ["Alpha", "Alpha Beta Classic", "Gamma", "Beta", "Ácido Fólico", "zinco b", "zinco a"]
    vocabulary = spark.createDataFrame([("v", t) for t in terms], "vocabulary string, term string")
    values = spark.createDataFrame([("v", v) for v in ["Alpha beta", "acido folico", "nothing", "", "zinco", None, "zinco"]], "vocabulary string, value string")
    got = {r["value"]: r["term"] for r in op.fuzzy_terms(values, vocabulary).collect()}
    assert got == {"Alpha beta": "Alpha Beta Classic", "acido folico": "Ácido Fólico", "zinco": "zinco a"}


def test_fuzzy_terms_against_all_pairs(spark):
    rng = random.Random(3)
    words = ["gel", "creme", "Forte", "50mg", "plus", "ácido", "fólico", "baby"]
    terms = sorted({" ".join(rng.sample(words, rng.randint(1, 3))) for _ in range(40)})
    asked = sorted({" ".join(rng.sample(words, rng.randint(1, 4))).replace("e", "E") for _ in range(40)})
    got = {r["value"]: (r["term"], r["overlap"], r["score"], r["scorer"]) for r in op.fuzzy_terms(
        spark.createDataFrame([("v", x) for x in asked], "vocabulary string, value string"),
        spark.createDataFrame([("v", x) for x in terms], "vocabulary string, term string")).collect()}
    plain = str.maketrans("áó", "ao")
    for v in asked:
        rows = []
        for t in terms:
            overlap = len(set(v.lower().translate(plain).split()) & set(t.lower().translate(plain).split()))
            if overlap:
                top, first, _ = dp_best(v.translate(plain), t)
                rows.append((-overlap, -top, first, t))
        if rows:
            o, s, first, t = min(rows)
            assert got.pop(v) == (t, -o, -s, list(fuzzy.SCORERS)[first])
    assert not got


# --- pages ------------------------------------------------------------------------------------------


class Plain(HTMLParser):
    """Tokens as the standard parser finds them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.raw = [], None

    def handle_starttag(self, tag, attrs):
        self.found.append(("start", tag))
        if tag in html.RAW:
            self.raw = tag

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.found.append(("end", tag))
        self.raw = None if tag == self.raw else self.raw

    def handle_data(self, data):
        if not self.raw:
            self.found.append(("text", data))


def plain_tokens(page):
    p = Plain()
    p.feed(page)
    p.close()
    return p.found


def joined(found):
    out = []
    for kind, value in found:
        if kind == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + value)
        elif value or kind != "text":
            out.append((kind, value))
    return out


def test_tokens_of_all_pages(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    assert pages
    for page in pages:
        assert joined(html.tokens(page)) == joined(plain_tokens(page))


CASES = {
    "<p>one <b>two</b>\n three</p><p>four": "one two three\n\nfour",
    "<h2>Use</h2>a<br>b<hr>c": "## Use\n\na\nb\n---\nc",
    "<ul><li>a<li>b<ol><li>x</li><li>y</ol><li>c</ul>d": "* a\n* b\n  1. x\n  2. y\n* c\n\nd",
    "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td> </td><td>3</td></tr></table>": "a | b\n1 | | 3",
    "x<pre>\n  a  b\n\n   c\n</pre>y": "x\n\n  a  b\n\n   c\n\ny",
    "&lt;b&gt; &#65;&#x42; &amp;amp; a&nbsp;b &eacute;": "<b> AB &amp; a b é",
    "a<!-- x > <b> -->b<!DOCTYPE html>c<?php 1 ?>d": "abcd",
    "a < b <3 c": "a < b <3 c",
    "<a title='x>y' href=\"z>\">t</a><p class=it's>u": "t\n\nu",
    "<script>var a = '<p>x</p>';</SCRIPT >t<style>p{}": "t",
    "t<script>never closed <p>x": "t",
    "t<!-- never closed <p>x": "t",
    "t<a href=": "t",
    "": "",
    "<div></div><p> </p>": "",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "</p></ul></li>x<li>y": "x\n* y",
}


@pytest.mark.parametrize("page", list(CASES))
def test_lines(page):
    assert html.text_of(page) == CASES[page]


@pytest.mark.parametrize("part", ["<script>", "<script", "<!--", "<a ", '<a x="', "<a x='>", "&", "<", "</", "<p", "<ul><li>", "<pre>", "<td>", "<!x"])
def test_time_grows_with_the_page(part):
    start = time.perf_counter()
    html.text_of(part * (400_000 // len(part)))
    assert time.perf_counter() - start < 5


def test_document_lines(spark):
    pages = spark.createDataFrame([(1, "<p>a</p><p>b"), (2, None), (3, "<p></p>"), (4, "x")], "id int, html string")
    done = spark.createDataFrame([(4,)], "id int")
    texts, empty = op.document_texts(pages, "id", "html", done, html.lines)
    assert [tuple(r) for r in texts.collect()] == [(1, "a\n\nb")]
    assert sorted(r["id"] for r in empty.collect()) == [2, 3]
