"""Personal data: base rules, and contextual extraction bootstrapped from what they find.

1. Base rules find e-mail addresses, IP addresses, card numbers and phone numbers; these are the seeds.
2. Seeds induce lexical patterns: the word before them, the two words before them, or an attached prefix such as `tel:`.
   Patterns seen with few different seeds are dropped; a seed spreads its support over its patterns. The support
   needed is a fixed number, so patterns grow with the corpus.
3. A second pass counts every occurrence of such a pattern (patterns go to the tasks in blocks of about `block_patterns`, each block
   is one pass), and lists those that lead to something of the loose shape of a
   kind, an instance. Spark scores the graph of patterns and instances in rounds: a pattern is as good as the share of
   its occurrences that lead to trusted instances; seeds are trusted, other instances as far as their patterns are.
4. Patterns of high confidence discover identifiers that the base rules miss. Up to `most_patterns` of them go to the tasks; more stay a table,
   which is joined with what stands behind possible patterns in the texts (equal texts once). The spans are the same.

Every pass reads whole texts once, without shuffling them. Offsets are code points, ends exclusive.

Defined results: a null or empty text has no span; null ids and repeated rows are searched like others; an empty table gives
an empty result; without seeds there are no patterns and only base spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import map_batches, map_texts
from gondola.session import lineage_cut

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, number of the kind

# The base rules. Look-behinds and possessive repeats only keep long runs from being tried again at every character.
DIGIT = re.compile(r"[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Loose shapes of what may follow a pattern, by kind.
LOOSE = (
    re.compile(r"[^\s@<>()\[\],;:\"]{1,64}+@[A-Za-z0-9][A-Za-z0-9-]*+(?:\.[A-Za-z0-9-]++)*"),
    re.compile(r"[0-9]{1,3}(?:[.:-][0-9]{1,3}){3}(?![0-9])"),
    re.compile(r"[0-9](?:[ -]?[0-9]){11,18}(?![0-9])"),
    re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9])"),
)
# Words that hold a digit or an @, all words, and attached prefixes: a name and the delimiters behind it, anywhere in a word.
MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
WORDS = re.compile(r"\S++")
DELIMITERS = ":=(<[\"'/#|,;&?{}"
PREFIX = re.compile(r"[^\s:=(<\[\"'/#|,;&?{}]++[:=(<\[\"'/#|,;&?{}]++(?=\S)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and a domain with a dot: found from each @, so that long runs cost nothing."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and LOCAL.match(text, start - 1):
            start -= 1
        end = at + 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            yield start, found.end()
            floor = end = found.end()
        else:
            floor = max(floor, at)  # the run before this @ ends here
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), m.end(), 1))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def contexts(text: str, places: Iterable[int]) -> dict[int, list[str]]:
    """The lexical patterns before each of some places (none: no entry), lower-cased and typed: `1 word`, `2 two words`, or `p prefix:`,
    with the name before the last delimiters. A word is read once, however many places it holds."""
    asked, out = sorted(set(places)), {}
    if not asked:
        return out
    i, before = 0, ["", ""]
    for m in WORDS.finditer(text):
        start, end = m.span()
        if asked[i] <= start and before[1]:
            out[start] = [f"1 {before[1]}", *([f"2 {before[0]} {before[1]}"] if before[0] else [])]
        i += asked[i] == start
        if i < len(asked) and asked[i] < end:
            prefixes = {at: prefix for at, prefix in attached(m.group(), start)}
            while i < len(asked) and asked[i] < end:
                if asked[i] in prefixes:
                    out[asked[i]] = [prefixes[asked[i]]]
                i += 1
        if i == len(asked):
            break
        before = [before[1], m.group().lower()]
    return out


def attached(run: str, start: int = 0) -> Iterator[tuple[int, str]]:
    """(place, pattern) after every prefix in a word; a bracket that may begin a number is tried on both sides."""
    for m in PREFIX.finditer(run):
        prefix = m.group().lower()
        if prefix[-1] == "(" and prefix[-2] in DELIMITERS:
            yield start + m.end() - 1, f"p {prefix[:-1]}"
        yield start + m.end(), f"p {prefix}"


def behind(text: str) -> Iterator[tuple[int, str]]:
    """(place, pattern) of everything that could be a pattern before a word with a digit or an @, or inside of one."""
    marked = [(m.start(), m.group()) for m in MARKED.finditer(text)]
    before = contexts(text, [start for start, _ in marked])
    for start, run in marked:
        yield from ((start, p) for p in before.get(start, []))
        yield from attached(run, start)


def with_added(base: list[Span], discovered: Iterable[Span]) -> list[Span]:
    """Base spans and those discovered spans that overlap no base span and no discovered one before them."""
    # what is covered, as stretches that do not touch each other's inside, by start
    starts, ends = [], []
    for a, b, _ in base:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    added = []
    for span in discovered:
        at = bisect_right(starts, span[0])
        if (at == 0 or ends[at - 1] <= span[0]) and (at == len(starts) or span[1] <= starts[at]):
            starts.insert(at, span[0])
            ends.insert(at, span[1])
            added.append(span)
    return sorted([*base, *added], key=lambda s: (s[0], s[2]))


def named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


@dataclass
class Patterns:
    """Kinds by pattern."""

    kinds: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def instances(self, text: str) -> Iterator[tuple[str, Span]]:
        """(pattern, span) wherever a pattern leads to something of the loose shape of its kind."""
        for at, pattern in behind(text):
            for kind in self.kinds.get(pattern, ()):
                if found := LOOSE[kind].match(text, at):
                    yield pattern, (at, found.end(), kind)

    def counts(self, text: str) -> Counter:
        """How often each pattern occurs, whatever follows."""
        words = text.lower().split()
        ones = {p[2:] for p in self.kinds if p[0] == "1"}
        twos = {p[2:] for p in self.kinds if p[0] == "2"}
        ends = {p.rsplit(" ", 1)[1] for p in twos}
        out: Counter = Counter(f"1 {w}" for w in words[:-1] if w in ones)
        pairs = (f"{a} {b}" for a, b in zip(words, words[1:-1]) if b in ends)
        out.update(f"2 {p}" for p in pairs if p in twos)
        if any(p[0] == "p" for p in self.kinds):
            out.update(p for p in (f"p {x.lower()}" for x in PREFIX.findall(text)) if p in self.kinds)
        return out

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans: discovered ones overlap no base span and no earlier discovered one."""
        base = base_spans(text)
        if not self.kinds:
            return base, base
        return base, with_added(base, (span for _, span in self.instances(text)))


def candidates(docs: DataFrame, least: float, text: str) -> DataFrame:
    """(kind, pattern) of the patterns that enough different seeds share. A seed spreads a weight of one over its patterns of a type."""

    names = ("kind", "type", "pattern", "seed")

    def induce(batch):
        rows = set()
        for t in batch["t"]:
            spans = base_spans(t)
            before = contexts(t, [a for a, *_ in spans])
            rows.update((k, c[0], c, t[a:b]) for a, b, k in spans for c in before.get(a, []))
        return {n: [r[i] for r in rows] for i, n in enumerate(names)}

    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    seen = lineage_cut(map_batches(source, "kind int, type string, pattern string, seed string", induce).distinct())
    weight = seen.groupBy("kind", "type", "seed").agg((1 / F.count(F.lit(1))).alias("weight"))
    support = seen.join(weight, ["kind", "type", "seed"]).groupBy("kind", "type", "pattern").agg(F.sum("weight").alias("support"))
    # weights are fractions: their sum may fall short of the support by a rounding error
    return lineage_cut(support.filter(F.col("support") >= least - 1e-9).select("kind", "pattern"))


def patterns_of(rows: DataFrame) -> Patterns:
    kinds: dict[str, tuple[int, ...]] = {}
    for r in rows.select("pattern", "kind").toLocalIterator():
        kinds[r["pattern"]] = tuple(sorted({*kinds.get(r["pattern"], ()), r["kind"]}))
    return Patterns(kinds)


def followed(docs: DataFrame, tried: Patterns, text: str) -> DataFrame:
    """(pattern, kind, instance, seed, n): what the patterns of a block lead to, and, without a kind, how often they occur."""
    names = ("pattern", "kind", "instance", "seed")

    def follow(batch):
        seen: Counter = Counter()
        for t in batch["t"]:
            base = {(a, k) for a, _, k in base_spans(t)}
            for pattern, (a, b, kind) in tried.instances(t):
                seen[pattern, kind, t[a:b], (a, kind) in base] += 1
            for pattern, n in tried.counts(t).items():
                seen[pattern, None, None, None] += n
        return {**{n: [k[i] for k in seen] for i, n in enumerate(names)}, "n": list(seen.values())}

    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    seen = map_batches(source, "pattern string, kind int, instance string, seed boolean, n long", follow)
    return lineage_cut(seen.groupBy("pattern", "kind", "instance").agg(F.sum("n").alias("n"), F.max("seed").alias("seed")))


def learn(
    docs: DataFrame, confidence: float = 0.8, rounds: int = 3, least: float = 3.0, text: str = "text", block_patterns: int = 50_000,
    most_patterns: int = 50_000
) -> Patterns | DataFrame:
    """The patterns of at least `confidence` after `rounds` of scoring the pattern-instance graph; more than `most_patterns` as a table (pattern, kind)."""
    tried = candidates(docs, least, text)
    number = tried.count()
    if not number:
        return Patterns()
    blocks = -(-number // block_patterns)
    seen = None
    for k in range(blocks):
        # all kinds of a pattern are in one block
        part = followed(docs, patterns_of(tried.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == k)), text)
        seen = part if seen is None else seen.unionByName(part)
    totals = seen.filter("kind is null").select("pattern", F.col("n").alias("total"))
    edges = seen.filter("kind is not null")
    trusted = edges.groupBy("kind", "instance").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    trust = trusted.withColumnRenamed("seed", "trust")
    for _ in range(rounds):
        patterns = edges.join(trust, ["kind", "instance"]).groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("trust")).alias("good"), F.sum("n").alias("n"))
        patterns = patterns.join(totals, "pattern", "left").select(
            "pattern", "kind", (F.col("good") / (F.greatest("n", F.coalesce("total", "n")) + 1)).alias("sure"))
        doubt = edges.join(patterns, ["pattern", "kind"]).groupBy("kind", "instance").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("sure"))))).alias("found"))
        trust = lineage_cut(trusted.join(doubt, ["kind", "instance"]).select(
            "kind", "instance", F.greatest("seed", "found").alias("trust")))
        best = patterns
    sure = lineage_cut(best.filter(F.col("sure") >= confidence).select("pattern", "kind"))
    return patterns_of(sure) if sure.count() <= most_patterns else sure


def _led(docs: DataFrame, columns: Sequence[str], table: DataFrame, text: str) -> tuple[DataFrame, str, str]:
    """`columns` of `docs`, the text (null: empty) and an array of (no, kind, a, b): what the patterns of a table lead to, by a join; and the names of both, which
    `docs` does not use. Texts are known by their digest, so that equal ones are searched and joined once."""
    names = ("digest", "pattern", "kind", "no", "a", "b")
    mark = "_"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark += "_"
    whole, key, led = f"{mark}text", f"{mark}digest", f"{mark}leads"

    def follow(batch):
        out = []
        for t in set(batch["t"]):
            digest = hashlib.md5(t.encode("utf-8", "replace")).digest()
            for no, (at, pattern) in enumerate(behind(t)):
                out += [(digest, pattern, kind, no, at, m.end()) for kind, shape in enumerate(LOOSE) if (m := shape.match(t, at))]
        return {n: [r[i] for r in out] for i, n in enumerate(names)}

    rows = docs.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(whole))
    places = map_batches(rows.select(F.col(whole).alias("t")), "digest binary, pattern string, kind int, no int, a int, b int", follow).distinct()
    # a text holds no more leads than it has places
    leads = places.join(table, ["pattern", "kind"], "left_semi").groupBy(F.col("digest").alias(key)).agg(
        F.collect_list(F.struct("no", "kind", "a", "b")).alias(led))
    return rows.withColumn(key, F.unhex(F.md5(F.col(whole).cast("binary")))).join(leads, key, "left").drop(key), whole, led


def _in_order(leads: Iterable | None) -> Iterator[Span]:
    return ((x["a"], x["b"], x["kind"]) for x in sorted(leads if leads is not None else (), key=lambda x: (x["no"], x["kind"])))


def found(docs: DataFrame, patterns: Patterns | DataFrame) -> DataFrame:
    """All documents: doc_id, the number of base spans by kind, the hash of the base spans, all spans, `n_added`."""

    def described(rows):
        out = {f"n_{kind}": [sum(s[2] == i for s in base) for base, _ in rows] for i, kind in enumerate(KINDS)}
        out["base_sha256"] = [hashlib.sha256(named(base).encode()).hexdigest() for base, _ in rows]
        out["spans"] = [named(every) for _, every in rows]
        out["n_added"] = [len(every) - len(base) for base, every in rows]
        return out

    added = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    if isinstance(patterns, Patterns):
        return map_texts(docs, ["doc_id"], added, lambda texts: described([patterns.spans(t) for t in texts]))

    rows, whole, led = _led(docs, ["doc_id"], patterns, "text")

    def run(batch):
        pairs = ((base_spans(t), x) for t, x in zip(batch[whole], batch[led]))
        return {"doc_id": batch["doc_id"], **described([(base, with_added(base, _in_order(x))) for base, x in pairs])}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, f"doc_id {kind}, {added}", run)


def masked(text: str, spans: list[Span]) -> str:
    """A text with `<kind>` in place of each span; of overlapping spans the first to start covers the others' common part."""
    out, at = [], 0
    for a, b, k in spans:
        if b <= at:
            continue
        out += [text[at:a] if a >= at else "", f"<{KINDS[k]}>"]
        at = b
    return "".join([*out, text[at:]])


def mask(patterns: Patterns, text: Column) -> Column:
    """A column of texts with all personal data masked; null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else masked(t, patterns.spans(t)[1]) for t in texts], dtype=object)

    return run(text)


def hidden(docs: DataFrame, patterns: Patterns | DataFrame, text: str = "text") -> DataFrame:
    """`docs` with all personal data of a column masked; null stays null."""
    if isinstance(patterns, Patterns):
        return docs.withColumn(text, mask(patterns, F.col(f"`{text}`")))

    @F.pandas_udf("string")
    def run(texts: pd.Series, leads: pd.Series) -> pd.Series:
        rows = ((t, base_spans(t), x) for t, x in zip(texts, leads))
        return pd.Series([masked(t, with_added(base, _in_order(x))) for t, base, x in rows], dtype=object)

    out, whole, led = _led(docs, docs.columns, patterns, text)
    own = F.when(F.col(f"`{text}`").isNotNull(), run(whole, led)).alias(text)
    return out.select(*[own if c == text else F.col(f"`{c}`") for c in docs.columns])
