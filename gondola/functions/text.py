"""Text rules as Column expressions (they stay inside whole-stage code generation)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"([\p{L}\p{N}_]+)"


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and their plain forms, derived from Unicode decompositions."""
    marked, plain = [], []
    for code in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _plain_letters()

# Units, pack words and fillers that say nothing about which product a name means.
FILLER_WORDS = [
    "mg", "ml", "mcg", "ui", "iu", "gr",
    "un", "unid", "und", "cp", "cps", "cap", "caps", "com", "comp", "cx", "fr", "po", "tab", "pct", "env",
    "sache", "ampola", "amp",
    "sem", "para", "por", "ate", "dos", "das", "del",
]

# HTML entities rewritten to text, ampersand last so that nothing is decoded twice.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def unaccent(c: Column) -> Column:
    """Letters without their marks; texts of plain characters pass untouched."""
    plain = F.translate(F.regexp_replace(c, "[\\u0300-\\u036F]", ""), _MARKED, _PLAIN)
    return F.when(c.rlike("[^\\x00-\\x7F]"), plain).otherwise(c)


def alnum_key(c: Column) -> Column:
    """Comparison key: lower case, no accents, letters and digits only."""
    return F.regexp_replace(unaccent(F.lower(F.trim(c))), "[^a-z0-9]+", "")


def slug(c: Column) -> Column:
    """Lower case, no accents, words joined by '-'."""
    return F.regexp_replace(F.regexp_replace(unaccent(F.lower(F.trim(c))), "[^a-z0-9]+", "-"), "^-|-$", "")


def identifier(c: Column) -> Column:
    """Text to identifier: blanks to '_', other symbols dropped."""
    return F.regexp_replace(F.regexp_replace(F.lower(unaccent(c)), r"\s+", "_"), r"[^\p{L}\p{N}_]", "")


def column_name(name: str) -> str:
    """The same for a column name at planning time."""
    text = name.lower().strip()
    for sign in " ,;\n\t=":
        text = text.replace(sign, "_")
    for sign in "{}()":
        text = text.replace(sign, "")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def phone(c: Column) -> Column:
    """Brazilian phone format by number of digits (8 to 11); other lengths are null."""
    digits = F.regexp_replace(F.regexp_replace(c, r"\D", ""), "^0", "")
    size = F.length(digits)

    def area(head: int) -> Column:
        return F.concat(
            F.lit("("), F.substring(digits, 1, 2), F.lit(") "), F.substring(digits, 3, head),
            F.lit("-"), F.substring(digits, 3 + head, 9))

    return (
        F.when(size == 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 4)))
        .when((size == 9) & digits.startswith("0"), area(3))
        .when(size == 9, F.concat_ws("-", F.substring(digits, 1, 5), F.substring(digits, 6, 4)))
        .when(size == 10, area(4))
        .when(size == 11, area(5))
    )


def tax_id(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[./\n-]", ""), "^0+", ""))


def email(c: Column) -> Column:
    """The trimmed address when it has an '@' with a '.' somewhere after it, else null."""
    t = F.trim(c)
    return F.when(t.rlike(r"(?s)^[^@]*@.*\."), t)


def split_pipe(c: Column) -> Column:
    """'a | b|' to [a, b]; blank text is null."""
    parts = F.transform(F.split(F.trim(c), r"\|"), lambda x: F.trim(x))
    return F.when(F.trim(c) != "", F.filter(parts, lambda x: x != ""))


def join_pipe(c: Column) -> Column:
    """[a, b] to 'a|b'; an empty list is null."""
    return F.when(F.size(c) > 0, F.array_join(c, "|"))


def plain_text(c: Column) -> Column:
    """Keeps ASCII letters, digits, blanks and . _ -, with single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^a-zA-Z0-9\s._-]", ""), r"\s+", " "))


def token_budget(c: Column, tokens: int) -> Column:
    """The first `tokens` blank-separated tokens; shorter texts stay as they are."""
    parts = F.split(F.trim(c), r"\s+")
    return F.when(F.size(parts) > tokens, F.array_join(F.slice(parts, 1, tokens), " ")).otherwise(c)


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), 1)


def significant_tokens(c: Column) -> Column:
    """Distinct words that tell products apart: no numbers, number-unit or unit-number words, fillers or
    words under three letters. Null text gives an empty list."""
    found = F.filter(
        words(F.lower(unaccent(c))),
        lambda w: (F.length(w) >= 3)
        & ~w.rlike(r"^(\d+|\d+[a-z]+|[a-z]+\d+)$")
        & ~w.isin(FILLER_WORDS),
    )
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all tokens of two token sets; 0 when either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / (F.size(a) + F.size(b) - shared)).otherwise(F.lit(0.0))


def similar_names(reference: Column, names: Column, low: float = 0.20, high: float = 0.95) -> Column:
    """Names that resemble the reference without repeating it (low <= Jaccard < high). Without
    significant words in the reference, all names that differ from it stay. An empty outcome is null."""

    def scored(s: Column) -> Column:
        """Every name with its similarity; the words of the reference are found once."""
        pair = F.transform(s["names"], lambda n: F.struct(n.alias("n"), significant_tokens(n).alias("t")))
        return F.transform(pair, lambda x: F.struct(x["n"].alias("n"), jaccard(s["ref"], x["t"]).alias("j")))

    bound = F.array(F.struct(significant_tokens(reference).alias("ref"), names.alias("names"), F.lower(unaccent(reference)).alias("plain")))
    kept = F.transform(bound, lambda s: F.when(
        F.size(s["ref"]) > 0,
        F.transform(F.filter(scored(s), lambda x: (x["j"] > 0) & (x["j"] >= low) & (x["j"] < high)), lambda x: x["n"])
    ).otherwise(F.filter(s["names"], lambda n: (n != "") & (F.lower(unaccent(n)) != s["plain"]))))[0]
    untouched = reference.isNull() | (reference == "") | names.isNull() | (F.size(names) == 0)
    return F.when(untouched, names).otherwise(F.when(F.size(kept) > 0, kept))


def matching_tokens(
    name: Column, ingredient: Column, min_length: int, blocked: list[str], max_name: int, max_ingredient: int
) -> Column:
    """Ordered tokens for matching: the first `max_name` usable words of the name, then up to
    `max_ingredient` further ones of the ingredient."""

    def usable(c: Column) -> Column:
        letters = F.transform(words(F.upper(unaccent(F.trim(c)))), lambda w: F.regexp_replace(w, "[^A-Z]", ""))
        kept = F.filter(letters, lambda w: (F.length(w) >= min_length) & (~w.isin(blocked) if blocked else F.lit(True)))
        return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))

    first = F.slice(usable(name), 1, max_name)
    more = F.slice(F.array_except(usable(ingredient), first), 1, max_ingredient)
    return F.concat(first, more)


def html_text(c: Column) -> Column:
    """Visible text of a page or leaflet: scripts, styles, comments and tags out, entities decoded,
    blanks collapsed."""
    t = F.regexp_replace(c, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, sign in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def sections_text(c: Column, field: str = "content") -> Column:
    """Text of a list of leaflet sections, in order; no sections give an empty text."""
    return F.coalesce(
        F.array_join(F.transform(c, lambda s: F.coalesce(html_text(s[field]), F.lit(""))), " "), F.lit(""))


def prune_empty(c: Column) -> Column:
    """Drops nulls and blank texts from a list of strings; an empty list is null."""
    kept = F.filter(c, lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, kept)
