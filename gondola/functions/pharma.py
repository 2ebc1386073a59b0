"""Dosage, active ingredient, pharmaceutical form and street address rules.

Dosages are read, not rewritten: a text is a sum of amounts, each a number with an optional unit and an optional denominator. What
does not read as such a sum is no concentration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gondola.functions.scoring import EMPTY_LITERALS
from gondola.functions.text import unaccent

# Units of a dosage, units that make a concentration in a product name, what those are per, units with another
# spelling, what a dispensed amount is per (not part of the dosage), and words that open a remark.
UNITS = ["mg", "g", "mcg", "µg", "μg", "ug", "mui", "ui", "iu", "meq", "mmol", "ud", "ml", "%", "u"]
NAME_UNITS = ["mg", "mcg", "µg", "ui", "iu", "meq", "%"]
NAME_PER = ["ml", "g", "kg", "dose", "comp", "cp"]
SPELLINGS = {"µg": "mcg", "μg": "mcg", "ug": "mcg", "u": "ui"}
DISPENSED = ["gota", "cepa"]
REMARKS = ["por", "para", "de"]

_NUMBER = r"\d+(?:[.,]\d+)*"
_UNIT = "(?:" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}.^])"
_PER = r"\s*/\s*(?:\d+(?:[.,]\d+)?\s*)?(?!h\b)\p{L}+"
_AMOUNT = rf"({_NUMBER})\s*(?:({_UNIT})({_PER})?)?"
_SUM = rf"{_AMOUNT}(?:\s*\+\s*{_AMOUNT})*"
_HOURS = r"\s*[,/]\s*\d*\s*h\b"

# Spellings of hydrates and the spelling kept, applied in this order.
HYDRATES = [
    ("triidratado", "tri-hidratado"), ("trihidratado", "tri-hidratado"),
    ("triidratada", "tri-hidratada"), ("trihidratada", "tri-hidratada"),
    ("diidratado", "di-hidratado"), ("dihidratado", "di-hidratado"),
    ("diidratada", "di-hidratada"), ("dihidratada", "di-hidratada"),
    ("monohidratado", "monoidratado"), ("mono-hidratado", "monoidratado"),
    ("monohidratada", "monoidratada"), ("mono-hidratada", "monoidratada"),
    ("hemihidratado", "hemi-hidratado"), ("hemiidratado", "hemi-hidratado"),
    ("heptahidratado", "heptaidratado"), ("hepta-hidratado", "heptaidratado"),
    ("hexahidratado", "hexaidratado"), ("hexa-hidratado", "hexaidratado"),
    ("hemipentahidratado", "hemipentaidratado"), ("hemi-pentaidratado", "hemipentaidratado"),
    ("pentahidratado", "pentaidratado"), ("penta-hidratado", "pentaidratado"),
]

# Salts and esters written before the substance ("cloridrato de ...").
SALTS = [
    "acetato", "aceponato", "antimoniato", "benzoato", "besilato", "bissulfato", "brometo", "bromidrato",
    "butilbrometo", "carbonato", "citrato", "cloreto", "cloridrato", "decanoato", "diaspartato",
    "dicloridrato", "dimaleato", "dimesilato", "dipropionato", "embonato", "etanolato", "etexilato",
    "fendizoato", "fosfato", "fumarato", "furoato", "hemifumarato", "hemitartarato", "hiclato",
    "hidroxibenzoato", "lactato", "lisinato", "maleato", "malato", "mesilato", "metilsulfato",
    "micofenolato", "nitrato", "oleato", "oxalato", "pamoato", "propionato", "succinato", "sulfato",
    "tartarato", "tosilato", "valerato",
]

# Street abbreviations and their long forms, and words that announce a number.
STREET_WORDS = {"r.": "Rua", "av.": "Avenida", "rod.": "Rodovia", "trav.": "Travessa", "pres.": "Presidente", "pres": "Presidente",
                "gov.": "Governador", "gov": "Governador"}
NUMBER_WORDS = ["n°", "nº", "n.°", "n.º", "no", "número", "numero"]


def _either(words) -> str:
    return "|".join(words)


def _spelled(value: Column, spellings: dict[str, str]) -> Column:
    """The kept spelling of a word that has another one (compared in lower case)."""
    out = None
    for word, kept in spellings.items():
        out = F.when(F.lower(value) == word, kept) if out is None else out.when(F.lower(value) == word, kept)
    return out.otherwise(value)


def _number(value: Column) -> Column:
    """A number with a decimal point. Dots are thousands separators when they part two or more groups of three digits, or one
    group of zeros, after a number that does not begin with zero; a comma is always decimal."""
    grouped = value.rlike(r"^[1-9]\d{0,2}(\.\d{3}){2,}$") | value.rlike(r"^[1-9]\d{0,2}\.000$")
    return F.when(grouped, F.replace(value, F.lit("."))).otherwise(F.translate(value, ",", "."))


def dosage(c: Column) -> Column:
    """One spelling for concentrations ("12,5 mg" to "12.5mg", "(1000 + 200)mg" to "1000mg + 200mg"); null for anything that
    is not a concentration: other units, ranges, alternatives, lists, directions for use, units per themselves, mg
    beside g. Remarks (in parentheses, or from a remark word on), hourly rates and dispensed units are left out."""
    text = F.regexp_replace(F.trim(c), r"^[≥>]\s*", "")
    text = F.regexp_replace(text, rf"(?iu)\((?!\s*{_SUM}\s*\))[^()]*\)", "")  # parentheses that hold no sum
    text = F.regexp_replace(text, rf"(?iu)(?:\s+(?:{_either(REMARKS)})\b|\s*/\s*(?:{_either(DISPENSED)})\b|{_HOURS})[^+()]*", "")
    text = F.trim(F.translate(text, "()", ""))
    pattern = f"(?iu){_AMOUNT}"
    read = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(
        _number(F.regexp_extract(m, pattern, 1)).alias("number"),
        _spelled(F.regexp_extract(m, pattern, 2), SPELLINGS).alias("unit"),
        F.translate(F.regexp_replace(F.regexp_extract(m, pattern, 3), r"\s", ""), ",", ".").alias("per")))

    def shown(amount: Column, at: Column) -> Column:
        # a number without a unit takes the next unit to its right
        later = F.filter(F.slice(read, at + 1, F.size(read)), lambda a: a["unit"] != "")
        return F.concat(amount["number"], F.coalesce(F.concat(F.get(later, F.lit(0))["unit"], F.get(later, F.lit(0))["per"]), F.lit("")))

    plain = F.transform(F.filter(read, lambda a: a["per"] == ""), lambda a: F.lower(a["unit"]))
    to_itself = F.exists(read, lambda a: (a["unit"] != "") & (F.lower(a["per"]) == F.concat(F.lit("/"), F.lower(a["unit"]))))
    sums_up = text.rlike(f"^{pattern.replace('(?iu)', '(?iu)(?:', 1)}(?:\\s*\\+\\s*|$))+$") & ~text.rlike(r"\+\s*$")
    mixed = F.array_contains(plain, "mg") & F.array_contains(plain, "g")
    empty = F.lower(F.trim(c)).isin(EMPTY_LITERALS)
    return F.when(~empty & sums_up & ~to_itself & ~mixed, F.array_join(F.transform(read, shown), " + "))


def dosage_in_name(c: Column) -> Column:
    """The first concentration in a product name, without blanks; pack weights in g and volumes in ml do not count."""
    found = F.regexp_extract(c, rf"(?iu){_NUMBER}\s*(?:{_either(NAME_UNITS)})(?:\s*/\s*(?:{_NUMBER}\s*)?(?:{_either(NAME_PER)}))?", 0)
    return F.when(found != "", F.regexp_replace(found, r"\s", ""))


def _component(c: Column) -> Column:
    """One ingredient as words: strength and other remarks at the end left out, the salt first ("salt de substance"), and then
    the word acido first."""
    text = unaccent(c)
    for spelling, kept in HYDRATES:
        text = F.replace(text, F.lit(spelling), F.lit(kept))
    salted = F.regexp_replace(text, rf"\(({_either(SALTS)})\)\s*$", "$1")
    bare = F.regexp_replace(salted, r"(?:\s*\([^()]*\)|\s+\d+(?:[.,]\d+)?\s*(?:%|mg(?:/ml)?))+\s*$", "")
    words = F.filter(F.split(bare, r"\s+"), lambda w: w != "")
    n = F.size(words)
    first, last = F.get(words, F.lit(0)), F.get(words, n - 1)
    of = F.array(F.lit("de"))
    ahead = first.isin(SALTS) & (n > 1) & (F.get(words, F.lit(1)) != "de")
    behind = last.isin(SALTS) & (n > 1) & (F.get(words, n - 2) != "de") & ~first.isin(SALTS)
    ordered = (
        F.when(ahead, F.concat(F.slice(words, 1, 1), of, F.slice(words, F.lit(2), n)))
        .when(behind, F.concat(F.array(last), of, F.slice(words, F.lit(1), n - 1)))
        .otherwise(words))
    acid = F.array(F.lit("acido"))
    moved = F.when(F.array_contains(ordered, "acido"), F.concat(acid, F.filter(ordered, lambda w: w != "acido"))).otherwise(ordered)
    return F.array_join(moved, " ")


def ingredient(c: Column) -> Column:
    """One spelling for lists of active ingredients: sorted, distinct, upper case, joined by ' + '. Parts end at a plus sign, a
    semicolon, a line end, or a comma before a letter."""
    parts = F.filter(F.split(F.lower(c), r"[+;\r\n]|,(?=\s*\p{L})"), lambda p: F.trim(p) != "")
    named = F.array_sort(F.array_distinct(F.transform(parts, _component)))
    return F.when(F.trim(c) == "", c).otherwise(F.upper(F.array_join(named, " + ")))


def forms(c: Column) -> Column:
    """'Gel / Creme (tubo)' to [gel, creme]; null gives an empty list."""
    parts = F.transform(
        F.split(c, "[/,]"),
        lambda p: F.trim(F.regexp_replace(
            F.regexp_replace(F.lower(unaccent(F.trim(p))), r"\s*\([^)]*\)\s*", " "), r"\s+", " ")))
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def street_and_number(c: Column) -> Column:
    """'R. das Flores nº 10 - Centro' to 'Rua das Flores, 10'; without a number the street alone.

    Of the part before a dash or slash, the words are looked at: after a comma the first number is the house number, else the
    first one that stands behind the first word and is no day of the month ("27 de Setembro")."""
    raw = F.trim(F.translate(c, '\n"', " "))
    main = F.regexp_replace(F.regexp_extract(raw, r"^[^/-]*", 0), r"\.(?=[^\s°º])", ". ")

    def words(text: Column) -> Column:
        return F.filter(F.split(text, r"[\s,]+"), lambda w: (w != "") & ~F.lower(w).isin(NUMBER_WORDS))

    def numeric(word: Column) -> Column:
        return F.regexp_replace(word, r"(?iu)^n\.?[°º]", "").rlike(r"^\d+\p{L}?$")

    every = words(main)
    ahead, behind = words(F.split_part(main, F.lit(","), F.lit(1))), words(F.regexp_extract(main, r",(.*)$", 1))
    told = F.filter(behind, numeric)
    spots = F.filter(F.sequence(F.lit(1), F.greatest(F.size(every) - 1, F.lit(1))), lambda i: F.coalesce(
        numeric(F.get(every, i)) & (F.lower(F.coalesce(F.get(every, i + 1), F.lit(""))) != "de"), F.lit(False)))
    at = F.get(spots, F.lit(0))
    name = F.when(F.size(told) > 0, ahead).when(at.isNotNull(), F.slice(every, F.lit(1), at)).otherwise(ahead)
    number = F.regexp_replace(F.when(F.size(told) > 0, F.get(told, F.lit(0))).otherwise(F.get(every, at)), r"^\P{N}+", "")
    street = F.array_join(F.transform(name, lambda w: _spelled(w, STREET_WORDS)), " ")
    return F.when(street == "", raw).when(c.isNotNull(), F.concat_ws(", ", street, number))
