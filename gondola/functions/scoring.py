"""Scores, bands and the test for values that say nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no value".
EMPTY_LITERALS = [
    "n/a", "n/i", "n/d", "n.a", "n.a.", "n.i", "n.i.", "n.d", "n.d.", "na", "ni", "nd",
    "none", "null", "nan", "-", "--", "---", ".", "..", "...",
]

# Age bands, upper bound (exclusive) and label.
AGE_BANDS = [(2, "bebe"), (13, "crianca"), (18, "adolescente"), (25, "jovem"), (60, "adulto")]
OLDEST_BAND = "idoso"


def quintile(value: Column, cuts: Sequence[Column], ascending: bool = True) -> Column:
    """1 to 5 by four cut points (a value on a cut belongs below it); reversed when not ascending."""
    top = len(cuts) + 1
    out = None
    for i, cut in enumerate(cuts):
        level = i + 1 if ascending else top - i
        out = F.when(value <= cut, level) if out is None else out.when(value <= cut, level)
    return out.otherwise(top if ascending else 1)


def age(birth: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, birth) / 12).cast("int")


def age_band(years: Column) -> Column:
    out = F.when(years.isNull() | (years < 0), F.lit(None).cast("string"))
    for bound, label in AGE_BANDS:
        out = out.when(years < bound, label)
    return out.otherwise(OLDEST_BAND)


def says_nothing(c: Column, allow_numeric: bool = False) -> Column:
    """True for null, blank, placeholder, punctuation-only, one-character, one-repeated-character and
    (unless allowed) digits-only texts."""
    t = F.trim(c)
    low = F.lower(t)
    digits = t.rlike(r"^\d+$")
    repeated = low.rlike(r"^(.)\1*$")
    bad = (
        c.isNull() | (t == "") | low.isin(EMPTY_LITERALS) | t.rlike(r"^[\W_]+$") | (F.length(t) == 1)
        | (repeated & ~digits if allow_numeric else repeated)
    )
    return bad if allow_numeric else bad | digits


def null_if_nothing(c: Column, allow_numeric: bool = False) -> Column:
    return F.when(~says_nothing(c, allow_numeric), c)


def without_nothing(c: Column, allow_numeric: bool = False) -> Column:
    """A list without such elements; null when none is left."""
    kept = F.filter(c, lambda x: ~says_nothing(x, allow_numeric))
    return F.when(F.size(kept) > 0, kept)


def sweep_nothing(
    df: DataFrame, exclude: Sequence[str] = (), allow_numeric: Sequence[str] = ()
) -> DataFrame:
    """Nulls such values in every string and string-list column of a frame, in one projection."""
    out = []
    for f in df.schema.fields:
        numeric = f.name in allow_numeric
        if f.name in exclude:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(null_if_nothing(F.col(f.name), numeric).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            out.append(without_nothing(F.col(f.name), numeric).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def first_largest(columns: Sequence[str], labels: Sequence[str] | None = None) -> Column:
    """Label of the column with the largest value (first one on ties); null when all are null or the
    sum is 0."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    top = F.greatest(*values)
    out = F.when(sum(values[1:], values[0]) == 0, F.lit(None).cast("string"))
    for v, label in zip(values, labels or columns):
        out = out.when(v == top, label)
    return out
