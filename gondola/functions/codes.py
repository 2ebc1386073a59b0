"""Product barcodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _weighted(code13: Column) -> Column:
    return reduce(
        lambda a, b: a + b,
        [F.substring(code13, i + 1, 1).cast("int") * (3 if i % 2 else 1) for i in range(12)],
    )


def check_digit(code12: Column) -> Column:
    """EAN-13 check digit of the first twelve digits."""
    return ((10 - _weighted(code12) % 10) % 10).cast("string")


def barcode(number: Column) -> Column:
    """A valid 13-digit code for a number."""
    body = F.lpad(number.cast("string"), 12, "0")
    return F.concat(body, check_digit(body))


def valid_barcode(c: Column) -> Column:
    """Digits only, 1 to 13 of them, no in-store prefix 99, right check digit."""
    t = F.trim(c)
    shaped = t.rlike(r"^\d{1,13}$") & ~t.startswith("99")
    full = F.lpad(t, 13, "0")
    return F.coalesce(shaped & (check_digit(full) == F.substring(full, 13, 1)), F.lit(False))


def canonical_code(c: Column) -> Column:
    """The code without leading zeros: variants of one code meet here."""
    return F.regexp_replace(c, "^0+", "")
