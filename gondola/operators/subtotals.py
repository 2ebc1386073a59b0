"""Subtotals over several sets of columns (grouping sets, rollup, cube) in one pass.

Rows are summed per finest group before they are copied for the sets: Spark's own grouping sets copy every input row as often as there are sets, and only then begin
to add up. A distinct count is no sum, so its column stays in the groups until every set has met it. For that the groups of a
value are brought to one place, once for all sets, and the first of them in a group of a set is counted there. No group keeps a
set of values in memory, and a group that holds a third of all rows is folded by every map task."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    """All columns, then one fewer from the right each, down to the grand total."""
    return [list(dims[:n]) for n in range(len(dims), -1, -1)]


def cube_sets(dims: Sequence[str]) -> list[list[str]]:
    """Every choice of columns."""
    return [list(c) for n in range(len(dims), -1, -1) for c in combinations(dims, n)]


def subtotals(
    df: DataFrame, dims: Sequence[str], sets: Iterable[Sequence[str]], sums: Mapping[str, Column], distinct: tuple[str, str] | None = None
) -> DataFrame:
    """One row per group of each of `sets` (columns among `dims`): `dims`, null where the set leaves the column out; `level`, which tells these
    nulls from null values (a bit per column, the first one highest, 1: left out); the sums; and, for `distinct` (column,
    name), how many different values other than null the column has. A set given twice counts once; a null value is a group of its own. Without rows there is
    no row, the grand total neither."""
    dims = list(dims)
    chosen = list(dict.fromkeys(tuple(d for d in dims if d in s) for s in map(set, sets)))
    more = [F.col(distinct[0]).alias("_value")] if distinct else []
    names = ["_value"] if distinct else []
    fine = df.select(*dims, *more, *[c.alias(n) for n, c in sums.items()]).groupBy(*dims, *names).agg(*[F.sum(n).alias(n) for n in sums])
    if not distinct:
        copied = fine.groupingSets([[F.col(d) for d in s] for s in chosen], *dims)
        return copied.agg(F.grouping_id(*dims).alias("level"), *[F.sum(n).alias(n) for n in sums])
    # a value has one row per group of all columns here, and all of them in one place: the first one in a group of a set counts for it
    placed = fine.repartition("_value")
    firsts = []
    for order, some in _orders(dims, chosen):
        windows = {}
        for s in some:
            place = F.row_number().over(Window.partitionBy("_value", *order[:len(s)]).orderBy(*order[len(s):])) if len(s) < len(dims) else F.lit(1)
            windows[f"_first_{chosen.index(s)}"] = ((place == 1) & F.col("_value").isNotNull()).cast("long")
        placed = placed.withColumns(windows)
        firsts += windows
    folded = placed.groupBy(*dims).agg(*[F.sum(n).alias(n) for n in [*sums, *firsts]])
    copied = folded.groupingSets([[F.col(d) for d in s] for s in chosen], *dims)
    totals = copied.agg(F.grouping_id(*dims).alias("level"), *[F.sum(n).alias(n) for n in [*sums, *firsts]])
    number = F.coalesce(*[F.when(F.col("level") == _level(dims, s), F.col(f"_first_{i}")) for i, s in enumerate(chosen)])
    return totals.select(*dims, "level", *sums, number.alias(distinct[1]))


def _level(dims: Sequence[str], chosen: Sequence[str]) -> int:
    return sum(0 if d in chosen else 1 << (len(dims) - 1 - i) for i, d in enumerate(dims))


def _orders(dims: Sequence[str], sets: Sequence[tuple[str, ...]]) -> list[tuple[list[str], list[tuple[str, ...]]]]:
    """Orders of all columns with the sets that are a beginning of them, each set once: sets of one order share its sort."""
    out: list[tuple[list[str], list[tuple[str, ...]]]] = []
    for s in sorted(sets, key=len, reverse=True):
        fits = next((some for order, some in out if set(order[:len(s)]) == set(s)), None)
        if fits is None:
            out.append(([*s, *[d for d in dims if d not in s]], [s]))
        else:
            fits.append(s)
    return out
