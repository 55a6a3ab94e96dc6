"""Partial states of grouped measures, which merge: of parts of a table into the whole, and
of fine groups into coarse ones.

A state has the number, sum, sum of squares about its own mean, least and greatest value of
a measure. Merging adds up the first two and takes the extremes; the squares get what the
parts' means differ by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("n", "sum", "m2", "min", "max")


def _name(measure: str, field: str) -> str:
    return f"{measure}__{field}"


def partial(measures: Sequence[str]) -> list[Column]:
    """Aggregates that make the states of measures, columns of doubles."""
    out = []
    for m in measures:
        x = F.col(m)
        made = {
            "n": F.count(x), "sum": F.sum(x), "m2": F.var_pop(x) * F.count(x), "min": F.min(x),
            "max": F.max(x),
        }
        out += [made[f].alias(_name(m, f)) for f in FIELDS]
    return out


def merged(measures: Sequence[str]) -> list[Column]:
    """Aggregates that merge states into one."""
    out = []
    for m in measures:
        n, total, m2, low, high = (F.col(_name(m, f)) for f in FIELDS)
        number, whole = F.sum(n), F.sum(total)
        apart = F.sum(total * total / F.nullif(n, F.lit(0))) - whole * whole / F.nullif(number, F.lit(0))
        # Rounding may leave less than nothing.
        squares = F.sum(m2) + F.greatest(apart, F.lit(0.0))
        both = {"n": number, "sum": whole, "m2": squares, "min": F.min(low), "max": F.max(high)}
        out += [both[f].alias(_name(m, f)) for f in FIELDS]
    return out


def count(measure: str) -> Column:
    return F.col(_name(measure, "n"))


def mean(measure: str) -> Column:
    return F.col(_name(measure, "sum")) / F.nullif(count(measure), F.lit(0))


def deviation(measure: str) -> Column:
    """Of a sample; null for one value."""
    return F.sqrt(F.col(_name(measure, "m2")) / F.nullif(count(measure) - 1, F.lit(0)))


def least(measure: str) -> Column:
    return F.col(_name(measure, "min"))


def greatest(measure: str) -> Column:
    return F.col(_name(measure, "max"))


def roll_up(states: DataFrame, keys: Sequence[str], measures: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """States by coarser keys; the columns `sums` are counts to be added."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *merged(measures))
