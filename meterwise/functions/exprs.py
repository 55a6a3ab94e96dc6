"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.errors import BadMonth

_MONTH = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def check_month(month: str) -> str:
    """Return `month` if it is a valid YYYY-MM, raise BadMonth otherwise."""
    if not isinstance(month, str) or not _MONTH.fullmatch(month):
        raise BadMonth(f"month must look like 2025-01, got {month!r}")
    return month


def month_bounds(month: Column) -> tuple[Column, Column]:
    """First instant and last whole second of a YYYY-MM month column."""
    first = F.concat(month, F.lit("-01")).cast("date")
    start = first.cast("timestamp_ntz")
    end = F.add_months(first, 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 SECOND")
    return start, end


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where bottom is zero."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))


def decimals(value: Column, digits: int) -> Column:
    """Round a double half away from zero at `digits` decimals, the way SQL engines
    scale doubles: multiply, round to a whole number, divide."""
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale) / scale


def mean_decimals(value: Column, digits: int) -> Column:
    """Round a mean or deviation at `digits` decimals. Its last bits depend on the order
    in which tasks were merged, so it is first put on a grid of nine decimals: a mean on
    the edge between two results then rounds the same way on every run."""
    return decimals(decimals(value, 9), digits)


def percent(part: Column, whole: Column, digits: int = 3) -> Column:
    """100 * part / whole, 0 where there are no rows."""
    return F.when(whole > 0, decimals(F.lit(100.0) * part / whole, digits)).otherwise(
        F.lit(0.0)
    )


def is_true(predicate: Column) -> Column:
    """A comparison with null is no violation."""
    return F.coalesce(predicate, F.lit(False))


def timestamp_text(ts: Column) -> Column:
    """Text of a timestamp: six fraction digits, none at whole seconds."""
    whole = F.date_trunc("SECOND", ts).cast("timestamp_ntz") == ts
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def without_nan(df: DataFrame) -> dict[str, Column]:
    """The floating-point columns with NaN as null: NaN sorts above every number in Spark,
    the rules and the profile treat it as missing."""
    floats = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return {c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast("double")) for c in floats}


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns(without_nan(df))
