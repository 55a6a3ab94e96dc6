"""Column profile of a raw table: one aggregate for all columns, then tall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterwise.functions.exprs import (
    decimals,
    mean_decimals,
    nan_to_null,
    percent,
    timestamp_text,
)
from meterwise.operators.median import Median, exact_medians

TOP = 20

# The low-cardinality columns of a trip file.
TRIP_CATEGORIES = ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")

# Aggregate and rounding of each statistic that needs one pass only.
_STATISTICS = {
    "min": (F.min, decimals),
    "max": (F.max, decimals),
    "mean": (F.avg, mean_decimals),
    "std": (F.stddev_samp, mean_decimals),
}
STATISTICS = tuple(_STATISTICS)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def temporal_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def _tall(wide: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile_schema(df: DataFrame) -> DataFrame:
    """(position, column_name, dtype): the description of a table, from its schema."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("dtype"))
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return _tall(df.agg(F.lit(1)), rows)


class _Columns:
    """Aggregates over one pass and, for each column, the struct that shows its own."""

    def __init__(self) -> None:
        self.aggregates: list[Column] = []

    def add(self, aggregate: Column) -> Column:
        name = f"_a{len(self.aggregates)}"
        self.aggregates.append(aggregate.alias(name))
        return F.col(name)


def _counts(columns: _Columns, names: Sequence[str]) -> dict[str, list[Column]]:
    rows = columns.add(F.count(F.lit(1)))
    out = {}
    for c in names:
        nulls = rows - columns.add(F.count(F.col(f"`{c}`")))
        out[c] = [
            rows.alias("row_count"), nulls.alias("null_count"),
            percent(nulls, rows).alias("null_pct"),
        ]
    return out


def _statistics(columns: _Columns, names: Sequence[str]) -> dict[str, list[Column]]:
    return {
        c: [
            rounded(columns.add(aggregate(F.col(f"`{c}`").cast("double"))), 4).alias(s)
            for s, (aggregate, rounded) in _STATISTICS.items()
        ]
        for c in names
    }


def _ranges(columns: _Columns, names: Sequence[str]) -> dict[str, list[Column]]:
    def text(c: str, aggregate) -> Column:
        return columns.add(timestamp_text(aggregate(F.col(f"`{c}`").cast("timestamp_ntz"))))

    return {
        c: [text(c, F.min).alias("min_text"), text(c, F.max).alias("max_text")] for c in names
    }


def _show(df: DataFrame, columns: _Columns, shown: dict[str, list[Column]]) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column_name"), *cells) for c, cells in shown.items()]
    return _tall(df.agg(*columns.aggregates), rows)


def profile_counts(df: DataFrame) -> DataFrame:
    """Rows, nulls (NaN included) and null share of every column."""
    columns = _Columns()
    return _show(nan_to_null(df), columns, _counts(columns, df.columns))


def profile_temporal(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Earliest and latest value of every date and time column, as text."""
    columns = _Columns()
    return _show(df, columns, _ranges(columns, names or temporal_columns(df)))


def _medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    medians = exact_medians(df, [Median(c, c) for c in names])
    return medians.select(
        F.col("name").alias("column_name"), decimals(F.col("median"), 4).alias("median")
    )


def profile_numeric(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Minimum, maximum, mean, sample deviation and exact median of numeric columns, at
    four decimals. One row per column; all null where a column has no value."""
    names, columns = list(names or numeric_columns(df)), _Columns()
    stats = _show(nan_to_null(df), columns, _statistics(columns, names))
    return stats.join(_medians(df, names), "column_name", "left").select(
        "column_name", "min", "max", "mean", "median", "std"
    )


def value_counts(df: DataFrame, columns: Sequence[str], top: int = TOP) -> DataFrame:
    """(column_name, value, n): the `top` most frequent values of each column, nulls
    counted too. Ties go to the smaller text. Counts are combined before the shuffle,
    and the rank limit is pushed below it, so a column with many values costs no task
    more than its share."""
    df = nan_to_null(df.select(*columns))
    numbers = set(numeric_columns(df))
    missing = {c: "nan" if c in numbers else "None" for c in columns}
    text = [F.coalesce(F.col(c).cast("string"), F.lit(missing[c])).alias(c) for c in columns]
    counts = (
        df.select(*text)
        .unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "value"))
    return counts.withColumn("_rank", rank).where(F.col("_rank") <= top).drop("_rank")


class OnePass:
    """What a profile takes from a single pass: counts, statistics and ranges of all
    columns. The aggregates can be computed on their own, or be observed on a table while
    it is written."""

    def __init__(self, df: DataFrame) -> None:
        columns = _Columns()
        counts = _counts(columns, df.columns)
        statistics = _statistics(columns, numeric_columns(df))
        ranges = _ranges(columns, temporal_columns(df))
        no_statistics = [F.lit(None).cast("double").alias(s) for s in STATISTICS]
        no_range = [F.lit(None).cast("string").alias(c) for c in ("min_text", "max_text")]
        self.aggregates = columns.aggregates
        self.measured = list(statistics)
        self._source = df
        self._shown = {
            f.name: [
                F.lit(i).alias("position"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                *counts[f.name],
                *statistics.get(f.name, no_statistics),
                *ranges.get(f.name, no_range),
            ]
            for i, f in enumerate(df.schema.fields, 1)
        }

    def tall(self, observed: dict | None = None) -> DataFrame:
        """One row per column, from a pass of its own or from observed values."""
        wide = nan_to_null(self._source).agg(*self.aggregates)
        if observed is not None:
            row = tuple(observed[c] for c in wide.columns)
            wide = wide.sparkSession.createDataFrame([row], wide.schema)
        rows = [F.struct(F.lit(c).alias("column_name"), *cells) for c, cells in self._shown.items()]
        return _tall(wide, rows)


def column_profile(
    df: DataFrame,
    categories: Sequence[str] = TRIP_CATEGORIES,
    top: int = TOP,
    observed: dict | None = None,
) -> DataFrame:
    """The whole profile, one row per column in table order. Statistics that do not
    apply to a column are null; `value_counts` is a map, most frequent first.

    Counts, statistics and ranges of all columns are one aggregate over one scan, or come
    from `observed`, the values of the aggregates of `OnePass(df)`.
    """
    one_pass = OnePass(df)
    tall = one_pass.tall(observed)
    if one_pass.measured:
        tall = tall.join(_medians(df, one_pass.measured), "column_name", "left")
    else:
        tall = tall.withColumn("median", F.lit(None).cast("double"))
    categories = [c for c in categories if c in df.columns]
    if categories:
        entry = F.struct((-F.col("n")).alias("order"), "value", "n")
        entries = F.transform(
            F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["value"], e["n"])
        )
        maps = value_counts(df, categories, top).groupBy("column_name").agg(
            F.map_from_entries(entries).alias("value_counts")
        )
        tall = tall.join(maps, "column_name", "left")
    else:
        tall = tall.withColumn("value_counts", F.lit(None).cast("map<string,bigint>"))
    return tall.select(
        "position", "column_name", "dtype", "row_count", "null_count", "null_pct",
        "min", "max", "mean", "median", "std", "min_text", "max_text", "value_counts",
    )
