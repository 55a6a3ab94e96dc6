"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from meterwise.errors import DuplicateKeys


def same_keys_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Equi-join on equally named keys in which null equals null, as in GROUP BY. Keys
    known to hold no null are compared plainly, which hashes faster."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = [
        left[k] == right[f"_r_{k}"] if k in never_null else left[k].eqNullSafe(right[f"_r_{k}"])
        for k in keys
    ]
    joined = left.join(right, reduce(lambda a, b: a & b, match), how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def bounded_rows(df: DataFrame, limit: int) -> int | None:
    """The row count of a small table, or None if it holds more than `limit` rows.
    Reads at most limit + 1 rows."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def repeated_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a dimension, with their row counts."""
    counts = dim.where(dim[key].isNotNull()).groupBy(key).count()
    return counts.where("count > 1").withColumnRenamed("count", "copies")


def check_unique(dim: DataFrame, key: str) -> None:
    repeated = [str(r[key]) for r in repeated_keys(dim, key).limit(10).collect()]
    if repeated:
        raise DuplicateKeys(
            f"dimension key {key} is repeated (first ones: {', '.join(repeated)}); "
            "a left join would multiply fact rows"
        )
