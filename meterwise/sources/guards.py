"""Checks on inputs, run on the driver before work starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from meterwise.errors import EmptyInput, MissingInput


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def guard_inputs(spark: SparkSession, paths: dict[str, str]) -> None:
    """Raise MissingInput naming every `{what: path}` that does not exist."""
    missing = [f"{what} ({path})" for what, path in paths.items() if not path_exists(spark, path)]
    if missing:
        raise MissingInput(f"missing input: {', '.join(missing)}; load it first")


def guard_empty(df: DataFrame, what: str) -> DataFrame:
    """Return `df` if it has a row, raise EmptyInput otherwise. Reads one row."""
    if df.isEmpty():
        raise EmptyInput(f"{what} holds no rows")
    return df


def outputs_done(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether every output was committed (its `_SUCCESS` marker is there)."""
    return all(path_exists(spark, f"{p.rstrip('/')}/_SUCCESS") for p in paths)
