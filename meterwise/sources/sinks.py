"""Published outputs."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.sources.files import list_files


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let `write` fill a new folder beside `path` and put it in the place of `path` once
    it is complete. A failed write leaves what was there."""
    parent, _, name = path.rstrip("/").rpartition("/")
    # Spark's readers pass over names with a leading underscore.
    token = os.urandom(8).hex()
    new, old = (f"{parent}/_{kind}-{name}-{token}" for kind in ("new", "old"))
    at = spark._jvm.org.apache.hadoop.fs.Path
    system = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(new)
        if system.exists(at(path)):
            system.rename(at(path), at(old))
        if not system.rename(at(new), at(path)):
            raise OSError(f"cannot put {new} in the place of {path}")
    finally:
        if system.exists(at(old)) and not system.exists(at(path)):
            system.rename(at(old), at(path))
        for left in (new, old):
            system.delete(at(left), True)


def write_month(trips: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Publish one month of a Parquet table at `path` (`.../month=2025-01`). The month is
    replaced as a whole, sub-partitions that no longer occur included; until the new one
    is complete, readers see the old one."""
    publish(
        trips.sparkSession, path, lambda to: trips.write.partitionBy(*partitions).parquet(to)
    )


def write_csv(table: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """Publish a KPI table (one row per group) as one CSV file with a header. The
    aggregation stays parallel; its result moves to one task for the sorted write."""
    one = table.repartition(1)
    if order:
        one = one.sortWithinPartitions(*order)
    writer = one.write.option("header", True).option("emptyValue", "")
    publish(table.sparkSession, path, writer.csv)


def write_text(document: DataFrame, path: str) -> None:
    """Publish a one-row document."""
    publish(document.sparkSession, path, document.coalesce(1).write.text)


def write_table(table: DataFrame, path: str) -> None:
    """Publish a small Parquet table."""
    publish(table.sparkSession, path, table.repartition(1).write.parquet)


def output_inventory(spark: SparkSession, root: str, expected: Sequence[str]) -> DataFrame:
    """(output, present, files, kb) of every expected file or folder below `root`."""
    base = root.rstrip("/")
    inside = F.regexp_extract(F.col("file_path"), r"^(?:[a-z0-9]+:/*)?/?(.*)$", 1)
    prefix = base.split(":", 1)[-1].strip("/") + "/"
    relative = F.substring_index(F.replace(inside, F.lit(prefix), F.lit("")), "/", 1)
    found = (
        list_files(spark, root, "*")
        .groupBy(relative.alias("output"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size_bytes").alias("bytes"))
    )
    wanted = spark.createDataFrame([(e,) for e in expected], "output STRING")
    joined = wanted.join(found, "output", "left")
    return joined.select(
        "output",
        F.col("files").isNotNull().alias("present"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.round(F.col("bytes") / 1024, 1).alias("kb"),
    )
