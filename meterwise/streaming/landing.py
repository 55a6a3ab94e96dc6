"""Validation of files as they land, with Structured Streaming.

The rules are row predicates, so the same `flag_rows` runs on a stream. The checkpoint
remembers which files were taken; a file is flagged and published exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterwise.operators import rules


def validate_landed(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | str,
    zones: DataFrame,
    month: str | Column,
    trips_path: str,
    checkpoint: str,
    rule_set: Sequence[rules.Rule] = rules.TRIP_RULES,
    limits: rules.Limits = rules.Limits(),
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Take all files not seen before, in batches, and stop. Valid and excluded rows go
    to one table partitioned by month and `valid`. `month` may be a column."""
    landed = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    flagged = rules.flag_rows(landed, zones, month, rule_set, limits)
    label = F.lit(month) if isinstance(month, str) else month
    marked = flagged.withColumns(
        {"month": label, "valid": ~rules.any_flag(rule_set, rules.HARD)}
    )
    return (
        rules.drop_working_columns(marked)
        .writeStream.format("parquet")
        .option("path", trips_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("month", "valid")
        .trigger(availableNow=True)
        .start()
    )
