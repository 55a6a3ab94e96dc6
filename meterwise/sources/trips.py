"""The raw trip scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterwise.errors import SchemaDrift
from meterwise.operators.rules import check_columns


def scan_trips(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Trip Parquet with the columns of all files; a column that a file lacks is null in
    its rows. Raises SchemaDrift if a required column is missing, or if files disagree on
    the type of a column. Give a schema to skip the footers of many files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    try:
        trips = reader.parquet(*paths)
    except Exception as error:  # raised by the JVM as such
        if "CANNOT_MERGE" not in str(error):
            raise
        raise SchemaDrift(f"the files disagree on column types: {error}") from error
    check_columns(trips)
    return trips


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of several tables."""
    from functools import reduce

    from pyspark.sql import functions as F

    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
