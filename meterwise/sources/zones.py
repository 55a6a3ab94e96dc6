"""The zone lookup, from a JSON export or a CSV file, as one normalised dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.errors import MeterwiseError, MissingInput
from meterwise.sources.files import file_checksums
from meterwise.sources.guards import guard_empty, path_exists

UNKNOWN = "Unknown"

# Fields read from the JSON export; the nested geometry is not among them.
_JSON_FIELDS = "locationid STRING, zone STRING, borough STRING"


def read_zones_json(spark: SparkSession, path: str) -> DataFrame:
    """dim_zones(location_id, zone_name, borough) from a JSON array of records. Records
    without an integer id are left out."""
    raw = spark.read.schema(_JSON_FIELDS).option("multiLine", True).json(path)
    zones = raw.select(
        F.trim("locationid").try_cast("int").alias("location_id"),
        F.coalesce("zone", F.lit(UNKNOWN)).alias("zone_name"),
        F.coalesce("borough", F.lit(UNKNOWN)).alias("borough"),
    )
    return zones.where(F.col("location_id").isNotNull())


def skipped_zones_json(spark: SparkSession, path: str) -> DataFrame:
    """Ids of JSON records left out because they are not integers."""
    raw = spark.read.schema(_JSON_FIELDS).option("multiLine", True).json(path)
    return raw.select("locationid").where(
        F.col("locationid").isNotNull() & F.trim("locationid").try_cast("int").isNull()
    )


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """The same dimension from a CSV file with a header (LocationID, Zone, Borough, in
    any case and order). Null ids are left out; a non-numeric id is an error."""
    raw = spark.read.option("header", True).csv(path)
    names = {c.strip().lower(): c for c in raw.columns}
    if "locationid" not in names:
        raise MissingInput(f"zone CSV {path} has no LocationID column")

    def text(name: str):
        return F.coalesce(F.col(names[name]), F.lit(UNKNOWN)) if name in names else F.lit(UNKNOWN)

    zones = raw.select(
        F.col(names["locationid"]).cast("double").cast("int").alias("location_id"),
        text("zone").alias("zone_name"),
        text("borough").alias("borough"),
    )
    return zones.where(F.col("location_id").isNotNull())


READERS = {"json": read_zones_json, "csv": read_zones_csv}


Source = tuple[str, str, str]
"""How a lookup was retrieved, its format (json or csv), and its path."""


def read_zones(spark: SparkSession, sources: Sequence[Source]) -> tuple[DataFrame, Source]:
    """The zones of the first usable source, and that source. One that is missing,
    unreadable or empty falls through to the next; the model and the validation both
    read whatever was chosen."""
    reasons = []
    for mode, kind, path in sources:
        if not path_exists(spark, path):
            reasons.append(f"{mode}: {path} does not exist")
            continue
        try:
            return guard_empty(READERS[kind](spark, path), f"zone source {mode}"), (
                mode, kind, path,
            )
        except (MeterwiseError, AnalysisException) as error:
            reasons.append(f"{mode}: {error}")
    raise MissingInput("no usable zone source; " + "; ".join(reasons))


def source_facts(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """The files of a lookup in the shape of `files.FACTS`, with the number of records
    and all columns of the source, read or not."""
    reader = spark.read.option("header", True).option("multiLine", True)
    raw = reader.csv(path) if kind == "csv" else reader.json(path)
    return file_checksums(spark, path, "*").select(
        F.lit(path).alias("file_path"),
        "entry",
        "file_name",
        "file_size_bytes",
        F.lit(raw.count()).cast("bigint").alias("row_count"),
        F.lit(None).cast("int").alias("num_row_groups"),
        F.array(*[F.lit(c) for c in raw.columns]).alias("columns"),
        *[F.lit(None).cast("string").alias(c) for c in ("range_min", "range_max")],
        "sha256",
        F.lit(None).cast("string").alias("error"),
    )
