"""Star model: zone dimension, trip fact, and the fact with both zone roles joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.functions.exprs import minutes_between, ratio
from meterwise.operators.joins import check_unique
from meterwise.operators.rules import DROPOFF, FLAGS, PICKUP
from meterwise.sources.guards import path_exists

# Columns passed through when the input has them, with their name in the fact.
_OPTIONAL = {
    "passenger_count": "passenger_count",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "congestion_surcharge": "congestion_surcharge",
    "total_amount": "total_amount",
}

ROLES = ("pu", "do")


def fact_trips(valid: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Validated trips under model names, with the derived measures. Columns named in
    `carry` (a natural key, say) are kept as they are."""
    minutes = minutes_between(F.col(PICKUP), F.col(DROPOFF))
    columns = [
        F.col(PICKUP).alias("pickup_at"),
        F.col("PULocationID").alias("pu_location_id"),
        F.hour(PICKUP).alias("pickup_hour"),
        F.to_date(F.col(PICKUP)).alias("pickup_date"),
        F.col(DROPOFF).alias("dropoff_at"),
        F.col("DOLocationID").alias("do_location_id"),
        minutes.alias("duration_minutes"),
        F.col("trip_distance"),
        ratio(F.col("trip_distance"), minutes / 60).alias("speed_mph"),
        F.col("payment_type"),
        F.col("fare_amount"),
        ratio(F.col("fare_amount"), F.col("trip_distance")).alias("fare_per_mile"),
        *[F.col(c).alias(name) for c, name in _OPTIONAL.items() if c in valid.columns],
        F.col(FLAGS),
        (F.col(FLAGS) != "").alias("has_soft_flag"),
    ]
    return valid.select(*carry, *columns)


def enrich(
    fact: DataFrame,
    zones: DataFrame,
    roles: Sequence[str] = ROLES,
    on_duplicate: str = "error",
) -> DataFrame:
    """Left join the zone dimension once per role (`pu` pickup, `do` dropoff).

    A repeated zone id would multiply trips. `on_duplicate` decides: `error` checks the
    dimension and raises, `first` keeps the alphabetically first zone of an id, `allow`
    joins as is. Except for `allow`, the join key is visibly distinct, so Spark drops the
    join of a role no query column comes from. The join carries no hint; see
    `rules._join_known_zones`.
    """
    if on_duplicate == "error":
        check_unique(zones, "location_id")
        zones = zones.dropDuplicates(["location_id"])
    elif on_duplicate == "first":
        first = F.min(F.struct("zone_name", "borough")).alias("z")
        zones = zones.groupBy("location_id").agg(first).select("location_id", "z.*")
    elif on_duplicate != "allow":
        raise ValueError(f"on_duplicate: error, first or allow, not {on_duplicate!r}")
    for role in roles:
        side = zones.select(
            F.col("location_id").alias(f"_{role}"),
            F.col("zone_name").alias(f"{role}_zone"),
            F.col("borough").alias(f"{role}_borough"),
        )
        match = fact[f"{role}_location_id"] == side[f"_{role}"]
        fact = fact.join(side, match, "left").drop(f"_{role}")
    return fact


def unmatched_zones(fact: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Trips per zone id of the role that the dimension does not hold (null included).
    Trips are counted per id first, so the anti join sees one row per id."""
    ids = fact.groupBy(F.col(f"{role}_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("trips")
    )
    return ids.join(zones.select("location_id").distinct(), "location_id", "left_anti")


def write_ordered(table: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write a table so that its rows are numbered in this order: ranges of it go to tasks,
    each of which sorts its range and writes one file."""
    ranges = table.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.write.option("maxRecordsPerFile", 0).parquet(path)
    number_files(table.sparkSession, path)


def _ordinal(name: str = "_metadata.file_name") -> Column:
    """The number of a file in its write, from the name that Spark gave it: the task's
    number, then the task's count of files."""
    found = lambda pattern: F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).cast("bigint")
    return found(r"^part-(\d+)-") * (1 << 20) + found(r"[-.]c(\d+)\.")


def _offsets(spark: SparkSession, path: str) -> DataFrame:
    """(_ordinal, _ahead): the rows of earlier files, for every file of one write. The
    running sum covers one row per file."""
    files = spark.read.parquet(path).groupBy(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = files.groupBy(_ordinal("_name").alias("_ordinal")).agg(
        F.sum("_rows").alias("_rows"), F.min("_path").alias("_one"), F.max("_path").alias("_other")
    )
    earlier = Window.orderBy("_ordinal").rowsBetween(Window.unboundedPreceding, -1)
    mixed = F.raise_error(F.concat(F.lit("files of several writes, or not by Spark: "), F.col("_other")))
    told_apart = F.col("_ordinal").isNotNull() & (F.col("_one") == F.col("_other"))
    ahead = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    return sizes.select("_ordinal", F.when(told_apart, ahead).otherwise(mixed.cast("bigint")).alias("_ahead"))


def number_files(spark: SparkSession, path: str) -> None:
    """Publish the offsets of a table's files beside them, for `read_numbered`."""
    _offsets(spark, path).write.mode("overwrite").parquet(f"{path}/_offsets")


def read_numbered(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A Parquet table of one write with dense ids 1..n by position in its files, without
    moving any row: the id is the number of rows in earlier files plus the row's place in
    its file. Needs no key, so full copies of a row are no problem. The files' offsets were
    published by `number_files` or are counted now; they are joined by the number in the
    file's name. A query that does not read the id does not pay for it: Spark drops an
    outer join whose columns are unused."""
    table = spark.read.parquet(path)
    place = table.select(
        "*", _ordinal().alias("_file"), F.col("_metadata.row_index").alias("_place")
    )
    published = f"{path}/_offsets"
    if path_exists(spark, f"{published}/_SUCCESS"):
        offsets = spark.read.schema("_ordinal BIGINT, _ahead BIGINT").parquet(published)
    else:
        offsets = _offsets(spark, path)
    offsets = offsets.groupBy(F.col("_ordinal").alias("_file")).agg(F.max("_ahead").alias("_ahead"))
    numbered = place.join(offsets, "_file", "left")
    return numbered.select(
        (F.col("_ahead") + F.col("_place") + 1).cast("bigint").alias(name), *table.columns
    )
