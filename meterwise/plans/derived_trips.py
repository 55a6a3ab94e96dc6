"""Trip tables derived from the driver's tables, to run the operators on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.operators.rules import TRIP_RULES, Limits, Rule, flag_rows

MONTH = "2024-01"
EVENT_LIMITS = Limits(unknown_zones=(25, 26))

# Orders span years and ship weeks later: no month rule, limits in days.
ORDER_RULES: tuple[Rule, ...] = tuple(r for r in TRIP_RULES if r.name != "out_of_month")
ORDER_LIMITS = Limits(
    min_minutes=1440.0, max_minutes=1440.0 * 365, max_miles=45.0, max_fare=90000.0,
    min_fare_per_mile=1000.0, max_fare_per_mile=2000.0, unknown_zones=(24,),
)

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of one key that a task may sort in a window.
HOT = 100_000


def next_time(
    df: DataFrame, key: str, time: str, tie: str, name: str, every: str = "hour", hot: int = HOT
) -> DataFrame:
    """Add the `time` of the following row of the same key, null on its last row. Rows
    without a time come first, null keys are one key.

    A key may hold a third of all rows, and a window by key would sort it in one task. So
    keys of more than `hot` rows are cut into hours, and a mark at the end of each hour
    carries the first time of the key's next one, found by a window with one row per hour.
    Other keys are windows whole. Rows are shuffled once; the keys that are cut are at most
    one per `hot` rows of the table, so they are broadcast.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    cut_keys = F.broadcast(counts.where(F.col("_rows") > hot).select("_key", F.lit(True).alias("_cut")))
    same = F.col(key).eqNullSafe(F.col("_key"))
    hour = F.date_trunc(every, F.col(time)).cast("timestamp_ntz")
    rows = df.join(cut_keys, same, "left").select(
        *df.columns, F.when(F.col("_cut"), hour).alias("_slice"), F.lit(False).alias("_mark")
    )
    starts = (
        df.select(key, time).join(cut_keys, same).groupBy(key, hour.alias("_slice")).agg(F.min(time).alias("_start"))
    )
    following = F.lead("_start").over(Window.partitionBy(key).orderBy("_slice"))
    marks = starts.select(
        key, "_slice", following.alias(time), F.lit(True).alias("_mark")
    )
    ahead = F.lead(time).over(Window.partitionBy(key, "_slice").orderBy("_mark", time, tie))
    both = rows.unionByName(marks, allowMissingColumns=True).withColumn(name, ahead)
    return both.where(~F.col("_mark")).select(*df.columns, name)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event: picked up when the event happened (a day earlier), dropped
    off at the user's next event. Every rule fires on some of them."""
    kinds = {"purchase": 1, "view": 2, "click": 3, "signup": 6}
    payment = F.coalesce(
        *[F.when(F.col("event_type") == kind, F.lit(code)) for kind, code in kinds.items()]
    )
    # Narrow before the shuffle: the strings stay behind.
    events = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        payment.cast("double").alias("payment_type"),
    )
    events = next_time(events, "user_id", "ts", "event_id", "_next")
    day = F.expr("INTERVAL 1 DAY")
    event, user = F.col("event_id"), F.col("user_id")
    pickup = F.col("ts") - day
    backwards = pickup - F.expr("INTERVAL 10 MINUTES")
    return events.select(
        event,
        pickup.alias("tpep_pickup_datetime"),
        F.when(event % 97 == 0, backwards)
        .otherwise(F.col("_next") - day)
        .alias("tpep_dropoff_datetime"),
        F.when(event % 10 != 9, (event % 10).cast("double")).alias("passenger_count"),
        (F.col("k") * F.lit(1.05)).alias("trip_distance"),
        ((user * 3 + event) % 28).cast("int").alias("PULocationID"),
        ((event * 5 + user) % 28).cast("int").alias("DOLocationID"),
        "payment_type",
        F.when(event % 50 == 0, F.lit(0.0))
        .otherwise(F.col("value") * F.lit(1.1) - F.lit(5.0))
        .alias("fare_amount"),
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, from order to shipping, between the supplier's and the
    customer's nation. All three joins are between tables that grow, so none is hinted."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        (F.col("l_linenumber") % 8).cast("double").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("s_nationkey").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        F.lit(1.0).alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
    )


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_zones from nations (zones) and regions (boroughs)."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("n_name").alias("zone_name"),
        F.col("r_name").alias("borough"),
    )


def nation_zones_repeated(
    spark: SparkSession, sf_dir: str, ids: Sequence[int] = (3, 7)
) -> DataFrame:
    """The same dimension with second copies of some keys."""
    zones = nation_zones(spark, sf_dir)
    return zones.unionByName(zones.where(F.col("location_id").isin(list(ids))))


def flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = nation_zones(spark, sf_dir)
    return flag_rows(event_trips(spark, sf_dir), zones, MONTH, limits=EVENT_LIMITS)


def flagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = order_trips(spark, sf_dir)
    # Each line is filed under the month it was ordered in.
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    zones = nation_zones(spark, sf_dir)
    return flag_rows(trips, zones, month, rules=ORDER_RULES, limits=ORDER_LIMITS)
