"""The registered queries: every operator on tables derived from the driver's."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.functions.exprs import month_bounds
from meterwise.operators import metrics, model, profile, report, rules
from meterwise.operators.joins import repeated_keys
from meterwise.plans import derived_trips as src
from meterwise.plans import monthly
from meterwise.plans.incremental import KpiStore
from meterwise.session import apply_settings
from meterwise.sources import commits, files, sinks, trips, zones
from meterwise.sources.scratch import scratch_folder, written
from meterwise.streaming.landing import validate_landed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
TIME_COLUMNS = ("ts", "l_shipdate", "o_orderdate")


def query(fn: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir.rstrip("/"))

    _QUERIES[name or fn.__name__] = run
    return run


def named(name: str) -> Callable[[Query], Query]:
    """Register under a name that an import already uses."""
    return lambda fn: query(fn, name)


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources and manifest ---------------------------------------------------


@query
def scan_trips(spark, sf_dir):
    """Two landed files, one of which has a column more."""
    path = scratch_folder(spark, "landed")
    rows = src.event_trips(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    rows.where(~odd).write.parquet(f"{path}/plain")
    rows.where(odd).withColumn("surcharge", F.col("event_id") * 0.25).write.parquet(f"{path}/more")
    return trips.scan_trips(spark, [f"{path}/plain", f"{path}/more"])


@query
def manifest(spark, sf_dir):
    """All that does not change with the place and the time of the files."""
    facts = files.inspect_files(spark, sf_dir, TIME_COLUMNS)
    entries = files.manifest_rows(facts, "S1", "bulk_parquet", "driver tables")
    return entries.select(
        "entry", "source", "retrieval_mode", "description", "filename", "row_count",
        F.concat_ws(",", "columns").alias("columns"), "pickup_date_min", "pickup_date_max",
        (F.length("sha256") == 64).alias("has_checksum"), (F.col("num_row_groups") > 0).alias("has_rows"),
    )


@query
def manifest_counts(spark, sf_dir):
    facts = files.inspect_files(spark, sf_dir, TIME_COLUMNS, checksum=False)
    return files.manifest_rows(facts, "S1", "bulk_parquet", "driver tables").select(
        "filename", "row_count", F.size("columns").cast("bigint").alias("n_columns")
    )


@query
def source_coverage(spark, sf_dir):
    facts = files.inspect_files(spark, sf_dir, TIME_COLUMNS, checksum=False)
    return facts.select("file_name", "range_min", "range_max")


@query
def file_checksums(spark, sf_dir):
    return files.file_checksums(spark, sf_dir, "*.parquet")


@query
def checksums_of_written_files(spark, sf_dir):
    """The ids of the events of each type, a line each, as files whose bytes are known."""
    path, lines = scratch_folder(spark, "ids"), F.col("event_id").cast("string").alias("value")
    ids = src.table(spark, sf_dir, "events").select("event_type", "event_id").repartition("event_type")
    ids = ids.sortWithinPartitions("event_type", "event_id").select("event_type", lines)
    ids.write.partitionBy("event_type").text(path)
    kind = F.regexp_extract("entry", "event_type=([^/]+)/", 1).alias("event_type")
    return files.file_checksums(spark, path, "part-*").select(kind, "file_size_bytes", "sha256")


@query
def incremental_files(spark, sf_dir):
    """Against a manifest that lacks events, has an older orders file and one file
    that is gone."""
    current = files.file_checksums(spark, sf_dir, "*.parquet").withColumn("source", F.lit("S1"))
    entry = F.col("entry")
    known = current.where(entry != "events.parquet").select(
        "source",
        F.when(entry == "region.parquet", "gone.parquet").otherwise(entry).alias("entry"),
        F.when(entry == "orders.parquet", F.sha2("sha256", 256))
        .otherwise(F.col("sha256"))
        .alias("sha256"),
    )
    return files.decide_loads(current, known).select("entry", "decision")


@query
def rejected_files(spark, sf_dir):
    """All given files, beside one that is no Parquet."""
    path = scratch_folder(spark, "landed")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/broken.parquet")
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    stream.write(bytearray(b"no Parquet"))
    stream.close()
    facts = files.inspect_files(spark, sf_dir).unionByName(files.inspect_files(spark, path))
    bad = F.col("error").isNotNull()
    return facts.select(
        "entry", bad.alias("rejected"), F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


@query
def dim_zones(spark, sf_dir):
    return src.nation_zones(spark, sf_dir)


def _zones_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the dimension the way a publisher would and return the path."""
    path = scratch_folder(spark, "zones-csv")
    src.nation_zones(spark, sf_dir).select(
        F.col("location_id").alias("LocationID"),
        F.col("borough").alias("Borough"),
        F.col("zone_name").alias("Zone"),
    ).write.option("header", True).csv(path)
    return path


@query
def dim_zones_csv(spark, sf_dir):
    return zones.read_zones_csv(spark, _zones_csv(spark, sf_dir))


@query
def dim_zones_json(spark, sf_dir):
    """One JSON array, as the publisher's service sends it."""
    path = scratch_folder(spark, "zones-json")
    record = F.struct(
        F.col("location_id").cast("string").alias("locationid"),
        F.col("zone_name").alias("zone"), "borough", F.lit("ignored").alias("the_geom"),
    )
    zones_of = src.nation_zones(spark, sf_dir)
    zones_of.agg(F.to_json(F.collect_list(record))).coalesce(1).write.text(path)
    return zones.read_zones_json(spark, path)


@query
def zone_source_mode(spark, sf_dir):
    csv = _zones_csv(spark, sf_dir)
    candidates = [("api_json", "json", f"{csv}-absent"), ("csv_fallback", "csv", csv)]
    dim, (mode, _, _) = zones.read_zones(spark, candidates)
    return dim.withColumn("zone_lookup_mode", F.lit(mode))


@query
def zone_manifest(spark, sf_dir):
    facts = zones.source_facts(spark, "csv", _zones_csv(spark, sf_dir))
    entries = files.manifest_rows(facts, "S3", "csv_fallback", "zone lookup")
    return entries.select(
        "source", "retrieval_mode", "row_count", F.concat_ws(",", "columns").alias("columns")
    ).distinct()


# --- profile ----------------------------------------------------------------


@query
def profile_counts(spark, sf_dir):
    return profile.profile_counts(src.event_trips(spark, sf_dir))


@query
def profile_schema(spark, sf_dir):
    return profile.profile_schema(src.event_trips(spark, sf_dir))


@query
def profile_temporal(spark, sf_dir):
    return profile.profile_temporal(src.event_trips(spark, sf_dir))


@query
def profile_numeric(spark, sf_dir):
    return profile.profile_numeric(written(src.event_trips(spark, sf_dir), "trips"))


@query
def profile_lineitem(spark, sf_dir):
    return profile.profile_numeric(src.table(spark, sf_dir, "lineitem"))


@query
def profile_orders(spark, sf_dir):
    return profile.column_profile(src.table(spark, sf_dir, "orders"), ()).drop("value_counts")


@query
def profile_customer(spark, sf_dir):
    return profile.column_profile(src.table(spark, sf_dir, "customer"), ()).drop("value_counts")


@query
def value_counts_topk(spark, sf_dir):
    rows = src.event_trips(spark, sf_dir)
    return profile.value_counts(rows, ["payment_type", "passenger_count", "PULocationID"])


@query
def value_counts_part(spark, sf_dir):
    part = src.table(spark, sf_dir, "part")
    return profile.value_counts(part, ["p_brand", "p_type", "p_size"])


@named("profile")
def whole_profile(spark, sf_dir):
    rows = written(src.event_trips(spark, sf_dir), "trips")
    columns = profile.column_profile(rows, ("payment_type",))
    return columns.withColumn("value_counts", F.to_json("value_counts"))


# --- validation -------------------------------------------------------------


@named("month_bounds")
def month_bounds_of_orders(spark, sf_dir):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("month")
    months = src.table(spark, sf_dir, "orders").select(month).distinct()
    start, end = month_bounds(F.col("month"))
    return months.select("month", start.alias("month_start"), end.alias("month_end"))


@query
def trip_duration(spark, sf_dir):
    flagged = src.flagged_events(spark, sf_dir)
    return flagged.select("event_id", F.col(rules.DURATION).alias("duration_minutes"))


@query
def flag_rows(spark, sf_dir):
    flagged = src.flagged_events(spark, sf_dir)
    return flagged.select("event_id", *[r.column for r in rules.TRIP_RULES], rules.FLAGS)


def _flag_query(rule: rules.Rule) -> Query:
    def flag(spark, sf_dir):
        return src.flagged_events(spark, sf_dir).select("event_id", rule.column)

    return flag


for _rule in rules.TRIP_RULES:
    _short = _rule.column.replace("passenger_count_suspect", "passenger_suspect")
    query(_flag_query(_rule), _short)


@query
def row_disposition(spark, sf_dir):
    flagged = src.flagged_events(spark, sf_dir)
    return flagged.select("event_id", rules.disposition().alias("disposition"))


@query
def validated_trips(spark, sf_dir):
    return rules.valid_rows(src.flagged_events(spark, sf_dir))


@query
def excluded_trips(spark, sf_dir):
    return rules.excluded_rows(src.flagged_events(spark, sf_dir))


# --- report -----------------------------------------------------------------


def _tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.tally(src.flagged_events(spark, sf_dir))


@query
def report_counts(spark, sf_dir):
    return report.report_counts(_tally(spark, sf_dir))


@query
def flag_counts(spark, sf_dir):
    return report.flag_counts(_tally(spark, sf_dir))


@query
def flag_summary(spark, sf_dir):
    return report.flag_summary(_tally(spark, sf_dir))


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.mask_counts(src.flagged_events(spark, sf_dir))


@query
def flag_masks(spark, sf_dir):
    return _masks(spark, sf_dir)


@query
def flag_overlaps(spark, sf_dir):
    return report.flag_overlaps(_masks(spark, sf_dir))


@query
def mask_kpi_summary(spark, sf_dir):
    return metrics.kpi_summary(report.tally_masks(_masks(spark, sf_dir)), limits=src.EVENT_LIMITS)


@query
def rule_annotations(spark, sf_dir):
    return report.rule_annotations(_tally(spark, sf_dir), src.EVENT_LIMITS)


@query
def report_json(spark, sf_dir):
    rows = written(src.event_trips(spark, sf_dir), "trips")
    zones_of = src.nation_zones(spark, sf_dir)
    flagged = rules.flag_rows(rows, zones_of, src.MONTH, limits=src.EVENT_LIMITS)
    columns = profile.column_profile(rows)
    return report.report_json(
        report.tally(flagged), columns, src.MONTH, limits=src.EVENT_LIMITS
    )


@query
def report_document(spark, sf_dir):
    """What the JSON report says, read back from it."""
    paths = [f"counts.{c}" for c in ("rows_in_raw", "rows_hard_flagged", "rows_valid_out")]
    paths += [f"flag_counts.{r.name}" for r in rules.TRIP_RULES]
    paths += ["profile.passenger_count.null_count", "profile.fare_amount.median"]
    document = report_json(spark, sf_dir)
    value = lambda path: F.get_json_object("value", f"$.{path}").cast("double")
    return document.select(
        *[value(p).alias(p.replace(".", "_")) for p in paths],
        F.json_array_length(
            F.get_json_object("value", "$.known_unknown_assumption_limitation")
        ).cast("bigint").alias("annotations"),
    )


# --- model ------------------------------------------------------------------


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = rules.valid_rows(src.flagged_events(spark, sf_dir))
    return model.fact_trips(valid, carry=["event_id"])


def _enriched(spark: SparkSession, sf_dir: str, roles=("pu",)) -> DataFrame:
    return model.enrich(_fact(spark, sf_dir), src.nation_zones(spark, sf_dir), roles)


@query
def fact_trips(spark, sf_dir):
    # The date as text: result frames of different engines disagree on date types.
    return _fact(spark, sf_dir).withColumn("pickup_date", F.col("pickup_date").cast("string"))


@query
def enriched(spark, sf_dir):
    rows = _enriched(spark, sf_dir, model.ROLES)
    return rows.select("event_id", "pu_zone", "pu_borough", "do_zone", "do_borough")


@query
def enriched_fanout(spark, sf_dir):
    repeated = src.nation_zones_repeated(spark, sf_dir)
    rows = model.enrich(_fact(spark, sf_dir), repeated, on_duplicate="allow")
    return rows.groupBy("pu_borough").agg(F.count(F.lit(1)).alias("trips"))


@query
def enriched_first_zone(spark, sf_dir):
    repeated = src.nation_zones_repeated(spark, sf_dir)
    rows = model.enrich(_fact(spark, sf_dir), repeated, ("pu",), on_duplicate="first")
    return rows.groupBy("pu_zone").agg(F.count(F.lit(1)).alias("trips"))


@query
def dim_key_uniqueness(spark, sf_dir):
    return repeated_keys(src.nation_zones_repeated(spark, sf_dir), "location_id")


@query
def unmatched_zones(spark, sf_dir):
    """Of all trips, the flagged ones included: valid trips have no unmatched zone."""
    fact = model.fact_trips(src.flagged_events(spark, sf_dir))
    dim = src.nation_zones(spark, sf_dir)
    sides = [
        model.unmatched_zones(fact, dim, role).withColumn("role", F.lit(role))
        for role in model.ROLES
    ]
    return sides[0].unionByName(sides[1])


@query
def surrogate_key(spark, sf_dir):
    path = scratch_folder(spark, "validated")
    model.write_ordered(rules.valid_rows(src.flagged_events(spark, sf_dir)), path, ["event_id"])
    numbered = model.read_numbered(spark, path, "trip_id")
    return model.fact_trips(numbered, carry=["trip_id", "event_id"]).select("trip_id", "event_id")


@query
def table_counts(spark, sf_dir):
    return trips.table_counts(
        {"dim_zones": src.nation_zones(spark, sf_dir), "fact_trips": _fact(spark, sf_dir)}
    )


@query
def borough_distribution(spark, sf_dir):
    return metrics.borough_distribution(_enriched(spark, sf_dir))


# --- metrics ----------------------------------------------------------------


_MEASURES = (
    "pu_borough", "pu_zone", "pickup_hour", "trip_distance", "duration_minutes", "speed_mph",
    "fare_per_mile", rules.FLAGS,
)


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(_enriched(spark, sf_dir).select(*_MEASURES), "measures")


@query
def duration_speed_by_borough_hour(spark, sf_dir):
    return metrics.duration_speed_by_borough_hour(_measures(spark, sf_dir))


@query
def duration_speed_by_zone_hour(spark, sf_dir):
    return metrics.duration_speed_by_zone_hour(_measures(spark, sf_dir))


@query
def low_sample_groups(spark, sf_dir):
    by_zone = metrics.duration_speed_by_zone_hour(_measures(spark, sf_dir))
    return metrics.low_sample_groups(by_zone)


@query
def peak_groups(spark, sf_dir):
    by_hour = metrics.duration_speed_by_borough_hour(_measures(spark, sf_dir))
    return metrics.peak_groups(by_hour, ["pu_borough", "pickup_hour"])


@query
def fare_consistency(spark, sf_dir):
    return metrics.fare_consistency(_measures(spark, sf_dir))


@query
def kpi_reliability(spark, sf_dir):
    return metrics.scalar_kpis(_tally(spark, sf_dir), "M1_reliability")


@query
def kpi_anomaly(spark, sf_dir):
    return metrics.scalar_kpis(_tally(spark, sf_dir), "M5_anomaly")


@query
def kpi_flag_breakdown(spark, sf_dir):
    return metrics.flag_kpis(_tally(spark, sf_dir), limits=src.EVENT_LIMITS)


@query
def kpi_summary(spark, sf_dir):
    return metrics.kpi_summary(_tally(spark, sf_dir), limits=src.EVENT_LIMITS)


# --- the job and the stream ---------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark, "landed")
    src.event_trips(spark, sf_dir).write.parquet(path)
    return path


def _month(spark: SparkSession, sf_dir: str, *limits) -> dict[str, str]:
    """The outputs of a month that was run once with each of the limits."""
    landed, zones_csv = _landed(spark, sf_dir), _zones_csv(spark, sf_dir)
    root = scratch_folder(spark, "month")
    for limit in limits:
        out = monthly.run_month(
            spark, src.MONTH, landed, [("csv_fallback", "csv", zones_csv)], root, limits=limit
        )
    return out


@query
def monthly_kpi_summary(spark, sf_dir):
    """The published KPI table of a month that was run with a lower fare limit before."""
    lower = replace(src.EVENT_LIMITS, max_fare=50.0)
    out = _month(spark, sf_dir, lower, src.EVENT_LIMITS)
    kpis = spark.read.option("header", True).csv(out["summary"])
    return kpis.withColumn("value", F.col("value").cast("double"))


@query
def monthly_duration_speed(spark, sf_dir):
    """The published table by zone and hour, read back."""
    out = _month(spark, sf_dir, src.EVENT_LIMITS)
    schema = "pu_borough STRING, pu_zone STRING, pickup_hour INT, trip_count BIGINT, " + ", ".join(
        f"{c} DOUBLE" for c in ("median_duration_min", "median_speed_mph", "avg_trip_distance_miles")
    )
    return spark.read.schema(schema).option("header", True).csv(out["duration_speed_zone_hour"])


@query
def landed_trips(spark, sf_dir):
    """Valid trips, validated as a stream of files."""
    landing = _landed(spark, sf_dir)
    table = scratch_folder(spark, "stream")
    validate_landed(
        spark, landing, spark.read.parquet(landing).schema, src.nation_zones(spark, sf_dir),
        src.MONTH, f"{table}/trips", f"{table}/checkpoint", limits=src.EVENT_LIMITS,
    ).awaitTermination()
    trips_table = spark.read.parquet(f"{table}/trips")
    return trips_table.where(F.col("valid") == "true").drop("month", "valid")


def _grown_store(spark: SparkSession, sf_dir: str) -> KpiStore:
    """Three landed files, of which one held other rows when the states were made first,
    and one more that is gone since."""
    landing, rows = scratch_folder(spark, "landing"), written(src.event_trips(spark, sf_dir), "trips")
    file = lambda k: rows.where(F.col("event_id") % 3 == k).coalesce(1)
    for name, part in (("a", file(0)), ("b", file(1)), ("c", file(2).where("event_id % 2 = 0")), ("d", file(0))):
        part.write.parquet(f"{landing}/{name}")
    dim = written(src.nation_zones(spark, sf_dir), "zones")
    store = KpiStore(spark, scratch_folder(spark, "store"), landing, dim, src.MONTH, limits=src.EVENT_LIMITS)
    store.update()
    file(2).write.mode("overwrite").parquet(f"{landing}/c")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/d")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    store.update()
    return store


@query
def incremental_counts(spark, sf_dir):
    return report.report_counts(_grown_store(spark, sf_dir).totals())


@query
def incremental_duration_speed(spark, sf_dir):
    statistics = _grown_store(spark, sf_dir).statistics()
    return metrics.show_duration_speed(statistics, metrics.ZONE_HOUR)


@query
def incremental_fare_consistency(spark, sf_dir):
    return metrics.show_fare_consistency(_grown_store(spark, sf_dir).statistics())


@query
def versioned_trips(spark, sf_dir):
    """The newest of several versions of the validated trips; a reader of the first one
    may go on."""
    path = scratch_folder(spark, "versions")
    flagged = written(src.flagged_events(spark, sf_dir), "flagged")
    commits.publish_version(rules.excluded_rows(flagged), path)
    before = commits.read_version(spark, path)
    commits.publish_version(rules.valid_rows(flagged), path, after=1)
    both = [("newest", commits.read_version(spark, path)), ("first", before)]
    shown = [t.select("event_id", F.lit(name).alias("version")) for name, t in both]
    return shown[0].unionByName(shown[1])


@query
def manifest_log(spark, sf_dir):
    """The manifest after many commits: every table's file recorded many times with other
    sizes, two files gone, one come back."""
    path = scratch_folder(spark, "manifest")
    facts = written(files.inspect_files(spark, sf_dir, TIME_COLUMNS, checksum=False), "facts")
    entries = files.manifest_rows(facts.withColumn("sha256", F.lit("x")), "S1", "bulk_parquet", "driver tables", "2024-01")
    for k in range(11):
        files.record(entries.withColumn("elapsed_seconds", F.lit(float(k))), path)
    gone = entries.where("entry IN ('region.parquet', 'nation.parquet')").select("source", "entry")
    files.forget(gone, path, "2024-01")
    files.record(entries.where("entry = 'nation.parquet'"), path)
    newest = files.read_manifest(spark, path)
    return newest.select("entry", "row_count", F.coalesce("elapsed_seconds", F.lit(-1.0)).alias("elapsed_seconds"))


# --- the same operators on line items -----------------------------------------


def _order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = src.flagged_orders(spark, sf_dir)
    return model.fact_trips(rules.valid_rows(flagged, src.ORDER_RULES))


@query
def order_report_counts(spark, sf_dir):
    flagged = src.flagged_orders(spark, sf_dir)
    return report.report_counts(report.tally(flagged, src.ORDER_RULES))


@query
def order_flag_counts(spark, sf_dir):
    flagged = src.flagged_orders(spark, sf_dir)
    return report.flag_counts(report.tally(flagged, src.ORDER_RULES), src.ORDER_RULES)


@query
def order_duration_speed_by_region_month(spark, sf_dir):
    fact = _order_fact(spark, sf_dir)
    fact = fact.withColumn("pickup_month", F.date_format("pickup_at", "yyyy-MM"))
    rows = model.enrich(fact, src.nation_zones(spark, sf_dir), ("pu",))
    rows = written(
        rows.select("pu_borough", "pickup_month", "trip_distance", "duration_minutes",
                    "speed_mph"),
        "measures",
    )
    return metrics.duration_speed_by_borough_hour(rows, hour="pickup_month")


@query
def order_fare_consistency(spark, sf_dir):
    dim = src.nation_zones(spark, sf_dir)
    rows = model.enrich(_order_fact(spark, sf_dir), dim, ("pu",))
    rows = written(rows.select("pu_borough", "fare_per_mile", rules.FLAGS), "measures")
    return metrics.fare_consistency(rows)


@query
def output_inventory(spark, sf_dir):
    names = [f"{t}.parquet" for t in (*TABLES, "absent")]
    found = sinks.output_inventory(spark, sf_dir, names)
    return found.select("output", "present", (F.col("kb") > 0).alias("has_bytes"))
