"""The monthly job: landed files to validated trips, report, star model and KPI tables.

Three steps hand over tables, so a lost executor costs the tasks it ran and nothing else:

* ingest compares the landed files with the manifest and publishes the zone dimension,
* validate evaluates the rules once, into a table that holds valid and excluded rows,
* metrics reads that table.

Each of the last two ends by noting what it was built from: the checksums of the files,
the rules, limits and options, and the run of the step before. It is skipped while its
outputs are committed and the note still holds.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterwise.errors import EmptyInput
from meterwise.functions.exprs import check_month
from meterwise.operators import metrics, model, profile, report, rules
from meterwise.session import apply_settings
from meterwise.sources import files, sinks, zones
from meterwise.sources.guards import guard_inputs, outputs_done, path_exists
from meterwise.sources.trips import scan_trips

log = logging.getLogger("meterwise")


# The steps in order, with what each publishes.
STEPS = {
    "ingest": ("zones",),
    "validate": ("trips", "report"),
    "metrics": (
        "statistics", "summary", "duration_speed_borough_hour", "duration_speed_zone_hour",
        "fare_consistency", "peak_groups", "low_sample_groups",
    ),
}


@dataclass(frozen=True)
class Outputs:
    """Where a job keeps its tables, all below one root."""

    root: str
    month: str

    @property
    def trips(self) -> str:
        """All rows of the month, partitioned by `valid`. The folder above reads as one
        table partitioned by month and `valid`."""
        return f"{self.root}/trips/month={self.month}"

    def trips_of(self, valid: bool) -> str:
        return f"{self.trips}/valid={str(valid).lower()}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    def _monthly(self, name: str) -> str:
        return f"{self.root}/{name}/{self.month}"

    @property
    def tally(self) -> str:
        return self._monthly("tally")

    def built_from(self, step: str) -> str:
        return self._monthly(f"built_from/{step}")

    @property
    def published(self) -> dict[str, str]:
        """The outputs that make a month complete."""
        names = [name for step in STEPS.values() for name in step if name != "trips"]
        return {"trips": self.trips, **{name: self._monthly(name) for name in names}}


def ingest(
    spark: SparkSession,
    month: str,
    trips_path: str,
    zone_sources: Sequence[zones.Source],
    out: Outputs,
    force: bool = False,
) -> None:
    """Bring the manifest and the zone dimension up to date. Unreadable files go to the
    rejects and stop the job; the next run leaves them out unless they have changed."""
    guard_inputs(spark, {"trips": trips_path})
    started = time.time()
    dim, (mode, kind, zone_path) = zones.read_zones(spark, zone_sources)
    log.info("zones from %s", mode)
    if kind == "json":
        skipped = zones.skipped_zones_json(spark, zone_path).count()
        if skipped:
            log.warning("%d zone records without an integer id are left out", skipped)
    # One small row per file, read several times; a lost block is inspected again.
    zone_id = "S2" if kind == "json" else "S3"
    inspected = files.inspect_files(spark, trips_path).persist()
    trip_files = files.without_rejects(inspected, out.rejects).withColumn("source", F.lit("S1"))
    zone_files = zones.source_facts(spark, kind, zone_path).withColumn("source", F.lit(zone_id)).persist()
    decisions = files.decide_loads(
        trip_files.unionByName(zone_files), _inputs(spark, out), force
    ).persist()
    try:
        files.require_readable(trip_files, out.rejects)
        left_out = inspected.count() - trip_files.count()
        if left_out:
            log.warning("%d files that an earlier run rejected are left out", left_out)
        changed = decisions.where("decision = 'changed'")
        count = changed.count()
        if count:
            names = ", ".join(r["entry"] for r in changed.orderBy("entry").limit(10).collect())
            log.warning("content of %d files differs from the manifest, loading again: %s%s",
                        count, names, ", ..." if count > 10 else "")
        load = files.files_to_load(decisions).select("source", "entry")
        gone = decisions.where("decision = 'missing'").select("source", "entry")
        elapsed = round(time.time() - started, 1)
        for facts, source, how, what in (
            (trip_files, "S1", "bulk_parquet", "trip records"),
            (zone_files, zone_id, mode, "zone lookup"),
        ):
            new = facts.join(load, ["source", "entry"], "left_semi")
            if not new.isEmpty():
                entries = files.manifest_rows(new, source, how, what, month, elapsed)
                files.record(entries, out.manifest)
        if not gone.isEmpty():
            files.forget(gone, out.manifest, month)
    finally:
        # Spark tells listings apart by path only: left cached, these would hide new files.
        for cached in (decisions, inspected, zone_files):
            cached.unpersist()
    sinks.write_table(dim, out.published["zones"])


def _inputs(spark: SparkSession, out: Outputs) -> DataFrame:
    """(source, entry, sha256, local_path) of the month's files in the manifest."""
    if path_exists(spark, out.manifest):
        entries = files.read_manifest(spark, out.manifest).where(F.col("month") == out.month)
    else:
        entries = spark.createDataFrame([], files.MANIFEST)
    return entries.select("source", "entry", "sha256", "local_path")


# Names of the rows of a note that are no files.
RUN, PARAMETERS, BEFORE = "#run", "#parameters", "#before"


def _digest(
    step: str, rule_set: Sequence[rules.Rule], limits: rules.Limits, on_duplicate: str
) -> str:
    """What a step's result depends on besides its inputs."""
    of_rules = [(r.name, r.severity, r.version) for r in rule_set]
    parts = [step, of_rules, repr(limits), on_duplicate if step == "metrics" else ""]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def _run_of(spark: SparkSession, out: Outputs, step: str) -> str | None:
    """The id of the run that made a step's outputs."""
    if not path_exists(spark, out.built_from(step)):
        return None
    row = spark.read.parquet(out.built_from(step)).where(F.col("entry") == RUN).head()
    return row["sha256"] if row else None


def _note(spark: SparkSession, out: Outputs, step: str, digest: str) -> DataFrame:
    """(entry, sha256) of all that a step is built from."""
    facts = [(PARAMETERS, digest)]
    if step == "metrics":
        facts.append((BEFORE, _run_of(spark, out, "validate")))
    inputs = _inputs(spark, out).select(F.concat_ws("/", "source", "entry").alias("entry"), "sha256")
    return inputs.unionByName(spark.createDataFrame(facts, "entry STRING, sha256 STRING"))


def _up_to_date(spark: SparkSession, out: Outputs, step: str, digest: str) -> bool:
    """Whether a step's outputs are committed and built from what is there now."""
    path = out.built_from(step)
    if not outputs_done(spark, [path, *[out.published[name] for name in STEPS[step]]]):
        return False
    built = spark.read.schema("entry STRING, sha256 STRING").parquet(path).where(F.col("entry") != RUN)
    now = _note(spark, out, step, digest)
    return built.exceptAll(now).isEmpty() and now.exceptAll(built).isEmpty()


def validate(
    spark: SparkSession,
    month: str,
    trips_path: str,
    out: Outputs,
    rule_set: Sequence[rules.Rule] = rules.TRIP_RULES,
    limits: rules.Limits = rules.Limits(),
) -> None:
    """Flag every row of the files in the manifest once and publish valid and excluded
    rows in one write, which also counts them; then profile the raw rows and write the
    report. Observed by the write, the profile's many aggregates cost more than a pass of
    their own."""
    guard_inputs(spark, {"trips": trips_path, "zones": out.published["zones"]})
    started = time.time()
    # A list of files, as Spark itself keeps one on the driver.
    landed = _inputs(spark, out).where("source = 'S1'").select("local_path").collect()
    if not landed:
        raise EmptyInput(f"the manifest holds no trip files of {month}")
    trips = scan_trips(spark, [r["local_path"] for r in landed])
    dim = spark.read.parquet(out.published["zones"])
    flagged = rules.flag_rows(trips, dim, month, rule_set, limits)
    valid = ~rules.any_flag(rule_set, rules.HARD)
    marked = flagged.withColumn("valid", valid)
    # Observed above the last shuffle, in the tasks that write: a task counts once.
    seen = Observation("written")
    counts = report.tally_columns(rule_set)
    marked = marked.observe(seen, *counts)
    sinks.write_month(rules.drop_working_columns(marked), out.trips, ["valid"])
    if path_exists(spark, out.trips_of(True)):
        model.number_files(spark, out.trips_of(True))

    names = ["rows_in_raw", "rows_hard_flagged", "rows_soft_only_flagged", *[f"n_{r.name}" for r in rule_set]]
    row = tuple(seen.get[c] for c in names)
    totals = spark.createDataFrame([row], ", ".join(f"{c} BIGINT" for c in names))
    sinks.write_table(totals, out.tally)
    columns = profile.column_profile(trips)
    document = report.report_json(
        totals, columns, month, round(time.time() - started, 1), rule_set, limits
    )
    sinks.write_text(document, out.published["report"])


def register_model(
    spark: SparkSession, out: Outputs, on_duplicate: str = "error"
) -> tuple[DataFrame, int]:
    """Create the views dim_zones, fact_trips and fact_trips_enriched for a published
    month; return the last one and the number of trips."""
    guard_inputs(
        spark, {"validated trips": out.trips, "zones": out.published["zones"], "tally": out.tally}
    )
    if not path_exists(spark, out.trips_of(True)):
        raise EmptyInput(f"no trip of {out.month} is valid")
    dim = spark.read.parquet(out.published["zones"])
    numbered = model.read_numbered(spark, out.trips_of(True), "trip_id")
    fact = model.fact_trips(numbered, carry=["trip_id"])
    enriched = model.enrich(fact, dim, on_duplicate=on_duplicate)
    dim.createOrReplaceTempView("dim_zones")
    fact.createOrReplaceTempView("fact_trips")
    enriched.createOrReplaceTempView("fact_trips_enriched")
    return enriched, spark.read.parquet(out.trips_of(True)).count()


def publish_metrics(
    spark: SparkSession,
    out: Outputs,
    rule_set: Sequence[rules.Rule] = rules.TRIP_RULES,
    on_duplicate: str = "error",
    limits: rules.Limits = rules.Limits(),
) -> None:
    """Build the model and publish the KPI tables."""
    enriched, _ = register_model(spark, out, on_duplicate)
    unmatched = enriched.where(F.col("pu_borough").isNull()).count()
    if unmatched:
        log.warning("%d trips have no pickup borough and leave the borough metrics", unmatched)
    totals = spark.read.parquet(out.tally)
    # One row per group, shown in three tables: computed once.
    sinks.write_table(metrics.group_statistics(enriched), out.published["statistics"])
    statistics = spark.read.parquet(out.published["statistics"])
    by_hour = metrics.show_duration_speed(statistics, metrics.BOROUGH_HOUR)
    by_zone = metrics.show_duration_speed(statistics, metrics.ZONE_HOUR)
    tables = {
        "summary": (
            metrics.show_kpis(metrics.kpi_summary(totals, rule_set, limits)),
            [metrics.kpi_order(rule_set)],
        ),
        "duration_speed_borough_hour": (by_hour, ["pu_borough", "pickup_hour"]),
        "duration_speed_zone_hour": (by_zone, ["pu_borough", "pu_zone", "pickup_hour"]),
        "peak_groups": (metrics.peak_groups(by_hour, ["pu_borough", "pickup_hour"]), ["peak"]),
        "low_sample_groups": (metrics.low_sample_groups(by_zone), ["groups"]),
        "fare_consistency": (metrics.show_fare_consistency(statistics), ["pu_borough"]),
    }
    for name, (table, order) in tables.items():
        sinks.write_csv(table, out.published[name], order)


def run_month(
    spark: SparkSession,
    month: str,
    trips_path: str,
    zone_sources: Sequence[zones.Source],
    root: str,
    force: bool = False,
    step: str | None = None,
    rule_set: Sequence[rules.Rule] = rules.TRIP_RULES,
    limits: rules.Limits = rules.Limits(),
    on_duplicate: str = "error",
) -> dict[str, str]:
    """Run a month, or one step of it, and return the output paths. Steps that are up to
    date are left alone unless `force` is set; `force` re-reads every source, the zones
    included. `zone_sources` is in order of preference."""
    check_month(month)
    if step is not None and step not in STEPS:
        raise ValueError(f"step: one of {', '.join(STEPS)}, not {step!r}")
    apply_settings(spark)
    out = Outputs(root.rstrip("/"), month)
    work = {
        "ingest": lambda: ingest(spark, month, trips_path, zone_sources, out, force),
        "validate": lambda: validate(spark, month, trips_path, out, rule_set, limits),
        "metrics": lambda: publish_metrics(spark, out, rule_set, on_duplicate, limits),
    }
    for name in STEPS:
        if step not in (None, name):
            continue
        digest = _digest(name, rule_set, limits, on_duplicate)
        if name != "ingest" and not force and _up_to_date(spark, out, name, digest):
            log.info("%s of %s is up to date", name, month)
            continue
        work[name]()
        if name != "ingest":
            run = spark.createDataFrame([(RUN, uuid.uuid4().hex)], "entry STRING, sha256 STRING")
            note = _note(spark, out, name, digest).unionByName(run)
            sinks.write_table(note, out.built_from(name))
    for row in sinks.output_inventory(spark, out.root, list(out.published)).collect():
        log.info("%s: %s", row["output"], f"{row['kb']} KB" if row["present"] else "missing")
    return out.published
