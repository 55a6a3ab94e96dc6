"""KPIs of a landing folder, kept up to date file by file.

Every landed file is aggregated once, into mergeable states: the tally of its rows, and by
zone and hour the counts, sums, moments and sketches of its valid trips. States are
appended; a log of numbered commits says which run's states of a file count. So a changed
file is read alone, one that is gone needs no read at all, and every KPI is a merge. Only a
median of a group that its merged sketch cannot hold reads rows again, to count.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.operators import metrics, model, report, rules
from meterwise.operators.median import exact_medians, sketch_columns
from meterwise.sources import files
from meterwise.sources.commits import CommitLog
from meterwise.sources.scratch import written
from meterwise.sources.trips import scan_trips

LOADS = "entry STRING, file_path STRING, sha256 STRING, parameters STRING, run STRING"
MEDIANS = ("duration_minutes", "speed_mph", "fare_per_mile")
GROUPINGS = (metrics.BOROUGH_HOUR, metrics.ZONE_HOUR, metrics.BOROUGH)
NO_RUN = "gone"


class KpiStore:
    """The states of one month's landed files below `root`."""

    def __init__(
        self, spark: SparkSession, root: str, landing: str, zones: DataFrame, month: str,
        rule_set: Sequence[rules.Rule] = rules.TRIP_RULES, limits: rules.Limits = rules.Limits(),
    ):
        self.spark, self.root, self.landing = spark, root.rstrip("/"), landing
        self.zones, self.month, self.rules, self.limits = zones, month, rule_set, limits
        self.loads = CommitLog(spark, f"{self.root}/loads", LOADS, ["entry"])
        of_rules = [(r.name, r.severity, r.version) for r in rule_set]
        # States of other zones, rules or limits do not mix with these.
        dim = zones.select(F.xxhash64("location_id", "zone_name", "borough").alias("h"))
        seen = dim.agg(F.count(F.lit(1)), F.bit_xor("h")).first()
        self.parameters = str((month, of_rules, repr(limits), tuple(seen)))

    def update(self) -> list[str]:
        """Bring the states up to date with the folder; the entries that were read. A run
        that fails leaves states that no commit names, and the next one starts over."""
        after = self.loads.last()
        here = files.inspect_files(self.spark, self.landing).where("error IS NULL")
        known = self._current().select("entry", F.col("sha256").alias("known"), F.col("parameters").alias("made"))
        run = uuid.uuid4().hex
        both = here.join(known, "entry", "full_outer")
        both = both.where(~F.col("sha256").eqNullSafe(F.col("known")) | (F.col("made") != self.parameters))
        # One row per file.
        changed = written(
            both.select(
                "entry", "file_path", "sha256", F.lit(self.parameters).alias("parameters"),
                F.when(F.col("sha256").isNull(), NO_RUN).otherwise(run).alias("run"),
            ), "changed",
        )
        load = [r["file_path"] for r in changed.where(F.col("run") != NO_RUN).select("file_path").collect()]
        if load:
            self._aggregate(load, run)
        if not changed.isEmpty():
            self.loads.commit(changed, after)
        return sorted(r["entry"] for r in changed.where(F.col("run") != NO_RUN).select("entry").collect())

    def _current(self) -> DataFrame:
        return self.loads.read().where(F.col("run") != NO_RUN)

    def _flagged(self, paths: Sequence[str]) -> DataFrame:
        trips = scan_trips(self.spark, paths)
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        trips = trips.withColumn("_entry", files.entry_of(path, self.landing))
        return rules.flag_rows(trips, self.zones, self.month, self.rules, self.limits)

    def _enriched(self, flagged: DataFrame) -> DataFrame:
        valid = flagged.where(~rules.any_flag(self.rules, rules.HARD))
        fact = model.fact_trips(valid, carry=["_entry"])
        return model.enrich(fact, self.zones, ("pu",), on_duplicate="first")

    def _aggregate(self, paths: Sequence[str], run: str) -> None:
        flagged = self._flagged(paths)
        tallies = flagged.groupBy(F.col("_entry").alias("entry")).agg(*report.tally_columns(self.rules))
        tallies.write.parquet(f"{self.root}/tallies/run={run}")
        keys = [F.col("_entry").alias("entry"), "pu_borough", "pu_zone", "pickup_hour"]
        states = metrics.group_states(self._enriched(flagged), keys=keys, extra=sketch_columns(MEDIANS))
        states.write.parquet(f"{self.root}/states/run={run}")

    def _of_current(self, name: str) -> DataFrame:
        """The states, or tallies, that count: of every current file, those of its run."""
        current = self._current().select("entry", "run")
        runs = [r["run"] for r in current.select("run").distinct().collect()]
        paths = [f"{self.root}/{name}/run={run}" for run in runs]
        table = self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*paths)
        return table.withColumn("run", F.col("run").cast("string")).join(current, ["entry", "run"], "left_semi")

    def totals(self) -> DataFrame:
        """The one-row tally of all current files."""
        tallies = self._of_current("tallies")
        counts = [c for c in tallies.columns if c not in ("entry", "run")]
        return tallies.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])

    def statistics(self) -> DataFrame:
        """The rows of `metrics.group_statistics` over all current files."""
        states = written(self._of_current("states"), "states")
        paths = [r["file_path"] for r in self._current().select("file_path").collect()]
        rows = self._enriched(self._flagged(paths)).where(F.col("pu_borough").isNotNull())
        medians = exact_medians(rows, metrics.wanted_medians(GROUPINGS), states=states)
        return metrics.with_medians(metrics.rolled_statistics(states, GROUPINGS), medians, GROUPINGS)
