"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that may be changed on a live session.
RUNTIME_SETTINGS = {
    # TIMESTAMP_NTZ differences go through the session zone; UTC has no DST gaps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A dimension above the broadcast threshold is joined by shuffle; a zone that
    # holds a third of all trips is then split even if that costs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Re-running one month replaces that month's partitions only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "meterwise", cores: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Noting the caller's line costs several calls to the JVM for every column
        # expression, and a month builds thousands.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # A month compiles more stages than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)
