"""Landed Parquet files: facts from their footers, checksums, and the load manifest.

Files are listed by Spark and inspected inside tasks, one file at a time in fixed
memory; only one row per file comes out.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.errors import EmptyInput, RejectedInput
from meterwise.sources.commits import CommitLog
from meterwise.sources.guards import path_exists

# The functions below travel with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 20

FACTS = (
    "file_path STRING, entry STRING, file_name STRING, file_size_bytes BIGINT, row_count BIGINT, "
    "num_row_groups INT, columns ARRAY<STRING>, range_min STRING, range_max STRING, "
    "sha256 STRING, error STRING"
)


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file_path, entry, file_name, file_size_bytes, modified_at) of the files below a
    path; `entry` is the file's path relative to it. The content column is not selected,
    so no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select(
        F.col("path").alias("file_path"),
        entry_of(F.col("path"), path).alias("entry"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def entry_of(file_path: Column, path: str) -> Column:
    """A file's path relative to the folder that was listed or read."""
    name = F.element_at(F.split(file_path, "/"), -1)
    inside = F.regexp_extract(file_path, r"^(?:[A-Za-z0-9]+:/*)?/?(.*)$", 1)
    root = path.split(":", 1)[-1].strip("/") + "/"
    return F.when(F.contains(inside, F.lit(root)), F.substring_index(inside, root, -1)).otherwise(name)


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    # Hadoop's names of object stores, in Arrow's terms.
    path = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _digest(path: str) -> str:
    system, name = _open(path)
    digest = hashlib.sha256()
    with system.open_input_stream(name) as stream:
        while chunk := stream.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def _footer(path: str, time_columns: tuple[str, ...]) -> dict:
    """Row count, row groups, columns and the range of the first time column present,
    the latter from row-group statistics and None where a writer left them out."""
    import pyarrow.parquet as pq

    system, name = _open(path)
    with system.open_input_file(name) as handle:
        meta = pq.ParquetFile(handle).metadata
        names = meta.schema.to_arrow_schema().names
        facts = {"row_count": meta.num_rows, "num_row_groups": meta.num_row_groups,
                 "columns": names, "range_min": None, "range_max": None}
        paths = [meta.schema.column(i).path for i in range(len(meta.schema))]
        ranged = [paths.index(c) for c in time_columns if c in paths]
        if ranged:
            groups = (meta.row_group(g).column(ranged[0]).statistics
                      for g in range(meta.num_row_groups))
            known = [s for s in groups if s is not None and s.has_min_max]
            if known:
                facts["range_min"] = str(min(s.min for s in known))
                facts["range_max"] = str(max(s.max for s in known))
    return facts


def inspect_files(
    spark: SparkSession,
    path: str,
    time_columns: tuple[str, ...] = ("tpep_pickup_datetime",),
    checksum: bool = True,
) -> DataFrame:
    """One row of FACTS per Parquet file. Only footers are read, plus the bytes once if
    the checksum is asked for. A file that is no Parquet gets an `error`, not a failure;
    a file that cannot be reached fails the task, so that Spark tries again."""
    names = [column.split()[0] for column in FACTS.split(", ")]

    def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import ArrowInvalid

        for batch in batches:
            rows = []
            for file in batch.to_dict("records"):
                row = {**dict.fromkeys(names), **file}
                try:
                    row.update(_footer(file["file_path"], time_columns))
                except ArrowInvalid as error:
                    row["error"] = f"{type(error).__name__}: {error}"
                if checksum:
                    row["sha256"] = _digest(file["file_path"])
                rows.append(row)
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"row_count": "Int64", "num_row_groups": "Int32"})

    files = list_files(spark, path).drop("modified_at")
    return files.mapInPandas(inspect, FACTS)


def file_checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(entry, file_name, file_size_bytes, sha256) of any files, in fixed memory per task."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sha256=[_digest(p) for p in batch["file_path"]]).drop(
                columns="file_path"
            )

    files = list_files(spark, path, pattern).drop("modified_at")
    return files.mapInPandas(
        digest, "entry STRING, file_name STRING, file_size_bytes BIGINT, sha256 STRING"
    )


def rejected_files(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("error").isNotNull()).select(
        "file_path", "entry", "file_name", "sha256", "error"
    )


def without_rejects(facts: DataFrame, rejects_path: str) -> DataFrame:
    """The files but for those that an earlier run has rejected and that have not changed
    since."""
    spark = facts.sparkSession
    if not path_exists(spark, rejects_path):
        return facts
    known = spark.read.schema("file_path STRING, sha256 STRING").json(rejects_path).distinct()
    return facts.join(known, ["file_path", "sha256"], "left_anti")


def require_readable(facts: DataFrame, rejects_path: str | None = None) -> None:
    """Raise if a file could not be opened or no file holds a row. The rejects are
    written first, so that the next run leaves them out."""
    rejects = rejected_files(facts)
    count = rejects.count()
    if count:
        if rejects_path is not None:
            rejects.write.mode("append").json(rejects_path)
        names = [r["entry"] for r in rejects.orderBy("entry").limit(10).collect()]
        more = f" and {count - len(names)} more" if count > len(names) else ""
        raise RejectedInput(f"unreadable Parquet files: {', '.join(names)}{more}")
    if not facts.agg(F.sum("row_count")).head()[0]:
        raise EmptyInput("the input files hold no rows")


def manifest_rows(
    facts: DataFrame,
    source: str,
    mode: str,
    description: str,
    month: str | None = None,
    elapsed_seconds: float | None = None,
) -> DataFrame:
    """One manifest entry per inspected file."""
    return facts.where(F.col("error").isNull()).select(
        "entry",
        F.lit(source).alias("source"),
        F.lit(mode).alias("retrieval_mode"),
        F.lit(description).alias("description"),
        F.col("file_path").alias("local_path"),
        F.col("file_name").alias("filename"),
        F.lit(month).cast("string").alias("month"),
        F.current_timestamp().alias("downloaded_at"),
        "file_size_bytes",
        F.round(F.col("file_size_bytes") / 1e6, 2).alias("file_size_mb"),
        "row_count",
        "num_row_groups",
        "columns",
        F.col("range_min").alias("pickup_date_min"),
        F.col("range_max").alias("pickup_date_max"),
        "sha256",
        F.lit(elapsed_seconds).cast("double").alias("elapsed_seconds"),
    )


MANIFEST = (
    "entry STRING, source STRING, retrieval_mode STRING, description STRING, "
    "local_path STRING, filename STRING, month STRING, downloaded_at TIMESTAMP, "
    "file_size_bytes BIGINT, file_size_mb DOUBLE, row_count BIGINT, num_row_groups INT, "
    "columns ARRAY<STRING>, pickup_date_min STRING, pickup_date_max STRING, "
    "sha256 STRING, elapsed_seconds DOUBLE"
)


def manifest_log(spark: SparkSession, path: str) -> CommitLog:
    """A file is known by month, source and its path below the landing folder."""
    return CommitLog(spark, path, MANIFEST, ("month", "source", "entry"))


def record(rows: DataFrame, path: str, after: int | None = None) -> int:
    """Commit entries to the manifest and return the commit's number. With `after`, the
    last number that the caller has read, a commit in between is a conflict."""
    return manifest_log(rows.sparkSession, path).commit(rows, after)


def forget(gone: DataFrame, path: str, month: str | None = None) -> int:
    """Commit an entry without a checksum for each (source, entry) that is gone."""
    schema = [c.split() for c in MANIFEST.split(", ")]
    known = {
        "entry": F.col("entry"),
        "source": F.col("source"),
        "filename": F.element_at(F.split("entry", "/"), -1),
        "month": F.lit(month),
        "downloaded_at": F.current_timestamp(),
    }
    return record(
        gone.select(*[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in schema]), path
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry, by commit number, of every file of every month that is not gone."""
    return manifest_log(spark, path).read().where(F.col("sha256").isNotNull())


def decide_loads(current: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """(source, entry, sha256, recorded_sha256, decision) of every file on either side,
    where both hold one month's (source, entry, sha256).

    `new` is not in the manifest, `changed` has other content than recorded, `unchanged`
    is skipped, `missing` is recorded but gone; with `force` present files are `reload`.
    """
    known = manifest.select("source", "entry", F.col("sha256").alias("recorded_sha256"))
    here, recorded = F.col("sha256"), F.col("recorded_sha256")
    decision = (
        F.when(here.isNull(), "missing")
        .when(F.lit(force), "reload")
        .when(recorded.isNull(), "new")
        .when(here == recorded, "unchanged")
        .otherwise("changed")
    )
    both = current.select("source", "entry", "sha256").join(known, ["source", "entry"], "full_outer")
    return both.withColumn("decision", decision)


def files_to_load(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("decision").isin("new", "changed", "reload"))
