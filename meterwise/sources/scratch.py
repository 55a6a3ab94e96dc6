"""Tables that a run needs only while it lasts, in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

from meterwise.errors import MissingInput


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder below `spark.checkpoint.dir`, deleted when the session's
    JVM ends. Only a local master may go without that setting; it gets a temporary folder
    of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise MissingInput("spark.checkpoint.dir: name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    path = f"{shared.rstrip('/')}/{name}-{os.urandom(8).hex()}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table of its own, for what reads its input several times."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
