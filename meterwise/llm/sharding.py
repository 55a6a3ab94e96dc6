"""Contiguous shards of nearly equal bytes.

Rows are range partitioned by id once, as numbers only; each partition's total gives, by a
prefix sum over one row per partition, the bytes before it, and a running sum within the
partition the bytes before each row. Cutting that global sum at equal targets gives shards
that are contiguous in id order and differ by less than one document from the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.common import written

ROW = "_row"


def assign_shards(
    docs: DataFrame, shards: int = 8, size: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, *keep, size, before, shard, slot): `before` counts the bytes of all rows
    with smaller ids, `slot` numbers the rows of a shard from 0. `size` defaults to the
    text's UTF-8 bytes plus 1.

    Null ids come first, and repeated rows stay apart in a fixed but arbitrary order, so
    a hot id is spread over partitions as well. A null text weighs 1. An empty table gives
    an empty one. Columns not named in `keep` are ignored.
    """
    if size is None:
        size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 1
    order = ["doc_id", "size", *keep, ROW]
    rows = docs.select(
        "doc_id",
        *keep,
        size.cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias(ROW),
    )
    ranged = written(
        rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "sized"
    )
    totals = ranged.groupBy("_part").agg(
        F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per partition, however many rows the partitions hold.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    within = Window.partitionBy("_part").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("_upto", F.sum("size").over(running))
        .withColumn("_nth", F.row_number().over(within))
        .join(F.broadcast(bases), "_part")
        .withColumn("before", F.col("_bytes_before") + F.col("_upto") - F.col("size"))
    )
    # A row belongs where its middle byte falls.
    middle = 2 * F.col("before") + F.col("size")
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * F.col("_all"))))
    placed = written(
        placed.select(
            "doc_id", *keep, "size", "before", shard.cast("int").alias("shard"),
            (F.col("_rows_before") + F.col("_nth") - 1).alias("_index"),
        ),
        "placed",
    )
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("_index").alias("_first"))
    numbered = placed.join(F.broadcast(firsts), "shard")
    return numbered.select(
        "doc_id", *keep, "size", "before", "shard", (F.col("_index") - F.col("_first")).alias("slot")
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write the rows of `docs` (unique ids) below `path`, one folder per shard."""
    rows = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    rows.write.mode("overwrite").partitionBy("shard").parquet(path)
