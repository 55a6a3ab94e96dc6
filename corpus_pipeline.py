"""From raw documents to packed training sequences.

Each stage reads what the one before has written, applies one operator to all of it, and
returns the documents that stay, with the columns of `documents`; the last returns packed
pieces. Between stages lies a Parquet table in the shared folder, so a lost executor costs
the tasks of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm import bloom, decontamination, lines, minhash, packing, quality
from meterwise.llm.common import shared_folder, table, tuned, unused, write_parquet, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, those without words among them. Every
    row is judged by its own text, so null and repeated ids need no care; without trusted
    labels, or on an empty table, nothing else is rejected."""
    trusted = quality.trusted_sample(table(tuned(spark), sf_dir, "labels"))
    return quality.keep_good(docs, trusted)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, short ones where they are equal, and documents that lose their
    last word with them. `n_chars` follows the text. Rows with equal id and text are one
    document; null texts stay; an empty table gives an empty one."""
    tuned(spark)
    struck = lines.dedup_lines(docs, equal_from=1)
    changed = F.col("removed_lines") > 0
    left = struck.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays. Rows that
    repeat an id are one document; rows without an id or without words stay."""
    tuned(spark)
    found = minhash.near_duplicates(docs, shingle=5, percent=80)
    copies = written(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return bloom.without(docs, copies, "doc_id")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go, by their own text: rows without an id or
    with a repeated one are judged alike. Null texts hold none; an empty benchmark or table
    changes nothing."""
    benchmark = table(tuned(spark), sf_dir, "benchmark")
    uid = unused(docs, "_uid")
    # A number for every row, those without an id included.
    marked = docs.withColumn(uid, F.xxhash64("doc_id", "text"))
    source = marked.select(F.col(uid).alias("doc_id"), "text")
    found = decontamination.contamination(decontamination.find_matches(source, benchmark))
    bad = written(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    return bloom.without(marked, bad, uid).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 1024 tokens. A null or empty text is one
    piece; null and repeated ids pass through; an empty table gives an empty one."""
    tuned(spark)
    packed = packing.best_fit_pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Tokens, likelihood ratios and edit distances are not SQL's: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents` after all stages. A stage's table goes once the
    next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        write_parquet(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
        if before is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
