"""How filters interact: what each of them removes, at every place of every order.

A document is a cell: which of the filters it fails. Documents are counted by part and
cell, and a part's counts, reshaped, are a tensor with one axis of length two per filter.
What a step of an order keeps or removes is that tensor contracted with a vector for each
axis: those that pass, those that fail, or all. One einsum answers all steps of all orders.

Texts are read once, in tasks; 16 bytes stand for a text from there on. Whether a text is
a copy needs the smallest id of its digest, found by a map-side combined aggregate and
joined back by digest and id, so a text that a third of the documents share is no hot key.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import as_bytes, binary_array, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = "ABCDE"
# The bounds of the filters.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3
MARKS = b"#$%&*|"

CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUING = bytes(range(0x80, 0xC0))

PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

CHECKED = "doc_id BIGINT, part STRING, failed INT, digest BINARY"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
STEPS = "part STRING, filter_order STRING, step INT, " + ", ".join(f"{c} BIGINT" for c in COUNTS)


def bit(letter: str) -> int:
    """The first letter is the highest bit, as the first axis of a tensor is the slowest."""
    return 1 << (len(LETTERS) - 1 - LETTERS.index(letter))


def text_failures(text: bytes) -> int:
    """The bits of the filters A to D that a text fails: too short, too few distinct words,
    too many capitals, a mark."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUING))
    return (
        bit("A") * (len(words) < MIN_WORDS)
        | bit("B") * (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words))
        | bit("C") * (100 * capitals > MAX_CAPITAL_PERCENT * points)
        | bit("D") * (len(text.translate(None, MARKS)) < len(text))
    )


def checked(docs: DataFrame, part: str = "lang") -> DataFrame:
    """CHECKED of every row of `docs` (doc_id, text, and the column named by `part`): the
    filters A to D that it fails, and a 128-bit digest of its text."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"),
                 pa.array([text_failures(t) for t in texts], pa.int32()),
                 binary_array([xxhash.xxh3_128_digest(t) for t in texts])],
                ["doc_id", "part", "failed", "digest"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), as_bytes().alias("text"),
    ).mapInArrow(check, CHECKED)


def with_copies(rows: DataFrame) -> DataFrame:
    """CHECKED with the bit of filter E: a row with a smaller id has the same text. Rows
    without an id come after all others and not after each other."""
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = firsts.withColumnRenamed("digest", "of").withColumn("found", F.lit(True))
    same = (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    copy = F.when(F.col("found"), 0).otherwise(bit("E"))
    return rows.join(firsts, same, "left").select(
        "doc_id", "part", F.col("failed").bitwiseOR(copy).alias("failed")
    )


def cell_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and cell, and those that any label
    calls good (quality 1) or toxic (1)."""
    marked = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
    marked = marked.groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    joined = rows.join(marked, F.col("doc_id") == F.col("labelled"), "left")
    return joined.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"),
    )


def orders() -> list[str]:
    return ["".join(p) for p in itertools.permutations(LETTERS)]


def selectors(choose) -> list[np.ndarray]:
    """One array per axis, with a vector for every step of every order: `choose` gets the
    axis' letter, the letters before the step, and the step's own."""
    steps = [(order[:k], order[k]) for order in orders() for k in range(len(LETTERS))]
    return [
        np.array([choose(axis, before, own) for before, own in steps], np.int64) for axis in LETTERS
    ]


def contractions() -> dict[str, list[np.ndarray]]:
    """The selectors of what a step is asked."""
    earlier = lambda axis, before: PASS if axis in before else ALL
    return {
        "kept": selectors(lambda x, before, own: PASS if x == own else earlier(x, before)),
        "removed": selectors(lambda x, before, own: FAIL if x == own else earlier(x, before)),
        "failing": selectors(lambda x, before, own: FAIL if x == own else ALL),
        "unique_fails": selectors(lambda x, before, own: FAIL if x == own else PASS),
    }


def interactions(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of all steps of all orders, from a tensor with the measures (documents, good
    and toxic ones) on its first axis and one axis of pass and fail for each filter."""
    count = {
        name: np.einsum("mabcde,sa,sb,sc,sd,se->ms", tensor, *axes)
        for name, axes in contractions().items()
    }
    removed, good, toxic = count["removed"]
    own = np.array([LETTERS.index(letter) for order in orders() for letter in order])
    over_orders = np.zeros(len(LETTERS), np.int64)
    np.add.at(over_orders, own, removed)
    return {
        "kept": count["kept"][0], "removed": removed, "redundant": count["failing"][0] - removed,
        "unique_fails": count["unique_fails"][0], "good_lost": good, "toxic_lost": toxic,
        "shapley": over_orders[own],
    }


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """STEPS: for every part of `docs` (doc_id, text, and the column named by `part`), every
    order of the five filters and every step of it, what is kept and removed there, what
    the filter's failures had lost to earlier steps, those that fail nothing else, labelled
    documents removed, and the filter's removals over all orders.

    A null text is empty and has no words; a null part is the empty string. Null and
    repeated ids are rows of their own: see with_copies; labels of an id are true if any of
    its rows says so. Other columns are ignored. An empty table has no parts and gives no
    rows; labels may be empty.
    """
    rows = with_copies(written(checked(docs, part), "checked"))
    cells = cell_counts(rows, labels)
    # At most 32 cells a part.
    tensors = cells.groupBy("part").agg(
        F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells")
    )
    all_orders = [order for order in orders() for _ in LETTERS]
    steps = [k + 1 for _ in orders() for k in range(len(LETTERS))]

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, held in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                tensor = np.zeros((3, 1 << len(LETTERS)), np.int64)
                for c in held:
                    tensor[:, c["failed"]] = c["n"], c["good"], c["toxic"]
                counts = interactions(tensor.reshape(3, *[2] * len(LETTERS)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(steps)), pa.array(all_orders), pa.array(steps, pa.int32()),
                     *(pa.array(counts[c]) for c in COUNTS)],
                    [c.split()[0] for c in STEPS.split(", ")],
                )

    return tensors.mapInArrow(contract, STEPS)
