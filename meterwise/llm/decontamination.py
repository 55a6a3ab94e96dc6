"""Benchmark decontamination by training suffix arrays.

Every task builds suffix arrays over the words of its own documents, a bounded block at a
time, and finds each suffix of the benchmark in them by binary search. The benchmark goes
to the tasks in blocks of bounded size. Only suffixes that can hold a window enter an
array: a window consists of benchmark words, so a suffix whose first words are not all
known to the block cannot. Suffixes are compared up to the length of a window; longer
verbatim matches are read off as runs of windows that follow each other on both sides.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import as_bytes, worker_large

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
# UTF-8 bytes of benchmark text that are broadcast at a time.
BLOCK_BYTES = 16 << 20
# Words of the documents that share a suffix array.
ARRAY_WORDS = 1_000_000

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MATCH = "item STRING, item_start INT, doc_start INT, n_words INT"
FOUND = f"doc_id BIGINT, n_words BIGINT, matches ARRAY<STRUCT<{MATCH}>>"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all other characters."""
    return WORD.findall(text.lower())


class Suffixes:
    """The distinct windows of a block of benchmark items, as big-endian word numbers,
    so that byte order is word order; number 0 ends every suffix."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        # By length: window -> the places (item, start) that have it.
        self.places: dict[int, dict[bytes, list[tuple[str, int]]]] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            n = min(window, len(words))
            row = np.array(words, ">u4").tobytes()
            for i in range(len(words) - n + 1 if n else 0):
                found = self.places.setdefault(n, {}).setdefault(row[4 * i : 4 * (i + n)], [])
                # An item that repeats a window needs it once.
                if not found or found[-1][0] != item:
                    found.append((item, i))
        self.shortest = min(self.places, default=0)
        self.sorted = {n: sorted(p) for n, p in self.places.items()}

    def array(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, keys) of the suffixes of `words` that may begin with a window, in
        the order of their keys. Zeros in `words` part documents and stand for words that
        no item has."""
        # Length of the run of known words from each place on.
        zeros = np.flatnonzero(words == 0)
        ends = np.append(zeros, len(words))
        run = ends[np.searchsorted(zeros, np.arange(len(words)))] - np.arange(len(words))
        at = np.flatnonzero(run >= self.shortest)
        padded = np.append(words, np.zeros(self.window, words.dtype)).astype(">u4")
        heads = np.lib.stride_tricks.sliding_window_view(padded, self.window)[at]
        # Beyond the end of a run the suffix has ended.
        heads = np.where(np.arange(self.window) < run[at][:, None], heads, 0).astype(">u4")
        keys = np.ascontiguousarray(heads).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")
        return at[order], keys[order]

    def occurrences(self, words: np.ndarray) -> Iterator[tuple[int, bytes, np.ndarray]]:
        """(length, window, positions) of every window that occurs in `words`."""
        if not self.shortest:
            return
        at, keys = self.array(words)
        if not len(at):
            return
        width = 4 * self.window
        for n, windows in self.sorted.items():
            low = np.searchsorted(keys, np.array(windows, f"S{width}"), "left")
            last = [w + b"\xff" * (width - len(w)) for w in windows]
            high = np.searchsorted(keys, np.array(last, f"S{width}"), "right")
            for k in np.flatnonzero(high > low):
                yield n, windows[k], at[low[k] : high[k]]


def matches_of(suffixes: Suffixes, lengths: list[int], words: np.ndarray) -> list[list[tuple]]:
    """Verbatim matches of each document, whose words lie in `words` with one zero after
    each document."""
    starts = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) + 1)])
    found: dict[tuple, list[int]] = {}
    for n, window, positions in suffixes.occurrences(words):
        for item, start in suffixes.places[n][window]:
            for p in positions.tolist():
                # Windows on one diagonal belong to one alignment of the two texts.
                found.setdefault((item, n, p - start), []).append(p)
    out: list[list[tuple]] = [[] for _ in lengths]
    for (item, n, shift), places in found.items():
        places.sort()
        first = last = places[0]
        runs = []
        for p in places[1:]:
            if p != last + 1:
                runs.append((first, last))
                first = p
            last = p
        runs.append((first, last))
        for a, b in runs:
            k = int(np.searchsorted(starts, a, "right")) - 1
            out[k].append((item, a - shift, a - int(starts[k]), b - a + n))
    return out


def item_blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items, in blocks of at most `limit` bytes or one item."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        as_bytes().alias("text"),
    )
    sizes = items.groupBy(F.pmod(F.xxhash64("item", "text"), F.lit(1 << 12)).alias("deal")).agg(
        F.sum(F.length("text") + 64).alias("bytes")
    )
    # At most 4096 rows; whole deals go to a block until it is full.
    deals, block, held = [], [], 0
    for row in sizes.orderBy("deal").collect():
        if block and held + row["bytes"] > limit:
            deals.append(block)
            block, held = [], 0
        block.append(row["deal"])
        held += row["bytes"]
    if block:
        deals.append(block)
    dealt = items.withColumn("deal", F.pmod(F.xxhash64("item", "text"), F.lit(1 << 12)))
    for block in deals:
        rows = dealt.where(F.col("deal").between(block[0], block[-1]))
        yield sorted((r["item"], bytes(r["text"])) for r in rows.select("item", "text").collect())


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """FOUND for every row of `docs` (doc_id, text): its number of words and, of every
    benchmark item (item_id, text), the longest verbatim matches of at least `window`
    words, or of the whole item where that has fewer.

    Null texts have no words and no match; so do items without words. Null and repeated
    ids keep a row each. Other columns are ignored. An empty `docs` gives an empty table,
    an empty benchmark rows without matches. Of several equal windows of one item the
    first is reported.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text")
    )
    names = ["doc_id", "n_words", "matches"]
    match = pa.struct([
        pa.field(c.split()[0], pa.string() if "STRING" in c else pa.int32())
        for c in MATCH.split(", ")
    ])

    def pass_over(items: list[tuple[str, bytes]]) -> DataFrame:
        sent, version = spark.sparkContext.broadcast(items), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            suffixes = worker_large(version, lambda: Suffixes(sent.value, window))
            number = suffixes.number.get
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                done = 0
                lengths, rows, held = [], [], 0
                for k, text in enumerate(texts):
                    words = words_of(text)
                    row = np.zeros(len(words) + 1, np.uint32)
                    row[:-1] = [number(w, 0) for w in words]
                    rows.append(row)
                    lengths.append(len(words))
                    held += len(row)
                    if held >= ARRAY_WORDS or k == len(texts) - 1:
                        found = matches_of(suffixes, lengths, np.concatenate(rows))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[done : k + 1], pa.int64()),
                                pa.array(lengths, pa.int64()),
                                pa.array(
                                    [[dict(zip(match.names, m)) for m in ms] for ms in found],
                                    pa.list_(match),
                                ),
                            ],
                            names,
                        )
                        done, lengths, rows, held = k + 1, [], [], 0

        return source.mapInArrow(search, FOUND)

    passes = [pass_over(block) for block in item_blocks(benchmark, block_bytes)] or [pass_over([])]
    if len(passes) == 1:
        return passes[0]
    # The benchmark is searched block by block; a row's matches are put together again.
    numbered = [
        p.withColumn("_row", F.monotonically_increasing_id()) for p in passes
    ]
    whole = numbered[0]
    for more in numbered[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    ).drop("_row")


def contamination(found: DataFrame, per: int = 20) -> DataFrame:
    """`found` with `n_hit` (words inside a match), `items` (sorted) and `contaminated`:
    at least one word in `per` is hit."""
    spans = F.array_sort(
        F.transform(
            "matches",
            lambda m: F.struct(m["doc_start"].alias("a"), (m["doc_start"] + m["n_words"]).alias("b")),
        )
    )
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    hit = F.aggregate(
        spans,
        start,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["b"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    items = F.array_sort(F.array_distinct(F.col("matches.item")))
    return (
        found.withColumn("n_hit", hit)
        .withColumn("items", items)
        .withColumn("contaminated", (F.col("n_hit") > 0) & (per * F.col("n_hit") >= F.col("n_words")))
    )
