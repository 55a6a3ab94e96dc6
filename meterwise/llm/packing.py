"""Best-fit packing of documents into training sequences of a fixed length.

Every task packs the rows of its own partition, online and in one pass: a fixed number of
bins is open, and a bitset keyed by free space finds the fullest bin that a piece still
fits in one step. When a piece fits none, a new bin opens and, beyond the fixed number,
the fullest open one closes. Nothing is shuffled, so no source or document is too hot, and
memory is bounded by the open bins whatever the size of the input.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.tokens import encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKED = (
    "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids BINARY, "
    "sequence_id BIGINT, offset BIGINT"
)

# Documents that are packed at a time.
ROWS = 512


class OpenBins:
    """At most `limit` open bins of `size` places. `place(n)` gives (bin, offset)."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = 0  # bit f: a bin with f free places is open
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, n: int) -> tuple[int, int]:
        fitting = self.bits >> n
        if fitting:
            free = n + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.size, self.made
            self.made += 1
        left = free - n
        if left:  # a full bin closes at once
            if self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(found)
            self.bits |= 1 << left
            self.open += 1
        return found, self.size - free


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens: of `size` each, but for
    the first."""
    first = n % size or size
    return [(0, min(first, n))] + [(s, size) for s in range(first, n, size)]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches: texts, ids and pieces of one are held at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def best_fit_pack(
    docs: DataFrame,
    tokenizer: str,
    spaced: bool = True,
    end_id: int = 2,
    size: int = 1024,
    open_bins: int = 1024,
    cached: int | None = None,
) -> DataFrame:
    """PACKED, one row per piece of `docs` (doc_id, text): `ids` are the piece's token ids
    as little-endian unsigned 32-bit integers, found in the sequence `sequence_id` from
    `offset` on. Documents longer than `size` are cut, others never. `end_id` closes every
    document.

    A null or empty text is a piece that holds the end id alone. Null and repeated ids
    pass through. Other columns are ignored. An empty table gives an empty one. `cached`
    bounds the words whose ids a worker keeps; results do not depend on it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << 40
        encode = encoder(tokenizer, spaced, cached)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                for k, (start, n) in enumerate(cuts(len(ids) // 4, size)):
                    found, offset = bins.place(n)
                    piece = ids[4 * start : 4 * (start + n)]
                    rows.append((doc, k, start, n, piece, base + found, offset))
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            types += [pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                [c.split()[0] for c in PACKED.split(", ")],
            )

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return source.mapInArrow(pack, PACKED)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, documents): each sequence's token ids, joined in the order of
    their offsets, and the documents in it. A sequence holds at most `size` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    one = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate(
        F.col("parts.ids"), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)
    )
    return one.select(
        "sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("documents")
    )
