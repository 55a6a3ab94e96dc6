"""A Bloom filter over 64-bit ids, built by Spark and broadcast.

It thins out a scan before a join by id, so that the join shuffles little more than its
result. It has sixteen bits for every id, up to a fixed size. It never loses an id; beyond
that size it only lets more of the others pass, and the join drops those.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import freed_shuffles, mixed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# 8 KB at least, 16 MB at most.
LEAST, MOST = 1 << 16, 1 << 27
BITS_PER_ID = 16
SLICE_BYTES = 1 << 13
FORM = "slice INT, bits BINARY"


def places(ids: np.ndarray, size: int) -> list[np.ndarray]:
    """Bit numbers of every id in a filter of `size` bits, one array per hash."""
    h = mixed(ids.astype(np.int64).view(np.uint64))
    return [(h >> np.uint64(s)) % np.uint64(size) for s in (0, 18, 36)]


def maybe(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter."""
    passed = np.ones(len(ids), bool)
    for at in places(ids, 8 * len(bits)):
        passed &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return passed


def bloom(ids: DataFrame):
    """A broadcast of the bits for the ids (one column of integers, not null)."""
    name = ids.columns[0]
    with freed_shuffles(ids.sparkSession):
        number = ids.count()
    size = min(MOST, max(LEAST, 1 << (BITS_PER_ID * number).bit_length()))
    # As many slices whatever the size, so that a task sends few rows.
    piece = max(SLICE_BYTES, size // 8 // 64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(np.concatenate(places(batch.column(0).to_numpy(zero_copy_only=False), size)).astype(np.int64))
            if not len(at):
                continue
            # The bits of each byte, then the bytes of each slice.
            byte = at >> 3
            first = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
            value = np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), first)
            byte = byte[first]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(byte // piece)) + 1, [len(byte)]]).tolist()
            for low, high in zip(cuts[:-1], cuts[1:]):
                s = int(byte[low]) // piece
                bits = slices.setdefault(s, np.zeros(piece, np.uint8))
                bits[byte[low:high] - s * piece] |= value[low:high]
        yield sent(slices)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, part in zip(*(batch.column(c).to_pylist() for c in ("slice", "bits"))):
                bits = slices.setdefault(s, np.zeros(piece, np.uint8))
                bits |= np.frombuffer(part, np.uint8)
        yield sent(slices)

    def sent(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(slices, pa.int32()), pa.array([b.tobytes() for b in slices.values()], pa.binary())],
            ["slice", "bits"],
        )

    parts = ids.select(F.col(name).cast("bigint")).distinct().mapInArrow(add, FORM)
    whole = np.zeros(size // 8, np.uint8)
    with freed_shuffles(ids.sparkSession):
        merged = parts.repartition("slice").mapInArrow(merge, FORM).collect()
    for row in merged:
        low = row["slice"] * piece
        whole[low : low + piece] = np.frombuffer(row["bits"], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(whole)


def passing(table: DataFrame, ids, column: str) -> DataFrame:
    """The rows of `table` whose `column`, an integer, may be in the filter `ids`."""
    return table.mapInArrow(sieve(ids, column, True), table.schema)


def split(table: DataFrame, ids, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may be in the filter, rows that are not). Null is in no filter."""
    return passing(table, ids, column), table.mapInArrow(sieve(ids, column, False), table.schema)


def without(table: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of `table` whose `column` is not among the integers of `ids`: a join that
    shuffles only the rows that the filter does not clear."""
    gone = ids.select(F.col(ids.columns[0]).alias(column))
    maybe, clear = split(table, bloom(ids), column)
    return maybe.join(gone, column, "left_anti").select(*table.columns).unionByName(clear)


def sieve(ids, column: str, wanted: bool) -> Callable:
    """Batches with the rows whose `column` may be, or is not, in the filter."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(column)
            known = at.fill_null(0).to_numpy(zero_copy_only=False)
            found = maybe(ids.value, known) & ~at.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(found == wanted))

    return kept
