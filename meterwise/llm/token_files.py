"""Token ids as Arrow IPC files of equal-length sequences.

A file holds the token stream of one range of ids, cut into rows of a fixed length: `ids`
and the masks `valid` (not padding) and `ends` (last id of a document) are fixed-size
lists, so row i of a memory-mapped file is a slice of its buffers, found without reading
any other row. `end_ids` lists the documents that end in a row.

Documents are range partitioned by id and each task streams its range into one file, a
few hundred rows at a time. Only files that the committed manifest names count: what a
failed or repeated task leaves behind is never read. A document's place in the whole
stream is its file's place, summed over one row per file, plus its place in the file.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterwise.llm.common import write_parquet
from meterwise.llm.tokens import encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST = "part INT, file STRING, documents BIGINT, tokens BIGINT, sequences BIGINT"
DOCUMENTS = "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids BINARY"
ROWS_PER_BATCH = 256


def file_system(path: str):
    """(Arrow file system, path in it). The folder must be one that Arrow can reach from
    every executor: a mounted folder, HDFS or an object store."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def schema_of(length: int, wide: bool) -> pa.Schema:
    of = lambda kind: pa.list_(pa.field("item", kind, nullable=False), length)
    return pa.schema([
        pa.field("ids", of(pa.uint32() if wide else pa.uint16()), nullable=False),
        pa.field("valid", of(pa.bool_()), nullable=False),
        pa.field("ends", of(pa.bool_()), nullable=False),
        pa.field("end_ids", pa.list_(pa.int64()), nullable=False),
    ])


class SequenceWriter:
    """Append documents to one file; rows go out in batches."""

    def __init__(self, sink, length: int, wide: bool):
        self.schema, self.length = schema_of(length, wide), length
        self.kind = np.dtype("<u4" if wide else "<u2")
        self.out = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []  # ids that are not written yet
        self.ends: list[tuple[int, int | None]] = []  # (place after its end, document)
        self.n = self.tokens = self.documents = self.sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind))
        self.n += len(ids)
        self.tokens += len(ids)
        self.documents += 1
        self.ends.append((self.n, doc_id))
        # Every batch but the last is full, so that a row's number tells its batch.
        batches = self.n // (self.length * ROWS_PER_BATCH)
        if batches:
            self.flush(batches * ROWS_PER_BATCH)

    def flush(self, rows: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, self.kind)
        for at in range(0, rows, ROWS_PER_BATCH):
            self._batch(ids, at, min(ROWS_PER_BATCH, rows - at))
        done = min(rows * self.length, len(ids))
        self.held, self.n = [ids[done:]], len(ids) - done
        self.ends = [(e - done, d) for e, d in self.ends if e > done]

    def _batch(self, ids: np.ndarray, first: int, rows: int) -> None:
        length, low = self.length, first * self.length
        part = ids[low : low + rows * length]
        padded = np.zeros(rows * length, self.kind)
        padded[: len(part)] = part
        here = [(e - low - 1, d) for e, d in self.ends if low < e <= low + rows * length]
        places = np.array([p for p, _ in here], np.int64)
        ends = np.zeros(rows * length, bool)
        ends[places] = True
        offsets = np.searchsorted(places, np.arange(rows + 1) * length)
        lists = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(a), length)
        columns = [
            lists(padded),
            lists(np.arange(rows * length) < len(part)),
            lists(ends),
            pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array([d for _, d in here], pa.int64())
            ),
        ]
        columns = [c.cast(f.type) for c, f in zip(columns, self.schema)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.sequences += rows

    def close(self) -> None:
        self.flush(-(-self.n // self.length))
        self.out.close()


class TokenFile:
    """Random access to the sequences of one file."""

    def __init__(self, source):
        """`source`: a local path, which is memory-mapped, or an open Arrow file."""
        self.file = pa.ipc.open_file(pa.memory_map(source) if isinstance(source, str) else source)
        self.length = self.file.schema.field("ids").type.list_size

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray, pa.BooleanArray]:
        """(ids, valid, ends) of sequence i, as views of the file's buffers."""
        batch = self.file.get_batch(i // ROWS_PER_BATCH)
        low = i % ROWS_PER_BATCH * self.length
        ids, valid, ends = (
            batch.column(k).values.slice(low, self.length) for k in ("ids", "valid", "ends")
        )
        return ids.to_numpy(zero_copy_only=True), valid, ends

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of every document, in the order of the stream."""
        held: list[np.ndarray] = []
        start = 0
        for k in range(self.file.num_record_batches):
            batch = self.file.get_batch(k)
            ids = batch.column("ids").values.to_numpy()
            ends = np.flatnonzero(batch.column("ends").values.to_numpy(zero_copy_only=False))
            low = 0
            for end, doc in zip(ends + 1, batch.column("end_ids").values.to_pylist()):
                held.append(ids[low:end])
                whole = np.concatenate(held)
                yield doc, start, whole
                start += len(whole)
                held, low = [], end
            held.append(ids[low:])


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, spaced: bool = False, end_id: int = 1,
    length: int = 1024,
) -> DataFrame:
    """Encode `docs` (doc_id, text) in ascending id order into files below `path`, and
    commit and return their MANIFEST.

    Each document's ids are followed by `end_id`. A null or empty text is the end id
    alone; null ids come first; repeated ids stay separate documents. The last sequence of
    a file is padded with zeros that `valid` marks. Other columns are ignored. An empty
    table gives a manifest without rows.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaced)
        wide = max(encode.__self__.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
        part = TaskContext.get().partitionId()
        system, folder = file_system(path)
        system.create_dir(folder, recursive=True)
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.arrow"
        writer = None
        sink = None
        for batch in batches:
            if writer is None and batch.num_rows:
                sink = system.open_output_stream(f"{folder}/{name}")
                writer = SequenceWriter(sink, length, wide)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                writer.add(doc, np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)))
        if writer is not None:
            writer.close()
            sink.close()
            row = (part, name, writer.documents, writer.tokens, writer.sequences)
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, types)],
                [c.split()[0] for c in MANIFEST.split(", ")],
            )

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    write_parquet(ordered.mapInArrow(write, MANIFEST), f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """DOCUMENTS of the files that the manifest names: `start` counts the ids of all
    documents before, `ids` are little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(path)
        for batch in batches:
            for file, base in zip(*(batch.column(c).to_pylist() for c in ("file", "base"))):
                with system.open_input_file(f"{folder}/{file}") as source:
                    rows, held = [], 0
                    for doc, start, ids in TokenFile(source).documents():
                        rows.append((doc, base + start, len(ids), ids.astype("<u4").tobytes()))
                        held += len(ids)
                        if held > 1 << 20:
                            yield as_batch(rows)
                            rows, held = [], 0
                    yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            [c.split()[0] for c in DOCUMENTS.split(", ")],
        )

    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # One row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    files = manifest.count()
    return based.select("file", "base").repartition(max(1, files)).mapInArrow(read, DOCUMENTS)
