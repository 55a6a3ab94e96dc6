"""Suffix-array dedup: maximal repeats of at least `length` bytes, wherever they are.

1. Every window of `length` bytes is dealt to the smallest hash among its short grams.
   Equal windows have equal grams, so they meet; neighbours mostly share the smallest one,
   so a document becomes a few runs of windows, kept as hashes and places.
2. Sorted by gram and content, runs that equal an earlier run are repeats as a whole, and
   grams with one run only are done. What is left are grams with different runs: the edges
   of repeats. Tasks stream through the sorted rows and hold one row.
3. The texts of those runs are fetched, and blocks of whole grams become enhanced suffix
   arrays. All but the earliest window of each outermost common-prefix interval are
   repeats. `maximal_repeats` walks the same array with a stack and gives the intervals
   whose occurrences do not all extend to the left by one byte, with all occurrences.
4. A gram with very many different runs is dealt over several arrays, and the windows
   that come first in theirs are compared across arrays by an aggregation.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm import bloom
from meterwise.llm.common import MIX, as_bytes, mixed, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 100
# Bytes of the grams; a power of two. Short ones are common, long ones make many runs.
GRAM = 32
# Windows in a run at most.
RUN = 128
# Bytes that are hashed at a time.
BLOCK = 1 << 18
# Windows in a suffix array, but for the rest of a gram; different runs of a gram in one.
ARRAY = 30_000
CHUNK = 400

POWER = 0x9E3779B97F4A7C15 | 1


@functools.cache
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MIX[0]))


@functools.cache
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    h, step = values, 1
    while step < gram:
        h = mixed(h[:-step] * np.uint64(POWER) + h[step:] * np.uint64(MIX[1]))
        step *= 2
    return h


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    rest = width - step
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def runs(texts: Sequence[bytes], length: int, gram: int, longest: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, gram hash, content hash) of the runs of all texts. The number
    of windows is negative where the gram occurs twice, so that windows of the run itself
    may be equal."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    values = _byte_values()[data]
    grams, width = gram_hashes(values, gram), length - gram + 1
    least = sliding_least(grams, width)
    # Windows that end in the text they start in.
    row = np.repeat(np.arange(len(texts)), lengths)[: len(least)]
    whole = np.arange(len(least)) + length <= ends[row]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | (whole[1:] != whole[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(least)))
    keep = whole[starts]
    starts, sizes = starts[keep], sizes[keep]
    # Long runs, of texts that repeat themselves, are cut.
    pieces = -(-sizes // longest)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts, sizes = np.repeat(starts, pieces) + nth * longest, np.repeat(sizes, pieces) - nth * longest
    sizes = np.minimum(sizes, longest)
    # Content hash: a polynomial over the bytes of the run, shifted to its start.
    total = np.zeros(len(data) + 1, np.uint64)
    room = 1 << max(19, len(data).bit_length())
    np.cumsum(values * _powers(room, POWER)[: len(data)], out=total[1:])
    back = _powers(room, pow(POWER, -1, 1 << 64))
    content = mixed((total[starts + sizes + length - 1] - total[starts]) * back[starts])
    reach = sizes + width - 1
    before = np.cumsum(reach) - reach
    inside = np.arange(reach.sum()) + np.repeat(starts - before, reach)
    here = grams[inside] == np.repeat(least[starts], reach)
    twice = np.add.reduceat(here, before, dtype=np.int64) > 1 if len(starts) else here
    at = row[starts]
    return at, starts - firsts[at], np.where(twice, -sizes, sizes), least[starts].view(np.int64), content.view(np.int64)


RUNS = "gram BIGINT, content BIGINT, windows INT, doc_id BIGINT, start INT"


def run_rows(source: DataFrame, length: int, gram: int, longest: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            # A long text is hashed in slices that hold every window once.
            parts = [
                (i, at, text[at : at + BLOCK + length - 1])
                for i, text in zip(ids, batch.column("text").to_pylist())
                for at in range(0, max(1, len(text) - length + 1), BLOCK)
            ]
            low = held = 0
            for k, part in enumerate(parts):
                held += len(part[2])
                if held >= BLOCK or k == len(parts) - 1:
                    docs, offsets, texts = zip(*parts[low : k + 1])
                    row, start, n, least, content = runs(texts, length, gram, longest)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(least, pa.int64()), pa.array(content, pa.int64()),
                            pa.array(n.astype(np.int32)),
                            pa.array(np.array(docs, np.int64)[row]),
                            pa.array((start + np.array(offsets, np.int64)[row]).astype(np.int32)),
                        ],
                        ["gram", "content", "windows", "doc_id", "start"],
                    )
                    low, held = k + 1, 0

    return source.mapInArrow(make, RUNS)


MET = "gram BIGINT, windows INT, doc_id BIGINT, start INT, same BOOLEAN"


def meeting(rows: DataFrame) -> DataFrame:
    """MET: runs that equal an earlier one (`same`), and the first of each of the
    different runs of a gram that has several, or one that may repeat itself."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last different run, and whether its gram had several (so it is out)
        names = ["gram", "windows", "doc_id", "start"]
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy() for c in (*names, "content")}
            if last is not None:
                columns = {c: np.concatenate([last[0][c], v]) for c, v in columns.items()}
            n = len(columns["gram"])
            new_gram, new = np.ones(n, bool), np.ones(n, bool)
            g = columns["gram"]
            new_gram[1:] = g[1:] != g[:-1]
            new[1:] = new_gram[1:] | (np.diff(columns["content"]) != 0) | (np.diff(columns["windows"]) != 0)
            group = np.cumsum(new_gram) - 1
            runs_of = np.bincount(group, new) + np.bincount(group, columns["windows"] < 0)
            several = runs_of[group] > 1
            if last is not None and last[1]:
                several[group == 0] = True
            out = ~new | several
            if last is not None and last[1]:
                out[0] = False
            k = int(np.flatnonzero(new)[-1])
            last = ({c: v[k : k + 1].copy() for c, v in columns.items()}, bool(several[-1]))
            columns["windows"] = np.abs(columns["windows"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[c][out]) for c in names] + [pa.array(~new[out])], [*names, "same"]
            )

    ordered = rows.repartition("gram").sortWithinPartitions("gram", "content", "windows", "doc_id", "start")
    return ordered.mapInArrow(scan, MET)


def suffix_array(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, cap: int
) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the suffixes that begin at `starts` and end at `ends` in the order
    of their bytes, and the bytes that each has in common with the next, 0 below `length`."""
    padded = np.append(data, np.zeros(cap, np.uint8))
    heads = np.lib.stride_tricks.sliding_window_view(padded, cap)[starts]
    sizes = ends - starts
    heads = heads + np.uint8(1)  # UTF-8 has no byte 255, so that 0 is the end alone
    heads[np.arange(cap) >= sizes[:, None]] = 0
    keys = np.ascontiguousarray(heads).view(f"S{cap}").ravel()
    order = np.argsort(keys, kind="stable")
    heads = heads[order]
    differ = heads[1:] != heads[:-1]
    common = np.where(differ.any(1), differ.argmax(1), cap)
    common = np.minimum(common, np.minimum(sizes[order][1:], sizes[order][:-1]))
    return order, np.where(common >= length, common, 0)


def maximal_repeats(
    data: np.ndarray, starts: np.ndarray, left: np.ndarray, ends: np.ndarray, length: int, cap: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(bytes, indexes into `starts`) of the maximal repeats of at least `length` bytes
    among the suffixes that begin at `starts` and end at `ends`. `left`: the byte before
    each suffix, or a number of its own where that is not known."""
    order, common = suffix_array(data, starts, ends, length, cap)
    common = common.tolist()
    before = left[order].tolist()
    # Open intervals: (common prefix, first place, the byte before all, or None if diverse).
    stack: list[list] = []
    for i, lcp in enumerate([*common, 0]):
        # Suffixes i and i + 1 have lcp bytes in common.
        low, side = i, before[i]
        while stack and stack[-1][0] > lcp:
            size, first, byte = stack.pop()
            byte = byte if byte == side else None
            if byte is None:
                yield size, order[first : i + 1]
            low, side = first, byte
        if lcp:
            if stack and stack[-1][0] == lcp:
                if stack[-1][2] != side:
                    stack[-1][2] = None
            else:
                stack.append([lcp, low, side])


def block_spans(rows: list[tuple], length: int, longest: int) -> tuple[list[tuple], list[tuple]]:
    """From (doc_id, start, chunks, bytes) of runs: (doc_id, start, end) of repeats,
    and (window hash, doc_id, start) of first windows of grams that have several arrays."""
    import xxhash

    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    ends = np.cumsum(sizes)
    firsts = ends - sizes
    windows = sizes - length + 1
    row = np.repeat(np.arange(len(rows)), windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = firsts[row] + nth
    # Places in the order of documents.
    at = np.array([r[1] for r in rows])[row] + nth
    doc = np.array([r[0] for r in rows])[row]
    rank = np.empty(len(row), np.int64)
    rank[np.lexsort((at, doc))] = np.arange(len(row))
    # Outermost intervals of `length` bytes or more: in each the earliest window is the first,
    # whatever deeper intervals there are.
    order, common = suffix_array(data, starts, ends[row], length, length + longest - 1)
    opens = np.flatnonzero(np.append(True, common == 0))
    first = np.minimum.reduceat(rank[order], opens)
    later = np.zeros(len(row), bool)
    later[order] = rank[order] > np.repeat(first, np.diff(np.append(opens, len(order))))
    hit = np.flatnonzero(later)
    new = np.append(True, (np.diff(hit) != 1) | (np.diff(row[hit]) != 0))[: len(hit)]
    low, high = hit[new], hit[np.append(new[1:], True)[: len(hit)]]
    spans = list(zip(doc[low].tolist(), at[low].tolist(), (at[high] + length).tolist()))
    many = np.array([r[2] > 1 for r in rows])[row] & ~later
    heads = [
        (xxhash.xxh3_128_digest(data[starts[k] : starts[k] + length].tobytes()), int(doc[k]), int(at[k]))
        for k in np.flatnonzero(many).tolist()
    ]
    return spans, heads


FOUND = "window BINARY, doc_id BIGINT, start INT, end INT"


def edge_spans(source: DataFrame, met: DataFrame, length: int, longest: int) -> DataFrame:
    """(doc_id, start, end) of repeats among the different runs of grams."""
    edges = met.where("NOT same").select("gram", "windows", "doc_id", "start")
    counts = edges.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    dealt = edges.join(counts, "gram")
    wanted = F.struct("gram", "chunks", "start", "windows")
    by_doc = dealt.groupBy("doc_id").agg(F.collect_list(wanted).alias("wanted"))
    docs = bloom.passing(source, bloom.bloom(edges.select("doc_id")), "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, places in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "wanted"))):
                for p in places:
                    s, e = p["start"], p["start"] + p["windows"] + length - 1
                    rows.append((p["gram"], p["chunks"], doc, s, text[s:e]))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["gram", "chunks", "doc_id", "start", "bytes"],
            )

    form = "gram BIGINT, chunks INT, doc_id BIGINT, start INT, bytes BINARY"
    texts = docs.join(by_doc, "doc_id").mapInArrow(cut, form)
    texts = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start"), F.col("chunks")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, group = [], 0, None
        names = ["doc_id", "start", "chunks", "bytes"]
        for batch in batches:
            groups = zip(batch.column("gram").to_pylist(), batch.column("chunk").to_pylist())
            for key, row in zip(groups, zip(*(batch.column(c).to_pylist() for c in names))):
                if held >= ARRAY and key != group:
                    yield as_batch(*block_spans(block, length, longest))
                    block, held = [], 0
                block.append(row)
                held += len(row[3]) - length + 1
                group = key
        if block:
            yield as_batch(*block_spans(block, length, longest))

    def as_batch(spans: list[tuple], heads: list[tuple]) -> pa.RecordBatch:
        rows = [(None, *s) for s in spans] + [(*h, None) for h in heads]
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.binary(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in FOUND.split(", ")]
        )

    ordered = texts.repartition("gram", "chunk").sortWithinPartitions("gram", "chunk")
    found = written(ordered.mapInArrow(search, FOUND), "edges")
    heads = found.where("window IS NOT NULL")
    firsts = heads.groupBy("window").agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("times")
    ).where("times > 1")
    later = heads.join(firsts, "window").where(F.struct("doc_id", "start") != F.col("first"))
    return found.where("window IS NULL").select("doc_id", "start", "end").unionByName(
        later.select("doc_id", "start", (F.col("start") + length).alias("end"))
    )


def repeated_spans(source: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, spans): the maximal runs of bytes, as (start, end), that lie in a string
    of `length` bytes which also starts earlier. `source`: (doc_id, text as bytes), ids
    unique."""
    gram = GRAM
    while gram > length:
        gram //= 2
    met = written(meeting(run_rows(source, length, gram, RUN)), "met")
    whole = met.where("same").select(
        "doc_id", "start", (F.col("start") + F.col("windows") + length - 1).alias("end")
    )
    spans = whole.unionByName(edge_spans(source, met, length, RUN))
    by_doc = spans.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = []
            for spans in batch.column("spans").to_pylist():
                out: list[dict] = []
                for s in spans:
                    if out and s["start"] <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], s["end"])
                    else:
                        out.append(dict(s))
                merged.append(out)
            yield batch.set_column(1, batch.schema.field(1), pa.array(merged, batch.schema.field(1).type))

    return by_doc.mapInArrow(merge, by_doc.schema)


def dedup_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of `docs` (doc_id, text): `spans` are
    the maximal removed runs of its UTF-8 bytes, `kept` the remaining bytes.

    A byte is removed if a string of `length` bytes around it also starts earlier: in a
    document with a smaller id, or earlier in the same one. Strings are judged on the
    input. A null text is empty. Rows with a null id, or with an id that another row has
    too, have no place in that order: they stay whole and count for no other. Other
    columns are ignored. An empty table gives an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text"))
    source = rows.where("doc_id IS NOT NULL")
    twice = written(source.groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if not twice.isEmpty():
        maybe, rest = bloom.split(source, bloom.bloom(twice), "doc_id")
        source = maybe.join(twice, "doc_id", "left_anti").unionByName(rest)
    spans = written(repeated_spans(source, length), "spans")
    hit, whole = bloom.split(rows, bloom.bloom(spans.select("doc_id")), "doc_id")

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                parts, at = [], 0
                for s in spans or ():
                    parts.append(text[at : s["start"]])
                    at = s["end"]
                kept.append(b"".join(parts) + text[at:])
            sizes = [len(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), batch.column("spans"),
                    pa.array(kept, pa.binary()),
                ],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    kind = "ARRAY<STRUCT<start: INT, end: INT>>"
    form = f"doc_id BIGINT, n_bytes BIGINT, spans {kind}, kept BINARY"
    struck = hit.join(spans, "doc_id", "left").mapInArrow(strike, form)
    return struck.unionByName(
        whole.select(
            "doc_id", F.length("text").cast("bigint").alias("n_bytes"),
            F.lit(None).cast(kind).alias("spans"), F.col("text").alias("kept"),
        )
    ).withColumn("spans", F.coalesce("spans", F.array().cast(kind)))
