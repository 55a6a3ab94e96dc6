"""Line dedup: lines within a small edit distance, by a segment-partition join.

A line of length l is cut into threshold + 1 even segments. Of two lines within the
threshold, one holds a segment of the other unchanged, at a place that the difference of
their lengths bounds. So every line indexes its segments, keyed by length, number and
content, and probes the indexes of lines as long or a little shorter with the substrings
that may match. Lines that meet are compared by counts of their letters inside the join,
so that a segment that very many lines have makes no pairs by itself, and then verified by
banded bit-parallel edit distance on the texts: first with a few owners of the segment, then
those that this has not joined yet. Equal lines are one line throughout.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm import bloom
from meterwise.llm.common import unused, worker_alone, written
from meterwise.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 2
# Shorter lines are compared by equality only, if at all.
MIN_CHARS = 20
# Owners of a segment that all lines with it are compared with first.
LEADERS = 8
# Lines that a task has seen lately and need not be keyed again.
SEEN = 1_000_000
BLANKS = " \t\n\v\f\r"


def line_id(line: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def segments(n: int, threshold: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line of n characters; the last are longer."""
    parts = threshold + 1
    short, longer = n // parts, n % parts
    cuts, at = [], 0
    for i in range(parts):
        size = short + (i >= parts - longer)
        cuts.append((at, size))
        at += size
    return cuts


def substrings(n: int, threshold: int) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, length) of the substrings of a line of n
    characters to probe with, but for its own segments."""
    found = []
    for less in range(min(threshold, n) + 1):
        for i, (p, size) in enumerate(segments(n - less, threshold)):
            low = max(0, p - i, p + less - (threshold - i))
            high = min(n - size, p + i, p + less + threshold - i)
            found += [
                (n - less, i, start, size) for start in range(low, high + 1) if less or start != p
            ]
    return found


def letters(line: str) -> int:
    """Counts of 16 kinds of characters, modulo 16, in four bits each."""
    kinds = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) * np.uint32(0x9E3779B1)
    counts = np.bincount(kinds >> np.uint32(28), minlength=16) & 15
    packed = int((counts.astype(np.uint64) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum())
    return packed - (1 << 64) if packed >> 63 else packed


def letters_of(lines: list[str], at_a_time: int = 2048) -> np.ndarray:
    """`letters` of every line."""
    out = np.empty(len(lines), np.int64)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    for low in range(0, len(lines), at_a_time):
        some = lines[low : low + at_a_time]
        kinds = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32) * np.uint32(0x9E3779B1)
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        cells = np.repeat(np.arange(len(some)) * 16, sizes) + (kinds >> np.uint32(28))
        counts = np.bincount(cells, minlength=16 * len(some)).reshape(-1, 16) & 15
        out[low : low + len(some)] = (counts.astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64).view(np.int64)
    return out


def counts_near(x: Column, y: Column, threshold: int) -> Column:
    """Whether counts by `letters` differ in no more kinds than the threshold allows: an
    edit changes two at most."""
    z = x.bitwiseXOR(y)
    z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
    z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
    return F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111))) <= 2 * threshold


def edit_distance_within(x: str, y: str, threshold: int) -> bool:
    """Whether at most `threshold` edits make x from y: after the common ends are cut,
    Myers' bit vectors over a band of 2 * threshold + 1 diagonals."""
    if abs(len(x) - len(y)) > threshold:
        return False
    if len(x) > len(y):
        x, y = y, x
    low, n = 0, len(x)
    while low < n and x[low] == y[low]:
        low += 1
    end = 0
    while end < n - low and x[-1 - end] == y[-1 - end]:
        end += 1
    x, y = x[low : len(x) - end], y[low : len(y) - end]
    if not x:
        return len(y) <= threshold
    # Bit k of a band at column j stands for row j + k - threshold.
    width, top = 2 * threshold + 1, 1 << (2 * threshold)
    mask = (1 << width) - 1
    at: dict[str, int] = {}
    for i, c in enumerate(x):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus = mask & ~((1 << threshold) - 1), 0
    score = min(threshold, len(x))  # of the last row that the band has reached
    for j, c in enumerate(y):
        shift = j - threshold
        known = at.get(c, 0)
        match = (known >> shift if shift >= 0 else known << -shift) & mask
        d0 = (((match & plus) + plus) ^ plus) | match | minus
        hp = minus | (~(d0 | plus) & mask)
        hn = d0 & plus
        x0 = d0 >> 1
        plus = hn | (~(x0 | hp) & mask)
        minus = x0 & hp
        row = j + threshold
        if row < len(x):
            score += 0 if d0 & top else 1
        else:
            # The band leaves the text below: follow its last row to the right.
            bit = len(x) - 1 - shift
            if bit < 0:
                return False
            score += (hp >> bit & 1) - (hn >> bit & 1)
    return score <= threshold


def _lines(batch: pa.RecordBatch, shortest: int) -> Iterator[tuple[int, int, str]]:
    """(row, line number, line) of the lines that take part."""
    for row, text in enumerate(batch.column("text").to_pylist()):
        for n, line in enumerate(text.split("\n") if text else ()):
            if len(line) >= shortest:
                yield row, n, line


def line_rows(source: DataFrame, shortest: int, equal_from: int) -> DataFrame:
    """(doc_id, uid, n, line) of the lines that take part: shorter ones need a word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (row, n, line_id(line)) for row, n, line in _lines(batch, min(shortest, equal_from))
                if len(line) >= shortest or line.strip(BLANKS)
            ]
            at, n, ids = (np.array(c, np.int64) for c in (zip(*found) if found else ((), (), ())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at)), batch.column("_uid").take(pa.array(at)),
                    pa.array(n.astype(np.int32)), pa.array(ids),
                ],
                ["doc_id", "uid", "n", "line"],
            )

    return source.mapInArrow(rows, "doc_id BIGINT, uid BIGINT, n INT, line BIGINT")


def keys(source: DataFrame, shortest: int, threshold: int, probes: bool, among=None) -> DataFrame:
    """(key, line, letters) of the segments, or of the substrings that look for them, whose
    key may be in the filter `among`; the others never leave the worker."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        worker_alone("lines")
        digest = xxhash.xxh3_64_intdigest
        seen: set[int] = set()
        cuts: dict[int, list[tuple[int, int, int, int]]] = {}
        for batch in batches:
            out_keys, out_lines, texts, counts = [], [], [], []
            for _, _, line in _lines(batch, shortest):
                this = line_id(line)
                if this in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(this)
                n = len(line)
                if n not in cuts:
                    cuts[n] = substrings(n, threshold) if probes else [
                        (n, i, p, size) for i, (p, size) in enumerate(segments(n, threshold))
                    ]
                if line.isascii():
                    data = line.encode()
                    out_keys += [digest(data[p : p + size], of * 16 + i) for of, i, p, size in cuts[n]]
                else:
                    out_keys += [
                        digest(line[p : p + size].encode("utf-8", "surrogatepass"), of * 16 + i)
                        for of, i, p, size in cuts[n]
                    ]
                out_lines.append(this)
                texts.append(line)
                counts.append(len(cuts[n]))
            found = np.array(out_keys, np.uint64).view(np.int64)
            at = np.repeat(np.arange(len(counts)), np.array(counts, np.int64))
            if among is not None:
                kept = bloom.maybe(among.value, found)
                found, at = found[kept], at[kept]
            # Letters of the lines that still have a key.
            kept, at = np.unique(at, return_inverse=True)
            kinds = letters_of([texts[i] for i in kept.tolist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.array(out_lines, np.int64)[kept][at]), pa.array(kinds[at])],
                ["key", "line", "letters"],
            )

    return source.mapInArrow(make, "key BIGINT, line BIGINT, letters BIGINT")


def texts_of(source: DataFrame, ids: DataFrame, shortest: int) -> DataFrame:
    """(line, text) of the lines in `ids` (line)."""
    filter_bits = bloom.bloom(ids)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {line_id(line): line for _, _, line in _lines(batch, shortest)}
            known = np.array(list(found), np.int64)
            keep = bloom.maybe(filter_bits.value, known).tolist()
            pairs = [p for p, k in zip(found.items(), keep) if k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())],
                ["line", "text"],
            )

    lines = source.mapInArrow(extract, "line BIGINT, text STRING")
    return lines.join(ids, "line", "left_semi").groupBy("line").agg(F.first("text").alias("text"))


def meetings(source: DataFrame, shortest: int, threshold: int) -> DataFrame:
    """(key, line, letters, own) of the segments and probes that some other line has too.
    Probes whose key no line has as a segment end where they are made."""
    index = written(keys(source, shortest, threshold, False).dropDuplicates(["key", "line"]), "segments")
    probes = keys(source, shortest, threshold, True, bloom.bloom(index.select("key")))
    rows = index.withColumn("own", F.lit(True)).unionByName(
        probes.dropDuplicates(["key", "line"]).withColumn("own", F.lit(False))
    )
    rows = written(rows, "keyed")
    several = rows.groupBy("key").agg(
        F.min("line").alias("low"), F.max("line").alias("high"), F.max("own").alias("any_own")
    ).where("low <> high AND any_own").select("key")
    return written(rows.join(several, "key"), "meetings")


def near_lines(
    source: DataFrame, shortest: int = MIN_CHARS, threshold: int = THRESHOLD
) -> DataFrame:
    """(a, b): ids of different lines within `threshold` edits: enough pairs to join all
    that such pairs join.

    Of every key the lines are first held against LEADERS of its owners, which is linear in
    the key's lines; a pair is tried in the second round only if the first has not joined it.
    """
    met = meetings(source, shortest, threshold)
    texts = written(texts_of(source, met.select("line").distinct(), shortest), "texts")
    bucket = F.pmod(F.xxhash64("line"), F.lit(LEADERS))
    leaders = met.where("own").groupBy("key", bucket.alias("bucket")).agg(
        F.min(F.struct("line", "letters")).alias("leader")
    )
    led = met.join(leaders, "key").where(
        (F.col("line") != F.col("leader.line"))
        & counts_near(F.col("letters"), F.col("leader.letters"), threshold)
    )
    led = led.select("line", F.col("leader.line").alias("other"))
    first = written(near_pairs(led, texts, threshold), "links")
    found = components(first).withColumnRenamed("node", "line")
    placed = met.join(found, "line", "left").withColumn("class", F.coalesce("component", "line"))
    placed = written(placed.drop("component"), "placed")
    side = lambda df, s: df.select(*[F.col(c).alias(c + s) for c in df.columns])
    both = side(placed.where("own"), "_a").join(side(placed, "_b"), F.col("key_a") == F.col("key_b")).where(
        (F.col("class_a") != F.col("class_b"))
        # Lines of one length meet on both sides of the index.
        & (~F.col("own_b") | (F.col("line_a") < F.col("line_b")))
        & counts_near(F.col("letters_a"), F.col("letters_b"), threshold)
    )
    apart = both.select(F.col("line_a").alias("line"), F.col("line_b").alias("other"))
    return first.unionByName(written(near_pairs(apart, texts, threshold), "links"))


def near_pairs(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of the pairs (line, other) that are within `threshold` edits."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                edit_distance_within(x, y, threshold)
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    a, b = F.col("line"), F.col("other")
    pairs = pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    both = pairs.join(texts.select(a.alias("a"), F.col("text").alias("x")), "a").join(
        texts.select(a.alias("b"), F.col("text").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(verify, "a BIGINT, b BIGINT")


def dedup_lines(
    docs: DataFrame, shortest: int = MIN_CHARS, threshold: int = THRESHOLD, equal_from: int | None = None
) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) without repeated lines, and the number of
    lines taken out as `removed_lines`.

    Lines (parted by \\n) of at least `shortest` characters are of one class if steps of
    at most `threshold` edits lead from one to the other. Shorter lines of at least
    `equal_from` characters, one of them not blank, form classes by equality; without
    `equal_from` they all stay. Of every class the first line
    stays, in the order of ids and places; other columns pass through, and every row stays,
    even without text.

    A null text stays null. Null ids come first. Rows with equal id and text are one
    document. An empty table gives an empty one. A column `removed_lines` is replaced.
    """
    number = F.col("doc_id").cast("bigint")
    uid, out = unused(docs, "_uid"), unused(docs, "_gone")
    marked = docs.withColumn(uid, F.xxhash64(number, F.col("text").cast("string")))
    source = marked.select(
        number.alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(uid).alias("_uid")
    )
    rows = line_rows(source, shortest, shortest if equal_from is None else equal_from)
    rows = written(rows, "lines")
    place = F.struct("doc_id", "uid", "n")
    firsts = rows.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    found = components(near_lines(source, shortest, threshold)).withColumnRenamed("node", "line")
    classes = firsts.join(found, "line", "left").withColumn("class", F.coalesce("component", "line"))
    classes = written(classes.drop("component"), "classes")
    repeated = classes.groupBy("class").agg(
        F.min("first").alias("first"), F.sum("times").alias("times")
    ).where("times > 1").select("class", "first")
    keep = classes.select("class", "line").join(repeated, "class").select("line", "first")
    # An identical copy of a row has the same place.
    gone = rows.join(keep, "line").where(~place.eqNullSafe(F.col("first")))
    gone = gone.groupBy(F.col("uid").alias(uid)).agg(F.collect_set("n").alias(out))
    gone = written(gone, "gone")
    touched, whole = bloom.split(marked, bloom.bloom(gone.select(uid)), uid)
    joined = touched.join(gone, uid, "left")

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, struck in zip(batch.column("text").to_pylist(), batch.column(out).to_pylist()):
                if struck:
                    left = set(struck)
                    text = "\n".join(t for n, t in enumerate(text.split("\n")) if n not in left)
                texts.append(text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    struck = joined.mapInArrow(strike, joined.schema)
    columns = [c for c in docs.columns if c != "removed_lines"]
    count = F.coalesce(F.size(out), F.lit(0))
    return struck.select(*columns, F.greatest(count, F.lit(0)).cast("bigint").alias("removed_lines")).unionByName(
        whole.select(*columns, F.lit(0).cast("bigint").alias("removed_lines"))
    )
