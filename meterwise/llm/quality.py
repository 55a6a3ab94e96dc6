"""Quality rules: text statistics, and an n-gram likelihood ratio.

How much likelier are a document's words under a trusted target than under the raw
corpus? Words and word pairs are counted by hashes of 44 bits or more. The raw counts cover every
document; the target counts cover a bounded sample of trusted ids. The corpus is read once
and becomes a table of chunks, compressed texts of some megabytes each. A chunk asks for the
counts of its n-grams, each once and with its own occurrences: requests are dealt by ranges
of hashes and packed as differences, so that a common word is one entry and a rare one takes
four bytes. A task adds up a range, and the answers go back to their chunks in the same
order. What is exchanged grows with the corpus; nothing of it goes through the driver, and no
task holds more than a range or a chunk.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm import bloom
from meterwise.llm.common import (
    as_bytes, chained, give_back, hashed_words, unused, word_hashes, worker_alone, written,
)
from meterwise.llm.interpolation import names, packed, parts_of, rows_of, unpacked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# N-grams of a chunk, taken as a third of its bytes; a longer text is a chunk of its own.
HELD = 10_500_000
# N-grams of a chunk that are looked up at a time.
LOOKED_UP = 1 << 20
# Bytes of a chunk after which it is worth the time to return freed memory.
LARGE = 1 << 22
# Chunks of one file, which a reader may hold at once.
PER_FILE = 4
# Occurrences whose requests make up a range.
RANGE = 1 << 22
# Halves of the hashes are asked for, and halves of the chunks judged, one after the other:
# the disk holds the shuffle of one.
WAVES = 2
# Bits of a hash, and at least so many more than the number of all bytes has: one in a
# thousand n-grams at most shares its hash with another, on a small corpus nearly none.
BITS, MORE_BITS = 44, 10
# Trusted ids that the target is counted over; they are broadcast.
MAX_TRUSTED = 20_000
# Occurrences, seen and expected, that every n-gram starts with.
PRIOR = 2.0
# Mean log ratio per n-gram below which a document is rejected.
THRESHOLD = -0.25

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"

SCORES = (
    "doc_id BIGINT, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, "
    "n_repeat_words BIGINT, llr DOUBLE"
)
CHUNKS = (
    "chunk BIGINT, n_bytes BIGINT, ids BINARY, id_null BINARY, trusted BINARY, "
    "lengths BINARY, texts BINARY"
)
ASKED = "chunk BIGINT, part INT, grams BINARY, n BINARY, good BINARY"
ANSWERS = "chunk BIGINT, part INT, n BINARY, good BINARY, total BIGINT, total_good BIGINT"


def ngrams(words: np.ndarray) -> np.ndarray:
    """Hashes of a text's words and word pairs, in any order."""
    return np.concatenate([chained(words, (0,)), chained(words, (0, 1))]).view(np.int64)


def trusted_sample(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """(doc_id, trusted) of at most `limit` documents that any label calls good, chosen
    by a hash of the id."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    mixed = F.xxhash64(F.col("doc_id").cast("bigint"))
    return good.orderBy(mixed, "doc_id").limit(limit).withColumn("trusted", F.lit(True))


def log_ratios(n, good, scale: float):
    return np.log((good + PRIOR) / (n * scale + PRIOR))


def chunked(source: DataFrame, held: int) -> DataFrame:
    """CHUNKS of `source` (doc_id, text as bytes, trusted)."""

    def chunk_row(ids: list, trusted: list, texts: list[bytes]) -> pa.RecordBatch:
        import zstandard

        row = {
            "chunk": int.from_bytes(os.urandom(8), "little", signed=True), "n_bytes": sum(map(len, texts)),
            "ids": packed(np.array([i or 0 for i in ids], np.int64)),
            "id_null": packed(np.array([i is None for i in ids])),
            "trusted": packed(np.array(trusted, bool)),
            "lengths": packed(np.array([len(t) for t in texts], np.int64)),
            "texts": zstandard.ZstdCompressor(level=9).compress(b"".join(texts)),
        }
        types = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.RecordBatch.from_pylist([row], pa.schema(list(zip(names(CHUNKS), types))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_alone("chunks of texts")
        ids, trusted, texts, size = [], [], [], 0
        for batch in batches:
            for i, good, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "trusted", "text"))):
                if ids and size + len(text) > 3 * held:
                    yield chunk_row(ids, trusted, texts)
                    ids, trusted, texts, size = [], [], [], 0
                ids.append(i)
                trusted.append(good)
                texts.append(text)
                size += len(text)
        if ids:
            yield chunk_row(ids, trusted, texts)

    return source.mapInArrow(cut, CHUNKS)


def texts_of(row: dict) -> list[bytes]:
    import zstandard

    ends = np.cumsum(unpacked(row["lengths"], np.int64)).tolist()
    whole = zstandard.ZstdDecompressor().decompress(row["texts"])
    return [whole[a:b] for a, b in zip([0, *ends], ends)]


def short_hashes(grams: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of n-grams, in an array of its own, which has their order."""
    short = grams.view(np.uint64) ^ np.uint64(1 << 63)
    short >>= np.uint64(64 - bits)
    return short


def chunk_ngrams(hashes: Iterable[np.ndarray], most: int, bits: int, wave: int | None = None) -> np.ndarray:
    """Hashes of the n-grams of texts, given by those of their words, in ascending order, or
    those of one wave; `most` is a number that they do not exceed."""
    # What is not filled takes no memory.
    whole, size = np.empty(most, np.uint64), 0
    for words in hashes:
        short = short_hashes(ngrams(words), bits)
        if wave is not None:
            short = short[parts_of(short << np.uint64(64 - bits), WAVES) == wave]
        whole[size : size + len(short)] = short
        size += len(short)
    whole = whole[:size]
    whole.sort()
    return whole


def firsts(ranked: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array starts."""
    new = np.ones(len(ranked), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    return np.flatnonzero(new)


def requests(chunks: DataFrame, parts: int, bits: int, wave: int) -> DataFrame:
    """ASKED: the distinct n-grams of every chunk in the order of their hashes, with their
    occurrences in all of its documents and in the trusted ones, of one wave."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_alone("n-gram counts")
        known = word_hashes()
        for batch in batches:
            for row in rows_of(batch):
                texts, trusted = texts_of(row), unpacked(row["trusted"], bool).tolist()
                words = lambda some: (hashed_words(t.split(), known) for t in some)
                whole = chunk_ngrams(words(texts), row["n_bytes"], bits, wave)
                if len(whole):
                    chosen = [t for t, good in zip(texts, trusted) if good]
                    good = chunk_ngrams(words(chosen), sum(map(len, chosen)), bits, wave)
                    yield asked(row["chunk"], whole, good)

    def asked(chunk: int, whole: np.ndarray, trusted: np.ndarray) -> pa.RecordBatch:
        starts = firsts(whole)
        grams, n = whole[starts], np.diff(starts, append=len(whole))
        good, starts = np.zeros(len(grams), np.int64), firsts(trusted)
        good[np.searchsorted(grams, trusted[starts])] = np.diff(starts, append=len(trusted))
        part = parts_of(grams << np.uint64(64 - bits), parts)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
        rows = [
            (chunk, int(part[a]), packed(np.diff(grams[a:b], prepend=np.uint64(0))), packed(n[a:b]), packed(good[a:b]))
            for a, b in zip(cuts[:-1], cuts[1:])
        ]
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names(ASKED))

    return chunks.mapInArrow(ask, ASKED)


def answered(asked: DataFrame) -> DataFrame:
    """ANSWERS: for every request, the occurrences of its n-grams in all documents and in
    all trusted ones; and per range a row without a chunk with the sums of both."""

    def answer(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        grams, n, good = (
            [unpacked(b, kind) for b in group.column(c).to_pylist()]
            for c, kind in (("grams", np.uint64), ("n", np.int64), ("good", np.int64))
        )
        sizes = [len(x) for x in n]
        whole = np.concatenate([np.cumsum(d, dtype=np.uint64) for d in grams])
        del grams
        inverse = np.unique(whole, return_inverse=True)[1]
        del whole
        # Sums of integers below 2 ** 53.
        total, trusted = (np.bincount(inverse, np.concatenate(x)).astype(np.int64) for x in (n, good))
        rows, low = [], 0
        for chunk, size in zip(group.column("chunk").to_pylist(), sizes):
            at = inverse[low : low + size]
            low += size
            rows.append((chunk, part, packed(total[at]), packed(trusted[at]), None, None))
        rows.append((None, part, None, None, int(total.sum()), int(trusted.sum())))
        types = [pa.int64(), pa.int32(), *[pa.binary()] * 2, *[pa.int64()] * 2]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names(ANSWERS))

    return asked.groupBy("part").applyInArrow(answer, ANSWERS)


def repeated_words(words: np.ndarray) -> int:
    """Words inside windows of three words that occur twice or more."""
    grams = chained(words, (0, 1, 2))
    if not len(grams):
        return 0
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : len(words) - 2 + k] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def quality_scores(docs: DataFrame, trusted: DataFrame, held: int = HELD) -> DataFrame:
    """SCORES of every row of `docs` (doc_id, text); `llr` is the mean log ratio per word
    and word pair, 0 for texts without words, on a grid of nine decimals. `held` bounds
    what a worker holds and does not change a result.

    A null text has no words. Null and repeated ids keep a row each. Other columns are
    ignored. An empty table gives an empty one; without trusted documents every ratio is 0
    or less. `trusted` must be small: see trusted_sample.
    """
    number = F.col("doc_id").cast("bigint")
    return scores_by(docs, number, trusted, held)


def scores_by(docs: DataFrame, named: Column, trusted: DataFrame, held: int) -> DataFrame:
    """SCORES of every row of `docs` (doc_id, text), with `named` for the id."""
    marked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), named.alias("named"), as_bytes().alias("text")
    ).join(F.broadcast(trusted), "doc_id", "left")
    source = marked.select(
        F.col("named").alias("doc_id"), "text", F.coalesce("trusted", F.lit(False)).alias("trusted")
    )
    chunks = written(chunked(source, held), "chunks", maxRecordsPerFile=PER_FILE)
    size = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    bits = min(64, max(BITS, size.bit_length() + MORE_BITS))
    parts = max(64, size // 3 // RANGE)
    answers = reduce(DataFrame.unionByName, [
        written(answered(requests(chunks, parts, bits, wave)), "answers") for wave in range(WAVES)
    ])
    total, good = answers.where("chunk IS NULL").agg(F.sum("total"), F.sum("total_good")).first()
    scale = good / total if total else 0.0

    def judge(chunk: pa.Table, found: pa.Table) -> pa.Table:
        worker_alone("verdicts")
        # Piece by piece: a worker's memory holds a chunk's arrays as few times as it can.
        row = chunk.to_pylist()[0]
        figures, hashes = figures_of(texts_of(row))
        row.pop("texts")
        found = found.sort_by("part")
        pairs = zip(*(found.column(c).to_pylist() for c in ("n", "good")))
        ratios = np.concatenate([np.empty(0, np.float32), *(
            log_ratios(unpacked(n, np.int64), unpacked(good, np.int64), scale).astype(np.float32)
            for n, good in pairs
        )])
        grams = chunk_ngrams(hashes, row["n_bytes"], bits)
        grams = grams[firsts(grams)]
        if row["n_bytes"] >= LARGE:
            give_back()
        means: list[float] = []
        for _, sizes, some, owner in sorted_ngrams(hashes):
            at = np.searchsorted(grams, short_hashes(some, bits))
            means += (np.bincount(owner, ratios[at], len(sizes)) / np.maximum(sizes, 1)).tolist()
        ids, null = unpacked(row["ids"], np.int64), unpacked(row["id_null"], bool)
        columns = [pa.array(c, pa.int64()) for c in zip(*figures)]
        return pa.Table.from_arrays([pa.array(ids, mask=null), *columns, pa.array(means)], names(SCORES))

    of_chunks = answers.where("chunk IS NOT NULL").select("chunk", "part", "n", "good")
    scores = []
    for wave in range(WAVES):
        left, right = (t.where(F.pmod("chunk", F.lit(WAVES)) == wave).groupBy("chunk") for t in (chunks, of_chunks))
        scores.append(written(left.cogroup(right).applyInArrow(judge, SCORES), "scores"))
    return reduce(DataFrame.unionByName, scores).withColumn("llr", F.round("llr", 9))


def sorted_ngrams(hashes: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The n-grams of texts, given by the hashes of their words, some LOOKED_UP at a time:
    (first text, n-grams of each text, n-grams in ascending order, the text of each, from 0)."""
    first, size = 0, 0
    for i, words in enumerate(hashes):
        size += max(0, 2 * len(words) - 1)
        if i + 1 < len(hashes) and size < LOOKED_UP:
            continue
        lengths = np.array([len(h) for h in hashes[first : i + 1]])
        # In place and piece by piece: a worker's memory holds these arrays a few times only.
        joined = np.concatenate(hashes[first : i + 1])
        texts = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        # Pairs across the end of a text are none.
        inside = texts[1:] == texts[:-1]
        grams = np.concatenate([chained(joined, (0,)), chained(joined, (0, 1))[inside]]).view(np.int64)
        owner = np.concatenate([texts, texts[1:][inside]])
        del joined, texts, inside
        order = np.argsort(grams)
        grams, owner = grams[order], owner[order]
        del order
        yield first, np.maximum(2 * lengths - 1, 0), grams, owner
        del grams, owner
        first, size = i + 1, 0


def figures_of(texts: list[bytes]) -> tuple[list[tuple], list[np.ndarray]]:
    """SCORES of texts, but for the id and the ratio, and the hashes of their words."""
    known = word_hashes()
    symbol, inner = re.compile(b"[" + re.escape(SYMBOLS) + b"]"), re.compile(rb"[\x80-\xbf]+")
    rows, all_hashes = [], []
    for text in texts:
        words = text.split()
        hashes = hashed_words(words, known)
        all_hashes.append(hashes)
        inside = 0 if text.isascii() else sum(map(len, inner.findall(text)))
        rows.append((
            len(words), sum(map(len, words)) - inside, len(symbol.findall(text)),
            duplicate_lines(text), repeated_words(hashes),
        ))
    return rows, all_hashes


def base_fails(n_words, n_repeat_words):
    """Too short, or mostly repeated."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def keep_good(
    docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, held: int = HELD
) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) that the rules and the ratio keep, with all
    their columns; see quality_scores for odd rows."""
    uid = unused(docs, "_uid")
    marked = docs.withColumn(uid, F.xxhash64(as_bytes()))
    judged = verdicts(scores_by(docs, F.xxhash64(as_bytes()), trusted, held), threshold)
    bad = written(judged.where(~F.col("kept")).select("doc_id").distinct(), "bad")
    return bloom.without(marked, bad, uid).select(*docs.columns)


def verdicts(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`scores` with `base_failed` (too short, or mostly repeated) and `kept`."""
    failed = scores.withColumn("base_failed", base_fails(F.col("n_words"), F.col("n_repeat_words")))
    return failed.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
