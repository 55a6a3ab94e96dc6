"""Language-model scores by deleted interpolation.

A word's probability after another mixes three estimates: how often it followed that word,
how often it occurs, and one share for each word of the vocabulary. The mixture depends on
how often the context was seen, by powers of two, and its weights are learned by
expectation-maximisation on a deleted part of the training documents, whose counts are
taken out of the estimates.

The corpus is read once and becomes a table of chunks: up to CHUNK words each, as numbers
into the chunk's own vocabulary. A chunk asks for the counts of the words and pairs that it
holds, each once and with its own occurrences; requests are dealt by ranges of 64-bit
hashes, a task adds up a range, and the answers go back to their chunks. A word that is
everywhere is one request per chunk. What is exchanged grows with the corpus, nothing of
it is held by the driver, and no task holds more than a range or a chunk. Only the held-out
evidence for the weights is gathered: counts over a grid of fixed size.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import as_bytes, chained, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words of a chunk; a longer document is a chunk of its own.
CHUNK = 1 << 20
# Chunks of one file, which a reader may hold at once.
PER_FILE = 4
# Occurrences whose requests make up a range.
RANGE = 1 << 22
# Cells of the grid per factor of e between two estimates; ratios beyond LIMIT cells share one.
FINE, LIMIT = 8, 320
ABSENT = -LIMIT - 1
ROUNDS = 200

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# What stands for the beginning and the end of a text among hashes of words.
BOUNDARY = 0x5EED

CHUNKS = (
    "chunk BIGINT, n_docs INT, doc_ids BINARY, id_null BINARY, held_out BINARY, deleted BINARY, "
    "lengths BINARY, words BINARY, vocabulary BINARY"
)
ASKED = "chunk BIGINT, kind INT, part INT, keys BINARY, n BINARY, deleted BINARY"
ANSWERS = (
    "chunk BIGINT, kind INT, part INT, n BINARY, deleted BINARY, "
    "total BIGINT, distinct_keys BIGINT, total_kept BIGINT, distinct_kept BIGINT"
)
JOINED = CHUNKS + ", n1 BINARY, deleted1 BINARY, n2 BINARY, deleted2 BINARY"
GRID = "bucket INT, pair INT, word INT, n BIGINT"
SCORES = (
    "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
    "base_score DOUBLE, score DOUBLE"
)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, as each is large."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def packed(values: np.ndarray) -> bytes:
    """An array as bytes: equal bytes of all numbers side by side, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


class Numbers(dict):
    """Numbers of words in the order they come up; 0 is the boundary."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def chunked(docs: DataFrame, held_out: Column, deleted: Column) -> DataFrame:
    """CHUNKS of `docs` (doc_id, text). The conditions say which rows are not learned from,
    and which of the others have their counts taken out for the weights; null is no."""

    def chunk_row(ids, apart, taken, texts, numbers) -> pa.RecordBatch:
        import xxhash

        vocabulary = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
        row = {
            "chunk": int.from_bytes(os.urandom(8), "little", signed=True), "n_docs": len(ids),
            "doc_ids": packed(np.array([i or 0 for i in ids], np.int64)),
            "id_null": packed(np.array([i is None for i in ids])),
            "held_out": packed(np.array(apart, bool)), "deleted": packed(np.array(taken, bool)),
            "lengths": packed(np.array([len(t) for t in texts], np.int64)),
            "words": packed(np.concatenate(texts)), "vocabulary": packed(vocabulary),
        }
        schema = pa.schema([(n, {"chunk": pa.int64(), "n_docs": pa.int32()}.get(n, pa.binary())) for n in names(CHUNKS)])
        return pa.RecordBatch.from_pylist([row], schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, apart, taken, texts, size, numbers = [], [], [], [], 0, Numbers()
        for batch in batches:
            for i, text, h, d in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "held_out", "deleted"))):
                found = text.translate(LOWER).split()
                if ids and size + len(found) > CHUNK:
                    yield chunk_row(ids, apart, taken, texts, numbers)
                    ids, apart, taken, texts, size, numbers = [], [], [], [], 0, Numbers()
                ids.append(i)
                apart.append(h)
                taken.append(d)
                texts.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                size += len(found) + 1
        if ids:
            yield chunk_row(ids, apart, taken, texts, numbers)

    apart, taken = (F.coalesce(c, F.lit(False)) for c in (held_out, deleted))
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text"),
        apart.alias("held_out"), (~apart & taken).alias("deleted"),
    )
    return source.mapInArrow(cut, CHUNKS)


class Tokens(NamedTuple):
    """The tokens of a chunk, each with the one before it; the boundary ends every text."""

    before: np.ndarray
    word: np.ndarray
    doc: np.ndarray
    vocabulary: np.ndarray

    def keys(self) -> np.ndarray:
        """Hashes of the pairs."""
        first, second = self.vocabulary[self.before], self.vocabulary[self.word]
        return chained(np.stack([first, second], axis=1).ravel(), (0, 1))[::2]


def tokens_of(row: dict) -> Tokens:
    lengths, words = unpacked(row["lengths"], np.int64), unpacked(row["words"], np.uint32)
    ends = np.cumsum(lengths + 1)
    word = np.zeros(len(words) + len(lengths), np.uint32)
    inside = np.ones(len(word), bool)
    inside[ends - 1] = False
    word[inside] = words
    before = np.concatenate([[np.uint32(0)], word[:-1]])
    vocabulary = np.concatenate([[np.uint64(BOUNDARY)], unpacked(row["vocabulary"], np.uint64)])
    doc = np.repeat(np.arange(len(lengths)), lengths + 1)
    return Tokens(before, word, doc, vocabulary)


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range of each hash; ranges follow the order of hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def requests(chunks: DataFrame, parts: int) -> DataFrame:
    """ASKED: the distinct words (kind 1) and pairs (kind 2) of every chunk in the order of
    their hashes, with their occurrences in training and in deleted documents."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                tokens = tokens_of(row)
                learned = ~unpacked(row["held_out"], bool)[tokens.doc]
                taken = unpacked(row["deleted"], bool)[tokens.doc]
                size = len(tokens.vocabulary)
                order = np.argsort(tokens.vocabulary)
                once = [np.bincount(tokens.word[m], minlength=size)[order] for m in (learned, taken)]
                yield from asked(row["chunk"], 1, tokens.vocabulary[order], *once)
                keys, inverse = np.unique(tokens.keys(), return_inverse=True)
                twice = [np.bincount(inverse[m], minlength=len(keys)) for m in (learned, taken)]
                yield from asked(row["chunk"], 2, keys, *twice)

    def asked(chunk: int, kind: int, keys, n, deleted) -> Iterator[pa.RecordBatch]:
        part = parts_of(keys, parts)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
        rows = [
            (chunk, kind, int(part[a]), *(packed(x[a:b]) for x in (keys, n, deleted)))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
        ]
        types = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        yield pa.RecordBatch.from_arrays(columns, names(ASKED))

    return chunks.mapInArrow(ask, ASKED)


def answered(asked: DataFrame) -> DataFrame:
    """ANSWERS: for every request, the counts of its keys in all training documents and in
    all deleted ones; and per range a row without a chunk: occurrences and distinct keys,
    of all training documents and of those that are not deleted."""

    def answer(group: pa.Table) -> pa.Table:
        kind, part = group.column("kind")[0].as_py(), group.column("part")[0].as_py()
        keys, n, deleted = (
            [unpacked(b, t) for b in group.column(c).to_pylist()]
            for c, t in (("keys", np.uint64), ("n", np.int64), ("deleted", np.int64))
        )
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total, gone = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, np.concatenate(n))
        np.add.at(gone, inverse, np.concatenate(deleted))
        rows, low = [], 0
        for chunk, held in zip(group.column("chunk").to_pylist(), keys):
            at = inverse[low : low + len(held)]
            low += len(held)
            rows.append((chunk, kind, part, packed(total[at]), packed(gone[at]), None, None, None, None))
        left = total - gone
        sums = total.sum(), np.count_nonzero(total), left.sum(), np.count_nonzero(left)
        rows.append((None, kind, part, None, None, *map(int, sums)))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.Table.from_arrays(columns, names(ANSWERS))

    return asked.groupBy("kind", "part").applyInArrow(answer, ANSWERS)


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """JOINED: every chunk with the counts of its words and pairs, in hash order."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        out = left.select(names(CHUNKS))
        right = right.sort_by([("kind", "ascending"), ("part", "ascending")])
        kinds = right.column("kind").to_numpy()
        for kind in (1, 2):
            for c in ("n", "deleted"):
                blobs = right.filter(pa.array(kinds == kind)).column(c).to_pylist()
                whole = packed(np.concatenate([unpacked(b, np.int64) for b in blobs]))
                out = out.append_column(f"{c}{kind}", pa.array([whole], pa.binary()))
        return out.select(names(JOINED))

    of_chunks = answers.where("chunk IS NOT NULL").select("chunk", "kind", "part", "n", "deleted")
    return chunks.groupBy("chunk").cogroup(of_chunks.groupBy("chunk")).applyInArrow(join, JOINED)


class Counts(NamedTuple):
    """Counts for the tokens of a chunk, and the totals they belong to."""

    context: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    total: int
    distinct: int

    def estimates(self) -> tuple[np.ndarray, np.ndarray, float]:
        """The three probabilities of every token: after its context, alone, as any word."""
        pair = self.pair / np.maximum(self.context, 1)
        return pair, self.word / max(self.total, 1), 1 / (self.distinct + 1)

    def buckets(self) -> np.ndarray:
        """0 for contexts never seen, else the number of binary digits."""
        return np.frexp(self.context.astype(np.float64))[1]


def counts_of(row: dict, tokens: Tokens, total: int, distinct: int, kept: bool) -> Counts:
    """From all training documents, or from those that are kept when the rest is deleted."""
    n1, n2 = unpacked(row["n1"], np.int64), unpacked(row["n2"], np.int64)
    if kept:
        n1 = n1 - unpacked(row["deleted1"], np.int64)
        n2 = n2 - unpacked(row["deleted2"], np.int64)
    by_number = np.empty_like(n1)
    by_number[np.argsort(tokens.vocabulary)] = n1
    inverse = np.unique(tokens.keys(), return_inverse=True)[1]
    return Counts(by_number[tokens.before], by_number[tokens.word], n2[inverse], total, distinct)


def cells(ratio: np.ndarray) -> np.ndarray:
    """Numbers of the grid's cells for ratios between two estimates."""
    out = np.full(len(ratio), ABSENT, np.int64)
    some = ratio > 0
    out[some] = np.clip(np.round(FINE * np.log(ratio[some])), -LIMIT, LIMIT)
    return out


def evidence(joined: DataFrame, total: int, distinct: int) -> DataFrame:
    """GRID: the tokens of deleted documents by the bucket of their context and by how the
    estimates from the kept ones compare: what expectation-maximisation needs of them."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                taken = unpacked(row["deleted"], bool)
                if not taken.any():
                    continue
                tokens = tokens_of(row)
                counts = counts_of(row, tokens, total, distinct, kept=True)
                here = taken[tokens.doc]
                pair, word, any_word = counts.estimates()
                both = [cells(x[here] / any_word) - ABSENT for x in (pair, word)]
                shape = (65, 2 * LIMIT + 2, 2 * LIMIT + 2)
                cell = np.ravel_multi_index((counts.buckets()[here], *both), shape)
                found, n = np.unique(cell, return_counts=True)
                bucket, *both = np.unravel_index(found, shape)
                columns = [pa.array(c.astype(np.int32)) for c in (bucket, *(x + ABSENT for x in both))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n.astype(np.int64))], names(GRID))

    grid = joined.mapInArrow(weigh, GRID)
    return grid.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))


def learned_weights(grid: dict[str, np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the three estimates, one row per bucket, by expectation-maximisation on
    the grid. A bucket without evidence trusts all three alike; without a context there is
    nothing to trust in the first."""
    weights = np.full((65, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    ratio = lambda c: np.where(c == ABSENT, 0.0, np.exp(np.where(c == ABSENT, 0, c) / FINE))
    likely = np.stack([ratio(grid["pair"]), ratio(grid["word"]), np.ones(len(grid["n"]))], axis=1)
    for bucket in np.unique(grid["bucket"]):
        here = grid["bucket"] == bucket
        n, p, w = grid["n"][here], likely[here], weights[bucket]
        for _ in range(rounds):
            mixed = p * w
            w = (n[:, None] * mixed / mixed.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
        # No estimate is given up for good: a token always has a probability.
        floor = np.where(weights[bucket] > 0, 1e-6, 0)
        weights[bucket] = np.maximum(w, floor) / np.maximum(w, floor).sum()
    return weights


class Model(NamedTuple):
    """Totals of the training documents, the weights by bucket, and the chunks with the
    counts of all that they hold."""

    total: int
    distinct: int
    weights: np.ndarray
    joined: DataFrame


def fit(docs: DataFrame, held_out: Column, deleted: Column) -> Model:
    """Counts of the rows of `docs` (doc_id, text) that are not held out, and weights learned
    on those of them that are `deleted`."""
    chunks = written(chunked(docs, held_out, deleted), "chunks", maxRecordsPerFile=PER_FILE)
    size = chunks.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    # A packed word takes about two bytes.
    parts = max(64, size // 2 // RANGE)
    answers = written(answered(requests(chunks, parts)), "answers")
    sums = [F.sum(c).alias(c) for c in names(ANSWERS)[5:]]
    totals = answers.where("chunk IS NULL AND kind = 1").agg(*sums).first()
    total, distinct, kept, distinct_kept = (totals[c] or 0 for c in names(ANSWERS)[5:])
    joined = written(with_answers(chunks, answers), "joined", maxRecordsPerFile=PER_FILE)
    grid = evidence(joined, kept, distinct_kept).toArrow()
    weights = learned_weights({c: grid.column(c).to_numpy() for c in names(GRID)})
    if not total:
        weights[:] = 0, 0, 1
    return Model(total, distinct, weights, joined)


def score(model: Model) -> DataFrame:
    """SCORES of every document that the model was given."""
    total, distinct, weights = model.total, model.distinct, model.weights

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                tokens = tokens_of(row)
                counts = counts_of(row, tokens, total, distinct, kept=False)
                pair, word, any_word = counts.estimates()
                w = weights[counts.buckets()]
                mixed = w[:, 0] * pair + w[:, 1] * word + w[:, 2] * any_word
                plain = (counts.word + 1) / (total + distinct + 1)
                docs = row["n_docs"]
                per_doc = lambda x: np.bincount(tokens.doc, x, docs)
                n, known = per_doc(None), per_doc(counts.word > 0).astype(np.int64)
                ids, null = unpacked(row["doc_ids"], np.int64), unpacked(row["id_null"], bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=null), pa.array(unpacked(row["held_out"], bool)),
                     pa.array(n), pa.array(known), pa.array(np.full(docs, total)),
                     pa.array(per_doc(np.log10(plain))), pa.array(per_doc(np.log10(mixed)))],
                    names(SCORES),
                )

    return model.joined.mapInArrow(rate, SCORES)


def interpolated_scores(docs: DataFrame, held_out: Column, deleted: Column) -> DataFrame:
    """SCORES of every row of `docs` (doc_id, text): tokens, those that training holds, the
    training tokens, and the log10 probability of the text, with add-one counts of words
    (`base_score`) and by the model (`score`). Conditions as in `chunked`.

    A null text is empty and has one token, its end. Null and repeated ids keep a row each.
    Other columns are ignored, an empty table gives an empty one. With nothing to learn
    from, every token has probability 1, as the only word of the vocabulary.
    """
    return score(fit(docs, held_out, deleted))
