"""Toxicity: logistic regression over hashed word n-grams and skip-grams, fitted online by
FTRL-proximal.

Every coordinate has its own learning rate, and an L1 penalty keeps coordinates at zero
until they earn a weight, so the model is a short list of buckets that can be broadcast.
It is fitted by one task on a bounded sample of labelled documents, whose features are
extracted where the documents are read; the score covers every word of every document.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import as_bytes, chained, hashed_words, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 20
BIAS = BUCKETS  # one coordinate beyond the buckets
# Labelled documents that the model is fitted on; their ids are broadcast.
MAX_LABELLED = 12_000
EPOCHS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0

# Bytes of the stems of words.
STEMS = (5, 7)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def features(text: bytes, known) -> np.ndarray:
    """Buckets of a text's distinct words, word stems, word pairs and pairs that skip one
    word. A stem is the beginning of a word, so that one inflected form speaks for all."""
    found = WORD.findall(text.lower())
    words = hashed_words(found, known)
    grams = [chained(words, steps) for steps in ((0,), (0, 1), (0, 2))]
    for n in STEMS:
        stems = hashed_words([w[:n] for w in found if len(w) > n], known)
        grams.append(chained(stems, (0,)) + np.uint64(n))
    return np.unique((np.concatenate(grams) % np.uint64(BUCKETS)).astype(np.uint32))


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """FTRL-proximal over binary features. Weights are derived from z and n on use."""

    def __init__(self):
        self.z = np.zeros(BUCKETS + 1)
        self.n = np.zeros(BUCKETS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == BIAS, 0.0, L1)
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def labelled_sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic) of at most `limit` labelled documents, chosen by a hash of the id.
    A document with several labels is toxic if any says so; null labels are none."""
    one = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")
    ).agg(F.max("toxic").cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labelled: DataFrame) -> dict[int, float]:
    """Non-zero weights by bucket. `labelled` must be small: see labelled_sample."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        for batch in batches:
            found = [features(t, known).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.binary())],
                ["doc_id", "toxic", "features"],
            )

    def train(sample: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*(sample.column(c).to_pylist() for c in ("doc_id", "features", "toxic"))),
            key=lambda r: (r[0] * 0x9E3779B1 % (1 << 32), r[1]),
        )
        model = Ftrl()
        for _ in range(EPOCHS):
            for _, found, label in rows:
                model.learn(np.append(np.frombuffer(found, np.uint32).astype(np.int64), BIAS), label)
        at = np.flatnonzero(model.n > 0)
        w = model.weights(at)
        return pa.table({"bucket": pa.array(at[w != 0]), "weight": pa.array(w[w != 0])})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text"))
    rows = rows.join(F.broadcast(labelled), "doc_id")
    found = rows.mapInArrow(extract, "doc_id BIGINT, toxic INT, features BINARY")
    weights = found.groupBy(F.lit(0).alias("all")).applyInArrow(train, "bucket BIGINT, weight DOUBLE")
    # At most one row per bucket, and far fewer under the penalty.
    return {r["bucket"]: r["weight"] for r in weights.collect()}


def toxicity_scores(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of `docs` (doc_id, text): the probability of being
    toxic by a model fitted on `labelled` (doc_id, toxic), whose documents are in `docs`.

    A null or empty text gets the score of the bias. Null and repeated ids keep a row
    each. Other columns are ignored. An empty table gives an empty one; without labels the
    score is 0.5.
    """
    weights = fit(docs, labelled)
    at = np.array(sorted(weights), np.int64)
    model = docs.sparkSession.sparkContext.broadcast((at, np.array([weights[i] for i in at])))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_hashes()
        dense = np.zeros(BUCKETS + 1)
        dense[model.value[0]] = model.value[1]
        for batch in batches:
            scores = [
                float(sigmoid(dense[features(t, known)].sum() + dense[BIAS]))
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("text"))
    return source.mapInArrow(score, "doc_id BIGINT, score DOUBLE")
