import math
import re
import zlib
from collections import Counter

import numpy as np
import odd_docs
import pytest
from pyspark.sql import functions as F

from meterwise.llm import interpolation, queries


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def counted(texts):
    words, pairs = Counter(), Counter()
    for text in texts:
        found = tokens(text)
        words.update(found)
        pairs.update(zip([None, *found], found))
    return words, pairs


def estimates(text, words, pairs):
    """(context count, three estimates) of every token."""
    total, distinct = sum(words.values()), len(words)
    found = tokens(text)
    for v, w in zip([None, *found], found):
        yield words[v], (pairs[v, w] / words[v] if words[v] else 0.0, words[w] / total if total else 0.0, 1 / (distinct + 1))


def remainder(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


def plain_weights(deleted, kept, rounds=interpolation.ROUNDS):
    """Expectation-maximisation over the deleted tokens one by one."""
    events = {}
    for text in deleted:
        for n, p in estimates(text, *kept):
            events.setdefault(n.bit_length(), Counter())[p] += 1
    weights = {}
    for bucket, seen in events.items():
        w = np.array([1 / 3] * 3) if bucket else np.array([0, 0.5, 0.5])
        p, n = np.array(list(seen)), np.array(list(seen.values()))
        for _ in range(rounds):
            share = p * w / (p * w).sum(axis=1, keepdims=True)
            w = (n[:, None] * share).sum(axis=0) / n.sum()
        weights[bucket] = w
    return weights


def fitted(docs):
    r = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7))
    return interpolation.fit(docs, held_out=r == 2, deleted=r == 3)


def check(spark, data, docs):
    model = fitted(docs)
    got = [tuple(r) for r in interpolation.score(model).collect()]
    learned = [(i, t) for i, t in data if remainder(i) != 2]
    words, pairs = counted(t for _, t in learned)
    total, distinct = sum(words.values()), len(words)
    assert (model.total, model.distinct) == (total, distinct)
    kept = counted(t for i, t in learned if remainder(i) != 3)
    for bucket, w in plain_weights([t for i, t in learned if remainder(i) == 3], kept).items():
        # The grid moves an estimate by a sixteenth of a factor of e at most.
        assert np.abs(model.weights[bucket] - w).max() < 0.05, bucket
    want = []
    for i, t in data:
        found = tokens(t)
        base = sum(math.log10((words[w] + 1) / (total + distinct + 1)) for w in found)
        score = sum(math.log10(sum(model.weights[n.bit_length()] * p)) for n, p in estimates(t, words, pairs))
        want.append((i, remainder(i) == 2, len(found), sum(w in words for w in found), total, base, score))
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return got


def test_odd_rows_against_counting(spark):
    data = odd_docs.rows() + [(None, "a The"), (None, None), (3, "again"), (3, "again"), (70, "")]
    data += [(300 + 100 * s + i, t) for s in range(3) for i, t in enumerate(t for _, t in odd_docs.rows(s)[8:])]
    docs = odd_docs.docs(spark, data)
    for extra in ("chunk", "held_out", "deleted", "vocabulary", "n", "part"):
        docs = docs.withColumn(extra, F.lit("clash"))
    check(spark, data, docs)


def test_whole_table_and_chunks_of_any_size(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    one = sorted(check(spark, data, docs))
    # Tasks take the module along as it is now.
    monkeypatch.setattr(interpolation, "CHUNK", 2000)
    monkeypatch.setattr(interpolation, "PER_FILE", 2)
    monkeypatch.setattr(interpolation, "RANGE", 5000)
    many = sorted(tuple(r) for r in queries.registered()["op12_interpolated_scores"](spark, sf_dir).collect())
    for a, b in zip(one, many, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
    # The model is better than counts of words on texts that it has not seen.
    held_out = [r for r in one if r[1]]
    assert sum(r[6] for r in held_out) > 0.95 * sum(r[5] for r in held_out)


def test_the_model_is_a_distribution(spark):
    """After any context, the words of the vocabulary and one unknown add up to one."""
    data = [(i, t) for i, t in odd_docs.rows(2) if t is None or len(t) < 5000]
    model = fitted(odd_docs.docs(spark, data))
    words, pairs = counted(t for i, t in data if remainder(i) != 2)
    total, distinct = sum(words.values()), len(words)
    for v in [None, *list(words)[:20], "never seen"]:
        w = model.weights[words[v].bit_length()]
        whole = sum(
            w[0] * (pairs[v, x] / words[v] if words[v] else 0) + w[1] * words[x] / total + w[2] / (distinct + 1)
            for x in [*words, "unknown"]
        )
        assert whole == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from(spark):
    docs = odd_docs.docs(spark, [(1, "a b"), (2, None)])
    rows = interpolation.interpolated_scores(docs, F.lit(True), F.lit(None).cast("boolean")).collect()
    assert sorted(map(tuple, rows)) == [(1, True, 3, 0, 0, 0.0, 0.0), (2, True, 1, 0, 0, 0.0, 0.0)]
    assert interpolation.interpolated_scores(docs.limit(0), F.lit(False), F.lit(False)).count() == 0
