import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterwise.llm import queries

sys.path.insert(0, str(Path(__file__).parents[1]))
from check_oracle import compare, views  # noqa: E402


@pytest.mark.parametrize("name", queries.statements())
def test_query_matches_its_sql(spark, sf_dir, name):
    assert compare(spark, views(sf_dir), sf_dir, name, queries.statements()[name]) == "ok"


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.registered())
    assert numbers == list(range(1, 14))


def test_shards_are_contiguous_balanced_and_whole(spark, sf_dir):
    rows = sorted(map(tuple, queries.registered()["op6_sharding"](spark, sf_dir).collect()))
    target = sum(r[1] for r in rows) / 8
    widest = max(r[1] for r in rows)
    for k in range(8):
        mine = [r for r in rows if r[4] == k]
        assert [r[5] for r in mine] == list(range(len(mine)))
        assert abs(sum(r[1] for r in mine) - target) <= widest
    assert [r[4] for r in rows] == sorted(r[4] for r in rows)


def test_sharding_of_odd_tables(spark):
    import odd_docs

    from meterwise.llm.sharding import assign_shards

    rows = [(None, "x"), (None, None), *[(7, "same")] * 50, (3, "é" * 10), (9, "")]
    got = assign_shards(odd_docs.docs(spark, rows), 4).collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t in rows)
    for k in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert assign_shards(odd_docs.docs(spark, rows).limit(0), 4).count() == 0


def base_figures(text: str | None) -> tuple:
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {g for g in grams if grams.count(g) > 1} if len(words) < 3000 else None
    covered = {i + k for i, g in enumerate(grams) if again and g in again for k in range(3)}
    repeated = len(covered) if again is not None else None
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeated


def test_quality_figures_and_verdicts(spark, sf_dir):
    import odd_docs

    from meterwise.llm import quality

    data = odd_docs.rows() + [(900, "a b c a b c x #%|<\n\x0b\n\x85"), (None, "x y"), (901, "  é b")]
    none = spark.createDataFrame([], "doc_id BIGINT, trusted BOOLEAN")
    scores = quality.verdicts(quality.quality_scores(odd_docs.docs(spark, data), none)).collect()
    got = sorted((tuple(r)[1:5] for r in scores))
    assert got == sorted(base_figures(t)[:4] for _, t in data)
    by_id = {r["doc_id"]: r for r in scores}
    for i, t in data:
        if (want := base_figures(t)[4]) is not None:
            assert by_id[i]["n_repeat_words"] == want
        n = by_id[i]["n_words"]
        assert by_id[i]["base_failed"] == (n < 50 or 100 * by_id[i]["n_repeat_words"] > 50 * n)
    assert quality.quality_scores(odd_docs.docs(spark, data).limit(0), none).count() == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = queries.registered()["op8_quality_rules"](spark, sf_dir).join(labels, "doc_id").where("not base_failed")
    assert kept.where("quality = 1 and not kept").count() <= 0.02 * kept.where("quality = 1").count()
    assert kept.where("quality = 0 and kept").count() <= 0.2 * kept.where("quality = 0").count()


def test_quality_does_not_fade_as_ngrams_grow(spark, sf_dir):
    """16 corpora with words of their own are judged as one of them alone, also where
    most ratios are joined."""
    from meterwise.llm import quality

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    one = {r["doc_id"]: r for r in quality.quality_scores(docs, quality.trusted_sample(labels)).collect()}
    times = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("copy")
    number = (F.col("doc_id") * 16 + F.col("copy")).alias("doc_id")
    tail = F.concat(F.lit("$1"), F.substring(F.lit("abcdefghijklmnop"), F.col("copy") + 1, 1))
    many = docs.select("doc_id", "text", times).select(number, F.regexp_replace("text", F.lit(r"([^\x20\x09-\x0D]+)"), tail).alias("text"))
    trusted = quality.trusted_sample(labels.select("doc_id", "quality", times).select(number, "quality"))
    bad = {r[0] for r in labels.where("quality = 0").collect()}
    for held in (quality.HELD, 5000):
        got = quality.verdicts(quality.quality_scores(many, trusted, held)).collect()
        assert len(got) == 16 * len(one)
        assert max(abs(r["llr"] - one[r["doc_id"] // 16]["llr"]) for r in got) < 1e-6
        whole = [r for r in got if r["doc_id"] // 16 in bad and not r["base_failed"]]
        assert whole and sum(r["kept"] for r in whole) <= 0.05 * len(whole)
    kept = {r[0] for r in quality.keep_good(many, trusted, held=5000).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in got if r["kept"]}


@pytest.mark.parametrize("held", [10, 1000, 10**7])
def test_quality_ratios_against_plain_counts(spark, held):
    """Every n-gram is counted over the whole corpus, whatever a chunk holds; rare ones need
    no shuffle of documents' n-grams."""
    import math
    from collections import Counter

    import odd_docs

    from meterwise.llm import quality

    data = odd_docs.rows(3) + [(None, "a b a b c"), (4, "the same id"), (None, None)]
    trusted = {i for i, _ in data if i is not None and i % 3 == 0}
    marks = spark.createDataFrame([(i, True) for i in trusted], "doc_id BIGINT, trusted BOOLEAN")
    grams = lambda t: (w := (t or "").encode().split()) + list(zip(w, w[1:]))
    n, good = Counter(), Counter()
    for i, t in data:
        n.update(grams(t))
        good.update(grams(t) if i in trusted else ())
    scale = sum(good.values()) / sum(n.values())
    ratio = lambda g: math.log((good[g] + quality.PRIOR) / (n[g] * scale + quality.PRIOR))
    mean = lambda t: sum(map(ratio, grams(t))) / max(1, len(grams(t)))
    got = quality.quality_scores(odd_docs.docs(spark, data), marks, held).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((i, mean(t)) for i, t in data), key=key)
    found = sorted(((r["doc_id"], r["llr"]) for r in got), key=key)
    assert [i for i, _ in found] == [i for i, _ in want]
    assert max(abs(a - b) for (_, a), (_, b) in zip(found, want)) < 1e-6


def test_quality_requests_are_few_and_small(spark, sf_dir):
    """A chunk asks once for each of its n-grams, in a few bytes, and the waves part them."""
    import numpy as np

    from meterwise.llm import quality
    from meterwise.llm.common import as_bytes

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    source = docs.select("doc_id", as_bytes().alias("text"), F.lit(True).alias("trusted"))
    chunks = quality.chunked(source.coalesce(1), quality.HELD)
    assert chunks.count() == 1
    sent = [quality.requests(chunks, 4, quality.BITS, wave).collect() for wave in range(quality.WAVES)]
    assert {r["part"] for r in sent[0]} == {0, 1} and {r["part"] for r in sent[1]} == {2, 3}
    texts = [r["text"] for r in source.collect()]
    distinct = {g for t in texts for w in [t.split()] for g in [*w, *zip(w, w[1:])]}
    rows = sent[0] + sent[1]
    assert sum(len(quality.unpacked(r["n"], np.int64)) for r in rows) == len(distinct)
    assert sum(len(r["grams"]) + len(r["n"]) + len(r["good"]) for r in rows) < 6 * len(distinct)


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    scores = queries.registered()["op10_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scores.where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    found = sum(r["predicted"] and r["toxic"] for r in rows)
    assert right >= 0.96 * len(rows) and found >= 0.8 * sum(r["toxic"] for r in rows)
    assert found >= 0.95 * sum(r["predicted"] for r in rows)


def test_toxicity_of_odd_tables(spark):
    import odd_docs

    from meterwise.llm import toxicity

    data = odd_docs.rows() + [(None, "x"), (3, "again")]
    docs = odd_docs.docs(spark, data)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(30)] + [(4, None), (None, 1)], "doc_id BIGINT, toxic INT")
    scores = toxicity.toxicity_scores(docs, toxicity.labelled_sample(labels)).collect()
    assert len(scores) == len(data) and all(0 <= r["score"] <= 1 for r in scores)
    none = toxicity.labelled_sample(labels.limit(0))
    assert {r["score"] for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    assert toxicity.toxicity_scores(docs.limit(0), none).count() == 0
