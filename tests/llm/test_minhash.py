import random
import re

import odd_docs
import pytest

from meterwise.llm import minhash, queries
from meterwise.llm.components import components


def shingles(text: str | None, size: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute_force(data, size: int, percent: int = 80) -> list[tuple]:
    sets = [(i, shingles(t, size)) for i, t in data]
    root = {i: i for i, _ in data}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted((i, len(s), find(i)) for i, s in sets)


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


@pytest.mark.parametrize("k", [16, 256])
def test_against_brute_force(spark, k):
    data = odd_docs.rows(1)
    assert result(minhash.near_duplicates(odd_docs.docs(spark, data), 3, k=k)) == brute_force(data, 3)


@pytest.mark.parametrize("k", [8, 64])
def test_against_brute_force_with_small_sketches(spark, k):
    data = odd_docs.rows(1)
    assert result(minhash.near_duplicates(odd_docs.docs(spark, data), 3, k=k)) == brute_force(data, 3)


@pytest.mark.parametrize("k, pairs", [
    (8, [(8, 10, 100)]), (64, [(64, 80, 100)]),
    (256, [(16, 20, 200), (254, 316, 60), (256, 315, 60), (256, 320, 60)]),
])
def test_sets_inside_larger_ones_at_the_threshold(spark, k, pairs):
    texts = []
    for small, large, times in pairs:
        for _ in range(times):
            words = [f"w{len(texts)}x{i}" for i in range(large)]
            texts += [" ".join(words[:small]), " ".join(words)]
    data = list(enumerate(texts))
    got = minhash.near_duplicates(odd_docs.docs(spark, data), 1, k=k)
    assert result(got) == [(i, len(t.split()), i - i % 2) for i, t in data]


def test_chains_and_groups_of_copies(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = " ".join(rng.choices(vocabulary, k=60))
    texts = []
    for _ in range(4):  # copies that drift: ends of a chain are not similar to each other
        words = rng.choices(vocabulary, k=150)
        for _ in range(40):
            words = list(words)
            words[rng.randrange(150)] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    # Many documents that share a passage and nothing else.
    texts += [common + " " + " ".join(rng.choices(vocabulary, k=100)) for _ in range(60)]
    texts += [texts[3]] * 30
    rng.shuffle(texts)
    data = list(enumerate(texts))
    want = brute_force(data, 4)
    assert result(minhash.near_duplicates(odd_docs.docs(spark, data), 4)) == want
    assert len({c for _, _, c in want}) < 80


def test_nulls_repeats_and_empty_tables(spark):
    text = "a b c d e f g"
    docs = odd_docs.docs(spark, [(None, text), (4, text), (4, text), (9, text), (2, None), (1, ""), (None, None)])
    got = sorted(((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == [(1, 1), (2, 2), (4, 4), (4, 4), (9, 4), (None, None), (None, None)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_ids_with_several_texts_lose_no_link(spark):
    x, y, z = "a b c d e f g h", "i j k l m n o p", "q r s t u v w x"
    data = [(5, x), (5, y), (9, y), (11, y), (12, x), (13, x), (20, z), (3, z), (20, "y z 1 2 3 4"), (30, "y z 1 2 3 4")]
    got = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(odd_docs.docs(spark, data)).collect())
    assert got == sorted((i, 5 if t in (x, y) else 3) for i, t in data)


def test_only_ascii_letters_lose_their_case(spark):
    data = [
        (1, "One two THREE four Five six"), (2, "ONE TWO three FOUR five SIX"), (3, "a B c d A b C D"),
        (4, "\u00c9t\u00e9 two three four"), (5, "\u00e9t\u00e9 two three four"),
    ]
    got = result(minhash.near_duplicates(odd_docs.docs(spark, data), 4))
    assert got == [(1, 3, 1), (2, 3, 1), (3, 4, 3), (4, 1, 4), (5, 1, 5)]


def test_query_lowers_case(spark, tmp_path):
    data = [(7, "Some Words that DIFFER in case"), (8, "some words that differ in CASE")]
    folder = odd_docs.table_folder(tmp_path, spark, documents=odd_docs.docs(spark, data))
    got = queries.registered()["op5_minhash_dedup"](spark, folder).select("doc_id", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == [(7, 7, True), (8, 7, False)]


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    random.Random(2).shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()))
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}


def test_query_against_brute_force(spark, sf_dir):
    got = queries.registered()["op5_minhash_dedup"](spark, sf_dir).drop("links").collect()
    docs = [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, got)) == [(*r, r[0] == r[2]) for r in brute_force(docs, 4)]
