import hashlib
import re

import odd_docs
import pytest

from meterwise.llm import decontamination, queries


def words(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(docs, items, size=13):
    """{row: (n_words, n_hit, items)} by looking at every window of every document."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if names := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= names
        out.append((doc, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(df):
    rows = decontamination.contamination(df).collect()
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in rows), key=str
    )


def benchmark_of(data):
    texts = [t for _, t in data if t]
    items = [(k, " ".join(t.split()[3:40])) for k, t in enumerate(texts[6:26])]
    items += [(100, None), (101, ""), (102, "..."), (103, "one"), (104, items[3][1]), (None, items[4][1])]
    items += [(105, "the of, THE of the of the of " * 5), (10, "Straße Éa éa"), (9, texts[8] * 2)]
    return items


@pytest.mark.parametrize("window, block", [(13, 1 << 24), (3, 1 << 24), (5, 200)])
def test_against_brute_force(spark, window, block):
    data = odd_docs.rows()
    data += [(None, data[9][1]), (3, data[9][1]), (200, "the of the of the of the of " * 40)]
    items = benchmark_of(data)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id BIGINT, text STRING, doc_id INT")
    got = found(decontamination.find_matches(odd_docs.docs(spark, data), benchmark, window, block))
    want = brute_force(data, [("" if i is None else i, t) for i, t in items], window)
    assert got == want
    assert any(r[4] for r in want) and not all(r[4] for r in want)


def test_longest_matches_and_their_places(spark):
    w = [f"w{i}" for i in range(40)]
    item = spark.createDataFrame([(1, " ".join(w[:30]))], "item_id BIGINT, text STRING")
    docs = odd_docs.docs(spark, [(7, "x y " + " ".join(w[5:25]) + " z " + " ".join(w[0:13]))])
    row = decontamination.find_matches(docs, item).head()
    places = sorted((m["item_start"], m["doc_start"], m["n_words"]) for m in row["matches"])
    assert places == [(0, 23, 13), (5, 2, 20)]


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id BIGINT, text STRING")
    docs = odd_docs.docs(spark, [(1, "a b"), (2, None)])
    assert found(decontamination.find_matches(docs, benchmark)) == [(1, 2, 0, (), False), (2, 0, 0, (), False)]
    one = spark.createDataFrame([(1, "a b")], "item_id BIGINT, text STRING")
    assert decontamination.find_matches(docs.limit(0), one).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    got = queries.registered()["op4_decontamination"](spark, sf_dir).collect()
    read = lambda name: [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    want = brute_force(read("documents"), read("benchmark"))
    digest = lambda items: hashlib.sha256(",".join(items).encode()).hexdigest()
    assert sorted(map(tuple, got), key=str) == [
        (d, n, h, len(items), digest(items), c) for d, n, h, items, c in want
    ]
    assert any(r[4] for r in want)
