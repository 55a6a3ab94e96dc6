import hashlib
import random

import odd_docs
import pytest

from meterwise.llm import lines, queries


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def edited(rng: random.Random, text: str, edits: int, alphabet: str) -> str:
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randint(0, len(out)), rng.random()
        if kind < 0.33:
            out.insert(at, rng.choice(alphabet))
        elif at < len(out):
            out[at : at + 1] = [] if kind < 0.66 else [rng.choice(alphabet)]
    return "".join(out)


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(5000):
        a = "".join(rng.choices("abcé", k=rng.randint(0, 9)))
        b = edited(rng, a, rng.randint(0, 4), "abcé")
        for threshold in (1, 2, 3):
            assert lines.edit_distance_within(a, b, threshold) == (distance(a, b) <= threshold)


def brute_force(data, shortest: int, threshold: int) -> list[tuple]:
    rows = [(i, t, k, line) for i, t in data for k, line in enumerate((t or "").split("\n")) if len(line) >= shortest]
    distinct = sorted({r[3] for r in rows})
    root = {d: d for d in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, a in enumerate(distinct):
        for b in distinct[:x]:
            if abs(len(a) - len(b)) <= threshold and find(a) != find(b) and distance(a, b) <= threshold:
                root[find(a)] = find(b)
    first: dict[str, tuple] = {}
    for i, _, k, line in sorted(rows, key=lambda r: (r[0], r[2])):
        first.setdefault(find(line), (i, k))
    gone = {(i, k) for i, _, k, line in rows if first[find(line)] != (i, k)}
    out = []
    for i, t in data:
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)
        out.append((i, sum(d == i for d, _ in gone), kept))
    return sorted(out)


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcd éß", k=rng.randint(8, 40))) for _ in range(40)]
    template = "an entry of the log with number "
    texts = []
    for _ in range(60):
        some = [edited(rng, rng.choice(base), rng.choice((0, 0, 1, 2, 3)), "abcdé") for _ in range(rng.randint(1, 8))]
        some += [template + str(rng.randint(100, 999999)) for _ in range(rng.randint(0, 2))]
        texts.append("\n".join(some))
    return list(enumerate(texts + [None, "", "\n", texts[0], base[1]]))


def result(df):
    return sorted((r["doc_id"], r["removed_lines"], r["text"]) for r in df.collect())


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_against_brute_force(spark, threshold):
    data = corpus(threshold)
    want = brute_force(data, 10, threshold)
    assert result(lines.dedup_lines(odd_docs.docs(spark, data), 10, threshold)) == want
    assert sum(r[1] for r in want) > 60


def with_short_lines(data, shortest: int, threshold: int, equal_from: int) -> list[tuple]:
    """brute_force, and shorter lines with a word are struck where an equal one came before."""
    seen, want = set(), []
    for i, n, text in brute_force(data, shortest, threshold):
        if text is None:
            want.append((i, n, None))
            continue
        kept = []
        for line in text.split("\n"):
            takes_part = equal_from <= len(line) < shortest and line.strip(" \t\n\v\f\r")
            if not (takes_part and line in seen):
                kept.append(line)
            if takes_part:
                seen.add(line)
        want.append((i, n + text.count("\n") + 1 - len(kept), "\n".join(kept)))
    return want


@pytest.mark.parametrize("equal_from", [1, 6])
def test_short_lines_by_equality(spark, equal_from):
    rng = random.Random(4)
    short = ["a", "é", "ab cd", "ab ce", "sixsix", "sevenev", "  ", " \t ", "x  y"]
    data = [(i, "\n".join([t or "", *rng.choices(short, k=4)])) for i, t in corpus(7)]
    got = result(lines.dedup_lines(odd_docs.docs(spark, data), 10, 2, equal_from))
    want = with_short_lines(data, 10, 2, equal_from)
    # A text whose lines all went is empty, like one of a single empty line.
    assert [(i, n if t else 0, t) for i, n, t in got] == [(i, n if t else 0, t) for i, n, t in want]


def test_odd_documents_keep_their_columns(spark):
    data = odd_docs.rows(3)
    df = lines.dedup_lines(odd_docs.docs(spark, data).withColumn("removed_lines", odd_docs_column()))
    assert df.columns[-1] == "removed_lines" and set(odd_docs.docs(spark, data).columns) < set(df.columns)
    assert result(df) == brute_force(data, 20, 2)


def odd_docs_column():
    from pyspark.sql import functions as F

    return F.lit("mine")


def test_columns_named_like_the_operators_own(spark):
    data = corpus(2)
    names = ("_uid", "_GONE", "_gone_", "uid", "n", "line", "first")
    docs = odd_docs.docs(spark, data)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, odd_docs_column() if k % 2 else (docs["doc_id"] * 0 + k))
    df = lines.dedup_lines(docs, 10, 2)
    assert result(df) == brute_force(data, 10, 2)
    rows = df.select(*names).distinct().collect()
    assert [tuple(r) for r in rows] == [tuple("mine" if k % 2 else k for k in range(len(names)))]


def test_links_of_many_similar_lines_are_few(spark):
    """Lines that all are within two edits of each other are joined without all pairs."""
    texts = [f"the same words with one number {i:03d} in them" for i in range(120)]
    texts = [t for t in texts if t[31] in "01"]
    data = list(enumerate(texts))
    source = spark.createDataFrame(data, "doc_id BIGINT, text STRING").selectExpr("doc_id", "text", "doc_id AS _uid")
    links = lines.near_lines(source, 20, 2)
    assert links.count() < 12 * len(texts)
    assert result(lines.dedup_lines(odd_docs.docs(spark, data))) == brute_force(data, 20, 2)


def test_nulls_repeats_and_empty_tables(spark):
    line = "a line that is long enough to count"
    docs = odd_docs.docs(spark, [(None, line), (3, line), (3, line), (2, line + "\nx"), (4, None)])
    got = sorted(((r["doc_id"], r["text"]) for r in lines.dedup_lines(docs).collect()), key=str)
    assert got == [(2, "x"), (3, ""), (3, ""), (4, None), (None, line)]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_query_against_plain_search(spark, sf_dir):
    """Equal lines by a dictionary; near ones by comparing lines of like length that share
    a third."""
    got = queries.registered()["op9_line_dedup"](spark, sf_dir).collect()
    data = [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute_force_by_counts(data)
    assert sorted((r["doc_id"], r["removed_lines"], r["kept_sha256"]) for r in got) == want


def brute_force_by_counts(data):
    from collections import Counter

    rows = sorted({line for _, t in data for line in (t or "").split("\n") if len(line) >= 20}, key=len)
    bags = [Counter(r) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x + 1, len(rows)):
            if len(rows[y]) - len(rows[x]) > 2:
                break
            if (bags[y] - bags[x]).total() <= 2 and distance(rows[x], rows[y]) <= 2:
                root[find(y)] = find(x)
    of = {r: find(k) for k, r in enumerate(rows)}
    # Shorter lines with a word are classes by equality.
    short = {x for _, t in data for x in (t or "").split("\n") if len(x) < 20 and x.strip(" \t\n\v\f\r")}
    of.update({x: x for x in short})
    first: dict = {}
    places = [(i, k, x) for i, t in sorted(data) for k, x in enumerate((t or "").split("\n")) if x in of]
    for i, k, x in places:
        first.setdefault(of[x], (i, k))
    gone = {(i, k) for i, k, x in places if first[of[x]] != (i, k)}
    out = []
    for i, t in data:
        kept = "\n".join(x for k, x in enumerate((t or "").split("\n")) if (i, k) not in gone)
        out.append((i, sum(d == i for d, _ in gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_letters_of_many_lines_are_those_of_each():
    rng = random.Random(4)
    texts = ["", "a", "é" * 40, "😀x", *("".join(rng.choices("abcdeé \t😀", k=rng.randint(0, 60))) for _ in range(300))]
    for at_a_time in (1, 7, 10_000):
        assert lines.letters_of(texts, at_a_time).tolist() == [lines.letters(t) for t in texts]
    assert len(lines.letters_of([])) == 0


def test_components_that_are_stars_need_no_round(spark, monkeypatch):
    """Links that lead to the smallest node already are done after one look; others are
    joined whatever their shape."""
    from meterwise.llm import components as found

    tables = []
    monkeypatch.setattr(found, "written", lambda df, name, **options: tables.append(name) or written(df, name, **options))
    written = lines.written
    links = lambda pairs: spark.createDataFrame(pairs, "a BIGINT, b BIGINT")
    star = [(1, 5), (6, 1), (1, 7), (2, 9), (3, 3)]
    got = {tuple(r) for r in found.components(links(star)).collect()}
    assert got == {(5, 1), (6, 1), (7, 1), (9, 2)} and len(tables) == 1
    path = [(i, i + 1) for i in range(10, 40)] + [(50, 52), (51, 52), (51, 53)]
    got = {tuple(r) for r in found.components(links(star + path)).collect()}
    assert got == {(5, 1), (6, 1), (7, 1), (9, 2), *((i, 10) for i in range(11, 41)), (51, 50), (52, 50), (53, 50)}
    assert found.components(links([])).count() == 0
