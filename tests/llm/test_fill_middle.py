import hashlib
import re
from collections import Counter

import odd_docs
from pyspark.sql import functions as F

from meterwise.llm import fill_middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_search(doc_id, text, rate=50, spm_rate=80):
    """(doc_id, n, form, prefix_chars, middle_chars, output) by slicing the text."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNITS.findall(text)
    assert "".join(units) == text
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < spm_rate:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [
    (None, "no id"), (None, None), (7, "same"), (7, "same"), (7, "other\ttext "), (8, "é" * 9 + "  ß\x85 x"),
    (901, "<P>"), (902, "a <S> b"), (903, "<"), (904, "P> x <"), (905, "<<P <S<M"), (906, "<P"), (907, ">"),
    (908, " \n"), (909, "x\x0b\x0c\r\n y"), (910, "𝔘 𝔫 𝔦"), (911, "<p> <M"), (912, "a\x1cb\x00c"),
]


def run(docs, recipe=fill_middle.Recipe()):
    rows = fill_middle.restore(fill_middle.fill_in_middle(docs, recipe)).collect()
    return [
        ((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], bytes(r["output"]).decode()),
         bytes(r["restored"]).decode())
        for r in rows
    ]


def test_outputs_and_way_back_against_slicing(spark):
    data = odd_docs.rows() + ODD + [(1000 + i, t) for i in range(6) for _, t in odd_docs.rows(i)[8:]]
    docs = odd_docs.docs(spark, data).withColumn("output", F.lit(b"x")).withColumn("form", F.lit(3)).withColumn("n", F.lit("n"))
    for rate, spm_rate in ((50, 80), (100, 50), (0, 80)):
        got = run(docs, fill_middle.Recipe(rate=rate, spm_rate=spm_rate))
        assert Counter(g[0] for g in got) == Counter(plain_search(i, t, rate, spm_rate) for i, t in data)
        assert Counter(g[1] for g in got) == Counter(t or "" for _, t in data)
    forms = Counter(plain_search(i, t, 100, 50)[2] for i, t in data)
    assert min(forms["psm"], forms["spm"], forms["plain"]) > 4


def test_runs_of_any_size_give_the_same(spark, monkeypatch):
    data = ODD + odd_docs.rows(3)
    docs = odd_docs.docs(spark, data)
    want = Counter(plain_search(i, t) for i, t in data)
    for size in (1, 100, 5000):
        # Tasks take the module along as it is now.
        monkeypatch.setattr(fill_middle, "RUN", size)
        got = run(docs)
        assert Counter(g[0] for g in got) == want and Counter(g[1] for g in got) == Counter(t or "" for _, t in data)


def test_empty_table(spark):
    assert run(odd_docs.docs(spark, ODD).limit(0)) == []


def test_a_worker_holds_little_beside_a_batch():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    texts = [b"some words of a text, \xc3\xa9 \n" * 100] * 1600
    batch = pa.array(texts, pa.binary())

    def peak(low, high):
        tracemalloc.start()
        for first, last, data, starts in fill_middle.runs(batch.slice(low, high - low)):
            n, form, chars, output, at = fill_middle.transformed(
                data, starts, list(range(first, last)), fill_middle.Recipe()
            )
            back, _ = fill_middle.restored(output, at, form)
            assert np.array_equal(back, data)
            del n, chars, output, at, back
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    whole = sum(map(len, texts))
    assert whole > 4_000_000 and peak(0, len(texts)) < 2 * whole
