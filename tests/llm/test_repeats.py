import hashlib
import random

import numpy as np
import odd_docs
import pytest

from meterwise.llm import queries, repeats


def brute_force(data, length: int) -> list[tuple]:
    """(doc_id, n_bytes, spans, kept) by remembering every window."""
    seen, out = set(), []
    for doc, text in sorted(data):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = hash(b[s : s + length])
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        spans, at = [], 0
        while (s := gone.find(1, at)) >= 0:
            at = gone.find(0, s) if 0 in gone[s:] else len(gone)
            spans.append((s, at))
        out.append((doc, len(b), tuple(spans), bytes(c for c, g in zip(b, gone) if not g)))
    return out


def result(df):
    return sorted(
        (r["doc_id"], r["n_bytes"], tuple(tuple(s) for s in r["spans"]), bytes(r["kept"])) for r in df.collect()
    )


def corpus() -> list[tuple]:
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choices("abcdé \0", k=n))
    passage = noise(120)
    texts = [noise(200) + passage[rng.randrange(60) : rng.randrange(70, 120)] + noise(90) for _ in range(60)]
    texts += [noise(40) + passage + noise(40) for _ in range(20)]
    texts += ["a" * 900, "ab" * 400 + "a" * 300, "x" * 39, "x" * 40, "x" * 41, passage * 3]
    texts += [texts[3], texts[3] + "tail", texts[5][30:]]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk, array, block", [(400, 30_000, 1 << 18), (3, 50, 300)])
def test_against_brute_force(spark, monkeypatch, chunk, array, block):
    for name, value in dict(CHUNK=chunk, ARRAY=array, BLOCK=block).items():
        monkeypatch.setattr(repeats, name, value)
    data = corpus()
    want = brute_force(data, 40)
    assert result(repeats.dedup_repeats(odd_docs.docs(spark, data), 40)) == want
    assert sum(len(r[2]) for r in want) > 80


def test_odd_documents(spark):
    data = odd_docs.rows(6)
    assert result(repeats.dedup_repeats(odd_docs.docs(spark, data), 50)) == brute_force(data, 50)


def test_nulls_repeated_ids_and_empty_tables(spark):
    text = "0123456789" * 12
    docs = odd_docs.docs(spark, [(None, text), (5, text), (7, text), (7, "other"), (8, text), (9, None)])
    got = {(r["doc_id"], r["n_bytes"]): len(r["kept"]) for r in repeats.dedup_repeats(docs).collect()}
    assert got == {(None, 120): 120, (5, 120): 10, (7, 120): 120, (7, 5): 5, (8, 120): 0, (9, 0): 0}
    assert repeats.dedup_repeats(docs.limit(0)).count() == 0


def test_maximal_repeats_are_all_and_maximal():
    rng = random.Random(8)
    for _ in range(30):
        data = np.array(rng.choices([97, 98], k=60), np.uint8)
        starts = np.arange(57)
        left = np.append(-1, data[:56]).astype(np.int64)
        got = {
            (n, tuple(sorted(k.tolist())))
            for n, k in repeats.maximal_repeats(data, starts, left, np.full(57, 60), 4, 60)
        }
        text = data.tobytes()
        want = set()
        for n in range(4, 60):
            for word in {text[s : s + n] for s in range(min(57, 61 - n))}:
                at = [s for s in range(min(57, 61 - n)) if text[s : s + n] == word]
                right = {text[s + n : s + n + 1] or s for s in at}
                before = {text[s - 1 : s] or -1 for s in at}
                if len(at) > 1 and len(right) > 1 and len(before) > 1:
                    want.add((n, tuple(at)))
        assert got == want


def test_query_against_brute_force(spark, sf_dir):
    got = queries.registered()["op7_suffix_dedup"](spark, sf_dir).collect()
    data = [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = [
        (d, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        for d, n, spans, kept in brute_force(data, 100)
    ]
    assert sorted(map(tuple, got)) == want
