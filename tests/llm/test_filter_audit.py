import itertools
import re
from collections import defaultdict

import odd_docs
import pytest
from pyspark.sql import functions as F

from meterwise.llm import filter_audit


def fails(docs):
    """The letters that each (doc_id, text) fails."""
    out = []
    for doc_id, text in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [i for i, t in docs if (t or "") == text and i is not None]
        out.append({
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": bool(same) and (doc_id is None or min(same) < doc_id),
        })
    return out


def one_by_one(docs, parts, good, toxic):
    """The whole table, by running every order over every document."""
    failing, out = fails(docs), {}
    lost = defaultdict(int)
    for part in set(parts):
        mine = [k for k, p in enumerate(parts) if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [k for k in left if failing[k][x]]
                left = [k for k in left if not failing[k][x]]
                every = [k for k in mine if failing[k][x]]
                alone = [k for k in every if sum(failing[k].values()) == 1]
                ids = [docs[k][0] for k in gone]
                out[part, order, step] = (
                    len(left), len(gone), len(every) - len(gone), len(alone),
                    sum(i in good for i in ids), sum(i in toxic for i in ids),
                )
                lost[part, x] += len(gone)
    return {(p, o, s): (*row, lost[p, o[s - 1]]) for (p, o, s), row in out.items()}


def table(rows):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS) for r in rows}


@pytest.mark.parametrize("seed", [0, 1])
def test_against_running_every_order(spark, seed):
    data = odd_docs.rows(seed) + [(None, "x"), (None, "only here"), (3, "x"), (3, "x"), (9, "B A"), (9, "b #"), (800, "")]
    data += [(2000 + i, odd_docs.LONG[: 3000 * (i % 3 + 1)]) for i in range(9)]
    langs = {"en": "en", "": "", None: "", "fr": "fr"}
    marked = [(i, t, list(langs)[k % 4]) for k, (i, t) in enumerate(data)]
    docs = spark.createDataFrame(marked, "doc_id BIGINT, text STRING, lang STRING").repartition(3)
    for extra in ("part", "failed", "digest", "found", "first", "labelled", "n"):
        docs = docs.withColumn(extra, F.lit("clash"))
    labels = [(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(0, 40)] + [(3, 0, 1), (5, None, None), (None, 1, 1)]
    got = table(filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")).collect())
    good = {i for i, q, _ in labels if q and i is not None}
    toxic = {i for i, _, t in labels if t and i is not None}
    want = one_by_one(data, [langs[lang] for _, _, lang in marked], good, toxic)
    assert len(got) == 3 * 600 and got == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id BIGINT, text STRING, lang STRING")
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, "en")], docs.schema)
    rows = table(filter_audit.audit(one, labels).collect())
    assert len(rows) == 600 and rows["en", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
    assert rows["en", "BACDE", 1] == (1, 0, 0, 0, 0, 0, 0)
