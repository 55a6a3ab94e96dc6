"""Each stage against what it must do to its own input, and the whole run."""

import corpus_pipeline
import odd_docs
import test_decontamination
import test_lines
import test_minhash
import test_tokens_and_packing as packing
from meterwise.llm import queries
from meterwise.llm.common import table


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def folder(spark, tmp_path):
    labels = spark.createDataFrame([(k, k % 3 > 0, 0) for k in range(30)], "doc_id BIGINT, q BOOLEAN, toxic INT")
    benchmark = spark.createDataFrame(test_decontamination.benchmark_of(odd_docs.rows()), "item_id BIGINT, text STRING")
    return odd_docs.table_folder(
        tmp_path, spark, labels=labels.selectExpr("doc_id", "int(q) AS quality", "toxic"), benchmark=benchmark
    )


def test_stages_keep_the_columns_and_take_odd_documents(spark, tmp_path):
    sf_dir = folder(spark, tmp_path)
    data = odd_docs.rows()
    docs = odd_docs.docs(spark, data + [(None, data[12][1]), (None, None), (14, data[14][1])])
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, sf_dir)
        assert f(spark, docs.limit(0), sf_dir).count() == 0
        if name != "pack":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert 0 < out.count()


def test_near_dedup_leaves_one_of_each_group(spark, tmp_path):
    data = odd_docs.rows(1)
    want = [i for i, _, c in test_minhash.brute_force(data, 5) if i == c]
    got = rows(stage("near_dedup")(spark, odd_docs.docs(spark, data), str(tmp_path)))
    assert got == [(i, t) for i, t in data if i in want]


def test_decontamination_removes_what_the_rule_calls_contaminated(spark, tmp_path):
    sf_dir = folder(spark, tmp_path)
    data = odd_docs.rows()
    items = [("" if i is None else i, t) for i, t in test_decontamination.benchmark_of(data)]
    bad = {r[0] for r in test_decontamination.brute_force(data, items) if r[4]}
    got = rows(stage("decontaminate")(spark, odd_docs.docs(spark, data), sf_dir))
    assert got == [(i, t) for i, t in data if i not in bad] and bad


def test_line_dedup_drops_lines_and_emptied_documents(spark, tmp_path):
    data = test_lines.corpus(5)
    struck = test_lines.with_short_lines(data, 20, 2, 1)
    want = [(i, t) for i, n, t in struck if n == 0 or (t or "").strip()]
    assert rows(stage("line_dedup")(spark, odd_docs.docs(spark, data), str(tmp_path))) == want


def test_whole_run_against_its_parts(spark, sf_dir):
    """Every document that is packed stays whole from the line dedup on, and each filter
    agrees with its operator on its own input."""
    docs = table(spark, sf_dir, "documents")
    good = {r[0] for r in queries.registered()["op8_quality_rules"](spark, sf_dir).where("kept").collect()}
    kept = stage("quality_rules")(spark, docs, sf_dir)
    assert {i for i, _ in rows(kept)} == good
    want = {(i, h) for i, _, h in test_lines.brute_force_by_counts(rows(kept))}
    import hashlib

    struck = rows(stage("line_dedup")(spark, kept, sf_dir))
    assert {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in struck} <= want
    assert len(want) - len(struck) < 40
    left = {i for i, _, c in test_minhash.brute_force(struck, 5) if i == c}
    alone = [(i, t) for i, t in struck if i in left]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    bad = {r[0] for r in test_decontamination.brute_force(alone, items) if r[4]}
    clean = {i: t for i, t in alone if i not in bad}
    packed = corpus_pipeline.run(spark, sf_dir).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
    packing.check_packing([tuple(r) for r in packed.collect()], clean, 1024)
