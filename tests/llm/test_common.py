import glob
import time

import numpy as np

from meterwise.llm import bloom, common, quality


def shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirs() for f in glob.glob(f"{d.getPath()}/**/shuffle_*", recursive=True)}


def test_written_tables_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(common.FREE_SHUFFLES)
    counts = spark.range(1000).selectExpr("id % 10 AS k", "id").groupBy("k").count()
    bits = bloom.bloom(counts.select("k"))
    assert bloom.maybe(bits.value, np.arange(10)).all()
    table = common.written(counts.join(counts.withColumnRenamed("count", "n").hint("merge"), "k"), "counts")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(common.FREE_SHUFFLES) == setting
    assert sorted(map(tuple, table.collect())) == [(k, 100, 100) for k in range(10)]


def test_a_large_object_makes_way_with_all_else(monkeypatch):
    monkeypatch.setattr(common.sys, "_llm_worker_state", {}, raising=False)
    known = common.word_hashes()
    known[b"a"]
    first = common.worker_large("first", lambda: [1])
    assert common.worker_large("first", lambda: [2]) is first
    assert common.worker_large("second", lambda: [3]) == [3]
    assert common.word_hashes() is not known and not common.word_hashes()
    assert common.worker_large("first", lambda: [4]) == [4]
    common.worker_alone("a stage")
    assert common.worker_state("large", dict) == {"a stage": None}


def test_ngrams_of_many_texts_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 9, n).astype(np.uint64) for n in (0, 1, 5, 0, 40, 2, 0, 7, 300, 0)]
    for at_a_time in (1, 20, 10_000):
        monkeypatch.setattr(quality, "LOOKED_UP", at_a_time)
        found = {}
        for first, sizes, grams, owner in quality.sorted_ngrams(texts):
            assert (np.diff(grams) >= 0).all()
            for t in range(len(sizes)):
                found[first + t] = (int(sizes[t]), grams[owner == t].tolist())
        assert found == {
            i: (len(g), sorted(g.tolist())) for i, t in enumerate(texts) for g in [quality.ngrams(t)]
        }
