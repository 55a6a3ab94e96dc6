"""States kept beside a table stand for its first read."""

import statistics
from collections import defaultdict

from pyspark.sql import functions as F

from meterwise.operators import median
from meterwise.operators.median import Median, exact_medians, sketch_columns


def test_medians_from_states_of_parts(spark, monkeypatch):
    monkeypatch.setattr(median, "SKETCH", 64)
    rows = spark.range(3000).select(
        (F.col("id") % 5).cast("string").alias("k"), (F.col("id") % 40).alias("h"),
        (F.col("id") % 3).alias("part"), F.round(F.rand(5) * 50).alias("x"),
    ).cache()
    states = rows.groupBy("part", "k", "h").agg(*sketch_columns(["x"]))
    wanted = [Median("fine", "x", ("k", "h")), Median("coarse", "x", ("k",))]
    # Groups by k and h fit their sketches, those by k need the rows.
    got = exact_medians(rows, wanted, 10, states).collect()
    for name, keys in (("fine", ["k", "h"]), ("coarse", ["k"])):
        values = defaultdict(list)
        for r in rows.collect():
            values[tuple(r[c] for c in keys)].append(r["x"])
        assert {tuple(r[c] for c in keys): r["median"] for r in got if r["name"] == name} == {
            key: statistics.median(v) for key, v in values.items()
        }
