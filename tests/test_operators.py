"""Medians, numbering, the sliced window, profile, report and KPIs against brute force."""

import json
import math
import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterwise.errors import DuplicateKeys, EmptyInput
from meterwise.operators import median, metrics, model, profile, report, rules
from meterwise.operators.median import Median, exact_medians
from meterwise.plans.derived_trips import next_time
from meterwise.sources.guards import guard_empty
from trip_rows import at, frame, trip, zones

RNG = random.Random(7)


def _median_rows():
    rows = []
    shapes = {
        "hot": lambda: RNG.choice([0.1, 0.2, 0.3]),  # few values, many copies
        "wide": lambda: math.exp(RNG.uniform(-30, 30)) * RNG.choice([-1, 1]),
        "near": lambda: 1.0 + RNG.random() * 1e-9,
        "zero": lambda: RNG.choice([0.0, -0.0, 1e-300, -1e-300]),
        None: lambda: RNG.gauss(0, 10),
    }
    for key, draw in shapes.items():
        for i in range(RNG.choice([801, 1000])):
            x = draw()
            rows.append((key, i % 3, x, None if i % 7 == 0 else round(x, 1)))
    rows += [("one", 0, 4.5, None), ("two", 0, 1.0, 3.0), ("two", 0, 2.0, math.nan)]
    rows.append(("none", 0, None, math.nan))
    # Infinities, a burst of near-equal values with one far off, and two heavy values.
    rows += [("inf", 0, x, x) for x in (1.0, math.inf, 3.0)] + [("-inf", 0, -math.inf, 1.0)] * 3
    rows += [("burst", 0, 1.0 + i * 2**-52, 1.05) for i in range(3000)] + [("burst", 0, 1.05, None)]
    rows += [("two heavy", 0, float(i < 500), 0.5 if i == 7 else float(i % 2)) for i in range(1000)]
    return rows


# Values that a sketch keeps whole, and that a buffer may hold: none but the last, some
# groups, all groups.
SIZES = [(64, 1), (64, 50), (100, 1_000_000), (1024, 50)]


@pytest.fixture
def sketches(monkeypatch):
    def hold(size):
        monkeypatch.setattr(median, "SKETCH", size)
        monkeypatch.setattr(median, "SKETCH_WHOLE", size)

    return hold


@pytest.mark.parametrize("size, gather", SIZES)
@pytest.mark.parametrize("keys", [["k"], ["k", "h"], []])
def test_medians_are_exact(spark, sketches, size, gather, keys):
    sketches(size)
    rows = _median_rows()
    df = spark.createDataFrame(rows, "k STRING, h INT, a DOUBLE, b DOUBLE")
    expected = _expected(rows, keys, ["a", "b"])
    wanted = [Median("A", "a", tuple(keys)), Median("B", "b", tuple(keys))]
    out = exact_medians(df, wanted, gather).collect()
    assert len(out) == len(expected)
    assert {(r["name"].lower(), tuple(r[c] for c in keys)): r["median"] for r in out} == expected


def _expected(rows, keys, names):
    values = defaultdict(list)
    for row in rows:
        named = dict(zip("khab", row))
        for name in names:
            x = named[name]
            if x is not None and not math.isnan(x):
                values[name, tuple(named[c] for c in keys)].append(x)
    return {group: statistics.median(xs) for group, xs in values.items()}


@pytest.mark.parametrize("size, gather", SIZES)
def test_medians_by_different_keys(spark, sketches, size, gather):
    sketches(size)
    rows = _median_rows()
    df = spark.createDataFrame(rows, "k STRING, h INT, a DOUBLE, b DOUBLE")
    sets = {"kh": ("k", "h"), "k": ("k",), "all": ()}
    wanted = [Median(name, "a", keys) for name, keys in sets.items()]
    out = exact_medians(df, wanted, gather).collect()
    for name, keys in sets.items():
        got = {("a", tuple(r[c] for c in keys)): r["median"] for r in out if r["name"] == name}
        assert got == _expected(rows, keys, ["a"])
    assert all(r["h"] is None for r in out if r["name"] == "k")


def test_medians_of_unrelated_keys(spark, sketches):
    sketches(64)
    rows = _median_rows()
    df = spark.createDataFrame(rows, "k STRING, h INT, a DOUBLE, b DOUBLE")
    wanted = [Median("k", "a", ("k",)), Median("h", "b", ("h",)), Median("all", "b")]
    out = exact_medians(df, wanted, 30).collect()
    got = {n: {tuple(r[c] for c in keys): r["median"] for r in out if r["name"] == n} for n, keys in (("k", "k"), ("h", "h"), ("all", ""))}
    for name, column in (("k", "a"), ("h", "b"), ("all", "b")):
        keys = [] if name == "all" else [name]
        assert got[name] == {key: m for (c, key), m in _expected(rows, keys, [column]).items()}


@pytest.mark.parametrize("size", [8, 1024])
def test_a_sketch_that_is_not_full_holds_every_value(spark, sketches, size):
    """Up to its size a group is done after one read, merged or not."""
    sketches(size)
    rows = [(f"g{n}", i % 5, float(RNG.randrange(10 * n))) for n in (1, 2, size - 1, size) for i in range(n)]
    df = spark.createDataFrame(rows, "k STRING, h INT, a DOUBLE").repartition(5)
    out = exact_medians(df, [Median("k", "a", ("k",)), Median("kh", "a", ("k", "h"))], 1).collect()
    for name, keys in (("k", ["k"]), ("kh", ["k", "h"])):
        values = defaultdict(list)
        for k, h, a in rows:
            values[tuple({"k": k, "h": h}[c] for c in keys)].append(a)
        got = {tuple(r[c] for c in keys): r["median"] for r in out if r["name"] == name}
        assert got == {key: statistics.median(v) for key, v in values.items()}


def test_reads_of_the_input_for_medians(spark, tmp_path, monkeypatch):
    """One read where groups fit their sketches, two where what a sketch leaves may be
    gathered, whatever the number of groupings."""
    rows = spark.range(40_000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("h"), F.rand(3).alias("a"), F.randn(4).alias("b")
    )
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    reads = []
    narrow = median._Family.narrow
    monkeypatch.setattr(median._Family, "narrow", lambda self, open_: (reads.append(open_), narrow(self, open_)))
    wanted = [Median(f"{c}{len(by)}", c, by) for c in "ab" for by in (("k", "h"), ("k",), ())]
    exact_medians(table.limit(800), wanted)
    assert len(reads) == 0
    exact_medians(table, wanted)
    assert len(reads) == 1


def test_medians_of_nothing(spark):
    empty = spark.createDataFrame([], "k STRING, a DOUBLE")
    assert exact_medians(empty, [Median("a", "a", ("k",))]).collect() == []
    assert exact_medians(empty, [Median("a", "a")]).collect() == []


@pytest.mark.parametrize("every", ["second", "minute", "hour", "year"])
def test_next_time_with_a_hot_key(spark, every):
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else RNG.randrange(1, 40)
        rows.append((i, key, start + timedelta(seconds=RNG.randrange(5000) // 3)))
    rows += [(5000 + i, 99, start) for i in range(400)]  # a hot key without any span
    rows += [(6000 + i, 0, None) for i in range(5)] + [(7000, None, start), (7001, None, None)]
    df = spark.createDataFrame(rows, "id INT, key INT, t TIMESTAMP_NTZ")
    expected = {}
    groups = defaultdict(list)
    for i, key, t in rows:
        groups[key].append((t or datetime.min, i))
    for group in groups.values():
        group.sort()
        for (_, i), after in zip(group, [*group[1:], (None, None)]):
            expected[i] = None if after[0] == datetime.min else after[0]
    out = next_time(df, "key", "t", "id", "next", every).collect()
    assert {r["id"]: r["next"] for r in out} == expected
    assert len(out) == len(rows)


@pytest.mark.parametrize("hot", [0, 3, 40, 10**6])
def test_next_time_cuts_hot_keys_only(spark, hot):
    start = datetime(2024, 1, 1)
    rows = [(i, i % 9 if i % 2 else 0, start + timedelta(minutes=RNG.randrange(900))) for i in range(400)]
    rows += [(500 + i, k, None) for i, k in enumerate([0, 0, 1, None])]
    rows += [(600 + i, None, start + timedelta(minutes=RNG.randrange(900))) for i in range(60)]
    rows += [(700, None, None), (701, 77, None), (702, 78, start), (703, 79, start)]
    rows += rows[:50]  # copies
    df = spark.createDataFrame(rows, "id INT, key INT, t TIMESTAMP_NTZ")
    groups, expected = defaultdict(list), []
    for i, key, t in rows:
        groups[key].append((t or datetime.min, i))
    for key, group in groups.items():
        group.sort()
        for (t, i), (after, _) in zip(group, [*group[1:], (None, None)]):
            none = lambda x: None if x == datetime.min else x
            expected.append((i, key, none(t), none(after)))
    out = next_time(df, "key", "t", "id", "next", hot=hot)
    assert out.columns == ["id", "key", "t", "next"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, expected))


def test_narrowing_joins_rows_with_a_written_table_of_brackets(spark, monkeypatch):
    """Spark takes the smaller side of a join for broadcast by its estimates."""
    seen, join = [], median.same_keys_join

    def watched(left, right, keys, *more):
        if "_x0" in left.columns:
            seen.append(right._jdf.queryExecution().optimizedPlan().toString())
        return join(left, right, keys, *more)

    monkeypatch.setattr(median, "same_keys_join", watched)
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 4).alias("h"), F.rand(3).alias("a"))
    exact_medians(df, [Median("a", "a", ("k", "h")), Median("b", "a", ("k",))]).collect()
    assert seen and not any("Join" in plan for plan in seen)


def test_read_numbered_counts_copies(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") * 0).alias("v")).repartition(7).write.parquet(path)
    out = model.read_numbered(spark, path, "n")
    assert out.columns == ["n", "v"]
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 1001))


@pytest.fixture(scope="module")
def some_trips(spark):
    rows = []
    for i in range(600):
        start = at("2025-01-10 00:00:00") + timedelta(minutes=13 * i)
        rows.append(
            trip(
                id=i, pickup=start, dropoff=start + timedelta(seconds=RNG.randrange(0, 4000)),
                miles=RNG.choice([0.0, 1.25, 2.5, 7.0, 120.0]), fare=float(RNG.randrange(-5, 90)),
                pu=RNG.choice([1, 2, 3, 4, 264, 999]), do=RNG.choice([5, 6]),
                people=RNG.choice([None, 1.0, 6.0, 8.0]), pay=RNG.choice([1, 2, 3, None]),
                RatecodeID=RNG.choice([1.0, 2.0, None]),
                store_and_fwd_flag=RNG.choice(["N", "Y", None]),
            )
        )
    return rows


@pytest.fixture(scope="module")
def flagged(spark, some_trips):
    return rules.flag_rows(frame(spark, some_trips), zones(spark), "2025-01").cache()


def test_report_reconciles(flagged):
    rows = flagged.toPandas()
    hard = rows[[r.column for r in rules.TRIP_RULES if r.severity == "hard"]].any(axis=1)
    soft = rows[[r.column for r in rules.TRIP_RULES if r.severity == "soft"]].any(axis=1)
    totals = report.tally(flagged)
    counts = report.report_counts(totals).head()
    assert counts["rows_in_raw"] == len(rows) == counts["rows_hard_flagged"] + counts["rows_valid_out"]
    assert counts["rows_hard_flagged"] == hard.sum()
    assert counts["rows_soft_only_flagged"] == (soft & ~hard).sum()
    assert counts["rows_valid_pct"] == round((~hard).sum() / len(rows) * 100, 3)
    by_flag = {r["flag"]: r["n"] for r in report.flag_counts(totals).collect()}
    assert by_flag == {r.name: rows[r.column].sum() for r in rules.TRIP_RULES}
    assert list(by_flag) == [r.name for r in rules.TRIP_RULES]
    shown = report.flag_summary(totals).collect()
    assert {r["flag"] for r in shown} == {f for f, n in by_flag.items() if n}
    written = rules.drop_working_columns(flagged)
    assert report.tally_written(written).head() == totals.head()


def test_report_of_no_rows(spark):
    totals = report.tally(rules.flag_rows(frame(spark, []), zones(spark), "2025-01"))
    counts = report.report_counts(totals).head()
    assert counts["rows_in_raw"] == 0 and counts["rows_valid_pct"] == 0
    assert {r["value"] for r in metrics.scalar_kpis(totals).collect()} == {0.0}


def test_annotations(flagged):
    totals = report.tally(flagged)
    notes = report.rule_annotations(totals).collect()
    assert len(notes) == 11
    assert {n["category"] for n in notes} == {"KNOWN", "UNKNOWN", "ASSUMPTION", "LIMITATION"}
    unknown = totals.head()["n_location_unknown"]
    assert any(f"({unknown} rows)" in n["entry"] for n in notes)
    partial = report.rule_annotations(totals.drop("n_out_of_month")).collect()
    assert any(n["entry"].find("? rows are marked out_of_month") >= 0 for n in partial)


def test_profile_against_pandas(spark, some_trips):
    df = frame(spark, some_trips).drop("id")
    pdf = pd.DataFrame(some_trips).drop(columns="id")
    tall = profile.column_profile(df).withColumn("ordered", F.to_json("value_counts"))
    for row in tall.collect():
        column = pdf[row["column_name"]]
        assert row["row_count"] == len(pdf)
        assert row["null_count"] == column.isna().sum()
        assert row["null_pct"] == round(column.isna().sum() / len(pdf) * 100, 3)
        if row["column_name"].endswith("datetime"):
            assert row["min_text"] == str(column.min()) and row["max_text"] == str(column.max())
        elif pd.api.types.is_numeric_dtype(column):
            for stat in ("min", "max", "mean", "median", "std"):
                assert row[stat] == pytest.approx(getattr(column, stat)(), abs=1e-4), stat
        else:
            assert row["mean"] is None and row["min_text"] is None
        if row["column_name"] in profile.TRIP_CATEGORIES:
            expected = column.value_counts(dropna=False)
            total = {str(k): int(v) for k, v in expected.items()}
            got = {k.replace("None", "nan"): v for k, v in row["value_counts"].items()}
            if row["column_name"] != "payment_type":  # pandas turns nullable ints to float
                assert got == {k.replace("None", "nan"): v for k, v in total.items()}
            assert sorted(row["value_counts"].values()) == sorted(expected)
            ordered = json.loads(row["ordered"])
            assert list(ordered.values()) == sorted(expected, reverse=True)


def test_profile_edge_columns(spark):
    df = spark.createDataFrame(
        [(math.nan, None, "a", 5)], "x DOUBLE, y INT, s STRING, one INT"
    )
    rows = {r["column_name"]: r for r in profile.column_profile(df, ["s"]).collect()}
    assert [rows[c]["null_count"] for c in df.columns] == [1, 1, 0, 0]
    assert rows["x"]["mean"] is None and rows["y"]["median"] is None
    assert rows["one"]["median"] == 5.0 and rows["one"]["std"] is None
    assert rows["s"]["value_counts"] == {"a": 1}
    assert rows["s"]["position"] == 3 and rows["s"]["dtype"] == "string"


def test_value_counts_keep_the_top(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(1275 - 25)] + [(7,)] * 9, "v INT")
    rows = profile.value_counts(df, ["v"], top=20).collect()
    assert len(rows) == 20
    assert max(rows, key=lambda r: r["n"])["value"] == "7"
    # Ties go to the smaller text.
    assert {r["value"] for r in rows} == {"7", *sorted(str(i) for i in range(50) if i != 7)[:19]}


@pytest.fixture(scope="module")
def enriched(spark, flagged):
    fact = model.fact_trips(rules.valid_rows(flagged), carry=["id"])
    return model.enrich(fact, zones(spark)).cache()


def test_fact_columns(enriched):
    rows = enriched.toPandas()
    assert {"rate_code_id", "store_and_fwd_flag", "total_amount"} <= set(rows.columns)
    assert not {"VendorID", "Airport_fee", "RatecodeID"} & set(rows.columns)
    seconds = (rows["dropoff_at"] - rows["pickup_at"]).dt.total_seconds()
    assert (rows["duration_minutes"] - seconds / 60).abs().max() < 1e-9
    assert (rows["speed_mph"] - rows["trip_distance"] / (seconds / 3600)).abs().max() < 1e-6
    assert (rows["fare_per_mile"] - rows["fare_amount"] / rows["trip_distance"]).abs().max() < 1e-9
    assert (rows["has_soft_flag"] == (rows["validation_flags"] != "")).all()
    assert (rows["pickup_hour"] == rows["pickup_at"].dt.hour).all()


def test_zero_duration_and_distance_give_null(spark):
    row = frame(spark, [trip(dropoff=at("2025-01-08 17:15:00"), miles=0.0)])
    out = model.fact_trips(row.withColumn("validation_flags", F.lit(""))).head()
    assert out["speed_mph"] is None and out["fare_per_mile"] is None


def test_metrics_against_pandas(enriched):
    rows = enriched.toPandas()
    for r in metrics.duration_speed_by_borough_hour(enriched).collect():
        group = rows[(rows["pu_borough"] == r["pu_borough"]) & (rows["pickup_hour"] == r["pickup_hour"])]
        assert r["trip_count"] == len(group)
        assert r["median_duration_min"] == pytest.approx(group["duration_minutes"].median(), abs=0.0051)
        assert r["median_speed_mph"] == pytest.approx(group["speed_mph"].median(), abs=0.0051)
        assert r["avg_trip_distance_miles"] == pytest.approx(group["trip_distance"].mean(), abs=0.00051)
        assert r["avg_speed_mph"] == pytest.approx(group["speed_mph"].mean(), abs=0.0051)
    for r in metrics.fare_consistency(enriched).collect():
        group = rows[rows["pu_borough"] == r["pu_borough"]]
        fpm, flags = group["fare_per_mile"], group["validation_flags"]
        assert r["trip_count"] == len(group) and r["fare_trips_with_distance"] == fpm.count()
        assert r["fare_per_mile_median"] == pytest.approx(fpm.median(), abs=1e-4)
        assert r["fare_per_mile_high_2std"] == pytest.approx(fpm.mean() + 2 * fpm.std(), abs=1e-4)
        outliers = flags.str.contains("fare_per_mile_outlier").sum()
        assert r["fare_per_mile_outlier_count"] == outliers
        assert r["fare_per_mile_outlier_pct"] == pytest.approx(100 * outliers / fpm.count(), abs=1e-3)


def test_shared_statistics_show_the_same_tables(enriched):
    shared = metrics.group_statistics(enriched).cache()
    pairs = [
        (metrics.show_duration_speed(shared, metrics.BOROUGH_HOUR), metrics.duration_speed_by_borough_hour(enriched)),
        (metrics.show_duration_speed(shared, metrics.ZONE_HOUR), metrics.duration_speed_by_zone_hour(enriched)),
        (metrics.show_fare_consistency(shared), metrics.fare_consistency(enriched)),
    ]
    for shown, alone in pairs:
        assert shown.columns == alone.columns
        assert sorted(map(str, shown.collect())) == sorted(map(str, alone.collect()))


def test_null_hour_is_a_group_of_its_own(spark):
    rows = [trip(id=i, pickup=None, pu=1) for i in range(3)] + [trip(id=9, pu=1)]
    flagged = rules.flag_rows(frame(spark, rows), zones(spark), "2025-01")
    fact = model.enrich(model.fact_trips(rules.valid_rows(flagged)), zones(spark))
    out = {r["pickup_hour"]: r for r in metrics.duration_speed_by_borough_hour(fact).collect()}
    assert out[None]["trip_count"] == 3 and out[None]["median_duration_min"] is None
    assert out[trip()["tpep_pickup_datetime"].hour]["trip_count"] == 1


def test_tables_leave_out_trips_without_zone_or_borough(spark):
    schema = "pu_borough STRING, pu_zone STRING, pickup_hour INT, trip_distance DOUBLE, duration_minutes DOUBLE, speed_mph DOUBLE, fare_per_mile DOUBLE, validation_flags STRING"
    some = [("B", "Z", 1), ("B", "Z", 1), ("B", None, 1), (None, "Z", 1), (None, None, None), ("B", "Y", None)]
    rows = spark.createDataFrame([(*k, 1.0, 2.0, 3.0, 4.0, "") for k in some], schema)
    by_zone = metrics.duration_speed_by_zone_hour(rows)
    assert {(r["pu_zone"], r["pickup_hour"], r["trip_count"]) for r in by_zone.collect()} == {("Z", 1, 2), ("Y", None, 1)}
    assert tuple(metrics.low_sample_groups(by_zone, 2).head()) == (2, 1)
    assert sum(r["trip_count"] for r in metrics.duration_speed_by_borough_hour(rows).collect()) == 4
    assert [r["trip_count"] for r in metrics.fare_consistency(rows).collect()] == [4]


def test_peaks_take_the_first_of_equals(spark):
    rows = [("B", 1, 5.0, 3.0), ("A", 2, 5.0, 4.0), ("A", 1, 5.0, None), ("C", 0, None, 4.0)]
    table = spark.createDataFrame(rows, "pu_borough STRING, pickup_hour INT, median_duration_min DOUBLE, median_speed_mph DOUBLE")
    out = {r["peak"]: tuple(r)[1:] for r in metrics.peak_groups(table, ["pu_borough", "pickup_hour"]).collect()}
    assert out == {"slowest": ("A", 1, 5.0), "fastest": ("A", 2, 4.0)}


def test_low_samples(spark):
    df = spark.createDataFrame([(1, 10), (2, 9)], "k INT, trip_count BIGINT")
    assert tuple(metrics.low_sample_groups(df).head()) == (2, 1)


def test_kpi_table(flagged):
    rows = {r["metric_name"]: r for r in metrics.kpi_summary(report.tally(flagged)).collect()}
    assert len(rows) == 16
    assert rows["raw_trip_count"]["value"] == 600.0
    anomalies = rows["hard_flagged_count"]["value"] + rows["soft_only_flagged_count"]["value"]
    assert rows["anomaly_rate_pct"]["value"] == round(anomalies / 600 * 100, 3)
    limits = rules.Limits(max_minutes=90, unknown_zones=(7,))
    own = (*rules.TRIP_RULES, rules.Rule("own_rule", rules.SOFT, lambda *_: F.lit(False)))
    labelled = metrics.flag_kpis(report.tally(flagged.withColumn("flag_own_rule", F.lit(False)), own), own, limits)
    texts = {r["metric_name"]: r["description"] for r in labelled.collect()}
    assert texts["flag_count_duration_invalid"] == "Lasted under 1 or over 90 minutes"
    assert texts["flag_count_location_unknown"] == "Zone id 7, which stands for no zone"
    assert texts["flag_count_own_rule"] == "own_rule"


def test_repeated_dimension_keys(spark, flagged):
    fact = model.fact_trips(rules.valid_rows(flagged))
    repeated = zones(spark, [*range(1, 264), 1])
    copies = fact.where("pu_location_id = 1").count()
    with pytest.raises(DuplicateKeys, match="location_id"):
        model.enrich(fact, repeated)
    assert model.enrich(fact, repeated, ("pu",), "allow").count() == fact.count() + copies
    assert model.enrich(fact, repeated, ("pu",), "first").count() == fact.count()


def test_unmatched_zones(spark, flagged):
    fact = model.fact_trips(flagged)
    out = {r["location_id"]: r["trips"] for r in model.unmatched_zones(fact, zones(spark), "pu").collect()}
    ids = flagged.groupBy("PULocationID").count().collect()
    assert out == {r["PULocationID"]: r["count"] for r in ids if r["PULocationID"] in (264, 999)}


def test_guard_empty(spark):
    with pytest.raises(EmptyInput, match="trips"):
        guard_empty(spark.range(0), "trips")
    assert guard_empty(spark.range(1), "trips").count() == 1


def test_masks_say_what_the_tally_says(spark, some_trips):
    flagged = rules.flag_rows(frame(spark, some_trips), zones(spark), "2025-01").cache()
    masks = report.mask_counts(flagged)
    assert report.tally_masks(masks).head() == report.tally(flagged).head()
    assert report.tally_masks(masks.limit(0)).head()["rows_in_raw"] == 0
    names = [r.name for r in rules.TRIP_RULES]
    rows = [[n for n in names if r[f"flag_{n}"]] for r in flagged.collect()]
    got = {(r["flag"], r["other"]): (r["n"], r["only"]) for r in report.flag_overlaps(masks).collect()}
    assert len(got) == 45 and got == {
        (a, b): (sum(a in r and b in r for r in rows), sum(r == [a, b] for r in rows))
        for i, a in enumerate(names) for b in names[i + 1:]
    }
