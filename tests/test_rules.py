"""Each rule at its boundaries: one job over all cases."""

import math

import pytest
from pyspark.sql import functions as F

from meterwise.errors import BadMonth, SchemaDrift
from meterwise.functions.exprs import check_month
from meterwise.operators import rules
from trip_rows import at, frame, trip, zones

# (what, changes to the clean trip, names expected in validation_flags)
CASES = [
    ("clean", {}, ""),
    # month
    ("first instant", dict(pickup=at("2025-01-01 00:00:00"), dropoff=at("2025-01-01 00:30:00")), ""),
    ("last second", dict(pickup=at("2025-01-31 23:59:59"), dropoff=at("2025-02-01 00:30:00")), ""),
    ("half a second later", dict(pickup=at("2025-01-31 23:59:59.500000"), dropoff=at("2025-02-01 00:30:00")), "out_of_month"),
    ("month before", dict(pickup=at("2024-12-31 23:59:00"), dropoff=at("2025-01-01 00:30:00")), "out_of_month"),
    ("month after", dict(pickup=at("2025-02-01 00:00:01"), dropoff=at("2025-02-01 00:30:00")), "out_of_month"),
    # order of times; a duration below one minute always comes with it
    ("backwards", dict(dropoff=at("2025-01-08 16:45:00")), "temporal_invalid|duration_invalid"),
    ("no time at all", dict(dropoff=at("2025-01-08 17:15:00")), "temporal_invalid|duration_invalid"),
    # duration
    ("half a minute", dict(dropoff=at("2025-01-08 17:15:30")), "duration_invalid"),
    ("one minute", dict(dropoff=at("2025-01-08 17:16:00")), ""),
    ("six hours", dict(dropoff=at("2025-01-08 23:15:00")), ""),
    ("seven hours", dict(dropoff=at("2025-01-09 00:16:00")), "duration_invalid"),
    # distance
    ("no distance", dict(miles=0.0, fare=0.0, pay=3), "distance_invalid"),
    ("negative distance", dict(miles=-1.0), "distance_invalid"),
    ("hundred miles", dict(miles=100.0, fare=300.0), ""),
    ("more miles", dict(miles=101.0, fare=300.0), "distance_invalid"),
    # fare
    ("negative fare", dict(fare=-5.0), "fare_invalid|fare_per_mile_outlier"),
    ("free by card", dict(fare=0.0, pay=1), "fare_invalid|fare_per_mile_outlier"),
    ("free by cash", dict(fare=0.0, pay=2), "fare_invalid|fare_per_mile_outlier"),
    ("no charge", dict(fare=0.0, pay=3), "fare_per_mile_outlier"),
    ("voided", dict(fare=0.0, pay=6), "fare_per_mile_outlier"),
    ("free, payment unknown", dict(fare=0.0, pay=None), "fare_per_mile_outlier"),
    ("free, payment code 0", dict(fare=0.0, pay=0), "fare_per_mile_outlier"),
    ("500 dollars", dict(fare=500.0, miles=50.0), ""),
    ("501 dollars", dict(fare=501.0, miles=50.0), "fare_invalid"),
    # places
    ("unknown pickup", dict(pu=264), "location_unknown"),
    ("unknown dropoff", dict(do=265), "location_unknown"),
    ("no such pickup", dict(pu=999), "location_invalid"),
    ("no such dropoff", dict(do=0), "location_invalid"),
    ("unknown wins over no such", dict(pu=264, do=999), "location_unknown"),
    ("null pickup", dict(pu=None), "location_invalid"),
    # fare per mile: bounds are inside
    ("1.50 a mile", dict(miles=10.0, fare=15.0), ""),
    ("1 a mile", dict(miles=10.0, fare=10.0), "fare_per_mile_outlier"),
    ("50 a mile", dict(miles=0.5, fare=25.0), ""),
    ("60 a mile", dict(miles=0.5, fare=30.0), "fare_per_mile_outlier"),
    # people
    ("six people", dict(people=6.0), ""),
    ("seven people", dict(people=7.0), "passenger_count_suspect"),
    ("people unknown", dict(people=None), ""),
    # paid without moving; never a rate outlier
    ("paid standing", dict(miles=0.0, fare=5.0), "distance_invalid|zero_distance_with_fare"),
    # nulls break no comparison; NaN is a null
    ("null dropoff", dict(dropoff=None), ""),
    ("null pickup time", dict(pickup=None), ""),
    ("null distance", dict(miles=None), ""),
    ("null fare", dict(fare=None), ""),
    ("NaN distance", dict(miles=math.nan), ""),
    ("NaN people", dict(people=math.nan), ""),
    # several at once, in registry order
    ("two rules", dict(pickup=at("2024-12-31 10:00:00"), dropoff=at("2024-12-31 10:30:00"), fare=-10.0),
     "out_of_month|fare_invalid|fare_per_mile_outlier"),
]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [trip(id=i, **changes) for i, (_, changes, _) in enumerate(CASES)]
    return rules.flag_rows(frame(spark, rows), zones(spark), "2025-01").cache()


@pytest.fixture(scope="module")
def by_case(flagged):
    return {CASES[r["id"]][0]: r for r in flagged.collect()}


@pytest.mark.parametrize("what,_changes,expected", CASES, ids=[c[0] for c in CASES])
def test_flag_string(by_case, what, _changes, expected):
    row = by_case[what]
    assert row["validation_flags"] == expected
    raised = {n for n in expected.split("|") if n}
    assert {r.name for r in rules.TRIP_RULES if row[r.column]} == raised
    assert all(row[r.column] is not None for r in rules.TRIP_RULES)


def test_null_dropoff_has_no_duration(by_case):
    assert by_case["null dropoff"]["_duration_minutes"] is None
    assert by_case["half a minute"]["_duration_minutes"] == 0.5


def test_split_is_complete(flagged):
    valid, excluded = rules.valid_rows(flagged), rules.excluded_rows(flagged)
    assert valid.count() + excluded.count() == len(CASES)
    assert not [c for c in valid.columns if c.startswith(("flag_", "_"))]
    assert "validation_flags" in valid.columns and "Airport_fee" in valid.columns
    names = valid.select(F.explode(F.split("validation_flags", r"\|")).alias("f")).distinct()
    # The zero-distance rule implies a hard one, so it cannot survive.
    assert {r["f"] for r in names.collect()} <= {"", "fare_per_mile_outlier", "passenger_count_suspect"}


def test_december_rolls_the_year(spark):
    rows = [
        trip(id=0, pickup=at("2024-12-31 23:59:59"), dropoff=at("2025-01-01 00:20:00")),
        trip(id=1, pickup=at("2025-01-01 00:00:00"), dropoff=at("2025-01-01 00:20:00")),
    ]
    out = rules.flag_rows(frame(spark, rows), zones(spark), "2024-12").collect()
    assert {r["id"]: r["flag_out_of_month"] for r in out} == {0: False, 1: True}


def test_month_column_serves_many_months(spark):
    rows = [trip(id=i) for i in range(2)]
    month = F.when(F.col("id") == 0, "2025-01").otherwise("2025-02")
    out = rules.flag_rows(frame(spark, rows), zones(spark), month).collect()
    assert {r["id"]: r["flag_out_of_month"] for r in out} == {0: False, 1: True}


def test_repeated_zone_ids_do_not_multiply_rows(spark):
    ids = [*range(1, 264), 48, 48, 79]
    out = rules.flag_rows(frame(spark, [trip()]), zones(spark, ids), "2025-01")
    assert out.count() == 1


def test_own_rules_and_limits(spark):
    extra = rules.Rule("big_tip", rules.SOFT, lambda *_: F.col("tip_amount") > 2)
    rows = frame(spark, [trip(people=5.0)])
    out = rules.flag_rows(
        rows, zones(spark), "2025-01", [*rules.TRIP_RULES, extra],
        rules.Limits(max_passengers=4, unknown_zones=(79,)),
    ).head()
    assert out["validation_flags"] == "location_unknown|passenger_count_suspect|big_tip"


def test_schema_drift_names_columns_case_sensitively(spark):
    broken = frame(spark, [trip()]).withColumnRenamed("PULocationID", "pulocationid").drop("fare_amount")
    with pytest.raises(SchemaDrift, match="PULocationID, fare_amount"):
        rules.flag_rows(broken, zones(spark), "2025-01")


@pytest.mark.parametrize("month", ["2025-01", "2024-12", "1999-10"])
def test_good_month(month):
    assert check_month(month) == month


@pytest.mark.parametrize(
    "month", ["2025-13", "2025-00", "2025-1", "25-01", "2025/01", "january", "", "2025-01-01", " 2025-01", "2025-01\n", None]
)
def test_bad_month(month):
    with pytest.raises(BadMonth):
        check_month(month)
