"""Registered queries: golden counts and agreement with their SQL oracles."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from meterwise.operators import report
from meterwise.plans import derived_trips as src
from meterwise.plans.queries import registered

sys.path.insert(0, str(Path(__file__).parent))
from check_oracle import compare, views  # noqa: E402

# Golden counts of the trips derived from events, per scale.
GOLDEN = {
    "sf0.001": dict(
        rows_in_raw=1000, n_out_of_month=33, n_temporal_invalid=11, n_duration_invalid=579,
        n_distance_invalid=40, n_fare_invalid=91, n_location_unknown=145, n_location_invalid=56,
        n_fare_per_mile_outlier=694, n_passenger_count_suspect=200, n_zero_distance_with_fare=13,
        rows_hard_flagged=713, rows_soft_only_flagged=213,
    ),
    "sf0.01": dict(
        rows_in_raw=10000, n_out_of_month=364, n_temporal_invalid=104, n_duration_invalid=5640,
        n_distance_invalid=519, n_fare_invalid=936, n_location_unknown=1449, n_location_invalid=529,
        n_fare_per_mile_outlier=7107, n_passenger_count_suspect=2000, n_zero_distance_with_fare=85,
        rows_hard_flagged=7094, rows_soft_only_flagged=2147,
    ),
    "sf0.1": dict(
        rows_in_raw=100000, n_out_of_month=3344, n_temporal_invalid=1031, n_duration_invalid=56471,
        n_distance_invalid=5140, n_fare_invalid=9230, n_location_unknown=14197, n_location_invalid=5352,
        n_fare_per_mile_outlier=70448, n_passenger_count_suspect=20000, n_zero_distance_with_fare=932,
        rows_hard_flagged=70787, rows_soft_only_flagged=21685,
    ),
}


@pytest.mark.parametrize("sf", GOLDEN)
def test_golden_counts(spark, sf):
    flagged = src.flagged_events(spark, f"/root/testdata/{sf}")
    assert report.tally(flagged).head().asDict() == GOLDEN[sf]


# Zone and hour groups, and those with fewer than ten trips.
GROUPS = {"sf0.001": (227, 227), "sf0.01": (592, 573), "sf0.1": (600, 0)}


@pytest.mark.parametrize("sf", GROUPS)
def test_golden_groups(spark, sf):
    run = contract.queries()["low_sample_groups"]
    assert tuple(run(spark, f"/root/testdata/{sf}").head()) == GROUPS[sf]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", registered())
def test_query_matches_oracle(spark, sf_dir, name):
    sql = contract.oracle_sql().get(name)
    verdict = compare(spark, views(sf_dir), sf_dir, name, sql)
    assert verdict == "ok" or (sql is None and verdict.startswith("rows")), verdict


def test_entry(spark):
    assert contract.entry(spark).count() == 113
