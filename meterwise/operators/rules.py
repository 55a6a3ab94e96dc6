"""Row validation: an ordered registry of hard and soft rules over trip columns.

A rule is a predicate column. All rules of a set are evaluated in one projection;
the only joins are the two lookups of zone ids. Hard rules exclude a row, soft rules
mark it and keep it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.errors import SchemaDrift
from meterwise.functions.exprs import is_true, minutes_between, month_bounds, without_nan

HARD = "hard"
SOFT = "soft"

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
DISTANCE = "trip_distance"
FARE = "fare_amount"
PAYMENT = "payment_type"
PU_ZONE = "PULocationID"
DO_ZONE = "DOLocationID"
PASSENGERS = "passenger_count"

REQUIRED_COLUMNS = (
    PICKUP, DROPOFF, DISTANCE, FARE, PAYMENT, PU_ZONE, DO_ZONE, PASSENGERS,
)

DURATION = "_duration_minutes"
PU_KNOWN = "_pu_known"
DO_KNOWN = "_do_known"
FLAGS = "validation_flags"
NO_CODE = -1  # stands for a null payment type or location id


@dataclass(frozen=True)
class Limits:
    """The default thresholds of the trip rules."""

    min_minutes: float = 1.0
    max_minutes: float = 360.0
    max_miles: float = 100.0
    max_fare: float = 500.0
    min_fare_per_mile: float = 1.50
    max_fare_per_mile: float = 50.00
    max_passengers: float = 6.0
    paid_types: tuple[int, ...] = (1, 2)
    unknown_zones: tuple[int, ...] = (264, 265)


@dataclass(frozen=True)
class Rule:
    """A named predicate; `test(limits, start, end)` builds its column, where start
    and end are the bounds of the row's month. A published month notes name, severity and
    version: give a changed test another version."""

    name: str
    severity: str
    test: Callable[[Limits, Column, Column], Column] = field(repr=False)
    version: str = "1"

    @property
    def column(self) -> str:
        return f"flag_{self.name}"


def _code(column: str) -> Column:
    return F.coalesce(F.col(column).try_cast("int"), F.lit(NO_CODE))


def _unknown_zone(lim: Limits) -> Column:
    ids = list(lim.unknown_zones)
    return _code(PU_ZONE).isin(ids) | _code(DO_ZONE).isin(ids)


def _fare_invalid(lim: Limits) -> Column:
    fare = F.col(FARE)
    unpaid = (fare == 0) & _code(PAYMENT).isin(list(lim.paid_types))
    return (fare < 0) | (fare > lim.max_fare) | unpaid


def _fare_per_mile_outlier(lim: Limits) -> Column:
    rate = F.when(F.col(DISTANCE) > 0, F.col(FARE) / F.col(DISTANCE))
    return (rate < lim.min_fare_per_mile) | (rate > lim.max_fare_per_mile)


def _outside(value: Column, low: object, high: object) -> Column:
    return (value < low) | (value > high)


TRIP_RULES: tuple[Rule, ...] = (
    Rule("out_of_month", HARD, lambda lim, start, end: _outside(F.col(PICKUP), start, end)),
    Rule("temporal_invalid", HARD, lambda *_: F.col(DROPOFF) <= F.col(PICKUP)),
    Rule(
        "duration_invalid", HARD,
        lambda lim, *_: _outside(F.col(DURATION), lim.min_minutes, lim.max_minutes),
    ),
    Rule(
        "distance_invalid", HARD,
        lambda lim, *_: (F.col(DISTANCE) <= 0) | (F.col(DISTANCE) > lim.max_miles),
    ),
    Rule("fare_invalid", HARD, lambda lim, *_: _fare_invalid(lim)),
    Rule("location_unknown", HARD, lambda lim, *_: _unknown_zone(lim)),
    Rule(
        "location_invalid", HARD,
        lambda lim, *_: (F.col(PU_KNOWN).isNull() | F.col(DO_KNOWN).isNull())
        & ~_unknown_zone(lim),
    ),
    Rule("fare_per_mile_outlier", SOFT, lambda lim, *_: _fare_per_mile_outlier(lim)),
    Rule(
        "passenger_count_suspect", SOFT,
        lambda lim, *_: F.col(PASSENGERS) > lim.max_passengers,
    ),
    Rule(
        "zero_distance_with_fare", SOFT,
        lambda *_: (F.col(DISTANCE) == 0) & (F.col(FARE) > 0),
    ),
)


def check_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Raise SchemaDrift naming every missing column. Exact, case-sensitive names:
    Spark itself would resolve `pulocationid` too."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaDrift(f"schema drift: required columns missing: {', '.join(missing)}")


def _join_known_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Look both zone ids up; the column of a role is null where its id is not known.

    The id set is distinct, so neither join can multiply rows. No hint is given: Spark
    broadcasts the ids while they are below its threshold, and beyond it shuffles both
    sides and splits a hot zone at run time.
    """
    ids = zones.select(F.col("location_id").cast("int").alias("_id"))
    ids = ids.where(F.col("_id").isNotNull()).distinct()
    for zone, known in ((PU_ZONE, PU_KNOWN), (DO_ZONE, DO_KNOWN)):
        side = ids.withColumnRenamed("_id", known)
        trips = trips.join(side, _code(zone) == side[known], "left")
    return trips


def flag_rows(
    trips: DataFrame,
    zones: DataFrame,
    month: str | Column,
    rules: Sequence[Rule] = TRIP_RULES,
    limits: Limits = Limits(),
) -> DataFrame:
    """Add `_duration_minutes`, one `flag_<rule>` boolean per rule and the
    `validation_flags` string to every row.

    `month` is one YYYY-MM for the whole input, or a column, which flags many monthly
    files in one job.
    """
    check_columns(trips)
    month = F.lit(month) if isinstance(month, str) else month
    start, end = month_bounds(month)
    pickup, dropoff = (F.col(c).cast("timestamp_ntz") for c in (PICKUP, DROPOFF))
    trips = trips.withColumns(
        {
            **without_nan(trips),
            PICKUP: pickup,
            DROPOFF: dropoff,
            DURATION: minutes_between(pickup, dropoff),
        }
    )
    trips = _join_known_zones(trips, zones)
    trips = trips.withColumns({r.column: is_true(r.test(limits, start, end)) for r in rules})
    names = [F.when(F.col(r.column), F.lit(r.name)) for r in rules]
    return trips.withColumn(FLAGS, F.concat_ws("|", *names)).drop(PU_KNOWN, DO_KNOWN)


def any_flag(rules: Iterable[Rule], severity: str) -> Column:
    """True where at least one rule of the severity fired."""
    hit = F.lit(False)
    for rule in rules:
        if rule.severity == severity:
            hit = hit | F.col(rule.column)
    return hit


def disposition(rules: Sequence[Rule] = TRIP_RULES) -> Column:
    """`excluded` (hard flag), `flagged` (soft flags only) or `clean`."""
    return (
        F.when(any_flag(rules, HARD), "excluded")
        .when(any_flag(rules, SOFT), "flagged")
        .otherwise("clean")
    )


def drop_working_columns(flagged: DataFrame) -> DataFrame:
    work = [c for c in flagged.columns if c.startswith(("flag_", "_"))]
    return flagged.drop(*work)


def valid_rows(flagged: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """Rows without a hard flag, raw columns plus `validation_flags`."""
    return drop_working_columns(flagged.where(~any_flag(rules, HARD)))


def excluded_rows(flagged: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """The quarantine: rows with a hard flag, same columns as `valid_rows`."""
    return drop_working_columns(flagged.where(any_flag(rules, HARD)))
