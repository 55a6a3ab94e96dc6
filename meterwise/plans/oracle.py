"""Standard SQL for each registered query, to be run by DuckDB on the same tables."""

from __future__ import annotations

from meterwise.operators.rules import HARD, SOFT, TRIP_RULES, Rule
from meterwise.plans.derived_trips import ORDER_RULES

_RULES = [r.name for r in TRIP_RULES]
_TRIP_COLUMNS = (
    "event_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
)

ZONES = """
zones AS (
  SELECT n_nationkey AS location_id, n_name AS zone_name, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

REPEATED = """
repeated AS (
  SELECT * FROM zones UNION ALL SELECT * FROM zones WHERE location_id IN (3, 7)
)"""

TRIPS = """
trips AS (
  SELECT event_id,
    ts - INTERVAL 1 DAY AS tpep_pickup_datetime,
    CASE WHEN event_id % 97 = 0 THEN ts - INTERVAL 1 DAY - INTERVAL 10 MINUTE
         ELSE lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - INTERVAL 1 DAY
    END AS tpep_dropoff_datetime,
    CASE WHEN event_id % 10 = 9 THEN NULL ELSE CAST(event_id % 10 AS DOUBLE) END
      AS passenger_count,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) * CAST(1.05 AS DOUBLE) AS trip_distance,
    CAST((user_id * 3 + event_id) % 28 AS INTEGER) AS PULocationID,
    CAST((event_id * 5 + user_id) % 28 AS INTEGER) AS DOLocationID,
    CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
         WHEN 'signup' THEN 6 END AS DOUBLE) AS payment_type,
    CASE WHEN event_id % 50 = 0 THEN CAST(0 AS DOUBLE)
         ELSE value * CAST(1.1 AS DOUBLE) - CAST(5 AS DOUBLE) END AS fare_amount
  FROM events
)"""

ORDER_TRIPS = """
trips AS (
  SELECT o_orderdate AS tpep_pickup_datetime, l_shipdate AS tpep_dropoff_datetime,
    CAST(l_linenumber % 8 AS DOUBLE) AS passenger_count, l_quantity AS trip_distance,
    s_nationkey AS PULocationID, c_nationkey AS DOLocationID,
    CAST(1 AS DOUBLE) AS payment_type, l_extendedprice AS fare_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
)"""

DURATION = """
timed AS (
  SELECT *, date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 6e7
    AS duration_minutes
  FROM trips
)"""


def _flags(
    rules: tuple[Rule, ...], unknown: str, minutes: str, miles: str, fare: str, rate: str
) -> str:
    tests = {
        "out_of_month": "tpep_pickup_datetime < TIMESTAMP '2024-01-01 00:00:00' "
        "OR tpep_pickup_datetime > TIMESTAMP '2024-01-31 23:59:59'",
        "temporal_invalid": "tpep_pickup_datetime >= tpep_dropoff_datetime",
        "duration_invalid": f"duration_minutes NOT BETWEEN {minutes}",
        "distance_invalid": f"trip_distance <= 0 OR trip_distance > {miles}",
        "fare_invalid": "fare_amount < 0 OR (fare_amount = 0 AND coalesce(payment_type, -1) "
        f"IN (1, 2)) OR fare_amount > {fare}",
        "location_unknown": f"PULocationID IN ({unknown}) OR DOLocationID IN ({unknown})",
        "location_invalid": f"NOT (PULocationID IN ({unknown}) OR DOLocationID IN ({unknown})) "
        "AND (PULocationID NOT IN (SELECT location_id FROM zones) "
        "OR DOLocationID NOT IN (SELECT location_id FROM zones))",
        "fare_per_mile_outlier": "trip_distance > 0 AND "
        f"fare_amount / nullif(trip_distance, 0) NOT BETWEEN {rate}",
        "passenger_count_suspect": "passenger_count > 6",
        "zero_distance_with_fare": "trip_distance = 0 AND fare_amount > 0",
    }
    columns = ",\n    ".join(
        f"coalesce({tests[r.name]}, FALSE) AS flag_{r.name}" for r in rules
    )
    names = ", ".join(f"CASE WHEN flag_{r.name} THEN '{r.name}' END" for r in rules)
    any_of = {
        s: " OR ".join(f"flag_{r.name}" for r in rules if r.severity == s) for s in (HARD, SOFT)
    }
    return f"""
raised AS (
  SELECT *,
    {columns}
  FROM timed
),
flags AS (
  SELECT *, concat_ws('|', {names}) AS validation_flags,
    ({any_of[HARD]}) AS hard, ({any_of[SOFT]}) AS soft
  FROM raised
)"""


FACT = """
fact AS (
  SELECT *, CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    trip_distance / nullif(duration_minutes / 60, 0) AS speed_mph,
    fare_amount / nullif(trip_distance, 0) AS fare_per_mile
  FROM flags WHERE NOT hard
),
enriched AS (
  SELECT f.*, pu.zone_name AS pu_zone, pu.borough AS pu_borough,
    do_.zone_name AS do_zone, do_.borough AS do_borough
  FROM fact f LEFT JOIN zones pu ON f.PULocationID = pu.location_id
  LEFT JOIN zones do_ ON f.DOLocationID = do_.location_id
)"""


# What the labels must read under the limits of the derived trips.
_LABELS = {
    "out_of_month": "Picked up outside the month of the file",
    "temporal_invalid": "Dropped off at or before the pickup",
    "duration_invalid": "Lasted under 1 or over 360 minutes",
    "distance_invalid": "No distance, or over 100 miles",
    "fare_invalid": "Negative fare, none for payment type 1, 2, or over 500 dollars",
    "location_unknown": "Zone id 25, 26, which stands for no zone",
    "location_invalid": "Zone id that the zone table lacks",
    "fare_per_mile_outlier": "Fare per mile under 1.5 or over 50 dollars (kept)",
    "passenger_count_suspect": "More than 6 passengers (kept)",
    "zero_distance_with_fare": "A fare without a distance (kept, unless another rule excludes it)",
}


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_EVENT_FLAGS = _flags(
    TRIP_RULES, "25, 26", "1 AND 360", "100", "500", "1.5 AND 50"
)
_ORDER_FLAGS = _flags(
    ORDER_RULES, "24", "1440 AND 1440 * 365", "45", "90000", "1000 AND 2000"
)
TRIP = _with(TRIPS)
FLAG = _with(ZONES, TRIPS, DURATION, _EVENT_FLAGS)
MODEL = _with(ZONES, TRIPS, DURATION, _EVENT_FLAGS, FACT)
ORDER_FLAG = _with(ZONES, ORDER_TRIPS, DURATION, _ORDER_FLAGS)
ORDER_MODEL = _with(ZONES, ORDER_TRIPS, DURATION, _ORDER_FLAGS, FACT)

_COUNTS = """
  count(*) AS raw, count(*) FILTER (hard) AS hard_n,
  count(*) FILTER (soft AND NOT hard) AS soft_n"""

_REPORT_COUNTS = f"""
SELECT raw AS rows_in_raw, hard_n AS rows_hard_flagged,
  round(100.0::DOUBLE * hard_n / raw, 3) AS rows_hard_flagged_pct,
  soft_n AS rows_soft_only_flagged,
  round(100.0::DOUBLE * soft_n / raw, 3) AS rows_soft_only_flagged_pct,
  raw - hard_n AS rows_valid_out,
  round(100.0::DOUBLE * (raw - hard_n) / raw, 3) AS rows_valid_pct
FROM (SELECT {_COUNTS} FROM flags)"""


def _flag_counts(rules: tuple[Rule, ...] = TRIP_RULES) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{r.name}' AS flag, '{r.severity}' AS severity, {i} AS position, "
        f"count(*) FILTER (flag_{r.name}) AS n, count(*) AS raw FROM flags"
        for i, r in enumerate(rules, 1)
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Name, component, unit, value and text of the scalar KPIs.
_SCALAR_KPIS = (
    ("data_reliability_pct", "M1_reliability", "%", "round(100.0::DOUBLE * (raw - hard_n) / raw, 3)",
     "Share of the raw rows that no hard rule excludes"),
    ("valid_trip_count", "M1_reliability", "trips", "raw - hard_n", "Rows that the KPI tables are made of"),
    ("raw_trip_count", "M1_reliability", "trips", "raw", "Rows of the landed files, before any rule"),
    ("anomaly_rate_pct", "M5_anomaly", "%", "round(100.0::DOUBLE * (hard_n + soft_n) / raw, 3)",
     "Share of the raw rows with a flag, hard or soft"),
    ("hard_flagged_count", "M5_anomaly", "trips", "hard_n",
     "Rows that a hard rule keeps out of the KPI tables"),
    ("soft_only_flagged_count", "M5_anomaly", "trips", "soft_n",
     "Rows that are kept although a soft rule marks them"),
)


def _scalar_kpis(component: str | None = None) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric_name, '{kpi}' AS kpi_component, 'MONTH' AS \"group\", "
        f"CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, "
        f"{_quoted(text)} AS description FROM (SELECT {_COUNTS} FROM flags)"
        for name, kpi, unit, value, text in _SCALAR_KPIS
        if component in (None, kpi)
    )


def _flag_kpis() -> str:
    labels = " ".join(f"WHEN '{flag}' THEN {_quoted(t)}" for flag, t in _LABELS.items())
    return (
        "SELECT 'flag_count_' || flag AS metric_name, 'M5_anomaly' AS kpi_component, "
        "'FLAG' AS \"group\", CAST(n AS DOUBLE) AS value, 'trips' AS unit, "
        f"CASE flag {labels} ELSE flag END AS description FROM ({_flag_counts()})"
    )


# What the annotations must read under those limits; %s is the count of the flag.
_ANNOTATIONS = (
    ("KNOWN", "out_of_month",
     "Monthly files hold some trips picked up in a neighbouring month, because the"
     " publisher cuts batches late. %s rows are marked out_of_month; they leave "
     "the metrics but stay in these counts."),
    ("KNOWN", None,
     "passenger_count may be null: vendors need not fill it. A null is counted in "
     "the profile and breaks no rule."),
    ("KNOWN", "location_unknown",
     "Zone ids 25 and 26 are documented placeholders without a lookup entry. They "
     "are marked location_unknown (%s rows), apart from location_invalid, which "
     "means an id nobody documents."),
    ('ASSUMPTION', None,
     "A trip takes at most 360 minutes. No published limit exists; longer ones are"
     " most likely meters left running."),
    ('ASSUMPTION', None,
     "A trip covers at most 100 miles. No published limit exists; the metered "
     "service area fits well inside it."),
    ('ASSUMPTION', None,
     "A fare is at most 500 dollars: the metered rate over the longest allowed "
     "distance plus tolls stays below. No published limit exists."),
    ('ASSUMPTION', None,
     "A plausible fare per mile lies in 1.5 to 50 dollars. Set from the rate card,"
     " not from a model of the data; recalibrate with more months."),
    ('UNKNOWN', None,
     "Negative fares may be refunds, disputes or corruption; the data dictionary "
     "does not say. All are marked fare_invalid and excluded."),
    ('UNKNOWN', None,
     "Published files may be corrected later. The manifest keeps load time and "
     "SHA-256 of each file, so a silent change shows."),
    ('LIMITATION', None,
     "Trips carry zone ids, no coordinates. Nothing below a zone can be observed."),
    ('LIMITATION', None,
     "tip_amount holds card tips only. Fare consistency therefore uses "
     "fare_amount, not total_amount."),
)


def _annotations() -> str:
    rows = []
    for i, (category, flag, text) in enumerate(_ANNOTATIONS, 1):
        entry = _quoted(text)
        if flag is not None:
            entry = f"replace({entry}, '%s', CAST(count(*) FILTER (flag_{flag}) AS VARCHAR))"
            rows.append(f"SELECT {i} AS position, '{category}' AS category, {entry} AS entry "
                        "FROM flags")
        else:
            rows.append(f"SELECT {i} AS position, '{category}' AS category, {entry} AS entry")
    return "\nUNION ALL ".join(rows)


def _stamp(value: str) -> str:
    return (
        f"CASE WHEN date_trunc('second', {value}) = {value} "
        f"THEN strftime({value}, '%Y-%m-%d %H:%M:%S') "
        f"ELSE strftime({value}, '%Y-%m-%d %H:%M:%S.%f') END"
    )


def _numeric(source: str, columns: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, round(CAST(min({c}) AS DOUBLE), 4) AS \"min\", "
        f"round(CAST(max({c}) AS DOUBLE), 4) AS \"max\", round(round(avg({c}), 9), 4) AS \"mean\", "
        f"round(CAST(median({c}) AS DOUBLE), 4) AS \"median\", "
        f"round(round(stddev_samp({c}), 9), 4) AS \"std\" FROM {source}"
        for name, c in columns.items()
    )


def _numeric_of(source: str, *columns: str) -> str:
    return _numeric(source, {c: c for c in columns})


def _counts(source: str, columns: tuple[str, ...]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"CASE WHEN count(*) > 0 THEN round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 3) "
        f"ELSE 0.0 END AS null_pct FROM {source}"
        for c in columns
    )


def _temporal(source: str, *columns: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_stamp(f'min({c})')} AS min_text, "
        f"{_stamp(f'max({c})')} AS max_text FROM {source}"
        for c in columns
    )


def _top_values(source: str, columns: dict[str, str]) -> str:
    union = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), '{missing}') AS value "
        f"FROM {source}"
        for c, missing in columns.items()
    )
    return f"""
SELECT column_name, value, n FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place
  FROM (SELECT column_name, value, count(*) AS n FROM ({union}) GROUP BY ALL)
) WHERE place <= 20"""


def _profile(source: str, dtypes: dict[str, str], numeric: str, temporal: str, extra: str = "") -> str:
    schema = ", ".join(
        f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(dtypes.items(), 1)
    )
    return f"""
SELECT position, column_name, dtype, row_count, null_count, null_pct,
  "min", "max", "mean", "median", "std", min_text, max_text{extra}
FROM (VALUES {schema}) s(position, column_name, dtype)
JOIN ({_counts(source, tuple(dtypes))}) USING (column_name)
LEFT JOIN ({numeric}) USING (column_name)
LEFT JOIN ({temporal}) USING (column_name)"""


_TRIP_NUMBERS = (
    "event_id", "passenger_count", "trip_distance", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount",
)
_TRIP_TIMES = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
_TRIP_TYPES = {
    "event_id": "bigint", "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz", "passenger_count": "double",
    "trip_distance": "double", "PULocationID": "int", "DOLocationID": "int",
    "payment_type": "double", "fare_amount": "double",
}
_ORDER_TYPES = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
_CUSTOMER_TYPES = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
    "c_mktsegment": "string",
}

_DURATION_SPEED = """
  count(*) AS trip_count,
  round(median(duration_minutes), 2) AS median_duration_min,
  round(median(speed_mph), 2) AS median_speed_mph,
  round(round(avg(trip_distance), 9), 3) AS avg_trip_distance_miles"""

_BOROUGH_HOUR = f"""
SELECT pu_borough, pickup_hour, {_DURATION_SPEED},
  round(round(avg(duration_minutes), 9), 2) AS avg_duration_min, round(round(avg(speed_mph), 9), 2) AS avg_speed_mph
FROM enriched WHERE pu_borough IS NOT NULL GROUP BY pu_borough, pickup_hour"""

_FARE = """
SELECT pu_borough, count(*) AS trip_count, count(fare_per_mile) AS fare_trips_with_distance,
  round(round(avg(fare_per_mile), 9), 4) AS fare_per_mile_mean,
  round(round(stddev_samp(fare_per_mile), 9), 4) AS fare_per_mile_std,
  round(min(fare_per_mile), 4) AS fare_per_mile_min,
  round(max(fare_per_mile), 4) AS fare_per_mile_max,
  round(median(fare_per_mile), 4) AS fare_per_mile_median,
  round(round(avg(fare_per_mile) - 2 * stddev_samp(fare_per_mile), 9), 4) AS fare_per_mile_low_2std,
  round(round(avg(fare_per_mile) + 2 * stddev_samp(fare_per_mile), 9), 4) AS fare_per_mile_high_2std,
  count(*) FILTER (contains(validation_flags, 'fare_per_mile_outlier'))
    AS fare_per_mile_outlier_count,
  round(100.0::DOUBLE * count(*) FILTER (contains(validation_flags, 'fare_per_mile_outlier'))
    / nullif(count(fare_per_mile), 0), 3) AS fare_per_mile_outlier_pct
FROM enriched WHERE pu_borough IS NOT NULL GROUP BY pu_borough"""

_TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
    "labels": 3, "conversations": 4,
}
_TIMES = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate"}


def _fact_columns() -> str:
    return """
SELECT event_id, tpep_pickup_datetime AS pickup_at, PULocationID AS pu_location_id,
  pickup_hour, strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date,
  tpep_dropoff_datetime AS dropoff_at, DOLocationID AS do_location_id, duration_minutes,
  trip_distance, speed_mph, payment_type, fare_amount, fare_per_mile, passenger_count,
  validation_flags, validation_flags <> '' AS has_soft_flag
FROM fact"""


def statements() -> dict[str, str]:
    trip_columns = ", ".join(_TRIP_COLUMNS)
    flag_columns = ", ".join(f"flag_{r}" for r in _RULES)
    zones = _with(ZONES)
    numbers = _numeric_of("trips", *_TRIP_NUMBERS)
    times = _temporal("trips", *_TRIP_TIMES)
    out = {
        "scan_trips": TRIP + """
SELECT *, CASE WHEN event_id % 2 = 1 THEN event_id * CAST(0.25 AS DOUBLE) END AS surcharge FROM trips""",
        "manifest": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS entry, 'S1' AS source, 'bulk_parquet' AS retrieval_mode, "
            f"'driver tables' AS description, '{t}.parquet' AS filename, "
            f"(SELECT count(*) FROM {t}) AS row_count, "
            f"(SELECT string_agg(column_name, ',') FROM (DESCRIBE {t})) AS columns, "
            + (
                f"(SELECT {_stamp(f'min({_TIMES[t]})')} FROM {t}) AS pickup_date_min, "
                f"(SELECT {_stamp(f'max({_TIMES[t]})')} FROM {t}) AS pickup_date_max, "
                if t in _TIMES else "NULL::VARCHAR AS pickup_date_min, NULL::VARCHAR AS pickup_date_max, "
            )
            + "TRUE AS has_checksum, TRUE AS has_rows"
            for t in _TABLES
        ),
        "incremental_files": "SELECT entry || '.parquet' AS entry, decision FROM (VALUES "
        "('events', 'new'), ('region', 'new'), ('orders', 'changed'), ('gone', 'missing'), "
        + ", ".join(
            f"('{t}', 'unchanged')" for t in _TABLES if t not in ("events", "region", "orders")
        ) + ") d(entry, decision)",
        "rejected_files": "SELECT 'broken.parquet' AS entry, TRUE AS rejected, CAST(0 AS BIGINT) "
        "AS row_count" + "".join(
            f" UNION ALL SELECT '{t}.parquet', FALSE, count(*) FROM {t}" for t in _TABLES
        ),
        "output_inventory": "SELECT output, output <> 'absent.parquet' AS present, "
        "CASE WHEN output <> 'absent.parquet' THEN TRUE END AS has_bytes FROM (VALUES "
        + ", ".join(f"('{t}.parquet')" for t in (*_TABLES, "absent")) + ") o(output)",
        "manifest_counts": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS filename, count(*) AS row_count, "
            f"CAST({n} AS BIGINT) AS n_columns FROM {t}"
            for t, n in _TABLES.items()
        ),
        "source_coverage": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, {_stamp(f'min({_TIMES[t]})')} AS range_min, "
            f"{_stamp(f'max({_TIMES[t]})')} AS range_max FROM {t}"
            if t in _TIMES
            else f"SELECT '{t}.parquet', NULL, NULL"
            for t in ["events", *[t for t in _TABLES if t != "events"]]
        ),
        "dim_zones": zones + "SELECT * FROM zones",
        "dim_zones_csv": zones + "SELECT * FROM zones",
        "dim_zones_json": zones + "SELECT * FROM zones",
        "zone_source_mode": zones + "SELECT *, 'csv_fallback' AS zone_lookup_mode FROM zones",
        "zone_manifest": zones + """SELECT 'S3' AS source, 'csv_fallback' AS retrieval_mode,
  count(*) AS row_count, 'LocationID,Borough,Zone' AS columns FROM zones""",
        "profile_counts": TRIP + _counts("trips", _TRIP_COLUMNS),
        "profile_schema": """
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
  CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS dtype
FROM (DESCRIBE """ + TRIP + """SELECT * FROM trips)""",
        "profile_temporal": TRIP + times,
        "profile_numeric": TRIP + numbers,
        "profile_lineitem": _numeric_of(
            "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax",
        ),
        "profile_orders": _profile(
            "orders", _ORDER_TYPES,
            _numeric_of("orders", "o_orderkey", "o_custkey", "o_totalprice"),
            _temporal("orders", "o_orderdate"),
        ),
        "profile_customer": _profile(
            "customer", _CUSTOMER_TYPES,
            _numeric_of("customer", "c_custkey", "c_nationkey", "c_acctbal"),
            "SELECT NULL::VARCHAR AS column_name, NULL::VARCHAR AS min_text, "
            "NULL::VARCHAR AS max_text",
        ),
        "profile": TRIP + _profile(
            "trips", _TRIP_TYPES, numbers, times,
            extra=""", CASE WHEN column_name = 'payment_type' THEN (
              SELECT '{' || string_agg('"' || value || '":' || n, ',' ORDER BY n DESC, value) || '}'
              FROM (SELECT coalesce(CAST(payment_type AS VARCHAR), 'nan') AS value, count(*) AS n
                    FROM trips GROUP BY ALL)) END AS value_counts""",
        ),
        "value_counts_topk": TRIP + _top_values(
            "trips", {"payment_type": "nan", "passenger_count": "nan", "PULocationID": "nan"}
        ),
        "value_counts_part": _top_values(
            "part", {"p_brand": "None", "p_type": "None", "p_size": "nan"}
        ),
        "month_bounds": """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month,
  date_trunc('month', o_orderdate)::TIMESTAMP AS month_start,
  (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 SECOND)::TIMESTAMP AS month_end
FROM orders""",
        "trip_duration": FLAG + "SELECT event_id, duration_minutes FROM flags",
        "flag_rows": FLAG + f"SELECT event_id, {flag_columns}, validation_flags FROM flags",
        "row_disposition": FLAG + """
SELECT event_id, CASE WHEN hard THEN 'excluded' WHEN soft THEN 'flagged' ELSE 'clean' END
  AS disposition FROM flags""",
        "validated_trips": FLAG
        + f"SELECT {trip_columns}, validation_flags FROM flags WHERE NOT hard",
        "excluded_trips": FLAG + f"SELECT {trip_columns}, validation_flags FROM flags WHERE hard",
        "report_counts": FLAG + _REPORT_COUNTS,
        "flag_counts": FLAG + f"SELECT flag, n FROM ({_flag_counts()})",
        "flag_summary": FLAG + f"""
SELECT flag, severity, n, round(100.0::DOUBLE * n / raw, 3) AS pct_of_raw
FROM ({_flag_counts()}) WHERE n > 0""",
        "rule_annotations": FLAG + _annotations(),
        "report_document": FLAG + "SELECT " + ", ".join(
            [
                "CAST(count(*) AS DOUBLE) AS counts_rows_in_raw",
                "CAST(count(*) FILTER (hard) AS DOUBLE) AS counts_rows_hard_flagged",
                "CAST(count(*) FILTER (NOT hard) AS DOUBLE) AS counts_rows_valid_out",
                *[f"CAST(count(*) FILTER (flag_{r}) AS DOUBLE) AS flag_counts_{r}"
                  for r in _RULES],
                "CAST(count(*) - count(passenger_count) AS DOUBLE) "
                "AS profile_passenger_count_null_count",
                "round(median(fare_amount), 4) AS profile_fare_amount_median",
                f"CAST({len(_ANNOTATIONS)} AS BIGINT) AS annotations",
            ]
        ) + " FROM flags",
        "fact_trips": MODEL + _fact_columns(),
        "enriched": MODEL
        + "SELECT event_id, pu_zone, pu_borough, do_zone, do_borough FROM enriched",
        "enriched_fanout": _with(ZONES, REPEATED, TRIPS, DURATION, _EVENT_FLAGS, FACT) + """
SELECT pu.borough AS pu_borough, count(*) AS trips
FROM fact f LEFT JOIN repeated pu ON f.PULocationID = pu.location_id
LEFT JOIN repeated do_ ON f.DOLocationID = do_.location_id GROUP BY pu.borough""",
        "enriched_first_zone": MODEL
        + "SELECT pu_zone, count(*) AS trips FROM enriched GROUP BY pu_zone",
        "dim_key_uniqueness": _with(ZONES, REPEATED) + """
SELECT location_id, count(*) AS copies FROM repeated GROUP BY location_id HAVING count(*) > 1""",
        "unmatched_zones": FLAG + """
SELECT PULocationID AS location_id, count(*) AS trips, 'pu' AS role FROM flags
WHERE PULocationID NOT IN (SELECT location_id FROM zones) GROUP BY ALL
UNION ALL SELECT DOLocationID, count(*), 'do' FROM flags
WHERE DOLocationID NOT IN (SELECT location_id FROM zones) GROUP BY ALL""",
        "surrogate_key": MODEL
        + "SELECT row_number() OVER (ORDER BY event_id) AS trip_id, event_id FROM fact",
        "table_counts": MODEL + """
SELECT 'dim_zones' AS table_name, count(*) AS "rows" FROM zones
UNION ALL SELECT 'fact_trips', count(*) FROM fact""",
        "borough_distribution": MODEL
        + "SELECT pu_borough, count(*) AS trips FROM enriched GROUP BY pu_borough",
        "duration_speed_by_borough_hour": MODEL + _BOROUGH_HOUR,
        "duration_speed_by_zone_hour": MODEL + f"""
SELECT pu_borough, pu_zone, pickup_hour, {_DURATION_SPEED}
FROM enriched WHERE pu_borough IS NOT NULL AND pu_zone IS NOT NULL
GROUP BY pu_borough, pu_zone, pickup_hour""",
        "low_sample_groups": MODEL + """
SELECT count(*) AS groups, count(*) FILTER (n < 10) AS low_sample_groups
FROM (SELECT count(*) AS n FROM enriched WHERE pu_borough IS NOT NULL AND pu_zone IS NOT NULL
      GROUP BY pu_borough, pu_zone, pickup_hour)""",
        "peak_groups": MODEL + f""", by_hour AS ({_BOROUGH_HOUR})
(SELECT 'slowest' AS peak, pu_borough, pickup_hour, median_duration_min AS value FROM by_hour
 WHERE median_duration_min IS NOT NULL
 ORDER BY median_duration_min DESC, pu_borough, pickup_hour LIMIT 1)
UNION ALL
(SELECT 'fastest', pu_borough, pickup_hour, median_speed_mph FROM by_hour
 WHERE median_speed_mph IS NOT NULL
 ORDER BY median_speed_mph DESC, pu_borough, pickup_hour LIMIT 1)""",
        "fare_consistency": MODEL + _FARE,
        "kpi_reliability": FLAG + _scalar_kpis("M1_reliability"),
        "kpi_anomaly": FLAG + _scalar_kpis("M5_anomaly"),
        "kpi_flag_breakdown": FLAG + _flag_kpis(),
        "kpi_summary": FLAG + _scalar_kpis() + "\nUNION ALL " + _flag_kpis(),
        "order_report_counts": ORDER_FLAG + _REPORT_COUNTS,
        "order_flag_counts": ORDER_FLAG + f"SELECT flag, n FROM ({_flag_counts(ORDER_RULES)})",
        "order_duration_speed_by_region_month": ORDER_MODEL + _BOROUGH_HOUR.replace(
            "pickup_hour, ", "strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month, "
        ).replace("pu_borough, pickup_hour", "ALL"),
        "order_fare_consistency": ORDER_MODEL + _FARE,
    }
    mask = " + ".join(f"flag_{r}::INTEGER * {1 << i}" for i, r in enumerate(_RULES))
    out["flag_masks"] = FLAG + f"SELECT CAST({mask} AS INTEGER) AS mask, count(*) AS n FROM flags GROUP BY 1"
    raised = " + ".join(f"flag_{r}::INTEGER" for r in _RULES)
    out["flag_overlaps"] = FLAG + "\nUNION ALL ".join(
        f"SELECT '{a}' AS flag, '{b}' AS other, count(*) FILTER (flag_{a} AND flag_{b}) AS n, "
        f"count(*) FILTER (flag_{a} AND flag_{b} AND {raised} = 2) AS \"only\" FROM flags"
        for i, a in enumerate(_RULES) for b in _RULES[i + 1:]
    )
    out["checksums_of_written_files"] = """
SELECT event_type, CAST(length(ids) AS BIGINT) AS file_size_bytes, sha256(ids) AS sha256 FROM (
  SELECT event_type, string_agg(CAST(event_id AS VARCHAR), chr(10) ORDER BY event_id) || chr(10) AS ids
  FROM events GROUP BY event_type)"""
    out["mask_kpi_summary"] = out["kpi_summary"]
    out["incremental_counts"] = out["report_counts"]
    out["incremental_duration_speed"] = out["duration_speed_by_zone_hour"]
    out["incremental_fare_consistency"] = out["fare_consistency"]
    out["versioned_trips"] = FLAG + """
SELECT event_id, 'newest' AS version FROM flags WHERE NOT hard
UNION ALL SELECT event_id, 'first' FROM flags WHERE hard"""
    out["manifest_log"] = "\nUNION ALL ".join(
        f"SELECT '{t}.parquet' AS entry, count(*) AS row_count, "
        f"CAST({-1 if t == 'nation' else 10} AS DOUBLE) AS elapsed_seconds FROM {t}"
        for t in _TABLES if t != "region"
    )
    out["monthly_kpi_summary"] = out["kpi_summary"]
    out["monthly_duration_speed"] = out["duration_speed_by_zone_hour"]
    out["landed_trips"] = out["validated_trips"]
    for name in _RULES:
        key = f"flag_{name}".replace("passenger_count_suspect", "passenger_suspect")
        out[key] = FLAG + f"SELECT event_id, flag_{name} FROM flags"
    return out
