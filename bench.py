"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

All queries run twice to warm up and are then timed in full (all rows, all columns, into
the no-op sink). `rows_per_sec` divides the rows of the query's main input by its time,
`month` has the steps of the monthly job; it is not in the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterwise.plans import monthly  # noqa: E402
from meterwise.plans.derived_trips import EVENT_LIMITS, MONTH  # noqa: E402
from meterwise.plans.queries import _landed, _zones_csv, registered  # noqa: E402
from meterwise.session import local_session  # noqa: E402
from meterwise.sources.scratch import scratch_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Query and its main input.
HEADLINE = {
    "scan_trips": "events",
    "flag_rows": "events",
    "validated_trips": "events",
    "report_counts": "events",
    "kpi_summary": "events",
    "profile": "events",
    "profile_lineitem": "lineitem",
    "value_counts_topk": "events",
    "fact_trips": "events",
    "enriched": "events",
    "surrogate_key": "events",
    "duration_speed_by_borough_hour": "events",
    "duration_speed_by_zone_hour": "events",
    "fare_consistency": "events",
    "order_report_counts": "lineitem",
    "order_duration_speed_by_region_month": "lineitem",
    "order_fare_consistency": "lineitem",
    "manifest": "events",
}


def month_seconds(spark) -> dict[str, float]:
    """The monthly job over trips from events: its steps when forced, the second time, and
    the whole when all is up to date."""
    landed, zones_csv = _landed(spark, SF_DIR), _zones_csv(spark, SF_DIR)
    root, seconds = scratch_folder(spark, "month"), {}

    def run(**options) -> float:
        start = time.perf_counter()
        sources = [("csv_fallback", "csv", zones_csv)]
        monthly.run_month(spark, MONTH, landed, sources, root, limits=EVENT_LIMITS, **options)
        return round(time.perf_counter() - start, 3)

    run()
    for step in monthly.STEPS:
        seconds[step] = run(step=step, force=True)
    seconds["up_to_date"] = run()
    return seconds


def main() -> None:
    spark = local_session("bench", CPUS)
    rows = {
        t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in set(HEADLINE.values())
    }
    seconds = {}
    for _ in range(3):
        for name in HEADLINE:
            start = time.perf_counter()
            registered()[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    rate = {n: round(rows[t] / seconds[n]) for n, t in HEADLINE.items()}
    month = month_seconds(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rate,
                "month": month,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
