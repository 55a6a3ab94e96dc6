"""Compare registered queries with their SQL oracles: python tests/check_oracle.py
[sf_dir] [query ...]. Rows are compared as sets of text, floats at full precision first
and at ten significant digits second."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__ as contract  # noqa: E402
from meterwise.plans.queries import TABLES  # noqa: E402
from meterwise.session import local_session  # noqa: E402


def cell(value: object, digits: int | None) -> str:
    if value is None or str(value) in ("NaT", "<NA>", "nan"):
        return "null"
    if isinstance(value, float):
        return repr(value) if digits is None else f"{value:.{digits}g}"
    if type(value).__name__ in ("float64", "float32"):
        return cell(float(value), digits)
    return str(value)


def bag(frame, digits: int | None) -> Counter:
    columns = sorted(frame.columns)
    rows = frame[columns].astype(object).itertuples(index=False, name=None)
    return Counter(tuple(cell(v, digits) for v in row) for row in rows)


def compare(spark, con, sf_dir: str, name: str, sql: str | None) -> str:
    """`ok`, `close` (equal at ten digits), `rows` (no oracle) or what differs."""
    got = contract.queries()[name](spark, sf_dir).toPandas()
    if sql is None:
        return f"rows {len(got)}"
    want = con.sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"DIFF columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"DIFF rows {len(got)} vs {len(want)}"
    types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns
             if got[c].notna().all()  # columns with nulls change their type in frames
             and (got[c].dtype.kind != want[c].dtype.kind
                  or got[c].dtype.itemsize != want[c].dtype.itemsize)}
    note = f" types {types}" if types else ""
    if bag(got, None) == bag(want, None):
        return "ok" + note
    a, b = bag(got, 10), bag(want, 10)
    if a == b:
        return "close" + note
    return f"DIFF values{note}\n   spark {list((a - b).items())[:2]}\n   sql   {list((b - a).items())[:2]}"


def views(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session("check", os.environ.get("BENCH_CPUS", "8")), views(sf_dir)
    oracle = contract.oracle_sql()
    names = sys.argv[2:] or list(contract.queries())
    unknown = set(oracle) - set(contract.queries())
    print("oracle without query:", unknown) if unknown else None
    bad = 0
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, con, sf_dir, name, oracle.get(name))
        except Exception as error:
            verdict = f"DIFF {type(error).__name__}: {str(error)[:600]}"
        bad += verdict.startswith("DIFF")
        print(f"{time.time() - start:6.2f}s {name:40} {verdict}", flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))
