"""Sources, manifest, the monthly job and the stream, on files written by the tests."""

import hashlib
import json
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meterwise.errors import (
    BadMonth, ConflictingCommit, DuplicateKeys, EmptyInput, MissingInput, RejectedInput, SchemaDrift,
)
from meterwise.operators import metrics, model, report, rules
from meterwise.plans import monthly
from meterwise.plans.incremental import KpiStore
from meterwise.sources import commits, files, sinks, trips, zones
from meterwise.sources.guards import guard_inputs, outputs_done
from meterwise.streaming.landing import validate_landed
from trip_rows import at, frame, trip

RECORDS = [
    {"the_geom": {"type": "Polygon", "coordinates": [[[0, 1]]]}, "zone": "Zone A",
     "locationid": "48", "borough": "East"},
    {"zone": "Zone B", "locationid": "79", "borough": "West"},
    {"locationid": "7"},
    {"zone": "no id", "borough": "East"},
    {"zone": "bad id", "locationid": "x9", "borough": "East"},
]


def land_zones(tmp_path, records=RECORDS):
    path = tmp_path / "zones.json"
    path.write_text(json.dumps(records, indent=2))
    return str(path)


def land_trips(spark, path, rows, copies=3):
    frame(spark, rows).drop("id").repartition(copies).write.mode("append").parquet(str(path))


def some_rows():
    rows = [trip(fare=20.0 + i, pu=48 if i % 3 else 79) for i in range(40)]
    rows += [trip(fare=-1.0), trip(miles=0.0), trip(pu=264), trip(people=7.0), trip(dropoff=None)]
    return rows


def test_zones_json(spark, tmp_path):
    path = land_zones(tmp_path)
    rows = sorted(map(tuple, zones.read_zones_json(spark, path).collect()))
    assert rows == [(7, "Unknown", "Unknown"), (48, "Zone A", "East"), (79, "Zone B", "West")]
    assert [r[0] for r in zones.skipped_zones_json(spark, path).collect()] == ["x9"]


def test_zones_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone"\n48,"East","Zone A, north"\n,"West","no id"\n79,West,\n')
    rows = sorted(map(tuple, zones.read_zones_csv(spark, str(path)).collect()))
    assert rows == [(48, "Zone A, north", "East"), (79, "Unknown", "West")]


def test_zone_fallback(spark, tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone\n1,East,A\n")
    empty = land_zones(tmp_path, [])
    for first in (empty, str(tmp_path / "absent.json")):
        dim, chosen = zones.read_zones(spark, [("api", "json", first), ("csv", "csv", str(csv))])
        assert chosen == ("csv", "csv", str(csv)) and dim.count() == 1
    with pytest.raises(MissingInput, match="absent"):
        zones.read_zones(spark, [("api", "json", str(tmp_path / "absent.json"))])


def test_scan_checks_columns(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(SchemaDrift, match="trip_distance"):
        trips.scan_trips(spark, str(tmp_path / "t"))


def test_scan_takes_the_columns_of_all_files(spark, tmp_path):
    rows = frame(spark, [trip(), trip()]).drop("id")
    rows.write.parquet(str(tmp_path / "a"))
    rows.withColumn("surcharge", F.lit(0.75)).write.parquet(str(tmp_path / "b"))
    both = trips.scan_trips(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(str(r["surcharge"]) for r in both.collect()) == ["0.75", "0.75", "None", "None"]
    rows.withColumn("surcharge", F.lit("x")).write.parquet(str(tmp_path / "c"))
    with pytest.raises(SchemaDrift, match="disagree"):
        trips.scan_trips(spark, [str(tmp_path / k) for k in "abc"])


def test_failed_write_leaves_the_old_month(spark, tmp_path):
    path = str(tmp_path / "trips" / "month=2025-01")
    sinks.write_month(spark.range(5).withColumn("valid", F.lit(True)), path, ["valid"])
    broken = spark.range(5).select((F.lit(1) / F.col("id")).alias("id"), F.lit(True).alias("valid"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.write_month(broken, path, ["valid"])
    assert spark.read.parquet(path).count() == 5
    sinks.write_month(spark.range(3).withColumn("valid", F.lit(False)), path, ["valid"])
    assert spark.read.parquet(path).where("not valid").count() == spark.read.parquet(path).count() == 3
    assert [p.name for p in (tmp_path / "trips").iterdir()] == ["month=2025-01"]


def test_footers_and_checksums(spark, tmp_path):
    table = pa.table({"t": [at("2024-12-31 20:47:55"), at("2025-02-01 00:00:44.5")], "v": [1, 2]})
    pq.write_table(table, tmp_path / "a b.parquet", row_group_size=1)
    pq.write_table(table, tmp_path / "plain.parquet", write_statistics=False)
    pq.write_table(table.select(["v"]), tmp_path / "other.parquet")
    (tmp_path / "broken.parquet").write_bytes(b"not parquet")
    facts = files.inspect_files(spark, str(tmp_path), ("t",)).cache()
    rows = {r["file_name"]: r for r in facts.collect()}
    good = rows["a b.parquet"]
    assert (good["row_count"], good["num_row_groups"], list(good["columns"])) == (2, 2, ["t", "v"])
    assert (good["range_min"], good["range_max"]) == ("2024-12-31 20:47:55", "2025-02-01 00:00:44.500000")
    content = (tmp_path / "a b.parquet").read_bytes()
    assert good["sha256"] == hashlib.sha256(content).hexdigest()
    assert good["file_size_bytes"] == len(content)
    assert rows["plain.parquet"]["range_min"] is None and rows["plain.parquet"]["row_count"] == 2
    assert rows["other.parquet"]["range_min"] is None
    assert rows["broken.parquet"]["row_count"] is None and rows["broken.parquet"]["error"]
    with pytest.raises(RejectedInput, match="broken.parquet"):
        files.require_readable(facts, str(tmp_path / "rejects"))
    assert spark.read.json(str(tmp_path / "rejects")).count() == 1
    assert files.manifest_rows(facts, "S1", "m", "d").count() == 3
    sums = {r["file_name"]: r["sha256"] for r in files.file_checksums(spark, str(tmp_path), "*.parquet").collect()}
    assert sums["broken.parquet"] == hashlib.sha256(b"not parquet").hexdigest()


def test_files_without_rows_are_refused(spark, tmp_path):
    pq.write_table(pa.table({"v": pa.array([], pa.int64())}), tmp_path / "empty.parquet")
    with pytest.raises(EmptyInput):
        files.require_readable(files.inspect_files(spark, str(tmp_path)))


def test_load_decisions(spark):
    here = spark.createDataFrame([("S", "a", "1"), ("S", "b", "2"), ("S", "x/b", "3")], "source STRING, entry STRING, sha256 STRING")
    known = spark.createDataFrame([("S", "a", "1"), ("S", "b", "0"), ("T", "a", "4")], "source STRING, entry STRING, sha256 STRING")
    out = {(r["source"], r["entry"]): r["decision"] for r in files.decide_loads(here, known).collect()}
    assert out == {("S", "a"): "unchanged", ("S", "b"): "changed", ("S", "x/b"): "new", ("T", "a"): "missing"}
    forced = files.decide_loads(here, known, force=True)
    assert {r["decision"] for r in forced.collect()} == {"reload", "missing"}
    assert {r["entry"] for r in files.files_to_load(forced).collect()} == {"a", "b", "x/b"}


def test_manifest_knows_files_by_month_source_and_path(spark, tmp_path):
    for sub in ("x", "y"):
        (tmp_path / "in" / sub).mkdir(parents=True)
        pq.write_table(pa.table({"v": [1] * (1 + ord(sub))}), tmp_path / "in" / sub / "p.parquet")
    log = str(tmp_path / "manifest")
    facts = files.inspect_files(spark, str(tmp_path / "in"))
    assert sorted(r["entry"] for r in facts.collect()) == ["x/p.parquet", "y/p.parquet"]
    for month in ("2025-01", "2025-02"):
        files.record(files.manifest_rows(facts, "S1", "m", "d", month), log)
    entries = files.read_manifest(spark, log)
    assert entries.count() == 4 and entries.select("row_count").distinct().count() == 2
    gone = spark.createDataFrame([("S1", "x/p.parquet")], "source STRING, entry STRING")
    files.forget(gone, log, "2025-01")
    left = {(r["month"], r["entry"]) for r in files.read_manifest(spark, log).collect()}
    assert left == {("2025-01", "y/p.parquet"), ("2025-02", "x/p.parquet"), ("2025-02", "y/p.parquet")}


def test_manifest_keeps_the_newest(spark, tmp_path):
    land = tmp_path / "in"
    land.mkdir()
    log = str(tmp_path / "manifest")
    for values in ([1], [1, 2]):
        pq.write_table(pa.table({"v": values}), land / "f.parquet")
        files.record(files.manifest_rows(files.inspect_files(spark, str(land)), "S1", "m", "d", "2025-01"), log)
    assert spark.read.json(log).count() == 2
    row = files.read_manifest(spark, log).head()
    assert row["row_count"] == 2 and row["month"] == "2025-01"


def test_guard_inputs(spark, tmp_path):
    guard_inputs(spark, {"folder": str(tmp_path)})
    with pytest.raises(MissingInput, match="zones"):
        guard_inputs(spark, {"folder": str(tmp_path), "zones": str(tmp_path / "none")})


def test_inventory(spark, tmp_path):
    sinks.write_csv(spark.range(3), str(tmp_path / "a"), ["id"])
    rows = {r["output"]: r for r in sinks.output_inventory(spark, str(tmp_path), ["a", "b"]).collect()}
    assert rows["a"]["present"] and rows["a"]["kb"] is not None
    assert not rows["b"]["present"] and rows["b"]["files"] == 0
    assert outputs_done(spark, [str(tmp_path / "a")])
    assert not outputs_done(spark, [str(tmp_path / "a"), str(tmp_path / "b")])


@pytest.fixture
def month(spark, tmp_path):
    land_trips(spark, tmp_path / "raw", some_rows())
    sources = [("api_json", "json", land_zones(tmp_path))]

    def run(**options):
        return monthly.run_month(
            spark, "2025-01", str(tmp_path / "raw"), sources, str(tmp_path / "out"), **options
        )

    run.root = tmp_path
    return run


def stamp(spark, path):
    return files.list_files(spark, path, "part-*").agg(F.max("modified_at")).head()[0]


def test_month_end_to_end(spark, month):
    out = month()
    table = spark.read.parquet(str(month.root / "out" / "trips"))
    by_valid = {r["valid"]: r["count"] for r in table.groupBy("valid").count().collect()}
    assert sum(by_valid.values()) == 45
    assert {str(r["month"]) for r in table.select("month").distinct().collect()} == {"2025-01"}
    assert not [c for c in table.columns if c.startswith(("flag_", "_"))]

    document = json.loads(spark.read.text(out["report"]).head()[0])
    assert list(document) == ["run_at", "month", "elapsed_seconds", "counts", "flag_counts",
                              "profile", "known_unknown_assumption_limitation"]
    counts = document["counts"]
    assert counts["rows_in_raw"] == 45 == counts["rows_hard_flagged"] + counts["rows_valid_out"]
    assert counts["rows_hard_flagged"] == 3
    assert document["flag_counts"]["location_unknown"] == 1
    assert list(document["flag_counts"]) == [r.name for r in rules.TRIP_RULES]
    assert document["profile"]["fare_amount"]["min"] == -1.0
    assert document["profile"]["tpep_pickup_datetime"]["min"] == "2025-01-08 17:15:00"
    assert document["profile"]["tpep_dropoff_datetime"]["null_count"] == 1
    assert document["profile"]["store_and_fwd_flag"]["value_counts"] == {"N": 45}
    assert "mean" not in document["profile"]["store_and_fwd_flag"]
    assert len(document["known_unknown_assumption_limitation"]) == 11

    summary = spark.read.option("header", True).csv(out["summary"])
    assert summary.columns == ["metric_name", "kpi_component", "group", "value", "unit", "description"]
    names = [r["metric_name"] for r in summary.collect()]
    assert names[:2] == ["data_reliability_pct", "valid_trip_count"]
    assert names[6:] == [f"flag_count_{r.name}" for r in rules.TRIP_RULES]
    assert [r["value"] for r in summary.collect()][:3] == ["93.333", "42", "45"]
    hours = spark.read.option("header", True).csv(out["duration_speed_borough_hour"]).collect()
    assert [(r["pu_borough"], r["pickup_hour"]) for r in hours] == [("East", "17"), ("West", "17")]
    assert sum(int(r["trip_count"]) for r in hours) == 42
    assert spark.read.option("header", True).csv(out["fare_consistency"]).count() == 2

    views = {t.name for t in spark.catalog.listTables()}
    assert {"dim_zones", "fact_trips", "fact_trips_enriched"} <= views
    ids = spark.sql("SELECT count(DISTINCT trip_id), min(trip_id), max(trip_id) FROM fact_trips").head()
    assert tuple(ids) == (42, 1, 42)
    joined = spark.sql("SELECT DISTINCT do_borough FROM fact_trips_enriched").collect()
    assert [r[0] for r in joined] == ["West"]


def test_second_run_is_skipped_until_forced_or_changed(spark, month):
    out = month()
    written = stamp(spark, out["trips"])
    month()
    assert stamp(spark, out["trips"]) == written
    month(force=True)
    forced = stamp(spark, out["trips"])
    assert forced > written
    manifest = str(month.root / "out" / "manifest")
    assert spark.read.json(manifest).count() == 8 and files.read_manifest(spark, manifest).count() == 4
    land_trips(spark, month.root / "raw", [trip()], 1)
    month()
    added = stamp(spark, out["trips"])
    assert added > forced
    assert spark.read.parquet(out["trips"]).count() == 46
    # A file that goes away, and zones that change, count as changes too.
    gone = next((month.root / "raw").glob("part-00000-*.parquet"))
    gone.rename(month.root / gone.name)
    month()
    removed = stamp(spark, out["trips"])
    assert removed > added and spark.read.parquet(out["trips"]).count() < 46
    land_zones(month.root, RECORDS[:2])
    month()
    assert stamp(spark, out["trips"]) > removed


def test_zone_source_in_the_manifest(spark, month):
    month()
    log = files.read_manifest(spark, str(month.root / "out" / "manifest"))
    entry = log.where("source = 'S2'").head()
    assert entry["retrieval_mode"] == "api_json" and entry["row_count"] == len(RECORDS)
    assert set(entry["columns"]) == {"the_geom", "zone", "locationid", "borough"}


def test_single_steps(spark, month):
    with pytest.raises(MissingInput):
        month(step="metrics")
    with pytest.raises(ValueError, match="step"):
        month(step="download")
    month(step="ingest")
    out = month(step="validate")
    assert outputs_done(spark, [out["trips"], out["report"]])
    assert not outputs_done(spark, [out["summary"]])
    validated = stamp(spark, out["trips"])
    month()
    assert outputs_done(spark, list(out.values())) and stamp(spark, out["trips"]) == validated


def test_month_without_excluded_rows_replaces_them(spark, month):
    out = month(limits=rules.Limits(max_fare=25.0))
    assert spark.read.parquet(out["trips"]).where("not valid").count() > 3
    loose = tuple(r for r in rules.TRIP_RULES if r.severity == rules.SOFT)
    month(force=True, rule_set=loose)
    table = spark.read.parquet(out["trips"])
    assert table.count() == 45 and table.where("not valid").count() == 0


def test_failed_run_is_not_taken_for_done(spark, month):
    land_zones(month.root, [*RECORDS, RECORDS[0]])
    with pytest.raises(DuplicateKeys):
        month()
    out = month(on_duplicate="allow")
    fares = spark.read.option("header", True).csv(out["fare_consistency"]).collect()
    assert sum(int(r["trip_count"]) for r in fares) > 42
    assert sum(
        int(r["trip_count"])
        for r in spark.read.option("header", True).csv(month(on_duplicate="first", force=True)["fare_consistency"]).collect()
    ) == 42


def test_month_refuses_bad_input(spark, month):
    with pytest.raises(BadMonth):
        monthly.run_month(spark, "2025-13", "x", [], "y")
    with pytest.raises(MissingInput):
        monthly.run_month(spark, "2025-01", str(month.root / "none"), [], str(month.root / "o"))
    (month.root / "raw" / "bad.parquet").write_bytes(b"junk")
    with pytest.raises(RejectedInput):
        month()
    # The next run knows the file and does without it, until it changes.
    out = month()
    assert spark.read.parquet(out["trips"]).count() == 45
    (month.root / "raw" / "bad.parquet").write_bytes(b"other junk")
    with pytest.raises(RejectedInput):
        month()


def published(spark, out):
    rows = spark.read.option("header", True).csv(out["summary"]).collect()
    return {r["metric_name"]: r["value"] for r in rows}


def test_metrics_follow_a_new_validation(spark, month):
    out = month()
    limits = rules.Limits(max_fare=25.0)
    month(step="validate", limits=limits, force=True)
    month(limits=limits)
    strict = published(spark, out)
    assert int(strict["valid_trip_count"]) < 42
    raw = json.loads(spark.read.text(out["report"]).head()[0])["counts"]
    assert strict["valid_trip_count"] == str(raw["rows_valid_out"])
    month()
    assert published(spark, out)["valid_trip_count"] == "42"
    other = tuple(rules.Rule(r.name, r.severity, r.test, "2") if r.name == "fare_invalid" else r for r in rules.TRIP_RULES)
    before = stamp(spark, out["trips"])
    month(rule_set=other)
    assert stamp(spark, out["trips"]) > before


def test_month_without_valid_trips_is_empty(spark, month):
    with pytest.raises(EmptyInput, match="valid"):
        month(limits=rules.Limits(max_fare=1.0))


def test_peaks_and_low_samples_are_published(spark, month):
    out = month()
    peaks = spark.read.option("header", True).csv(out["peak_groups"]).collect()
    assert {r["peak"] for r in peaks} == {"slowest", "fastest"}
    low = spark.read.option("header", True).csv(out["low_sample_groups"]).head()
    assert (low["groups"], low["low_sample_groups"]) == ("2", "0")


def test_stream_takes_each_file_once(spark, tmp_path):
    dim = zones.read_zones_json(spark, land_zones(tmp_path))
    landing, table = tmp_path / "landing", str(tmp_path / "trips")
    schema = frame(spark, []).drop("id").schema

    def take():
        query = validate_landed(
            spark, str(landing), schema, dim, "2025-01", table, str(tmp_path / "checkpoint")
        )
        query.awaitTermination(120)
        assert query.exception() is None

    land_trips(spark, landing, some_rows())
    take()
    first = spark.read.parquet(table)
    assert first.count() == 45 and first.where("valid = 'false'").count() == 3
    take()
    land_trips(spark, landing, [trip(pickup=at("2025-02-03 00:00:00"))], 1)
    take()
    assert spark.read.parquet(table).count() == 46


def manifest_entry(spark, name, size):
    row = {"month": "2025-01", "source": "S1", "entry": name, "row_count": size, "sha256": "x"}
    return spark.createDataFrame([row], files.MANIFEST)


def test_manifest_is_compacted_and_ordered_by_number(spark, tmp_path, monkeypatch):
    """After many commits a reader needs one folder; clocks play no part."""
    monkeypatch.setattr(commits, "EVERY", 4)
    path = str(tmp_path / "manifest")
    sizes = {}
    for k in range(17):
        name = f"f{k % 5}.parquet"
        sizes[name] = k
        assert files.record(manifest_entry(spark, name, k), path) == k + 1
        log = files.manifest_log(spark, path)
        assert len(log.folders()[1]) <= 4 and log.last() == k + 1
    assert len(files.manifest_log(spark, path).folders()[1]) == 2
    assert len(list((tmp_path / "manifest").glob("commit=*"))) <= 2 * 4
    got = {r["entry"]: r["row_count"] for r in files.read_manifest(spark, path).collect()}
    assert got == sizes


def test_manifest_refuses_a_commit_that_came_between(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert files.record(manifest_entry(spark, "a", 1), path, after=0) == 1
    with pytest.raises(ConflictingCommit):
        files.record(manifest_entry(spark, "a", 2), path, after=0)
    # A writer that died after taking a number leaves a gap.
    (tmp_path / "manifest" / "_claims" / "0000000002").touch()
    assert files.record(manifest_entry(spark, "a", 3), path) == 3
    assert [r["row_count"] for r in files.read_manifest(spark, path).collect()] == [3]
    assert not list((tmp_path / "manifest").glob("_new-*"))


def test_readers_see_whole_versions_while_others_are_published(spark, tmp_path):
    path = str(tmp_path / "table")
    version = lambda k: spark.range(100 * k, 100 * k + 100).withColumn("k", F.lit(k))
    commits.publish_version(version(0), path)
    done, seen, failed = threading.Event(), set(), []

    def read():
        while not done.is_set():
            try:
                rows = commits.read_version(spark, path).collect()
                seen.add((len(rows), *{r["k"] for r in rows}))
            except Exception as error:  # any failure of a reader is what is tested
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 8):
        assert commits.publish_version(version(k), path) == k + 1
    done.set()
    reader.join()
    assert not failed and len(seen) > 1 and all(n == 100 and len(ks) == 1 for n, *ks in seen)
    assert len(list((tmp_path / "table").glob("data-*"))) == 3
    assert commits.read_version(spark, path, 7).head()["k"] == 6
    with pytest.raises(MissingInput):
        commits.read_version(spark, path, 2)
    with pytest.raises(ConflictingCommit):
        commits.publish_version(version(9), path, after=3)
    broken = spark.range(3).select((F.lit(1) / F.col("id")).alias("id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        commits.publish_version(broken, path)
    assert commits.read_version(spark, path).count() == 100


def test_store_reads_changed_files_alone(spark, tmp_path):
    landing, dim = tmp_path / "in", zones.read_zones_json(spark, land_zones(tmp_path))
    landing.mkdir()
    rows = some_rows()
    parts = {f"{n} +.parquet": rows[k::3] for k, n in enumerate("abc")}

    def land(name, part):
        path = str(tmp_path / "one")
        frame(spark, part).drop("id").coalesce(1).write.mode("overwrite").parquet(path)
        next((tmp_path / "one").glob("*.parquet")).replace(landing / name)

    for name, part in parts.items():
        land(name, part)

    def check(store, rows):
        # Against the plain operators over all rows.
        flagged = rules.flag_rows(frame(spark, rows), dim, "2025-01", limits=store.limits)
        assert store.totals().head() == report.tally(flagged).head()
        enriched = model.enrich(model.fact_trips(rules.valid_rows(flagged)), dim, ("pu",)).cache()
        shown = lambda s: sorted(map(str, metrics.show_duration_speed(s, metrics.ZONE_HOUR).collect())) + sorted(
            map(str, metrics.show_fare_consistency(s).collect()))
        assert shown(store.statistics()) == shown(metrics.group_statistics(enriched))

    store = KpiStore(spark, str(tmp_path / "store"), str(landing), dim, "2025-01")
    assert store.update() == sorted(parts)
    assert store.update() == []
    check(store, rows)
    changed = [*parts["b +.parquet"], trip(fare=33.0, pu=79), trip(miles=0.0)]
    land("b +.parquet", changed)
    assert store.update() == ["b +.parquet"]
    check(store, parts["a +.parquet"] + changed + parts["c +.parquet"])
    (landing / "a +.parquet").rename(tmp_path / "a.parquet")
    assert store.update() == []
    check(store, changed + parts["c +.parquet"])
    stricter = KpiStore(spark, store.root, str(landing), dim, "2025-01", limits=rules.Limits(max_fare=30.0))
    assert stricter.update() == ["b +.parquet", "c +.parquet"]
    check(stricter, changed + parts["c +.parquet"])


def test_rows_are_numbered_in_their_order(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    model.write_ordered(rows.repartition(5), path, ["k"])
    out = model.read_numbered(spark, path, "n")
    assert all(r["n"] == r["k"] + 1 for r in out.collect()) and out.count() == 1000
    # Files of two writes cannot be told apart by their numbers.
    rows.coalesce(1).write.mode("append").parquet(path)
    (tmp_path / "t" / "_offsets").rename(tmp_path / "offsets")
    with pytest.raises(Exception, match="several writes"):
        model.read_numbered(spark, path, "n").collect()
