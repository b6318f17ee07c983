import datetime

import pytest

from vaportrail.plans.medallion import CheckFailed, Lake
from vaportrail.schemas import (
    AIRSPACE_TABLE,
    FLEET_TABLE,
    FLIGHTS_TABLE,
    HEATMAP_TABLE,
    INVENTORY_TABLE,
    QUALITY_TABLE,
    SNAPSHOT_TABLE,
)
from vaportrail.session import fresh_path
from vaportrail.sources.bronze import write_ndjson
from vaportrail.sources.seeds import known_airspaces
from vaportrail.streaming.micro_batches import (
    ONCE,
    recent_flights_once,
    stream_flights,
    stream_lake,
    stream_landing,
)

from tests.test_models import DAY, T0, record

GOLD = (SNAPSHOT_TABLE, INVENTORY_TABLE, HEATMAP_TABLE, FLEET_TABLE)


@pytest.fixture
def lake(spark):
    def make(**options):
        return Lake(spark, fresh_path(spark, "test-lake"), **options)

    return make


def rows_of(lake, spec):
    return sorted(map(tuple, lake.read(spec).collect()), key=repr)


def report_of(report):
    return {(r.model, r.step): (r.status, r.rows) for r in report.collect()}


def snapshot(loaded, *aircraft):
    return [record(a, loaded, callsign=f"{a}123", origin_country="CH") for a in aircraft]


def test_incremental_equals_full_and_repeats_change_nothing(spark, bronze, lake):
    loads = [
        snapshot(T0, "aaa", "bbb") + [record("bad", T0, latitude=None)],
        snapshot(T0 + 600, "aaa", "ccc"),
        snapshot(T0 + DAY, "aaa", "bbb") + [record("", T0 + DAY)],
    ]
    seed = known_airspaces(spark)
    grown, whole = lake(), lake()
    for load in loads:
        grown.build(bronze(*load), seed)
    everything = bronze(*[r for load in loads for r in load])
    whole.build(everything, seed)
    for spec in (FLIGHTS_TABLE, QUALITY_TABLE, *GOLD):
        assert rows_of(grown, spec) == rows_of(whole, spec), spec.name
    before = {spec.name: rows_of(grown, spec) for spec in (FLIGHTS_TABLE, QUALITY_TABLE, *GOLD)}
    grown.build(everything, seed)
    for spec in (FLIGHTS_TABLE, QUALITY_TABLE, *GOLD):
        assert rows_of(grown, spec) == before[spec.name], spec.name


def test_late_snapshots_are_dropped(bronze, lake):
    target = lake()
    target.load_flights(bronze(*snapshot(T0 + 600, "aaa")))
    target.load_flights(bronze(*snapshot(T0, "bbb"), *snapshot(T0 + 600, "ccc")))
    assert [r.icao24 for r in target.read(FLIGHTS_TABLE).collect()] == ["aaa"]
    target.load_flights(bronze(*snapshot(T0, "bbb")), full=True)
    assert [r.icao24 for r in target.read(FLIGHTS_TABLE).collect()] == ["bbb"]


def test_records_without_load_time_enter_only_at_first(bronze, lake):
    target = lake(as_of_date=datetime.date(2026, 5, 29))
    target.load_quality_logs(bronze(record("a", "bad"), record(None, T0)))
    target.load_quality_logs(bronze(record("b", "bad"), record(None, T0 + 1)))
    reasons = [r.primary_error_reason for r in target.read(QUALITY_TABLE).collect()]
    assert sorted(reasons) == [
        "INVALID_METADATA_TIMESTAMP",
        "MISSING_AIRCRAFT_ID",
        "MISSING_AIRCRAFT_ID",
    ]


@pytest.mark.parametrize("policy, admitted", [("admit_none", 0), ("admit_all", 1)])
def test_empty_target(bronze, lake, policy, admitted):
    target = lake(empty_target=policy)
    target.load_quality_logs(bronze(record()))
    assert target.read(QUALITY_TABLE).count() == 0
    target.load_quality_logs(bronze(record(None)))
    assert target.read(QUALITY_TABLE).count() == admitted


def test_last_day_is_done_again(bronze, lake, spark):
    target = lake()
    target.load_airspaces(known_airspaces(spark))
    target.load_flights(bronze(*snapshot(T0, "aaa"), *snapshot(T0 + DAY, "aaa")))
    target.load_snapshots()
    target.load_fleet()
    target.load_flights(bronze(*snapshot(T0 + DAY + 600, "aaa", "bbb")))
    target.load_snapshots()
    target.load_fleet()
    pings = sorted(
        (str(r.flight_date), r.airline_code, r.total_telemetry_pings)
        for r in target.read(FLEET_TABLE).collect()
    )
    assert pings == [
        ("2026-05-30", "AAA", 1),
        ("2026-05-31", "AAA", 2),
        ("2026-05-31", "BBB", 1),
    ]


def test_failed_check_skips_what_depends_on_it(spark, bronze, lake):
    raw = bronze(*snapshot(T0, "aaa"), record(None, T0))
    seed = known_airspaces(spark)
    skipping = lake()
    report = report_of(skipping.build(raw, seed))
    assert report["fct_flight_snapshots", "model"] == ("built", 2)
    assert report["fct_flight_snapshots", "not_null_snapshot_id"] == ("failed", 1)
    assert report["fct_flight_snapshots", "unique_snapshot_id"] == ("passed", 0)
    assert report["stg_data_quality_logs", "unique_log_id"] == ("passed", 0)
    for spec in GOLD[1:]:
        assert report[spec.name, "model"] == ("skipped", None)
        assert not skipping.table(spec).exists()

    recording = lake(gate="record")
    report = report_of(recording.build(raw, seed))
    assert report["agg_hourly_traffic_heatmap", "model"] == ("built", 1)
    with pytest.raises(CheckFailed, match="not_null_snapshot_id"):
        lake(gate="raise").build(raw, seed)
    with pytest.raises(ValueError):
        lake(gate="ignore")


def test_first_day_still_to_read(bronze, lake):
    target = lake()
    day = datetime.timedelta(days=1)
    assert target.bronze_since(day) is None
    target.load_flights(bronze(*snapshot(T0, "aaa")))
    assert target.bronze_since(day) == datetime.date(2026, 5, 29)


def test_old_versions_go(spark, bronze, lake):
    target = lake(keep_versions=2)
    for i in range(4):
        target.build(bronze(*snapshot(T0 + i, "aaa")), known_airspaces(spark))
    assert len(target.table(INVENTORY_TABLE)._versions()) == 2
    assert len(target.table(HEATMAP_TABLE)._versions()) == 1
    assert len(target.table(FLIGHTS_TABLE)._versions()) == 1
    assert target.read(FLIGHTS_TABLE).count() == 4


def test_views(spark, bronze, lake):
    target = lake()
    target.build(bronze(*snapshot(T0, "aaa")), known_airspaces(spark))
    target.register_views()
    joined = spark.sql(
        "select count(*) n from fct_flight_snapshots"
        " join dim_spatial_airspaces using (airspace_name)"
    )
    assert joined.first().n == 1
    assert target.read(AIRSPACE_TABLE).count() == 10


def test_stream_of_raw_files(spark, bronze, lake):
    base, checkpoint = fresh_path(spark, "test-raw"), fresh_path(spark, "test-stream")
    seed = known_airspaces(spark)
    streamed, batch = lake(), lake()
    loads = [snapshot(T0, "aaa", "bbb"), snapshot(T0 + 600, "bbb", "ccc")]
    for load in loads:
        write_ndjson(bronze(*load), base)
        query = stream_lake(streamed, base, seed, checkpoint, trigger=ONCE)
        query.awaitTermination()
    batch.build(bronze(*[r for load in loads for r in load]), seed)
    for spec in (FLIGHTS_TABLE, *GOLD):
        assert rows_of(streamed, spec) == rows_of(batch, spec), spec.name
    # Nothing new has landed.
    stream_lake(streamed, base, seed, checkpoint, trigger=ONCE).awaitTermination()
    assert streamed.read(FLIGHTS_TABLE).count() == 4


def test_stream_of_payloads(spark, lake, tmp_path):
    from tests.test_raw_layer import VECTOR, payload

    base, checkpoint = fresh_path(spark, "test-raw"), fresh_path(spark, "test-stream")
    (tmp_path / "one.json").write_text(payload(VECTOR, VECTOR))
    stream_landing(
        spark, str(tmp_path), lambda df: write_ndjson(df, base), checkpoint, trigger=ONCE
    ).awaitTermination()
    target = lake()
    flights = stream_flights(target, base, fresh_path(spark, "test-stream"), trigger=ONCE)
    flights.awaitTermination()
    assert [r.icao24 for r in target.read(FLIGHTS_TABLE).collect()] == ["4b1814"]


def test_stream_dedup_by_state(spark, bronze, lake):
    from vaportrail.plans.silver import stg_flights

    source = fresh_path(spark, "test-flights")
    rows = stg_flights(bronze(*snapshot(T0, "aaa", "bbb")))
    rows.write.parquet(source)
    rows.write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    query = (
        recent_flights_once(stream, "1 hour")
        .writeStream.format("memory")
        .queryName("flights_once")
        .option("checkpointLocation", fresh_path(spark, "test-stream"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.table("flights_once").count() == 2


def test_a_snapshot_in_two_files(spark, bronze, lake):
    base, checkpoint = fresh_path(spark, "test-raw"), fresh_path(spark, "test-stream")
    seed = known_airspaces(spark)
    first = snapshot(T0, "aaa", "bbb") + [record(None, T0, last_contact=str(T0))]
    rest = snapshot(T0, "ccc") + [
        record("bbb", T0, last_contact=str(T0 + 5)),
        record(None, T0, last_contact=str(T0 + 1)),
        record("bad", T0, latitude=None),
    ]
    late = snapshot(T0 - 600, "ddd")
    streamed, whole = lake(gate="record"), lake(gate="record")
    for part in (first, rest, late):
        write_ndjson(bronze(*part).coalesce(1), base)
        stream_lake(streamed, base, seed, checkpoint, trigger=ONCE, max_files=1).awaitTermination()
    whole.build(bronze(*first, *rest), seed)
    for spec in (FLIGHTS_TABLE, QUALITY_TABLE, *GOLD):
        assert rows_of(streamed, spec) == rows_of(whole, spec), spec.name
    reports = spark.read.json(f"{streamed.root}/build_reports")
    assert reports.where("status = 'failed'").count() >= 3


def test_a_load_that_died_is_done_again(spark, bronze, lake):
    seed = known_airspaces(spark)
    first, second = snapshot(T0, "aaa"), snapshot(T0 + 600, "aaa", "bbb") + [record(None, T0 + 600)]
    target, whole = lake(gate="record"), lake(gate="record")
    for load in (first, second):
        whole.build(bronze(*load), seed)
    target.build(bronze(*first), seed)
    # Half of the second load is visible, in files that no finished load has noted.
    flights = target.table(FLIGHTS_TABLE)
    flights.append(whole.read(FLIGHTS_TABLE).where(f"loaded_at_timestamp > timestamp_seconds({T0})").limit(2))
    facts = target.table(SNAPSHOT_TABLE)
    facts.append(whole.read(SNAPSHOT_TABLE).where("icao24 is null"))
    target.build(bronze(*second), seed)
    for spec in (FLIGHTS_TABLE, QUALITY_TABLE, *GOLD):
        assert rows_of(target, spec) == rows_of(whole, spec), spec.name


def test_an_incremental_build_looks_at_touched_days(spark, bronze, lake, monkeypatch):
    from vaportrail.operators.checks import Check
    from vaportrail.plans import medallion

    target, seed = lake(), known_airspaces(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    target.build(bronze(*snapshot(T0, "aaa", "bbb"), record("bad", T0, latitude=None)), seed)
    seen = []
    failures = Check.failures
    heat = medallion.hourly_traffic_heatmap
    plan = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(Check, "failures", lambda self, df: plan(df) or failures(self, df))
    monkeypatch.setattr(medallion, "hourly_traffic_heatmap", lambda df: plan(df) or heat(df))
    target.build(bronze(*snapshot(T0 + DAY, "aaa")), seed)
    assert len(seen) == 6
    for text in seen:
        assert ">= 2026-05-30" in text.split("PartitionFilters")[1].split("]")[0]
    seen.clear()
    target.build(bronze(*snapshot(T0 + DAY, "aaa")), seed, full=True)
    assert not any(">= 2026" in text for text in seen)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_landing_tells_how_much(spark, tmp_path):
    from tests.test_raw_layer import VECTOR, payload

    (tmp_path / "one.json").write_text(payload(VECTOR, VECTOR))
    base, told = fresh_path(spark, "test-raw"), []
    stream_landing(
        spark,
        str(tmp_path),
        lambda df: write_ndjson(df, base),
        fresh_path(spark, "test-stream"),
        trigger=ONCE,
        loaded=told.append,
    ).awaitTermination()
    assert told == [2]


def test_airspaces_without_outline_are_counted(spark, bronze, lake):
    rows = [
        ("a", "Cap", "POLYGON((0 70, 90 70, 180 70, -90 70, 0 70))"),
        ("b", "Half", "POLYGON((-90 0, 90 0, 90 10, -90 10, -90 0))"),
        ("c", "Broken", "POLYGON(("),
        ("d", "Box", "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0))"),
    ]
    seed = spark.createDataFrame(rows, known_airspaces(spark).schema)
    report = report_of(lake().build(bronze(*snapshot(T0, "aaa")), seed))
    assert report["dim_spatial_airspaces", "null_airspace_polygon"] == ("counted", 3)


def _dies(*_):
    raise InterruptedError("the driver is gone")


def test_a_load_done_again_logs_once(spark, bronze, lake):
    """Crashes before the table, between table and mark, and after the mark; copies without key too."""
    from vaportrail.operators.tables import LakeTable

    target, log = lake(as_of_date=datetime.date(2026, 1, 1)), None
    log = target.table(QUALITY_TABLE)
    bad = {"latitude": None, "time_position": None}
    first = bronze(*[record(None, T0, **bad)] * 2, record("aaa", T0, latitude=None), record("bbb", "x"))
    second = bronze(
        *[record(None, T0, **bad)] * 3, record("aaa", T0, latitude=None), record("ccc", T0 + 600, latitude=None)
    )
    target.load_quality_logs(first, split=True, load="s.0")
    before = rows_of(target, QUALITY_TABLE)
    target.load_quality_logs(first, split=True, load="s.0")
    assert rows_of(target, QUALITY_TABLE) == before and len(before) == 4
    for _ in range(2):
        log.finished = _dies
        with pytest.raises(InterruptedError):
            target.load_quality_logs(second, split=True, load="s.1")
        del log.finished
    log._write = _dies
    with pytest.raises(InterruptedError):
        target.load_quality_logs(second, split=True, load="s.1")
    del log._write
    for _ in range(2):
        target.load_quality_logs(second, split=True, load="s.1")
    after = rows_of(target, QUALITY_TABLE)
    assert len(after) == len(before) + 5
    assert log.finished_load() == "s.1" and log.finished_rows()[0] == len(after)
    assert isinstance(log, LakeTable) and "_load" not in log.read().columns


def test_a_later_build_reads_the_days_it_touches(spark, bronze, lake):
    """Files of earlier days are spoilt: whatever read them, counts and tests included, would fail."""
    from pathlib import Path

    target, seed = lake(), known_airspaces(spark)
    loads = [snapshot(T0 + day * DAY, "aaa", "bbb") + [record("bad", T0 + day * DAY, latitude=None)] for day in range(4)]
    target.build(bronze(*loads[0], *loads[1]), seed)
    spoilt = 0
    for spec in (FLIGHTS_TABLE, QUALITY_TABLE, SNAPSHOT_TABLE, HEATMAP_TABLE, FLEET_TABLE):
        table = target.table(spec)
        for part in Path(table.path).glob(f"{spec.partition}={table._days()[-1]}/part-*.parquet"):
            part.write_bytes(b"no longer parquet")
            spoilt += 1
    assert spoilt >= 5
    for load in loads[2:]:
        report = report_of(target.build(bronze(*load), seed))
    whole = report_of(lake().build(bronze(*[r for load in loads for r in load]), seed))
    assert report == whole


def test_the_index_is_kept_until_airspaces_change(spark, bronze, lake):
    target, seed = lake(), known_airspaces(spark)
    target.load_airspaces(seed)
    first = target.airspaces().folder
    target.load_airspaces(seed)
    assert target.airspaces().folder == first
    target.load_airspaces(seed.where("airspace_id != 'US_AIR'"))
    second = target.airspaces().folder
    assert second != first
    from vaportrail.operators.tables import list_folder

    assert list_folder(spark, f"{target.root}/airspace_index") == [second.rpartition("/")[2]]


def test_later_records_are_added_without_a_staged_copy(spark, bronze, lake, monkeypatch):
    """No key of a batch that is later than all rows held can be known: nothing is staged or compared."""
    from vaportrail.operators.tables import LakeTable

    target, whole = lake(), lake()
    loads = [snapshot(T0, "aaa", "bbb"), snapshot(T0 + 600, "aaa", "ccc") + [record(None, T0 + 600)], snapshot(T0 + DAY, "aaa")]
    everything = bronze(*[r for load in loads for r in load])
    for at in (target, whole):
        at.load_airspaces(known_airspaces(spark))
    whole.load_flights(everything)
    whole.load_snapshots()

    def merge(*_):
        raise AssertionError("staged")

    monkeypatch.setattr(LakeTable, "_merge", merge)
    for batch in [*(bronze(*load) for load in loads), everything]:
        target.load_flights(batch)
        target.load_snapshots()
    for spec in (FLIGHTS_TABLE, SNAPSHOT_TABLE):
        assert rows_of(target, spec) == rows_of(whole, spec), spec.name
