import datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from vaportrail.operators.checks import Check
from vaportrail.operators.watermark import HighWater
from vaportrail.plans.gold import (
    active_flight_inventory,
    daily_fleet_utilization,
    flight_snapshots,
    hourly_traffic_heatmap,
)
from vaportrail.plans.silver import quality_logs, reason_summary, stg_flights
from vaportrail.schemas import FLEET, FLIGHTS, HEATMAP, INVENTORY, QUALITY_LOGS, SNAPSHOTS

T0 = 1780142400  # 2026-05-30 12:00:00
HOUR = 3600
DAY = 24 * HOUR


def record(icao24="abc123", loaded=T0, **more):
    defaults = {"latitude": "47.0", "longitude": "8.0", "time_position": str(T0 - 5)}
    return {"icao24": icao24, "_gcs_loaded_at": str(loaded), **defaults, **more}


def seconds(name):
    return F.unix_seconds(F.col(name)).alias(name)


def names_and_types(schema):
    return [(field.name, field.dataType) for field in schema]


def test_schemas(bronze, airspaces):
    raw = bronze(record())
    flights = stg_flights(raw)
    snapshots = flight_snapshots(flights, airspaces)
    for df, schema in [
        (flights, FLIGHTS),
        (quality_logs(raw), QUALITY_LOGS),
        (snapshots, SNAPSHOTS),
        (active_flight_inventory(snapshots), INVENTORY),
        (hourly_traffic_heatmap(snapshots), HEATMAP),
        (daily_fleet_utilization(snapshots), FLEET),
    ]:
        assert names_and_types(df.schema) == names_and_types(schema)


def test_flight_types(bronze):
    row = stg_flights(
        bronze(
            record(
                latitude="n/a", on_ground="TRUE", spi="no", velocity="1e2", position_source="3",
                last_contact=None, squawk="0012",
            )
        )
    ).first()
    assert (row.latitude, row.on_ground, row.spi, row.velocity) == (None, True, None, 100.0)
    assert (row.position_source, row.squawk, row.last_contact_timestamp) == (3, "0012", None)


def test_one_row_per_key_latest_contact_wins(bronze):
    raw = bronze(
        record(callsign="old", last_contact="10"),
        record(callsign="new", last_contact="20"),
        record(callsign="none", last_contact=None),
        record(callsign="later load", loaded=T0 + 600),
        record(icao24=None, callsign="b"),
        record(icao24=None, callsign="a"),
    )
    rows = stg_flights(raw).orderBy("icao24", "loaded_at_timestamp").collect()
    assert [r.callsign for r in rows] == ["a", "new", "later load"]
    # The order of the input does not matter.
    again = stg_flights(raw.orderBy(F.desc("callsign"))).orderBy("icao24", "loaded_at_timestamp")
    assert again.collect() == rows


def test_bad_rows_stay_in_silver(bronze):
    raw = bronze(record(latitude=None), record(icao24="  "), record(icao24="x", loaded="bad"))
    assert stg_flights(raw).count() == 3
    assert quality_logs(raw).count() == 3


def test_epoch_out_of_range(bronze):
    raw = bronze(record(loaded=9223372036854775807))
    with pytest.raises(SparkRuntimeException, match="out of range"):
        stg_flights(raw).collect()
    row = quality_logs(raw, as_of_date=datetime.date(2026, 6, 1)).first()
    assert row.primary_error_reason == "INVALID_METADATA_TIMESTAMP"
    assert (row.gcs_loaded_at, row.log_date) == (None, datetime.date(2026, 6, 1))


def test_high_water(bronze):
    raw = bronze(
        record("a", T0),
        record("b", T0 + 1),
        record("c", T0 - 1),
        record("d", "bad"),
        record("e", T0 + 2),
    )
    mark = HighWater(T0 * 1_000_000)
    assert {r.icao24 for r in stg_flights(raw, mark).collect()} == {"b", "e"}
    assert stg_flights(raw, HighWater(None)).count() == 0
    assert stg_flights(raw, HighWater(None, "admit_all")).count() == 5
    with pytest.raises(ValueError):
        HighWater(None, "maybe")


def test_rule_order(bronze):
    raw = bronze(
        record(icao24=None, latitude=None, loaded="bad"),
        record(icao24=" 　", loaded="bad"),
        record(latitude="n/a", loaded="bad"),
        record(longitude=None),
        record(loaded="bad"),
        record(time_position=None),
        record(),
    )
    rows = quality_logs(raw).collect()
    assert [r.primary_error_reason for r in rows] == [
        "MISSING_AIRCRAFT_ID",
        "MISSING_AIRCRAFT_ID",
        "MISSING_GEOSPATIAL_COORDINATES",
        "MISSING_GEOSPATIAL_COORDINATES",
        "INVALID_METADATA_TIMESTAMP",
    ]
    today = quality_logs(raw).where("gcs_loaded_at is null and log_date <> current_date()")
    assert today.count() == 0
    summary = reason_summary(quality_logs(raw)).collect()
    assert {r.primary_error_reason: r.records for r in summary} == {
        "MISSING_AIRCRAFT_ID": 2,
        "MISSING_GEOSPATIAL_COORDINATES": 2,
        "INVALID_METADATA_TIMESTAMP": 1,
    }


def test_log_keys_may_collide(bronze):
    raw = bronze(*[record(icao24=None, time_position=None, callsign=c) for c in "ab"])
    (row,) = Check("unique", "log_id").failures(quality_logs(raw)).collect()
    assert row.occurrences == 2


def test_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert [tuple(r) for r in Check("unique", "k").failures(df).collect()] == [("a", 2)]
    assert Check("not_null", "k").failures(df).count() == 2
    outside = Check("accepted_values", "k", ("a",)).failures(df).collect()
    assert [tuple(r) for r in outside] == [("b", 1)]
    with pytest.raises(ValueError):
        Check("range", "k").failures(df)


@pytest.mark.parametrize("unique", [True, False])
def test_null_keys_collapse(bronze, airspaces, unique):
    flights = stg_flights(
        bronze(
            record(icao24=None, loaded=T0),
            record(icao24=None, loaded=T0 + 60, latitude="0.0", longitude="-20.0"),
            record(icao24="x", loaded="bad"),
            record(icao24="x"),
            record(icao24="y"),
        )
    )
    rows = flight_snapshots(flights, airspaces, unique_flights=unique).collect()
    assert sorted(r.icao24 for r in rows if r.snapshot_id) == ["x", "y"]
    (unkeyed,) = [r for r in rows if r.snapshot_id is None]
    # No airspace sorts before any name.
    assert (unkeyed.longitude, unkeyed.airspace_name) == (-20.0, "International Airspace")
    failing = Check("not_null", "snapshot_id").failures(
        flight_snapshots(flights, airspaces, unique_flights=unique)
    )
    assert failing.count() == 1


def test_duplicate_input_collapses_when_not_unique(bronze, airspaces):
    flights = stg_flights(bronze(record()))
    twice = flights.unionByName(flights.withColumn("callsign", F.lit("z")))
    assert flight_snapshots(twice, airspaces, unique_flights=False).count() == 1


def test_airspace_of_snapshots(bronze, airspaces):
    places = {
        "riyadh": ("24.7", "46.7", "African Airspace"),
        "miami": ("25.76", "-80.19", "International Airspace"),
        "winnipeg": ("49.90", "-97.14", "United States Airspace"),
        "edmonton": ("53.55", "-113.49", "International Airspace"),
        "95 north": ("95.0", "0.0", "International Airspace"),
        "nan": ("NaN", "0.0", "International Airspace"),
        "null": (None, "0.0", "International Airspace"),
    }
    flights = stg_flights(
        bronze(*[record(n, latitude=lat, longitude=lon) for n, (lat, lon, _) in places.items()])
    )
    found = {r.icao24: r.airspace_name for r in flight_snapshots(flights, airspaces).collect()}
    assert found == {name: airspace for name, (_, _, airspace) in places.items()}


def snapshots_of(bronze, airspaces, *records):
    return flight_snapshots(stg_flights(bronze(*records)), airspaces)


def test_inventory_is_the_latest_load(bronze, airspaces):
    snapshots = snapshots_of(
        bronze,
        airspaces,
        record("old", T0),
        record("ground", T0 + 600, on_ground="true"),
        record("air", T0 + 600, on_ground="false"),
        record("unknown", T0 + 600),
    )
    rows = active_flight_inventory(snapshots).collect()
    assert {r.icao24 for r in rows} == {"ground", "air", "unknown"}
    airborne = active_flight_inventory(snapshots, airborne_only=True).collect()
    assert {r.icao24 for r in airborne} == {"air"}


def test_heatmap_cells(bronze, airspaces):
    snapshots = snapshots_of(
        bronze,
        airspaces,
        record("a", T0, latitude="12.25", longitude="-0.04"),
        record("b", T0 + 3599, latitude="12.34", longitude="0.04"),
        record("c", T0 + 3600, latitude="12.34", longitude="0.04"),
        record("d", T0, latitude="-12.25", longitude="0.0"),
        record("e", T0, latitude=None),
    )
    rows = hourly_traffic_heatmap(snapshots).select(
        seconds("snapshot_hour"), "rounded_latitude", "rounded_longitude", "total_flight_records"
    )
    assert sorted(map(tuple, rows.collect())) == [
        (T0, -12.3, 0.0, 1),
        (T0, 12.3, 0.0, 2),
        (T0 + 3600, 12.3, 0.0, 1),
    ]


def test_daily_roll_up(bronze, airspaces):
    snapshots = snapshots_of(
        bronze,
        airspaces,
        record("a", T0, callsign=" dal1 ", origin_country="US"),
        record("a", T0 + 60, callsign="DAL2", origin_country="US"),
        record("b", T0, callsign="DAL3", origin_country="US"),
        record("c", T0, callsign="ab", origin_country=None),
        record("d", T0, callsign=None, origin_country=""),
        record("a", T0 + DAY, callsign="DAL1", origin_country="US"),
        record(None, T0, callsign="DAL1", origin_country="US"),
    )
    daily = daily_fleet_utilization(snapshots)
    rows = daily.select(
        "flight_date", "origin_country", "airline_code", "total_telemetry_pings",
        "unique_airframes_tracked",
    )
    day, next_day = datetime.date(2026, 5, 30), datetime.date(2026, 5, 31)
    assert set(map(tuple, rows.collect())) == {
        (day, "US", "DAL", 4, 2),  # the record without id counts, its id does not
        (day, None, "UNKNOWN_CARRIER", 1, 1),
        (day, "", "UNKNOWN_CARRIER", 1, 1),
        (next_day, "US", "DAL", 1, 1),
    }
    # No country and an empty one share an id.
    assert Check("unique", "aggregation_id").failures(daily).count() == 1
    last = daily_fleet_utilization(snapshots, HighWater(next_day)).collect()
    assert [r.flight_date for r in last] == [next_day]
    assert daily_fleet_utilization(snapshots, approximate=True).count() == 4
