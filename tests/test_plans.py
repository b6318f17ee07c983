"""The physical plans that make the models hold at scale."""

import pytest

from vaportrail.operators.spatial import SpatialOptions, build_index, spatial_join
from vaportrail.plans.gold import (
    active_flight_inventory,
    daily_fleet_utilization,
    flight_snapshots,
    hourly_traffic_heatmap,
    spatial_airspaces,
)
from vaportrail.plans.silver import stg_flights
from vaportrail.schemas import FLIGHTS, SNAPSHOTS
from vaportrail.session import fresh_path
from vaportrail.sources.seeds import known_airspaces

from tests.test_models import T0, record


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(df):
    path = fresh_path(df.sparkSession, "test-stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@pytest.fixture
def flights(bronze):
    found = stored(stg_flights(bronze(record("a", T0), record(None, T0))))
    assert found.schema == FLIGHTS
    return found


@pytest.fixture
def snapshots(flights, airspaces):
    found = stored(flight_snapshots(flights, airspaces))
    assert found.schema == SNAPSHOTS
    return found


def test_dedup_keeps_one_row_per_key_before_the_shuffle(bronze):
    plan = plan_of(stg_flights(stored(bronze(record()))))
    before, after = plan.split("Exchange hashpartitioning")
    assert before.count("WindowGroupLimit") == 1 and after.count("WindowGroupLimit") == 1


def test_snapshots_are_not_shuffled(flights, airspaces):
    plan = plan_of(flight_snapshots(flights, airspaces))
    assert "hashpartitioning" not in plan
    assert plan.count("BroadcastHashJoin") == 2
    assert "TakeOrderedAndProject" in plan
    # The second branch reads rows without a key only.
    assert "Or(IsNull(icao24),IsNull(loaded_at_timestamp))" in plan
    assert "PushedFilters: [IsNotNull(icao24), IsNotNull(loaded_at_timestamp)]" in plan


def test_points_are_not_shuffled_for_hits(flights, airspaces):
    plan = plan_of(spatial_join(flights, airspaces))
    assert "hashpartitioning" not in plan and "NestedLoop" not in plan


def test_many_polygons_join_by_cell(spark, flights):
    options = SpatialOptions(broadcast_bytes=0)
    index = build_index(spatial_airspaces(known_airspaces(spark)), options=options)
    plan = plan_of(spatial_join(flights, index))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "_salt" in plan


def test_marts_read_the_columns_they_need(snapshots):
    def read_schema(df):
        return plan_of(df).split("ReadSchema: ")[1].split("\n")[0]

    assert read_schema(hourly_traffic_heatmap(snapshots)) == (
        "struct<loaded_at_timestamp:timestamp,latitude:double,longitude:double,"
        "airspace_name:string>"
    )
    assert read_schema(daily_fleet_utilization(snapshots)) == (
        "struct<flight_date:date,icao24:string,callsign:string,origin_country:string>"
    )


def test_distinct_aircraft_are_counted_in_two_steps(snapshots):
    """A busy group is split by aircraft before it is brought together."""
    plan = plan_of(daily_fleet_utilization(snapshots))
    assert plan.count("hashpartitioning") == 2
    assert "icao24" in plan.split("hashpartitioning")[2].split("]")[0]


def test_inventory_pushes_the_latest_load_down(snapshots):
    plan = plan_of(active_flight_inventory(snapshots))
    assert "Subquery" in plan and "Window" not in plan and "Join" not in plan
