"""Gold models: airspaces, flight snapshots and the three marts built on them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaportrail.functions.casts import safe_string
from vaportrail.functions.geography import has_outline, polygon_from_wkt
from vaportrail.functions.instants import hour_start
from vaportrail.functions.keys import aggregation_key, snapshot_key
from vaportrail.functions.numbers import round_tenth
from vaportrail.functions.text import carrier_code
from vaportrail.operators.ranking import content_order, first_per_key, first_row
from vaportrail.operators.spatial import (
    DEFAULTS,
    PolygonIndex,
    SpatialOptions,
    build_index,
    first_polygon,
)
from vaportrail.operators.watermark import HighWater
from vaportrail.schemas import FLEET, INVENTORY, SNAPSHOTS

NO_AIRSPACE = "International Airspace"


def spatial_airspaces(seed: DataFrame, edges: str = "geodesic") -> DataFrame:
    """Seed rows with the WKT compiled; a shape that is malformed or has no outline becomes NULL.

    Geodesics give no outline to a ring around a pole, nor to one with a side
    half around the globe.
    """
    shaped = seed.select(
        safe_string(F.col("airspace_id")).alias("airspace_id"),
        safe_string(F.col("airspace_name")).alias("airspace_name"),
        polygon_from_wkt("wkt_geometry").alias("_shape"),
    )
    outlined = F.expr(has_outline("_shape", edges))
    return shaped.withColumn("airspace_polygon", F.when(outlined, F.col("_shape"))).drop("_shape")


def airspace_index(
    airspaces: DataFrame, options: SpatialOptions = DEFAULTS, folder: str | None = None
) -> PolygonIndex:
    """The airspaces that have a shape, ready for joins; names decide which one is first."""
    shaped = airspaces.where(F.col("airspace_polygon").isNotNull())
    return build_index(shaped.select("airspace_name", "airspace_polygon"), options=options, folder=folder)


def airspaces_digest(airspaces: DataFrame, options: SpatialOptions = DEFAULTS) -> str:
    """Names what an index is made of: the same for the same airspaces and options."""
    row = airspaces.select(F.xxhash64("airspace_name", "airspace_polygon").cast("decimal(38,0)").alias("h"))
    count, total = row.agg(F.count("h"), F.sum("h")).first()
    return hashlib.sha256(f"{count} {total} {options}".encode()).hexdigest()[:32]


def flight_snapshots(
    flights: DataFrame,
    airspaces: PolygonIndex,
    filled: HighWater | None = None,
    *,
    unique_flights: bool = True,
) -> DataFrame:
    """One row per flight record, placed in an airspace.

    Where airspaces overlap, the first name in the alphabet wins. All records
    whose key is NULL collapse to a single row.

    ``unique_flights`` states that ``(icao24, loaded_at_timestamp)`` is unique
    where both are set, which ``stg_flights`` guarantees; nothing then has to
    be shuffled. Turn it off for other input.
    """
    source = flights.withColumns(
        {
            "snapshot_id": snapshot_key(F.col("icao24"), F.col("loaded_at_timestamp")),
            "flight_date": F.to_date("loaded_at_timestamp"),
        }
    ).select(*[name for name in SNAPSHOTS.names if name != "airspace_name"])
    if filled is not None:
        source = source.where(filled.later(F.col("loaded_at_timestamp")))
    by_name = F.col("airspace_name").asc_nulls_first()
    if unique_flights:
        # The key is NULL exactly when one of its parts is. Saying it with the
        # parts lets the file scan skip: few rows, usually none, are read twice.
        # They part ways before they are placed, so that nothing is placed twice.
        keyless = F.col("icao24").isNull() | F.col("loaded_at_timestamp").isNull()
        survivor = first_row(first_polygon(source.where(keyless), airspaces), by_name)
        placed = first_polygon(source.where(~keyless), airspaces).unionByName(survivor)
    else:
        placed = first_polygon(source, airspaces)
        placed = first_per_key(placed, ["snapshot_id"], content_order(placed, by_name))
    return placed.withColumn(
        "airspace_name", F.coalesce("airspace_name", F.lit(NO_AIRSPACE))
    ).select(*SNAPSHOTS.names)


def active_flight_inventory(snapshots: DataFrame, *, airborne_only: bool = False) -> DataFrame:
    """All records of the latest load, on the ground too unless ``airborne_only``."""
    latest = snapshots.select(F.max("loaded_at_timestamp")).scalar()
    current = snapshots.where(F.col("loaded_at_timestamp") == latest)
    if airborne_only:
        current = current.where(~F.col("on_ground"))
    return current.select(*INVENTORY.names)


def hourly_traffic_heatmap(snapshots: DataFrame) -> DataFrame:
    """Records per hour, 0.1 degree cell and airspace."""
    return (
        snapshots.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy(
            F.to_date("loaded_at_timestamp").alias("snapshot_date"),
            hour_start(F.col("loaded_at_timestamp")).alias("snapshot_hour"),
            round_tenth(F.col("latitude")).alias("rounded_latitude"),
            round_tenth(F.col("longitude")).alias("rounded_longitude"),
            "airspace_name",
        )
        .agg(F.count(F.lit(1)).alias("total_flight_records"))
    )


def daily_fleet_utilization(
    snapshots: DataFrame, filled: HighWater | None = None, *, approximate: bool = False
) -> DataFrame:
    """Records and distinct aircraft per day, country and carrier.

    With ``filled`` the last day is done again, together with all later ones.
    """
    if filled is not None:
        snapshots = snapshots.where(filled.same_or_later(F.col("flight_date")))
    airframes = F.approx_count_distinct if approximate else F.count_distinct
    return (
        snapshots.groupBy(
            "flight_date", "origin_country", carrier_code(F.col("callsign")).alias("airline_code")
        )
        .agg(
            F.count(F.lit(1)).alias("total_telemetry_pings"),
            airframes("icao24").alias("unique_airframes_tracked"),
        )
        .withColumn(
            "aggregation_id",
            aggregation_key(
                F.col("flight_date"), F.col("origin_country"), F.col("airline_code")
            ),
        )
        .select(*FLEET.names)
    )


def airspace_traffic(snapshots: DataFrame) -> DataFrame:
    """Records per airspace."""
    return snapshots.groupBy("airspace_name").agg(F.count(F.lit(1)).alias("snapshots"))
