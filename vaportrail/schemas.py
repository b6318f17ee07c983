"""Schemas of every layer, and how each table is keyed and laid out on disk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, FLAG, WHOLE, REAL = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()
DAY, INSTANT = T.DateType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Slots 0 to 16 of a state vector, in payload order.
STATE_SLOTS = (
    "icao24",
    "callsign",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "baro_altitude",
    "on_ground",
    "velocity",
    "true_track",
    "vertical_rate",
    "sensors",
    "geo_altitude",
    "squawk",
    "spi",
    "position_source",
)
LOAD_TIME = "_gcs_loaded_at"
LAKE_LEVELS = ("year", "month", "day", "hour")

# The payload keeps every scalar as text; the silver layer decides on types.
PAYLOAD = _schema(time=TEXT, states=T.ArrayType(T.ArrayType(TEXT)))

RECORD = T.StructType(
    [
        T.StructField(
            name, T.ArrayType(T.IntegerType()) if name == "sensors" else T.StringType()
        )
        for name in (*STATE_SLOTS, LOAD_TIME)
    ]
)
BRONZE = T.StructType(
    [
        *RECORD.fields,
        T.StructField("_corrupt_record", T.StringType()),
        *(T.StructField(level, T.IntegerType()) for level in LAKE_LEVELS),
    ]
)
SEED = _schema(airspace_id=TEXT, airspace_name=TEXT, wkt_geometry=TEXT)

FLIGHTS = _schema(
    icao24=TEXT,
    callsign=TEXT,
    origin_country=TEXT,
    latitude=REAL,
    longitude=REAL,
    baro_altitude=REAL,
    on_ground=FLAG,
    velocity=REAL,
    true_track=REAL,
    vertical_rate=REAL,
    geo_altitude=REAL,
    squawk=TEXT,
    spi=FLAG,
    position_source=WHOLE,
    flight_timestamp=INSTANT,
    last_contact_timestamp=INSTANT,
    loaded_at_timestamp=INSTANT,
)
QUALITY_LOGS = _schema(
    log_id=TEXT,
    log_date=DAY,
    primary_error_reason=TEXT,
    icao24=TEXT,
    callsign=TEXT,
    latitude=REAL,
    longitude=REAL,
    origin_country=TEXT,
    time_position=INSTANT,
    gcs_loaded_at=INSTANT,
)
AIRSPACES = _schema(
    airspace_id=TEXT,
    airspace_name=TEXT,
    airspace_polygon=_schema(rings=T.ArrayType(T.ArrayType(_schema(lon=REAL, lat=REAL)))),
)
SNAPSHOTS = _schema(
    snapshot_id=TEXT,
    flight_date=DAY,
    loaded_at_timestamp=INSTANT,
    flight_timestamp=INSTANT,
    icao24=TEXT,
    callsign=TEXT,
    origin_country=TEXT,
    latitude=REAL,
    longitude=REAL,
    baro_altitude=REAL,
    velocity=REAL,
    on_ground=FLAG,
    airspace_name=TEXT,
)
INVENTORY = T.StructType(
    [field for field in SNAPSHOTS.fields if field.name not in ("flight_date", "on_ground")]
)
HEATMAP = _schema(
    snapshot_date=DAY,
    snapshot_hour=INSTANT,
    rounded_latitude=REAL,
    rounded_longitude=REAL,
    airspace_name=TEXT,
    total_flight_records=WHOLE,
)
FLEET = _schema(
    aggregation_id=TEXT,
    flight_date=DAY,
    origin_country=TEXT,
    airline_code=TEXT,
    total_telemetry_pings=WHOLE,
    unique_airframes_tracked=WHOLE,
)


@dataclass(frozen=True)
class TableSpec:
    """One lake table.

    ``keys`` identify a row for upserts. ``partition`` is the day column that
    names the directories; where ``partition_from`` is set, that column is
    derived from a timestamp on write and dropped on read. ``cluster`` columns
    order the rows inside each file, so that file statistics can skip.
    ``instant`` is a timestamp that the keys determine: a key that is new has a
    later one than all that are known, as a rule. ``tagged`` rows are stored with the
    name of the load that brought them, so that a load done again finds its own.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition: str | None = None
    partition_from: str | None = None
    cluster: tuple[str, ...] = ()
    instant: str | None = None
    tagged: bool = False


FLIGHTS_TABLE = TableSpec(
    "stg_flights",
    FLIGHTS,
    keys=("icao24", "loaded_at_timestamp"),
    partition="load_date",
    partition_from="loaded_at_timestamp",
    cluster=("icao24", "origin_country"),
    instant="loaded_at_timestamp",
)
QUALITY_TABLE = TableSpec(
    "stg_data_quality_logs",
    QUALITY_LOGS,
    keys=("log_id",),
    partition="log_date",
    cluster=("primary_error_reason", "icao24"),
    instant="gcs_loaded_at",
    tagged=True,
)
AIRSPACE_TABLE = TableSpec("dim_spatial_airspaces", AIRSPACES)
SNAPSHOT_TABLE = TableSpec(
    "fct_flight_snapshots",
    SNAPSHOTS,
    keys=("snapshot_id",),
    partition="flight_date",
    cluster=("airspace_name", "icao24"),
    instant="loaded_at_timestamp",
)
INVENTORY_TABLE = TableSpec("fct_active_flight_inventory", INVENTORY)
HEATMAP_TABLE = TableSpec(
    "agg_hourly_traffic_heatmap",
    HEATMAP,
    partition="snapshot_date",
    cluster=("airspace_name",),
)
FLEET_TABLE = TableSpec(
    "agg_daily_fleet_utilization",
    FLEET,
    keys=("aggregation_id",),
    partition="flight_date",
)
