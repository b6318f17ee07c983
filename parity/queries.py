"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

import datetime
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parity.adapter import bronze_events, table
from vaportrail.functions.casts import safe_double, safe_long
from vaportrail.functions.instants import instant_or_null
from vaportrail.functions.keys import aggregation_key, log_key, snapshot_key
from vaportrail.functions.text import carrier_code
from vaportrail.operators.checks import duplicates, nulls, unexpected_values
from vaportrail.operators.ranking import first_per_key
from vaportrail.operators.spatial import (
    BROADCAST_BYTES,
    PolygonIndex,
    SpatialOptions,
    build_index,
    first_polygon,
    spatial_join,
)
from vaportrail.operators.tables import LakeTable, list_folder
from vaportrail.plans import gold
from vaportrail.plans.medallion import Lake
from vaportrail.plans.silver import ERROR_REASONS, quality_logs, reason_summary, stg_flights, typed_flights
from vaportrail.schemas import (
    FLEET_TABLE,
    FLIGHTS_TABLE,
    LOAD_TIME,
    QUALITY_TABLE,
    SNAPSHOT_TABLE,
    STATE_SLOTS,
    TableSpec,
)
from vaportrail.session import configure, fresh_path
from vaportrail.sources.bronze import read_bronze, register_bronze, stream_bronze, write_ndjson
from vaportrail.sources.payloads import flatten_states, read_payloads
from vaportrail.sources.seeds import known_airspaces, read_seed
from vaportrail.streaming.micro_batches import ONCE, recent_flights_once, stream_landing
from vaportrail.streaming.micro_batches import stream_flights as stream_into

# Quarantined records without a load time are dated by this day.
AS_OF = datetime.date(2024, 2, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; instants leave as UTC wall-clock time."""

    @functools.wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = build(configure(spark), folder)
        local = {
            field.name: F.col(field.name).cast("timestamp_ntz")
            for field in result.schema
            if isinstance(field.dataType, T.TimestampType)
        }
        return result.withColumns(local) if local else result

    QUERIES[build.__name__] = run
    return run


INDEXES: dict[tuple, PolygonIndex] = {}


def index(
    spark: SparkSession,
    edges: str = "geodesic",
    whole: bool = False,
    limit: int = BROADCAST_BYTES,
) -> PolygonIndex:
    """The airspaces, stored once per application as in a built lake.

    ``whole`` keeps the ids besides the names; ``limit`` is the most to broadcast.
    """
    key = (spark.sparkContext.applicationId, edges, whole, limit)
    if key not in INDEXES or not list_folder(spark, INDEXES[key].folder):
        airspaces = gold.spatial_airspaces(known_airspaces(spark))
        build = build_index if whole else gold.airspace_index
        INDEXES[key] = build(airspaces, options=SpatialOptions(edges=edges, broadcast_bytes=limit))
    return INDEXES[key]


def flights(spark: SparkSession, folder: str) -> DataFrame:
    return stg_flights(bronze_events(spark, folder))


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return gold.flight_snapshots(flights(spark, folder), index(spark))


def positions(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_events(spark, folder, "event_id").select(
        "event_id",
        safe_double(F.col("longitude")).alias("longitude"),
        safe_double(F.col("latitude")).alias("latitude"),
    )


def load_seconds() -> Column:
    return safe_long(F.col(LOAD_TIME))


# Raw layer


def _raw_fields(*more: str) -> list:
    return [
        "icao24",
        "callsign",
        "origin_country",
        "time_position",
        F.col(LOAD_TIME).alias("load_time"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        "on_ground",
        F.col("velocity").try_cast("double").alias("velocity"),
        "last_contact",
        "squawk",
        "spi",
        *more,
    ]


def _landed(spark: SparkSession, folder: str) -> str:
    base = fresh_path(spark, "raw")
    write_ndjson(bronze_events(spark, folder, "ts"), base, F.col("ts").cast("timestamp"))
    return base


@query
def bronze_scan(spark: SparkSession, folder: str) -> DataFrame:
    raw = read_bronze(spark, _landed(spark, folder))
    return raw.select(*_raw_fields("year", "month", "day", "hour"))


@query
def external_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lake as a table of the catalog, of which a partition filter leaves some folders."""
    name = f"raw_{uuid.uuid4().hex}"
    register_bronze(spark, name, _landed(spark, folder))
    raw = spark.table(name).where(F.col("day") % 2 == 0)
    return raw.select(*_raw_fields("year", "month", "day", "hour"))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    """All events as payload documents; ``batch`` deals them into three parts."""
    sensors = F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit("["), F.col("event_id") % 11, F.lit(", 7]"))
    )
    slots = {name: F.col(name) for name in STATE_SLOTS} | {"sensors": sensors}
    vectors = bronze_events(spark, folder, "event_id").select(
        F.col(LOAD_TIME).alias("time"),
        (F.col("event_id") % 3).alias("batch"),
        # Event ids are unique, so no document gets more than a thousand vectors.
        F.floor(F.col("event_id") / 1000).alias("part"),
        F.array(*slots.values()).alias("state"),
    )
    documents = vectors.groupBy("time", "batch", "part").agg(F.collect_list("state").alias("states"))
    return documents.select("batch", F.to_json(F.struct("time", "states")).alias("value"))


@query
def payload_flatten(spark: SparkSession, folder: str) -> DataFrame:
    landing = fresh_path(spark, "payloads")
    _documents(spark, folder).select("value").write.text(landing)
    records = flatten_states(read_payloads(spark, landing, per_line=True))
    return records.select(
        *_raw_fields(),
        F.size("sensors").alias("sensor_count"),
        F.coalesce(F.get("sensors", F.lit(0)), F.lit(-1)).alias("first_sensor"),
    )


@query
def landing_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads land in three parts; the stream tells how many records each batch has written."""
    landing, base, checkpoint = (fresh_path(spark, label) for label in ("payloads", "raw", "stream"))
    documents, told = _documents(spark, folder), []
    for batch in range(3):
        documents.where(F.col("batch") == batch).select("value").write.mode("append").text(landing)
        landed = stream_landing(
            spark, landing, lambda records: write_ndjson(records, base), checkpoint,
            trigger=ONCE, per_line=True, loaded=told.append,
        )
        landed.awaitTermination()
    counts = spark.createDataFrame(list(enumerate(told)), "batch long, records long")
    held = read_bronze(spark, base).agg(F.count(F.lit(1)).alias("records"))
    return counts.unionByName(held.withColumn("batch", F.lit(None).cast("long")))


# Silver layer


@query
def silver_flights(spark: SparkSession, folder: str) -> DataFrame:
    return flights(spark, folder)


@query
def silver_quality_logs(spark: SparkSession, folder: str) -> DataFrame:
    return quality_logs(bronze_events(spark, folder), as_of_date=AS_OF)


@query
def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reason_summary(quality_logs(bronze_events(spark, folder), as_of_date=AS_OF))


@query
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    loaded = bronze_events(spark, folder, "event_id").withColumn(
        "loaded", instant_or_null(load_seconds())
    )
    return loaded.select(
        "event_id",
        snapshot_key(F.col("icao24"), F.col("loaded")).alias("snapshot_id"),
        log_key(F.col("icao24"), F.col("time_position"), F.col(LOAD_TIME)).alias("log_id"),
        aggregation_key(
            F.to_date("loaded"), F.col("origin_country"), carrier_code(F.col("callsign"))
        ).alias("aggregation_id"),
    )


# Airspaces and the spatial join


@query
def dim_airspaces(spark: SparkSession, folder: str) -> DataFrame:
    vertices = "flatten(airspace_polygon.rings)"
    written = fresh_path(spark, "seed")
    known_airspaces(spark).write.option("header", True).option("escape", '"').csv(written)
    shapes = gold.spatial_airspaces(read_seed(spark, written)).select(
        "airspace_id",
        "airspace_name",
        F.expr(f"size({vertices})").alias("vertices"),
        *[
            F.expr(f"array_{end}(transform({vertices}, v -> v.{axis}))").alias(f"{axis}_{end}")
            for axis in ("lon", "lat")
            for end in ("min", "max")
        ],
    )
    hits = spatial_join(positions(spark, folder), index(spark, whole=True), how="inner")
    held = hits.groupBy("airspace_id").agg(F.count(F.lit(1)).alias("positions"))
    return shapes.join(held, "airspace_id", "left").fillna(0, ["positions"])


@query
def spatial_join_hits(spark: SparkSession, folder: str) -> DataFrame:
    hits = spatial_join(positions(spark, folder), index(spark, whole=True), how="inner")
    return hits.select("event_id", "airspace_id")


@query
def spatial_join_planar(spark: SparkSession, folder: str) -> DataFrame:
    hits = spatial_join(positions(spark, folder), index(spark, "planar", whole=True), how="inner")
    return hits.select("event_id", "airspace_id")


@query
def overlap_resolution(spark: SparkSession, folder: str) -> DataFrame:
    matched = spatial_join(positions(spark, folder), index(spark))
    first = first_per_key(matched, ["event_id"], [F.col("airspace_name").asc_nulls_first()])
    return first.select("event_id", "airspace_name")


@query
def first_polygon_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """All positions twice over, placed by an index treated as too large to broadcast."""
    points = positions(spark, folder).drop("event_id")
    placed = first_polygon(points.unionAll(points), index(spark, limit=0))
    return placed.groupBy("airspace_name").agg(F.count(F.lit(1)).alias("positions"))


# Gold layer


@query
def flight_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots(spark, folder)


@query
def airspace_traffic(spark: SparkSession, folder: str) -> DataFrame:
    return gold.airspace_traffic(snapshots(spark, folder))


@query
def active_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """From a stored table, whose latest day alone is read."""
    facts = Lake(spark, fresh_path(spark, "lake")).table(SNAPSHOT_TABLE)
    facts.replace(snapshots(spark, folder))
    return gold.active_flight_inventory(facts.latest_rows())


@query
def hourly_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return gold.hourly_traffic_heatmap(snapshots(spark, folder))


@query
def daily_fleet(spark: SparkSession, folder: str) -> DataFrame:
    return gold.daily_fleet_utilization(snapshots(spark, folder))


# Incremental loads


ORDER_BOOK = TableSpec(
    "order_book",
    T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("order_month", T.DateType()),
        ]
    ),
    keys=("o_orderkey",),
    partition="order_month",
    cluster=("o_orderkey",),
)


@query
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    """All orders; then open ones close, and pending ones are issued again as new orders."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("order_month")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", month
    )
    book = LakeTable(spark, fresh_path(spark, "orders"), ORDER_BOOK)
    book.replace(orders)
    closed = orders.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("F"))
    issued = orders.where("o_orderstatus = 'P'").withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit("O")}
    )
    book.upsert(closed.unionByName(issued))
    return book.read()


def _load_range(bronze: DataFrame) -> tuple[int, int]:
    return bronze.agg(F.min(load_seconds()), F.max(load_seconds())).first()


def _thirds(bronze: DataFrame) -> list[DataFrame]:
    """The records in the order of their loads, in three parts; those without load time come first."""
    first, last = _load_range(bronze)
    third = (last - first) // 3
    early = load_seconds() < first + third
    return [
        bronze.where(early | load_seconds().isNull()),
        bronze.where(~early & (load_seconds() < first + 2 * third)),
        bronze.where(load_seconds() >= first + 2 * third),
    ]


@query
def incremental_equals_full(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads in order and a repeated one give what one full load gives."""
    bronze = bronze_events(spark, folder)
    lake = Lake(spark, fresh_path(spark, "lake"))
    for batch in [*_thirds(bronze), bronze]:
        lake.load_flights(batch)
    return lake.read(FLIGHTS_TABLE)


@query
def quality_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine log by three loads and a repeated one."""
    bronze = bronze_events(spark, folder)
    lake = Lake(spark, fresh_path(spark, "lake"), as_of_date=AS_OF)
    for batch in [*_thirds(bronze), bronze]:
        lake.load_quality_logs(batch)
    return lake.read(QUALITY_TABLE)


@query
def quarantine_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches, cut within a snapshot. The second dies between table and mark, is done again, and once more."""
    bronze = bronze_events(spark, folder, "event_id")
    first, last = _load_range(bronze)
    cut = bronze.where(load_seconds() >= first + (last - first) // 2).agg(F.min(load_seconds())).first()[0]
    early = (load_seconds() < cut) | ((load_seconds() == cut) & (F.col("event_id") % 2 == 0)) | load_seconds().isNull()
    lake = Lake(spark, fresh_path(spark, "lake"), as_of_date=AS_OF)
    lake.load_quality_logs(bronze.where(early), split=True, load="stream.0")
    log = lake.table(QUALITY_TABLE)
    log.finished = _die
    try:
        lake.load_quality_logs(bronze.where(~early), split=True, load="stream.1")
    except InterruptedError:
        del log.finished
    for _ in range(2):
        lake.load_quality_logs(bronze.where(~early), split=True, load="stream.1")
    return lake.read(QUALITY_TABLE)


def _die(*_) -> None:
    raise InterruptedError("the driver is gone")


@query
def snapshots_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots by three loads and a repeated one; each load keeps one row without key, left out here."""
    bronze = bronze_events(spark, folder)
    lake = Lake(spark, fresh_path(spark, "lake"))
    lake.load_airspaces(known_airspaces(spark))
    for batch in [*_thirds(bronze), bronze]:
        lake.load_flights(batch)
        lake.load_snapshots()
    return lake.read(SNAPSHOT_TABLE).where("snapshot_id is not null")


@query
def late_data_drop(spark: SparkSession, folder: str) -> DataFrame:
    """The later half of the snapshots is loaded first; the rest then comes too late."""
    bronze = bronze_events(spark, folder)
    first, last = _load_range(bronze)
    lake = Lake(spark, fresh_path(spark, "lake"))
    lake.load_flights(bronze.where(load_seconds() >= first + (last - first) // 2))
    lake.load_flights(bronze)
    return lake.read(FLIGHTS_TABLE).select("icao24", "loaded_at_timestamp", "flight_timestamp")


@query
def daily_reprocess(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the snapshots, cut within a day; then all: that day is done again."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    facts = lake.table(SNAPSHOT_TABLE)
    facts.replace(snapshots(spark, folder))
    fleet = lake.table(FLEET_TABLE)
    loaded = F.unix_seconds("loaded_at_timestamp")
    first, last = facts.read().agg(F.min(loaded), F.max(loaded)).first()
    start = facts.read().where((loaded < first + (last - first) // 2) | loaded.isNull())
    fleet.replace(gold.daily_fleet_utilization(start))
    filled = fleet.high_water("flight_date")
    fleet.upsert(gold.daily_fleet_utilization(facts.read(), filled))
    return fleet.read()


@query
def stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lake as a file stream, loaded into the silver flights."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    checkpoint = fresh_path(spark, "stream")
    stream = stream_into(lake, _landed(spark, folder), checkpoint, trigger=ONCE)
    stream.awaitTermination()
    return lake.read(FLIGHTS_TABLE)


@query
def stream_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lake lands in three parts, cut within a snapshot; each is a batch of one stream."""
    lake, base = Lake(spark, fresh_path(spark, "lake")), fresh_path(spark, "raw")
    checkpoint = fresh_path(spark, "stream")
    bronze = bronze_events(spark, folder, "ts", "event_id")
    first, last = _load_range(bronze)
    cut = bronze.where(load_seconds() >= first + (last - first) // 3).agg(F.min(load_seconds())).first()[0]
    half = (load_seconds() == cut) & (F.col("event_id") % 2 == 0)
    early = (load_seconds() < cut) | half | load_seconds().isNull()
    late = load_seconds() > cut + (last - cut) // 2
    for part in (bronze.where(early), bronze.where(~early & ~late), bronze.where(~early & late)):
        write_ndjson(part, base, F.col("ts").cast("timestamp"))
        stream_into(lake, base, checkpoint, trigger=ONCE).awaitTermination()
    return lake.read(FLIGHTS_TABLE)


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Landed in parts, the first of them twice; a state store keeps each aircraft and load once, over restarts."""
    base, out, checkpoint = (fresh_path(spark, label) for label in ("raw", "flights", "stream"))
    bronze = bronze_events(spark, folder, "ts")
    thirds = _thirds(bronze)
    for part in (*thirds[:2], thirds[0], thirds[2]):
        write_ndjson(part, base, F.col("ts").cast("timestamp"))
        flown = typed_flights(stream_bronze(spark, base)).where("icao24 is not null and loaded_at_timestamp is not null")
        once = recent_flights_once(flown, "36500 days").select("icao24", "loaded_at_timestamp")
        stream = once.writeStream.option("checkpointLocation", checkpoint).option("path", out)
        stream.format("parquet").trigger(**ONCE).start().awaitTermination()
    return spark.read.parquet(out)


# Data tests and the whole build


@query
def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    """Aircraft with several log entries; the key itself has no duplicates to find."""
    logs = quality_logs(bronze_events(spark, folder), as_of_date=AS_OF)
    return duplicates(logs, "log_id").withColumnRenamed("log_id", "value").unionByName(
        duplicates(logs, "icao24").withColumnRenamed("icao24", "value")
    )


@query
def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return nulls(snapshots(spark, folder), "snapshot_id").select("airspace_name", "icao24")


@query
def check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    logs = quality_logs(bronze_events(spark, folder), as_of_date=AS_OF)
    return unexpected_values(logs, "primary_error_reason", ERROR_REASONS[:1])


@query
def medallion_build(spark: SparkSession, folder: str) -> DataFrame:
    lake = Lake(spark, fresh_path(spark, "lake"), gate="record", as_of_date=AS_OF)
    return lake.build(bronze_events(spark, folder), known_airspaces(spark))
