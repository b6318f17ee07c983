"""The same results in plain SQL, written for DuckDB over the given tables."""

from __future__ import annotations

from vaportrail.sources.seeds import AIRSPACES

AS_OF = "DATE '2024-02-01'"


def _outline(wkt: str) -> list[tuple[float, float]]:
    inner = wkt[wkt.index("((") + 2 : wkt.index("))")]
    return [tuple(float(x) for x in corner.split()) for corner in inner.split(",")]


def _edges() -> str:
    rows = []
    for airspace, name, wkt in AIRSPACES:
        ring = _outline(wkt)
        for (lon1, lat1), (lon2, lat2) in zip(ring, ring[1:]):
            ends = ", ".join(f"{x}::DOUBLE" for x in (lon1, lat1, lon2, lat2))
            rows.append(f"('{airspace}', '{name}', {ends})")
    return ",\n    ".join(rows)


BRONZE = """
bronze AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '  '
      ELSE printf('%06x', user_id) END AS icao24,
    CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' AB '
      ELSE substr(event_type, 1, 3) || user_id::VARCHAR || '  ' END AS callsign,
    CASE WHEN event_id % 61 <> 0 THEN 'NATION_' || (user_id % 25)::VARCHAR END AS origin_country,
    CASE WHEN event_id % 59 <> 0 THEN ep::VARCHAR END AS time_position,
    CASE WHEN event_id % 83 = 0 THEN 'bad' ELSE (ep - ep % 3600)::VARCHAR END AS load_time,
    CASE WHEN event_id % 53 = 0 OR event_id % 71 = 0 THEN NULL
      ELSE ((event_id * 7919) % 180001)::DOUBLE / 1e3 - 90 END AS latitude,
    ((event_id * 104729) % 360001)::DOUBLE / 1e3 - 180 AS longitude,
    CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS on_ground,
    value AS velocity, ep + event_id % 7 AS last_contact,
    ((event_id * 31) % 13001)::DOUBLE AS baro_altitude,
    ((event_id * 17) % 720)::DOUBLE / 2 AS true_track,
    lpad((event_id % 7778)::VARCHAR, 4, '0') AS squawk,
    event_id % 5 = 0 AS spi, event_id % 4 AS position_source
  FROM (SELECT *, floor(epoch(ts))::BIGINT AS ep FROM events)
)"""

FLIGHTS = (
    BRONZE
    + """,
typed AS (
  SELECT icao24, callsign, origin_country, latitude, longitude,
    baro_altitude, on_ground::BOOLEAN AS on_ground, velocity,
    true_track, NULL::DOUBLE AS vertical_rate, NULL::DOUBLE AS geo_altitude,
    squawk, spi, position_source,
    make_timestamp(try_cast(time_position AS BIGINT) * 1000000) AS flight_timestamp,
    make_timestamp(last_contact * 1000000) AS last_contact_timestamp,
    make_timestamp(try_cast(load_time AS BIGINT) * 1000000) AS loaded_at_timestamp
  FROM bronze
),
flights AS (
  SELECT * FROM typed
  QUALIFY row_number() OVER (
    PARTITION BY icao24, loaded_at_timestamp
    ORDER BY last_contact_timestamp DESC, flight_timestamp DESC NULLS LAST,
      callsign NULLS FIRST, origin_country NULLS FIRST, latitude NULLS FIRST, longitude,
      baro_altitude, on_ground NULLS FIRST, velocity, true_track, squawk, spi,
      position_source) = 1
)"""
)

EDGES = f"""
edges(airspace_id, airspace_name, lon1, lat1, lon2, lat2) AS (
  VALUES
    {_edges()}
)"""


def _within(points: str, key: str, planar: bool = False) -> str:
    """CTEs ``hits(key, airspace_id, airspace_name)`` by counting the edges north of a point."""
    if planar:
        lat = "lat1 + (lat2 - lat1) * (longitude - lon1) / nullif(lon2 - lon1, 0)"
    else:
        lat = (
            "degrees(atan((tan(radians(lat1)) * sin(radians(lon2 - longitude))"
            " + tan(radians(lat2)) * sin(radians(longitude - lon1)))"
            " / nullif(sin(radians(lon2 - lon1)), 0)))"
        )
    return (
        EDGES
        + f""",
crossings AS (
  SELECT {key}, airspace_id, airspace_name, longitude, latitude, lon1, lat1, lon2, lat2,
    {lat} AS edge_lat
  FROM {points}, edges
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
),
hits AS (
  SELECT {key}, airspace_id, any_value(airspace_name) AS airspace_name
  FROM crossings
  GROUP BY ALL
  HAVING sum(CASE WHEN (lon1 > longitude) <> (lon2 > longitude) AND edge_lat > latitude
             THEN 1 ELSE 0 END) % 2 = 1
    AND NOT bool_or(coalesce(
      CASE WHEN lon1 = lon2
        THEN longitude = lon1 AND latitude BETWEEN least(lat1, lat2) AND greatest(lat1, lat2)
        ELSE longitude BETWEEN least(lon1, lon2) AND greatest(lon1, lon2)
          AND abs(edge_lat - latitude) < 1e-10 END, FALSE))
)"""
    ).replace("GROUP BY ALL", f"GROUP BY {key}, airspace_id")


SNAPSHOTS = (
    FLIGHTS
    + ""","""
    + """
numbered AS (
  SELECT *, row_number() OVER () AS row_id FROM flights
),"""
    + _within("numbered", "row_id")
    + """,
matched AS (
  SELECT md5(icao24 || strftime(loaded_at_timestamp, '%Y-%m-%d %H:%M:%S') || '+00')
      AS snapshot_id,
    loaded_at_timestamp::DATE AS flight_date, loaded_at_timestamp, flight_timestamp, icao24,
    callsign, origin_country, latitude, longitude, baro_altitude, velocity, on_ground,
    h.airspace_name
  FROM numbered n LEFT JOIN hits h ON n.row_id = h.row_id
),
snapshots AS (
  SELECT * REPLACE (coalesce(airspace_name, 'International Airspace') AS airspace_name)
  FROM matched
  QUALIFY row_number() OVER (
    PARTITION BY snapshot_id
    ORDER BY airspace_name NULLS FIRST, flight_date NULLS FIRST,
      loaded_at_timestamp NULLS FIRST, flight_timestamp NULLS FIRST, icao24 NULLS FIRST,
      callsign NULLS FIRST, origin_country NULLS FIRST, latitude NULLS FIRST,
      longitude NULLS FIRST, baro_altitude, velocity, on_ground NULLS FIRST) = 1
)"""
)

CARRIER = """CASE WHEN length(trim(callsign)) >= 3 THEN upper(substr(trim(callsign), 1, 3))
      ELSE 'UNKNOWN_CARRIER' END"""

FLEET = (
    SNAPSHOTS
    + f""",
fleet AS (
  SELECT md5(flight_date::VARCHAR || coalesce(origin_country, '') || airline_code)
      AS aggregation_id, *
  FROM (
    SELECT flight_date, origin_country, {CARRIER} AS airline_code,
      count(*) AS total_telemetry_pings, count(DISTINCT icao24) AS unique_airframes_tracked
    FROM snapshots
    GROUP BY 1, 2, 3)
)"""
)

HEATMAP = """
  SELECT loaded_at_timestamp::DATE AS snapshot_date,
    date_trunc('hour', loaded_at_timestamp) AS snapshot_hour,
    round(latitude, 1) + 0.0 AS rounded_latitude,
    round(longitude, 1) + 0.0 AS rounded_longitude,
    airspace_name, count(*) AS total_flight_records
  FROM snapshots
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5"""

INVENTORY = """
  SELECT snapshot_id, loaded_at_timestamp, flight_timestamp, icao24, callsign, origin_country,
    latitude, longitude, baro_altitude, velocity, airspace_name
  FROM snapshots
  WHERE loaded_at_timestamp = (SELECT max(loaded_at_timestamp) FROM snapshots)"""

LOGS = f"""
logs AS (
  SELECT * FROM (
    SELECT md5(coalesce(icao24, '') || coalesce(time_position, '') || load_time) AS log_id,
      coalesce(gcs_loaded_at::DATE, {AS_OF}) AS log_date,
      CASE WHEN icao24 IS NULL OR trim(icao24) = '' THEN 'MISSING_AIRCRAFT_ID'
        WHEN latitude IS NULL OR longitude IS NULL THEN 'MISSING_GEOSPATIAL_COORDINATES'
        WHEN gcs_loaded_at IS NULL THEN 'INVALID_METADATA_TIMESTAMP'
        ELSE 'VALID' END AS primary_error_reason,
      icao24, callsign, latitude, longitude, origin_country,
      make_timestamp(try_cast(time_position AS BIGINT) * 1000000) AS time_position,
      gcs_loaded_at
    FROM (
      SELECT *, make_timestamp(try_cast(load_time AS BIGINT) * 1000000) AS gcs_loaded_at
      FROM bronze))
  WHERE primary_error_reason <> 'VALID'
)"""

RAW_FIELDS = """icao24, callsign, origin_country, time_position, load_time, latitude,
  longitude, on_ground, velocity, last_contact::VARCHAR AS last_contact, squawk,
  CASE WHEN spi THEN 'TRUE' ELSE 'false' END AS spi"""


def _shapes() -> str:
    rows = []
    for airspace, name, wkt in AIRSPACES:
        ring = _outline(wkt)
        lons, lats = [p[0] for p in ring], [p[1] for p in ring]
        bounds = ", ".join(
            f"{x}::DOUBLE" for x in (min(lons), max(lons), min(lats), max(lats))
        )
        rows.append(f"('{airspace}', '{name}', {len(ring)}, {bounds})")
    return ",\n    ".join(rows)


MODEL_ROWS = {
    "stg_flights": "flights",
    "stg_data_quality_logs": "logs",
    "dim_spatial_airspaces": "(SELECT DISTINCT airspace_id FROM edges)",
    "fct_flight_snapshots": "snapshots",
    "fct_active_flight_inventory": f"({INVENTORY})",
    "agg_hourly_traffic_heatmap": f"({HEATMAP})",
    "agg_daily_fleet_utilization": "fleet",
}
TEST_ROWS = {
    ("unique_log_id", "stg_data_quality_logs"): (
        "(SELECT log_id FROM logs GROUP BY 1 HAVING count(*) > 1)"
    ),
    ("not_null_log_id", "stg_data_quality_logs"): "(SELECT 1 FROM logs WHERE log_id IS NULL)",
    ("accepted_values_primary_error_reason", "stg_data_quality_logs"): (
        "(SELECT 1 FROM logs WHERE primary_error_reason NOT IN ('MISSING_AIRCRAFT_ID',"
        " 'MISSING_GEOSPATIAL_COORDINATES', 'INVALID_METADATA_TIMESTAMP'))"
    ),
    ("unique_snapshot_id", "fct_flight_snapshots"): (
        "(SELECT snapshot_id FROM snapshots WHERE snapshot_id IS NOT NULL"
        " GROUP BY 1 HAVING count(*) > 1)"
    ),
    ("not_null_snapshot_id", "fct_flight_snapshots"): (
        "(SELECT 1 FROM snapshots WHERE snapshot_id IS NULL)"
    ),
}


def _build_report() -> str:
    steps = [
        f"SELECT 'model' AS step, '{model}' AS model, 'built' AS status, count(*) AS rows"
        f" FROM {relation}"
        for model, relation in MODEL_ROWS.items()
    ] + [
        f"SELECT '{test}', '{model}', CASE WHEN count(*) = 0 THEN 'passed' ELSE 'failed' END,"
        f" count(*) FROM {relation}"
        for (test, model), relation in TEST_ROWS.items()
    ] + ["SELECT 'null_airspace_polygon', 'dim_spatial_airspaces', 'counted', 0"]
    return f"WITH {FLEET},{LOGS}\n" + "\nUNION ALL\n".join(steps)


ORACLE: dict[str, str] = {
    "bronze_scan": f"""WITH {BRONZE}
SELECT {RAW_FIELDS}, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month,
  day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour
FROM bronze""",
    "external_scan": f"""WITH {BRONZE}
SELECT {RAW_FIELDS}, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month,
  day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour
FROM bronze WHERE day(ts) % 2 = 0""",
    "landing_counts": """
SELECT event_id % 3 AS batch, count(*) AS records FROM events GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM events""",
    "quarantine_replayed": f"WITH {BRONZE},{LOGS}\nSELECT * FROM logs",
    "stream_dedup": f"""WITH {FLIGHTS}
SELECT DISTINCT icao24, loaded_at_timestamp FROM typed
WHERE icao24 IS NOT NULL AND loaded_at_timestamp IS NOT NULL""",
    "payload_flatten": f"""WITH {BRONZE}
SELECT icao24, CASE WHEN callsign <> '' THEN trim(callsign) END AS callsign, origin_country,
  time_position, load_time, latitude, longitude, on_ground, velocity,
  last_contact::VARCHAR AS last_contact, squawk,
  CASE WHEN spi THEN 'TRUE' ELSE 'false' END AS spi,
  CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END::INTEGER AS sensor_count,
  CASE WHEN event_id % 2 = 0 THEN event_id % 11 ELSE -1 END::INTEGER AS first_sensor
FROM bronze""",
    "silver_flights": f"WITH {FLIGHTS}\nSELECT * FROM flights",
    "silver_quality_logs": f"WITH {BRONZE},{LOGS}\nSELECT * FROM logs",
    "quality_summary": f"""WITH {BRONZE},{LOGS}
SELECT primary_error_reason, count(*) AS records FROM logs GROUP BY 1""",
    "surrogate_keys": f"""WITH {BRONZE}
SELECT event_id,
  md5(icao24 || strftime(loaded, '%Y-%m-%d %H:%M:%S') || '+00') AS snapshot_id,
  md5(coalesce(icao24, '') || coalesce(time_position, '') || load_time) AS log_id,
  md5(loaded::DATE::VARCHAR || coalesce(origin_country, '') || {CARRIER}) AS aggregation_id
FROM (
  SELECT *, make_timestamp(try_cast(load_time AS BIGINT) * 1000000) AS loaded FROM bronze)""",
    "dim_airspaces": f"""WITH {BRONZE},{_within("bronze", "event_id")},
shapes(airspace_id, airspace_name, vertices, lon_min, lon_max, lat_min, lat_max) AS (
  VALUES
    {_shapes()}
)
SELECT s.*, count(h.event_id) AS positions
FROM shapes s LEFT JOIN hits h ON s.airspace_id = h.airspace_id
GROUP BY ALL""",
    "spatial_join_hits": f"""WITH {BRONZE},{_within("bronze", "event_id")}
SELECT event_id, airspace_id FROM hits""",
    "spatial_join_planar": f"""WITH {BRONZE},{_within("bronze", "event_id", planar=True)}
SELECT event_id, airspace_id FROM hits""",
    "overlap_resolution": f"""WITH {BRONZE},{_within("bronze", "event_id")}
SELECT b.event_id, min(h.airspace_name) AS airspace_name
FROM bronze b LEFT JOIN hits h ON b.event_id = h.event_id
GROUP BY 1""",
    "first_polygon_shuffled": f"""WITH {BRONZE},{_within("bronze", "event_id")},
firsts AS (
  SELECT b.event_id, min(h.airspace_name) AS airspace_name
  FROM bronze b LEFT JOIN hits h ON b.event_id = h.event_id
  GROUP BY 1
)
SELECT airspace_name, 2 * count(*) AS positions FROM firsts GROUP BY 1""",
    "flight_snapshots": f"WITH {SNAPSHOTS}\nSELECT * FROM snapshots",
    "airspace_traffic": f"""WITH {SNAPSHOTS}
SELECT airspace_name, count(*) AS snapshots FROM snapshots GROUP BY 1""",
    "active_inventory": f"WITH {SNAPSHOTS}\n{INVENTORY}",
    "hourly_heatmap": f"WITH {SNAPSHOTS}\n{HEATMAP}",
    "daily_fleet": f"WITH {FLEET}\nSELECT * FROM fleet",
    "upsert_merge": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, date_trunc('month', o_orderdate)::DATE AS order_month
FROM orders
UNION ALL
SELECT -o_orderkey - 1, 'O', o_totalprice, date_trunc('month', o_orderdate)::DATE
FROM orders WHERE o_orderstatus = 'P'""",
    "incremental_equals_full": f"WITH {FLIGHTS}\nSELECT * FROM flights",
    "quality_incremental": f"WITH {BRONZE},{LOGS}\nSELECT * FROM logs",
    "snapshots_incremental": f"WITH {SNAPSHOTS}\nSELECT * FROM snapshots WHERE snapshot_id IS NOT NULL",
    "late_data_drop": f"""WITH {FLIGHTS},
span AS (
  SELECT min(epoch(loaded_at_timestamp)::BIGINT) AS first,
    max(epoch(loaded_at_timestamp)::BIGINT) AS last
  FROM flights
)
SELECT icao24, loaded_at_timestamp, flight_timestamp FROM flights
WHERE epoch(loaded_at_timestamp)::BIGINT >= (SELECT first + (last - first) // 2 FROM span)""",
    "daily_reprocess": f"WITH {FLEET}\nSELECT * FROM fleet",
    "stream_silver": f"WITH {FLIGHTS}\nSELECT * FROM flights",
    "stream_in_batches": f"WITH {FLIGHTS}\nSELECT * FROM flights",
    "check_unique": f"""WITH {BRONZE},{LOGS}
SELECT log_id AS value, count(*) AS occurrences FROM logs WHERE log_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1
UNION ALL
SELECT icao24, count(*) FROM logs WHERE icao24 IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "check_not_null": f"""WITH {SNAPSHOTS}
SELECT airspace_name, icao24 FROM snapshots WHERE snapshot_id IS NULL""",
    "check_accepted_values": f"""WITH {BRONZE},{LOGS}
SELECT primary_error_reason, count(*) AS occurrences FROM logs
WHERE primary_error_reason <> 'MISSING_AIRCRAFT_ID' GROUP BY 1""",
    "medallion_build": _build_report(),
}
