"""Silver models: typed flights and the quarantine log, both read from bronze."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaportrail.functions.casts import safe_boolean, safe_double, safe_long, safe_string
from vaportrail.functions.instants import instant_or_fail, instant_or_null
from vaportrail.functions.keys import log_key
from vaportrail.functions.text import trim_space
from vaportrail.operators.ranking import content_order, first_per_key
from vaportrail.operators.watermark import HighWater
from vaportrail.schemas import FLIGHTS_TABLE, LOAD_TIME, QUALITY_LOGS

EPOCHS = ("time_position", "last_contact", LOAD_TIME)
VALID = "VALID"
# The reasons a record is quarantined, in order of precedence.
ERROR_REASONS = (
    "MISSING_AIRCRAFT_ID",
    "MISSING_GEOSPATIAL_COORDINATES",
    "INVALID_METADATA_TIMESTAMP",
)


def typed_flights(bronze: DataFrame) -> DataFrame:
    """All records with their fields cast.

    Records with bad positions stay: the quarantine log copies them, it does
    not take them away.
    """
    # Epochs are read first: an instant looks at its seconds several times.
    records = bronze.withColumns({name: safe_long(F.col(name)) for name in EPOCHS})
    return records.select(
        safe_string(F.col("icao24")).alias("icao24"),
        safe_string(F.col("callsign")).alias("callsign"),
        safe_string(F.col("origin_country")).alias("origin_country"),
        safe_double(F.col("latitude")).alias("latitude"),
        safe_double(F.col("longitude")).alias("longitude"),
        safe_double(F.col("baro_altitude")).alias("baro_altitude"),
        safe_boolean(F.col("on_ground")).alias("on_ground"),
        safe_double(F.col("velocity")).alias("velocity"),
        safe_double(F.col("true_track")).alias("true_track"),
        safe_double(F.col("vertical_rate")).alias("vertical_rate"),
        safe_double(F.col("geo_altitude")).alias("geo_altitude"),
        safe_string(F.col("squawk")).alias("squawk"),
        safe_boolean(F.col("spi")).alias("spi"),
        safe_long(F.col("position_source")).alias("position_source"),
        instant_or_fail(F.col("time_position")).alias("flight_timestamp"),
        instant_or_fail(F.col("last_contact")).alias("last_contact_timestamp"),
        instant_or_fail(F.col(LOAD_TIME)).alias("loaded_at_timestamp"),
    )


def latest_contacts(flights: DataFrame) -> DataFrame:
    """One record per aircraft and load time: the latest contact wins, then the latest position."""
    latest = (
        F.col("last_contact_timestamp").desc_nulls_last(),
        F.col("flight_timestamp").desc_nulls_last(),
    )
    keys = FLIGHTS_TABLE.keys
    return first_per_key(flights, keys, content_order(flights, *latest, keys=keys))


def stg_flights(bronze: DataFrame, filled: HighWater | None = None) -> DataFrame:
    """Typed records, one per aircraft and load time; with ``filled`` only later load times."""
    typed = typed_flights(bronze)
    if filled is not None:
        typed = typed.where(filled.later(F.col("loaded_at_timestamp")))
    return latest_contacts(typed)


def classify(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    label = F
    for name, holds in rules:
        label = label.when(holds, F.lit(name))
    return label.otherwise(F.lit(otherwise))


def record_reason() -> Column:
    missing_id, missing_position, bad_load_time = ERROR_REASONS
    return classify(
        [
            (missing_id, F.col("icao24").isNull() | (trim_space(F.col("icao24")) == "")),
            (missing_position, F.col("latitude").isNull() | F.col("longitude").isNull()),
            (bad_load_time, F.col("gcs_loaded_at").isNull()),
        ],
        VALID,
    )


def quality_logs(
    bronze: DataFrame,
    filled: HighWater | None = None,
    as_of_date: datetime.date | None = None,
) -> DataFrame:
    """Copies of the records that break a rule, with the reason.

    ``as_of_date`` dates the entries without a load time; default is today.
    """
    records = bronze.select(
        log_key(F.col("icao24"), F.col("time_position"), F.col(LOAD_TIME)).alias("log_id"),
        safe_string(F.col("icao24")).alias("icao24"),
        safe_string(F.col("callsign")).alias("callsign"),
        safe_double(F.col("latitude")).alias("latitude"),
        safe_double(F.col("longitude")).alias("longitude"),
        safe_string(F.col("origin_country")).alias("origin_country"),
        instant_or_null(safe_long(F.col("time_position"))).alias("time_position"),
        instant_or_null(safe_long(F.col(LOAD_TIME))).alias("gcs_loaded_at"),
    )
    if filled is not None:
        records = records.where(filled.later(F.col("gcs_loaded_at")))
    today = F.current_date() if as_of_date is None else F.lit(as_of_date)
    return (
        records.withColumns(
            {
                "primary_error_reason": record_reason(),
                "log_date": F.coalesce(F.to_date("gcs_loaded_at"), today),
            }
        )
        .where(F.col("primary_error_reason") != VALID)
        .select(*QUALITY_LOGS.names)
    )


def reason_summary(logs: DataFrame) -> DataFrame:
    return logs.groupBy("primary_error_reason").agg(F.count(F.lit(1)).alias("records"))
