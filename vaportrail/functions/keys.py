"""Surrogate keys: lower-case hex MD5 over concatenated parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaportrail.functions.instants import instant_text


def surrogate_key(*parts: Column, blank_nulls: bool = False) -> Column:
    """Digest of the parts, joined without separator.

    A NULL part makes the key NULL, unless ``blank_nulls`` reads it as ``''``.
    """
    texts = [part.cast("string") for part in parts]
    if blank_nulls:
        texts = [F.coalesce(text, F.lit("")) for text in texts]
    return F.md5(F.concat(*texts))


def snapshot_key(icao24: Column, loaded_at: Column) -> Column:
    return surrogate_key(icao24, instant_text(loaded_at))


def log_key(icao24: Column, time_position: Column, loaded_at: Column) -> Column:
    return surrogate_key(icao24, time_position, loaded_at, blank_nulls=True)


def aggregation_key(flight_date: Column, country: Column, carrier: Column) -> Column:
    return surrogate_key(flight_date, F.coalesce(country, F.lit("")), carrier)
