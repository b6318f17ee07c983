"""Epoch seconds, UTC instants and the buckets made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC in epoch seconds.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def instant_or_null(seconds: Column) -> Column:
    """Instant, or NULL when out of range."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(seconds))


def instant_or_fail(seconds: Column) -> Column:
    """Instant; a value out of range fails the job."""
    message = F.concat(F.lit("epoch seconds out of range: "), seconds.cast("string"))
    return F.when(seconds.isNull(), F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(instant_or_null(seconds), F.raise_error(message).cast("timestamp"))
    )


def instant_text(instant: Column) -> Column:
    """Text with a UTC offset, such as ``2026-05-30 12:00:00+00``; keys hash this form."""
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ssx")


def hour_start(instant: Column) -> Column:
    return F.date_trunc("hour", instant)


def clock_parts(instant: Column) -> dict[str, Column]:
    """Zero-padded UTC parts, the lake's directory levels."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(instant, pattern) for name, pattern in patterns.items()}


def file_stamp(instant: Column) -> Column:
    return F.date_format(instant, "yyyyMMdd_HHmmss")
