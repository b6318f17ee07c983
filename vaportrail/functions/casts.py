"""Casts that give NULL instead of failing, for text of unknown quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_string(text: Column) -> Column:
    return text.try_cast("string")


def safe_double(text: Column) -> Column:
    """Number or NULL. The JVM would also read ``1d`` and ``1f``; those are not numbers."""
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def safe_long(text: Column) -> Column:
    """Whole number or NULL. A fraction rounds half away from zero."""
    return F.coalesce(text.try_cast("bigint"), F.round(safe_double(text)).try_cast("bigint"))


def safe_boolean(text: Column) -> Column:
    """Only the words true and false count, in any letter case."""
    word = F.lower(text)
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
