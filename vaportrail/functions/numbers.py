"""Numeric binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_tenth(value: Column) -> Column:
    """Round to one decimal, half away from zero; never gives ``-0.0``."""
    return F.round(value * 10) / 10 + F.lit(0.0)
