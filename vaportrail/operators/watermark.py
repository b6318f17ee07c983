"""High-water marks: how far a target table has been filled."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPTY_TARGET = ("admit_none", "admit_all")


@dataclass(frozen=True)
class HighWater:
    """The largest value in a target column: epoch microseconds, a date, or None.

    It is held as a plain value, so filters made of it are literals that prune
    partitions and reach the file scan.
    """

    value: int | datetime.date | None
    empty_target: str = "admit_none"

    def __post_init__(self):
        if self.empty_target not in EMPTY_TARGET:
            raise ValueError(f"empty_target must be one of {EMPTY_TARGET}")

    @property
    def day(self) -> str | None:
        """The marked day."""
        if self.value is None or isinstance(self.value, datetime.date):
            return self.value and str(self.value)
        return str((datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=self.value)).date())

    def _literal(self) -> Column:
        if isinstance(self.value, datetime.date):
            return F.lit(self.value)
        return F.timestamp_micros(F.lit(self.value))

    def _unset(self) -> Column:
        # Nothing compares with the maximum of an empty target, so by default
        # a target that exists without rows stays empty.
        return F.lit(self.empty_target == "admit_all")

    def later(self, column: Column) -> Column:
        return self._unset() if self.value is None else column > self._literal()

    def same_or_later(self, column: Column) -> Column:
        return self._unset() if self.value is None else column >= self._literal()

    def on_day_or_later(self, day: Column) -> Column:
        """For a day column derived from the marked instant: days that may hold later rows."""
        if self.value is None:
            return self._unset()
        return day >= F.to_date(self._literal())


def largest(df: DataFrame, column: str) -> int | datetime.date | None:
    """Global maximum of a timestamp (as epoch microseconds) or date column."""
    top = F.max(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        top = F.unix_micros(top)
    return df.agg(top).first()[0]


def high_water(df: DataFrame, column: str, empty_target: str = "admit_none") -> HighWater:
    return HighWater(largest(df, column), empty_target)
