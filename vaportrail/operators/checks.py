"""Data tests. Each gives the failing rows, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; NULLs are ignored."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def nulls(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is missing."""
    return df.where(F.col(column).isNull())


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones, with their count; NULLs pass."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


@dataclass(frozen=True)
class Check:
    """A named data test on one column: ``unique``, ``not_null`` or ``accepted_values``."""

    kind: str
    column: str
    accepted: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"

    def failures(self, df: DataFrame) -> DataFrame:
        if self.kind == "unique":
            return duplicates(df, self.column)
        if self.kind == "not_null":
            return nulls(df, self.column)
        if self.kind == "accepted_values":
            return unexpected_values(df, self.column, self.accepted)
        raise ValueError(f"unknown check {self.kind!r}")
