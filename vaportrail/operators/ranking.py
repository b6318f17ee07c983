"""Top-1 per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``; rows with a NULL key count as one group.

    Written as a rank filter: Spark then keeps one row per key in every map
    task before the shuffle, so a key that holds much of the table stays cheap.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def content_order(df: DataFrame, *leading: Column, keys: Sequence[str] = ()) -> list[Column]:
    """``leading``, then all columns but the keys, so that ties fall the same way each run."""
    rest = [name for name in df.columns if name not in keys]
    return [*leading, *(F.col(name).asc_nulls_first() for name in rest)]


def first_row(df: DataFrame, *order: Column) -> DataFrame:
    """The first row of all: found in every task by itself, then among those few."""
    return df.orderBy(*content_order(df, *order)).limit(1)
