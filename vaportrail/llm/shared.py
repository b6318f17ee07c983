"""Tables written once to the folder all executors share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.operators.tables import remove_folder
from vaportrail.session import fresh_path, stored

_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """At the end the tables go that operators have written inside.

    What is made of them must have been stored by then, and what is still to be read must
    not come from them. Outside, tables stay: a result that has not been read needs them.
    """
    paths: list[str] = []
    token = _WRITTEN.set(paths)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in paths:
            remove_folder(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, from a table in the shared folder: lineage ends there.

    Shuffles on the way have as many partitions as the size of the input asks for.
    """
    path = fresh_path(df.sparkSession, f"llm-{label}")
    paths = _WRITTEN.get()
    if paths is not None:
        paths.append(path)
    return stored(df, path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drawn(ids: DataFrame, rows: int, count: int) -> DataFrame:
    """At most ``rows`` of the ``count`` values of a column, those with the least hashes.

    A bound on the hash leaves about four times as many as asked for to be sorted,
    so no task gets more however many there are.
    """
    name = ids.columns[0]
    mark, share = F.xxhash64(name), (4 * rows + 1000) / max(count, 1)
    if share < 1:
        ids = ids.where(mark < F.lit(int(-(2**63) + share * 2**64)))
    return ids.orderBy(mark, name).limit(rows)


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package at the driver's path too, wherever the job was started."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
