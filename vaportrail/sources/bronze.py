"""The raw lake: NDJSON files under year/month/day/hour folders."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.functions.instants import clock_parts
from vaportrail.schemas import BRONZE, LAKE_LEVELS, RECORD


def write_ndjson(records: DataFrame, base: str, fetched_at: Column | None = None) -> None:
    """Append records, one JSON object per line, under the UTC hour of ``fetched_at``.

    Absent values are written as nulls, so every line has all fields. Without
    ``fetched_at`` the hour is that of the job.
    """
    clock = clock_parts(F.current_timestamp() if fetched_at is None else fetched_at)
    dated = records.select(*RECORD.names, *[part.alias(name) for name, part in clock.items()])
    # An hour may be large: the rebalance splits it over several tasks and files.
    (
        dated.hint("rebalance", *LAKE_LEVELS)
        .sortWithinPartitions(*LAKE_LEVELS)
        .write.mode("append")
        .option("ignoreNullFields", False)
        .partitionBy(*LAKE_LEVELS)
        .json(base)
    )


def since_day(day: datetime.date) -> Column:
    """Prunes the lake to folders of a day or later."""
    return F.make_date("year", "month", "day") >= F.lit(day)


def read_bronze(
    spark: SparkSession,
    base: str,
    *,
    infer_schema: bool = False,
    sampling_ratio: float = 1.0,
    since: datetime.date | None = None,
    files: str | None = None,
) -> DataFrame:
    """All records with their folder levels as columns.

    Fields are read as text, since the silver layer casts them; a line that is
    not JSON gives an empty record with the text in ``_corrupt_record``. With
    ``infer_schema`` types are derived from a sample instead, which costs a
    pass over the data. ``since`` skips folders of earlier days; the folder is
    named by the fetch clock, so leave some slack to the load time. ``files``
    takes only files with such names, as ``*.ndjson``.
    """
    reader = spark.read if files is None else spark.read.option("pathGlobFilter", files)
    if infer_schema:
        records = reader.option("samplingRatio", sampling_ratio).json(base)
    else:
        records = reader.schema(BRONZE).json(base)
    return records if since is None else records.where(since_day(since))


def stream_bronze(
    spark: SparkSession, base: str, max_files: int | None = None, files: str | None = None
) -> DataFrame:
    """The lake as a stream of newly landed files, ``files`` as in ``read_bronze``."""
    reader = spark.readStream.schema(BRONZE)
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(base)


def register_bronze(spark: SparkSession, name: str, base: str) -> bool:
    """Name the lake as an external table; an existing table is left as it is.

    Tells whether the table was created.
    """
    if spark.catalog.tableExists(name):
        return False
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in BRONZE)
    levels = ", ".join(LAKE_LEVELS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING json"
        f" PARTITIONED BY ({levels}) LOCATION '{base}'"
    )
    refresh_bronze(spark, name)
    return True


def refresh_bronze(spark: SparkSession, name: str) -> None:
    """Tell the catalog about folders that have landed since."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
