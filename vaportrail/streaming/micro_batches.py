"""Structured Streaming: the same models, run once per micro-batch of landed files."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from vaportrail.operators.tables import remove_folder
from vaportrail.plans.medallion import Lake
from vaportrail.schemas import FLIGHTS_TABLE
from vaportrail.session import fresh_path
from vaportrail.sources.bronze import stream_bronze
from vaportrail.sources.payloads import counted, flatten_states, stream_payloads

LOG = logging.getLogger(__name__)
EVERY_TEN_MINUTES = {"processingTime": "10 minutes"}
ONCE = {"availableNow": True}


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, str], object],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Call ``handle`` with every micro-batch and its name, which no other batch of any stream has.

    A batch may be handed over again after a failure, under the same name. Tables note the name with
    a finished load, so a batch that was done changes nothing, and one that was half done is done anew.
    """
    started, names = threading.Event(), []

    def named(batch: DataFrame, number: int) -> None:
        started.wait()
        handle(batch, f"{names[0]}.{number}")

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_TEN_MINUTES))
        .start()
    )
    # A stream keeps its id with its checkpoint; a new checkpoint is another stream.
    names.append(query.id)
    started.set()
    return query


def stream_lake(
    lake: Lake,
    base: str,
    seed: DataFrame,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    max_files: int | None = None,
    report: Callable[[DataFrame], object] | None = None,
) -> StreamingQuery:
    """Keep all tables up to date with the raw lake under ``base``.

    A snapshot lies in several files, and a batch may end between them, so every
    batch takes the newest snapshot loaded once more together with what is later.
    Each build's report goes to ``report``, by default to the lake's ``build_reports``.
    """
    told = report or lake.keep_report

    def build(batch: DataFrame, name: str) -> None:
        # Several models read the batch: it is parsed once.
        staged = fresh_path(lake.spark, "stream-batch")
        try:
            batch.write.parquet(staged)
            batch = lake.spark.read.schema(batch.schema).parquet(staged)
            told(lake.build(batch, seed, split=True, load=name))
        finally:
            remove_folder(lake.spark, staged)

    return run_batches(stream_bronze(lake.spark, base, max_files), build, checkpoint, trigger)


def stream_flights(
    lake: Lake,
    base: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Keep only the silver flights up to date, in the same way."""
    return run_batches(
        stream_bronze(lake.spark, base, max_files),
        lambda batch, name: lake.load_flights(batch, split=True, load=name),
        checkpoint,
        trigger,
    )


def stream_landing(
    spark: SparkSession,
    landing: str,
    write: Callable[[DataFrame], None],
    checkpoint: str,
    *,
    trigger: dict | None = None,
    per_line: bool = False,
    loaded: Callable[[int], object] | None = None,
) -> StreamingQuery:
    """Flatten newly landed payload documents and hand them to a raw-lake writer.

    ``loaded`` is told how many records each batch wrote; by default the log is.
    """
    told = loaded or (lambda records: LOG.info("%d records landed", records))

    def land(batch: DataFrame, _: str) -> None:
        records, observation = counted(batch)
        write(records)
        told(observation.get["records"])

    payloads = stream_payloads(spark, landing, per_line=per_line)
    return run_batches(flatten_states(payloads), land, checkpoint, trigger)


def recent_flights_once(flights: DataFrame, lateness: str) -> DataFrame:
    """Streaming dedup by state instead of by target: forgets keys older than ``lateness``."""
    return flights.withWatermark("loaded_at_timestamp", lateness).dropDuplicatesWithinWatermark(
        list(FLIGHTS_TABLE.keys)
    )
