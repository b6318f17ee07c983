"""Snapshot payloads: documents ``{time, states}`` and their flat records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaportrail.functions.text import strip_callsign
from vaportrail.schemas import LOAD_TIME, PAYLOAD, RECORD, STATE_SLOTS


def read_payloads(spark: SparkSession, path: str, *, per_line: bool = False) -> DataFrame:
    """Landed documents as ``(time, states)``: one per file, or one per line."""
    return parse_payloads(spark.read.text(path, wholetext=not per_line))


def stream_payloads(spark: SparkSession, path: str, *, per_line: bool = False) -> DataFrame:
    """The same as a stream that picks up new files."""
    reader = spark.readStream.format("text").option("wholetext", not per_line)
    return parse_payloads(reader.load(path))


def parse_payloads(documents: DataFrame, column: str = "value") -> DataFrame:
    parsed = F.from_json(F.col(column), PAYLOAD)
    return documents.select(parsed.alias("payload")).select("payload.time", "payload.states")


def flatten_states(payloads: DataFrame, *, strict: bool = True) -> DataFrame:
    """One record per state vector; the payload time is copied to each.

    Vectors have 17 slots by position; further ones are ignored. A shorter
    vector fails the job, or with ``strict=False`` leaves its last fields NULL.
    """
    vectors = payloads.select(
        F.col("time"), F.explode(F.coalesce("states", F.array())).alias("slots")
    )
    if strict:
        short = F.coalesce(F.size("slots") < len(STATE_SLOTS), F.lit(True))
        message = F.lit(f"a state vector has fewer than {len(STATE_SLOTS)} slots")
        checked = F.when(short, F.raise_error(message).cast("array<string>"))
        vectors = vectors.select("time", checked.otherwise(F.col("slots")).alias("slots"))
    slot = {name: F.get("slots", position) for position, name in enumerate(STATE_SLOTS)}
    slot["callsign"] = strip_callsign(slot["callsign"])
    slot["sensors"] = F.coalesce(
        F.from_json(slot["sensors"], RECORD["sensors"].dataType), F.array().cast("array<int>")
    )
    return vectors.select(
        *[value.alias(name) for name, value in slot.items()], F.col("time").alias(LOAD_TIME)
    )


def counted(records: DataFrame, label: str = "load") -> tuple[DataFrame, Observation]:
    """Count the records as they pass; read ``observation.get["records"]`` after the write."""
    observation = Observation(label)
    return records.observe(observation, F.count(F.lit(1)).alias("records")), observation
