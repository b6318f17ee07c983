"""Airspace polygons: a CSV reader, and the set shipped with the package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaportrail.schemas import SEED

# Id, name and outline (degrees, longitude first) of the known airspaces.
AIRSPACES = (
    ("US_AIR", "United States Airspace",
     "POLYGON((-125.0 24.0, -66.5 24.0, -66.5 49.5, -125.0 49.5, -125.0 24.0))"),
    ("CAN_AIR", "Canadian Airspace",
     "POLYGON((-141.0 49.5, -52.0 49.5, -52.0 83.0, -141.0 83.0, -141.0 49.5))"),
    ("WEU_AIR", "Western European Airspace",
     "POLYGON((-10.0 36.0, 16.0 36.0, 16.0 62.0, -10.0 62.0, -10.0 36.0))"),
    ("EEU_AIR", "Eastern European Airspace",
     "POLYGON((16.0 40.0, 45.0 40.0, 45.0 70.0, 16.0 70.0, 16.0 40.0))"),
    ("GLF_AIR", "Gulf / Middle East Airspace",
     "POLYGON((35.0 12.0, 60.0 12.0, 60.0 35.0, 35.0 35.0, 35.0 12.0))"),
    ("SAS_AIR", "South Asian Airspace",
     "POLYGON((68.0 6.0, 98.0 6.0, 98.0 36.0, 68.0 36.0, 68.0 6.0))"),
    ("EAS_AIR", "East Asian Airspace",
     "POLYGON((100.0 15.0, 145.0 15.0, 145.0 50.0, 100.0 50.0, 100.0 15.0))"),
    ("AFR_AIR", "African Airspace",
     "POLYGON((-18.0 -35.0, 51.0 -35.0, 51.0 37.0, -18.0 37.0, -18.0 -35.0))"),
    ("SAM_AIR", "South American Airspace",
     "POLYGON((-82.0 -56.0, -34.0 -56.0, -34.0 12.0, -82.0 12.0, -82.0 -56.0))"),
    ("OCE_AIR", "Oceania Airspace",
     "POLYGON((110.0 -48.0, 180.0 -48.0, 180.0 -10.0, 110.0 -10.0, 110.0 -48.0))"),
)


def known_airspaces(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AIRSPACES, SEED)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header line; quoted shapes may hold commas."""
    return spark.read.schema(SEED).option("header", True).option("escape", '"').csv(path)
