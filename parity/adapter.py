"""Bronze-shaped telemetry derived from the ``events`` table.

Every event becomes one record. A share of the records is made missing, blank
or unreadable by fixed rules on ``event_id``, so that all branches of the
models see data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaportrail.operators.tables import folder_size
from vaportrail.schemas import LOAD_TIME, RECORD
from vaportrail.session import fit_shuffle_to


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    fit_shuffle_to(spark, folder_size(spark, path))
    return spark.read.parquet(path)


# Bronze fields as SQL over the events; ``epoch`` is the event time in whole seconds.
FIELDS = {
    "icao24": """case when event_id % 97 = 0 then null when event_id % 89 = 0 then '  '
        else lower(lpad(hex(user_id), 6, '0')) end""",
    "callsign": """case event_id % 7 when 0 then null when 1 then '' when 2 then ' AB '
        else concat(substring(event_type, 1, 3), user_id, '  ') end""",
    "origin_country": "if(event_id % 61 = 0, null, concat('NATION_', user_id % 25))",
    "time_position": "if(event_id % 59 = 0, null, epoch)",
    "last_contact": "epoch + event_id % 7",
    "longitude": "cast((event_id * 104729) % 360001 as double) / 1e3D - 180",
    "latitude": """case when event_id % 53 = 0 then null when event_id % 71 = 0 then 'n/a'
        else cast(cast((event_id * 7919) % 180001 as double) / 1e3D - 90 as string) end""",
    "baro_altitude": "(event_id * 31) % 13001",
    "on_ground": "case event_id % 3 when 0 then 'true' when 1 then 'false' end",
    "velocity": "value",
    "true_track": "((event_id * 17) % 720) / 2D",
    "squawk": "lpad(cast(event_id % 7778 as string), 4, '0')",
    "spi": "if(event_id % 5 = 0, 'TRUE', 'false')",
    "position_source": "event_id % 4",
    LOAD_TIME: "if(event_id % 83 = 0, 'bad', cast(epoch - epoch % 3600 as string))",
}


def bronze_events(spark: SparkSession, folder: str, *carry: str) -> DataFrame:
    """All events as bronze records; ``carry`` names event columns to keep as well."""
    events = table(spark, folder, "events")
    return events.selectExpr("*", "unix_seconds(cast(ts as timestamp)) as epoch").selectExpr(
        *[
            f"cast({FIELDS.get(field.name, 'null')} as {field.dataType.simpleString()})"
            f" as {field.name}"
            for field in RECORD.fields
        ],
        *carry,
    )
