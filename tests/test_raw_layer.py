import datetime
import json
from pathlib import Path

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from vaportrail.schemas import BRONZE, RECORD
from vaportrail.session import fresh_path
from vaportrail.sources.bronze import (
    read_bronze,
    refresh_bronze,
    register_bronze,
    write_ndjson,
)
from vaportrail.sources.payloads import counted, flatten_states, parse_payloads, read_payloads
from vaportrail.sources.seeds import AIRSPACES, known_airspaces, read_seed

VECTOR = [
    "4b1814", " AAL123 ", "Switzerland", 1780142390, 1780142399, 8.5, 47.25, 1000.0, False,
    210.5, 90.0, -0.5, [1, 2], 1050.0, "1000", False, 0,
]


def moment():
    return F.timestamp_seconds(F.lit(1780124705))  # 2026-05-30 07:05:05


def vector(**changes):
    names = list(RECORD.names)
    slots = list(VECTOR)
    for name, value in changes.items():
        slots[names.index(name)] = value
    return slots


def payload(*vectors, time=1780142400, **more):
    return json.dumps({"time": time, "states": list(vectors), **more})


def flat(spark, *documents, strict=True):
    texts = spark.createDataFrame([(d,) for d in documents], "value string")
    return flatten_states(parse_payloads(texts), strict=strict)


def test_fields(spark):
    row = flat(spark, payload(VECTOR + ["extra slot"])).first()
    assert row.asDict() == {
        "icao24": "4b1814",
        "callsign": "AAL123",
        "origin_country": "Switzerland",
        "time_position": "1780142390",
        "last_contact": "1780142399",
        "longitude": "8.5",
        "latitude": "47.25",
        "baro_altitude": "1000.0",
        "on_ground": "false",
        "velocity": "210.5",
        "true_track": "90.0",
        "vertical_rate": "-0.5",
        "sensors": [1, 2],
        "geo_altitude": "1050.0",
        "squawk": "1000",
        "spi": "false",
        "position_source": "0",
        "_gcs_loaded_at": "1780142400",
    }


def test_defaults(spark):
    rows = flat(
        spark,
        payload(
            vector(callsign="   ", sensors=None),
            vector(callsign="", sensors=[]),
            vector(callsign=None, latitude=None),
        ),
        payload(time=None),
        json.dumps({"time": 1, "states": None}),
        json.dumps({"time": 1}),
    ).collect()
    assert [(r.callsign, r.sensors, r.latitude) for r in rows] == [
        ("", [], "47.25"),
        (None, [], "47.25"),
        (None, [1, 2], None),
    ]


def test_short_vector(spark):
    with pytest.raises(SparkRuntimeException, match="17 slots"):
        flat(spark, payload(VECTOR[:16])).collect()
    row = flat(spark, payload(VECTOR[:16]), strict=False).first()
    assert row.icao24 == "4b1814" and row.position_source is None


def test_documents_by_file_and_by_line(spark, tmp_path):
    document = json.dumps(json.loads(payload(VECTOR, VECTOR)), indent=2)
    (tmp_path / "files").mkdir()
    for name in "ab":
        (tmp_path / "files" / f"{name}.json").write_text(document)
    assert flatten_states(read_payloads(spark, str(tmp_path / "files"))).count() == 4
    (tmp_path / "lines.txt").write_text(payload(VECTOR) + "\n" + payload(VECTOR, VECTOR))
    lines = read_payloads(spark, str(tmp_path / "lines.txt"), per_line=True)
    assert flatten_states(lines).count() == 3


def test_ndjson_round_trip(spark):
    base = fresh_path(spark, "test-raw")
    records, observation = counted(flat(spark, payload(VECTOR, vector(callsign=None))))
    write_ndjson(records, base, moment())
    assert observation.get["records"] == 2
    (folder,) = Path(base).glob("year=*/month=*/day=*/hour=*")
    assert str(folder).endswith("year=2026/month=05/day=30/hour=07")
    lines = [json.loads(t) for f in folder.glob("part-*") for t in f.read_text().splitlines()]
    assert sorted(lines[0]) == sorted(RECORD.names)
    assert [line["callsign"] for line in lines] == ["AAL123", None]

    (folder / "more.ndjson").write_text('{"icao24": "x", "latitude": 1.50}\n{broken\n')
    found = read_bronze(spark, base)
    assert found.schema == BRONZE
    rows = found.orderBy("icao24").collect()
    assert [(r.icao24, r.latitude, r._corrupt_record) for r in rows] == [
        (None, None, "{broken"),
        ("4b1814", "47.25", None),
        ("4b1814", "47.25", None),
        ("x", "1.50", None),
    ]
    assert {(r.year, r.month, r.day, r.hour) for r in rows} == {(2026, 5, 30, 7)}
    assert read_bronze(spark, base, since=datetime.date(2026, 5, 31)).count() == 0
    assert read_bronze(spark, base, since=datetime.date(2026, 5, 30)).count() == 4

    inferred = read_bronze(spark, base, infer_schema=True)
    assert dict(inferred.dtypes)["sensors"] == "array<bigint>"
    assert inferred.where("icao24 = 'x'").count() == 1


def test_folder_filter_prunes(spark):
    base = fresh_path(spark, "test-raw")
    write_ndjson(flat(spark, payload(VECTOR)), base, moment())
    plan = read_bronze(spark, base, since=datetime.date(2026, 5, 30))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "make_date" in text.split("PartitionFilters")[1]


def test_external_table(spark):
    base = fresh_path(spark, "test-raw")
    write_ndjson(flat(spark, payload(VECTOR, VECTOR)), base, moment())
    assert register_bronze(spark, "raw_flights", base)
    assert not register_bronze(spark, "raw_flights", base + "-other")
    table = spark.table("raw_flights")
    assert table.count() == 2
    assert table.where("year = 2026 and hour = 7").count() == 2
    assert table.where("hour = 8").count() == 0
    write_ndjson(flat(spark, payload(VECTOR)), base, moment() + F.expr("interval 1 hour"))
    refresh_bronze(spark, "raw_flights")
    assert spark.table("raw_flights").where("hour = 8").count() == 1
    spark.sql("DROP TABLE raw_flights")


def test_seed_file(spark, tmp_path):
    lines = ["airspace_id,airspace_name,wkt_geometry"]
    lines += [f'{key},{name},"{shape}"' for key, name, shape in AIRSPACES]
    (tmp_path / "seed.csv").write_text("\n".join(lines) + "\n")
    found = read_seed(spark, str(tmp_path / "seed.csv"))
    assert sorted(found.collect()) == sorted(known_airspaces(spark).collect())
