import datetime
import hashlib

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from vaportrail.functions import casts, instants, keys, numbers, text


def values(spark, kind, items, expression):
    df = spark.createDataFrame([(i, item) for i, item in enumerate(items)], f"i int, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).collect()
    return [row.y for row in sorted(rows)]


def test_doubles(spark):
    found = values(spark, "string", ["1.5", "1d", "2F", "n/a", None, "-3e2"], casts.safe_double)
    assert found == [1.5, None, None, None, None, -300.0]
    assert values(spark, "string", ["inf", "-Infinity"], casts.safe_double) == [
        float("inf"),
        float("-inf"),
    ]
    (nan,) = values(spark, "string", ["NaN"], casts.safe_double)
    assert nan != nan


def test_whole_numbers(spark):
    items = ["12", "9223372036854775807", "1.5", "-2.5", "1e30", "NaN", "5d", "x", "", None]
    assert values(spark, "string", items, casts.safe_long) == [
        12,
        9223372036854775807,
        2,
        -3,
        None,
        None,
        None,
        None,
        None,
        None,
    ]


def test_booleans_know_two_words(spark):
    items = ["TRUE", "false", "yes", "t", "1", "", None]
    assert values(spark, "string", items, casts.safe_boolean) == [True, False] + [None] * 5


def test_epochs(spark):
    seconds = [0, 1780142400, None, 253402300800, 9223372036854775807]
    found = values(
        spark, "bigint", seconds, lambda x: instants.instant_text(instants.instant_or_null(x))
    )
    assert found == ["1970-01-01 00:00:00+00", "2026-05-30 12:00:00+00", None, None, None]
    fails = spark.createDataFrame([(9223372036854775807,)], "x bigint")
    with pytest.raises(SparkRuntimeException, match="out of range"):
        fails.select(instants.instant_or_fail(F.col("x"))).collect()


def test_clock(spark):
    moment = F.timestamp_seconds(F.lit(1780124705))
    row = spark.range(1).select(
        *[part.alias(name) for name, part in instants.clock_parts(moment).items()],
        instants.file_stamp(moment).alias("stamp"),
        F.unix_seconds(instants.hour_start(moment)).alias("hour_start"),
    )
    assert row.first() == ("2026", "05", "30", "07", "20260530_070505", 1780124400)


def test_trim_takes_all_white_space(spark):
    items = ["\tual1　", " ", " a b ", None]
    assert values(spark, "string", items, text.trim_space) == ["ual1", "", "a b", None]


def test_callsign_rule(spark):
    items = ["   ", "", None, " AAL123 ", "\x1cX\x1f"]
    assert values(spark, "string", items, text.strip_callsign) == ["", None, None, "AAL123", "X"]


def test_carrier(spark):
    items = ["ab", "dal42", None, "\tual1\t", "   ", "12x"]
    assert values(spark, "string", items, text.carrier_code) == [
        "UNKNOWN_CARRIER",
        "DAL",
        "UNKNOWN_CARRIER",
        "UAL",
        "UNKNOWN_CARRIER",
        "12X",
    ]


def test_rounding(spark):
    found = values(spark, "double", [-0.04, 12.25, -12.25, None], numbers.round_tenth)
    assert found == [0.0, 12.3, -12.3, None]
    assert str(found[0]) == "0.0"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_keys(spark):
    moment = F.timestamp_seconds(F.lit(1780142400))
    nothing = F.lit(None).cast("string")
    row = spark.range(1).select(
        keys.snapshot_key(F.lit("abc"), moment),
        keys.snapshot_key(nothing, moment),
        keys.log_key(nothing, F.lit("12"), nothing),
        keys.aggregation_key(F.lit(datetime.date(2026, 5, 30)), nothing, F.lit("DAL")),
        keys.aggregation_key(nothing.cast("date"), F.lit("FR"), F.lit("DAL")),
    )
    assert row.first() == (
        md5("abc2026-05-30 12:00:00+00"),
        None,
        md5("12"),
        md5("2026-05-30DAL"),
        None,
    )


def test_shuffle_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    from vaportrail import session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(1000).selectExpr("id", "uuid() as u")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    try:
        with session.shuffle_width(stored):
            assert spark.conf.get("spark.sql.shuffle.partitions") == before
        monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
        with session.shuffle_width(stored.groupBy("u").count()):
            wide = spark.conf.get("spark.sql.shuffle.partitions")
            with session.shuffle_width(spark.createDataFrame([(1,)], "a int")):
                assert spark.conf.get("spark.sql.shuffle.partitions") == wide
        assert int(wide) > int(before)
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
