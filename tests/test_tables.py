import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaportrail.operators.tables import DuplicateKeyError, LakeTable
from vaportrail.schemas import TableSpec
from vaportrail.session import fresh_path

DAY1, DAY2, DAY3 = (datetime.date(2026, 5, d) for d in (1, 2, 3))
SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("v", T.IntegerType()),
        T.StructField("day", T.DateType()),
    ]
)
SPEC = TableSpec("t", SCHEMA, keys=("k",), partition="day", cluster=("v",))


@pytest.fixture
def table(spark):
    def make(*rows, spec=SPEC):
        made = LakeTable(spark, fresh_path(spark, "test-table"), spec)
        made.replace(spark.createDataFrame(list(rows), SCHEMA))
        return made

    return make


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


def files_of(table):
    return {p.name for p in Path(table.path).rglob("part-*")}


def test_upsert_replaces_and_adds(spark, table):
    t = table(("a", 1, DAY1), ("b", 2, DAY1), ("c", 3, DAY2))
    untouched = {p for p in files_of(t) if any(Path(t.path).glob(f"day={DAY2}/{p}"))}
    t.upsert(batch(spark, ("a", 10, DAY1), ("d", 4, DAY3)))
    assert rows_of(t) == [("a", 10, DAY1), ("b", 2, DAY1), ("c", 3, DAY2), ("d", 4, DAY3)]
    assert untouched <= files_of(t)


def test_new_keys_only_append(spark, table):
    t = table(("a", 1, DAY1))
    before = files_of(t)
    t.upsert(batch(spark, ("b", 2, DAY1), ("b", 3, DAY1)))
    assert before <= files_of(t)
    assert rows_of(t) == [("a", 1, DAY1), ("b", 2, DAY1), ("b", 3, DAY1)]


def test_empty_batch(spark, table):
    t = table(("a", 1, DAY1))
    t.upsert(batch(spark))
    assert rows_of(t) == [("a", 1, DAY1)]


def test_known_key_twice_is_refused(spark, table):
    t = table(("a", 1, DAY1))
    with pytest.raises(DuplicateKeyError):
        t.upsert(batch(spark, ("a", 2, DAY1), ("a", 3, DAY1)))
    assert rows_of(t) == [("a", 1, DAY1)]


def test_null_keys_always_add(spark, table):
    t = table((None, 1, DAY1), ("a", 1, DAY1))
    t.upsert(batch(spark, (None, 2, DAY1), ("a", 5, DAY1)))
    assert rows_of(t) == sorted(
        [("a", 5, DAY1), (None, 1, DAY1), (None, 2, DAY1)], key=repr
    )


def test_null_partition_keeps_its_rows(spark, table):
    t = table(("a", 1, None), ("b", 2, None), ("c", 3, DAY1))
    t.upsert(batch(spark, ("a", 10, None)))
    assert rows_of(t) == sorted([("a", 10, None), ("b", 2, None), ("c", 3, DAY1)], key=repr)


def test_without_partition(spark, table):
    spec = TableSpec("t", SCHEMA, keys=("k",))
    t = table(("a", 1, DAY1), ("b", 2, DAY1), spec=spec)
    t.upsert(batch(spark, ("a", 10, DAY2)))
    assert rows_of(t) == [("a", 10, DAY2), ("b", 2, DAY1)]


def test_rebuild_makes_a_new_version(spark, table):
    t = table(("a", 1, DAY1))
    first = t.path
    earlier = spark.read.schema(SCHEMA).parquet(first)
    t.replace(t.read().withColumn("v", F.col("v") + 1))
    assert t.path != first
    assert rows_of(t) == [("a", 2, DAY1)]
    assert earlier.collect() == [("a", 1, DAY1)]
    # A version that did not finish is not read.
    (Path(t.folder) / "v00000099").mkdir()
    assert rows_of(t) == [("a", 2, DAY1)]
    t.replace(batch(spark))
    assert rows_of(t) == []
    t.drop_old_versions()
    assert len(t._versions()) == 1


def test_compaction(spark, table):
    t = table(("a", 1, DAY1), ("c", 3, DAY2))
    for i in range(3):
        t.upsert(batch(spark, (f"n{i}", i, DAY1)))
    before = rows_of(t)
    assert len(list(Path(t.path).glob(f"day={DAY1}/part-*.parquet"))) == 4
    t.compact(DAY1)
    assert len(list(Path(t.path).glob(f"day={DAY1}/part-*.parquet"))) == 1
    assert rows_of(t) == before


def test_missing_table(spark):
    t = LakeTable(spark, fresh_path(spark, "test-table"), SPEC)
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()


def test_high_water_reads_the_last_day(spark, table):
    t = table(("a", 1, DAY1), ("b", 2, DAY3), ("c", 3, None))
    assert t.latest_day() == str(DAY3)
    assert t.high_water("day").value == DAY3
    assert [r.k for r in t.latest_rows().collect()] == ["b"]
    assert table(("c", 3, None)).high_water("day").value is None
    assert table().high_water("day").value is None


def test_high_water_past_a_day_without_instants(spark):
    schema = T.StructType(
        [T.StructField("at", T.TimestampType()), T.StructField("day", T.DateType())]
    )
    t = LakeTable(spark, fresh_path(spark, "test-table"), TableSpec("u", schema, partition="day"))
    rows = spark.range(1).selectExpr(
        "inline(array(struct(timestamp_seconds(86400), date'1970-01-02'),"
        " struct(cast(null as timestamp), date'2026-01-01')))"
    )
    t.replace(rows.toDF("at", "day"))
    assert t.high_water("at").value == 86400_000_000


INSTANTS = TableSpec(
    "u",
    T.StructType(
        [
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("k", T.LongType()),
            T.StructField("at", T.TimestampType()),
        ]
    ),
    keys=("k",),
    partition="load_date",
    partition_from="at",
    cluster=("k",),
    instant="at",
    tagged=True,
)


def instants(spark, *seconds):
    rows = spark.createDataFrame([(None if s is None else float(s), i) for i, s in enumerate(seconds)], "s double, k long")
    at = F.timestamp_micros((F.col("s") * 1_000_000).cast("long"))
    return rows.select(F.array(F.lit("x"), F.lit("y")).alias("words"), F.col("k") + 10**18, at.alias("at")).toDF("words", "k", "at")


def test_marks_come_from_footers(spark):
    """The mark's plan has the aggregates pushed down; it lists the latest day alone and reads no row."""
    t = LakeTable(spark, fresh_path(spark, "test-table"), INSTANTS)
    # Times before 1970 and below a second, and a row without any.
    t.replace(instants(spark, -86400.25, 5.5, 86400 + 0.000123, 86400, None))
    assert t.read().columns == ["words", "k", "at"]
    assert t.high_water("at").value == 86400_000_123 == t.read().agg(F.max(F.unix_micros("at"))).first()[0]
    assert t.high_water("load_date").value == datetime.date(1970, 1, 2)
    found = t.footers(t.latest_day())
    assert tuple(found.first()) == (86400_000_123, 2)
    plan = found._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(_micros), COUNT(*)]" in plan
    # The days before the latest may be unreadable, and the mark is there all the same.
    spoilt = [part for part in Path(t.path).glob("load_date=*/part-*.parquet") if t.latest_day() not in str(part)]
    assert len(spoilt) >= 3
    for part in spoilt:
        part.write_bytes(b"no longer parquet")
    assert t.high_water("at").value == 86400_000_123


def test_marks_after_each_kind_of_change(spark):
    t = LakeTable(spark, fresh_path(spark, "test-table"), INSTANTS)
    t.replace(instants(spark, None))
    assert t.high_water("at").value is None
    t.append(instants(spark, 100, 7))
    assert t.high_water("at").value == 100_000_000
    # A known key is replaced, so its day is rewritten.
    t.upsert(instants(spark, 300))
    assert t.high_water("at").value == 300_000_000
    t.add(instants(spark, 400), "load", F.lit(False))
    t.add(instants(spark, 350), "load", F.lit(False))
    assert t.high_water("at").value == 350_000_000
    t.compact(datetime.date(1970, 1, 1))
    assert t.high_water("at").value == 350_000_000
    assert t.footers("1970-01-01").first()["rows"] == t.read().where("at is not null").count()


def test_mark_of_a_day_that_lies_aside(spark):
    t = LakeTable(spark, fresh_path(spark, "test-table"), INSTANTS)
    t.replace(instants(spark, 1, 86401))
    aside = Path(t.folder) / "replaced-x"
    aside.mkdir()
    (Path(t.path) / "load_date=1970-01-02").rename(aside / "load_date=1970-01-02")
    assert t.high_water("at").value == 86401_000_000


def test_marks_leave_the_session_alone(spark, table):
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    t = table(("a", 1, DAY1))
    t.high_water("day")
    assert before == {k: spark.conf.get(k) for k in before}
    assert "FileScan parquet" in t.read()._jdf.queryExecution().executedPlan().toString()


def test_mark_of_a_table_without_days(spark):
    spec = TableSpec("u", INSTANTS.schema, keys=("k",), instant="at")
    t = LakeTable(spark, fresh_path(spark, "test-table"), spec)
    t.replace(instants(spark))
    assert t.high_water("at").value is None
    t.replace(instants(spark, 3, None, 2))
    assert t.high_water("at").value == 3_000_000


def test_day_from_timestamp(spark):
    schema = T.StructType([T.StructField("at", T.TimestampType())])
    spec = TableSpec("u", schema, partition="load_date", partition_from="at")
    t = LakeTable(spark, fresh_path(spark, "test-table"), spec)
    t.replace(spark.createDataFrame([(86400 * i,) for i in range(3)], "s long").select(
        F.timestamp_seconds("s").alias("at")
    ))
    assert t.read().columns == ["at"]
    names = sorted(p.name for p in Path(t.path).glob("load_date=*"))
    assert names == ["load_date=1970-01-01", "load_date=1970-01-02", "load_date=1970-01-03"]
    mark = t.high_water("at")
    assert mark.value == 2 * 86400_000_000
    pruned = t.read(later_than=mark)
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "1970-01-03" in plan.split("PartitionFilters")[1].split("]")[0]


def test_files_are_ordered_by_cluster(spark, table):
    t = table(*[(str(i), (i * 37) % 101, DAY1) for i in range(300)])
    for part in Path(t.path).glob("day=*/part-*.parquet"):
        values = [r.v for r in spark.read.parquet(str(part)).collect()]
        assert values == sorted(values)


def test_a_large_day_is_split(spark, table):
    """One day with nearly all rows must not become one task."""
    t = LakeTable(spark, fresh_path(spark, "test-table"), SPEC)
    rows = spark.range(0, 200_000, 1, 8).select(
        F.uuid().alias("k"),
        F.col("id").cast("int").alias("v"),
        F.when(F.col("id") % 50 == 0, F.lit(DAY1)).otherwise(F.lit(DAY2)).alias("day"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        t.replace(rows)
    finally:
        spark.conf.unset(key)
    assert len(list(Path(t.path).glob(f"day={DAY2}/part-*.parquet"))) > 2
    assert t.read().count() == 200_000


def test_partitions_under_way_are_put_in_place(spark, table):
    """A driver that died between taking a day away and putting the new one there loses nothing."""
    t = table(("a", 1, DAY1), ("b", 2, DAY2))
    pending = f"{t.folder}/pending-x"
    t._write(t._stored().where(F.col("day") == DAY1).withColumn("v", F.lit(7)), pending, "errorifexists")
    torn = f"{t.folder}/pending-y"
    t._write(batch(spark, ("z", 9, DAY2)), torn, "errorifexists")
    (Path(torn) / "_SUCCESS").unlink()
    import shutil

    shutil.rmtree(f"{t.path}/day={DAY1}")
    t.recover()
    assert rows_of(t) == [("a", 7, DAY1), ("b", 2, DAY2)]
    assert not list(Path(t.folder).glob("pending-*"))


def test_redo_takes_rows_out(spark, table):
    t = table(("a", 1, DAY1), (None, 5, DAY1), ("b", 2, DAY2))
    t.upsert(batch(spark, ("c", 6, DAY1)), F.col("v") >= 5)
    assert rows_of(t) == [("a", 1, DAY1), ("b", 2, DAY2), ("c", 6, DAY1)]


def test_many_partitions_are_joined(spark, table, monkeypatch):
    from vaportrail.operators import tables

    monkeypatch.setattr(tables, "LISTED_PARTITIONS", 1)
    t = table(("a", 1, DAY1), ("b", 2, DAY2), ("n", 3, None))
    t.upsert(batch(spark, ("a", 10, DAY1), ("b", 20, DAY2), ("n", 30, None)))
    assert rows_of(t) == [("a", 10, DAY1), ("b", 20, DAY2), ("n", 30, None)]


def test_marks_of_finished_loads(spark, table):
    from vaportrail.operators.watermark import HighWater

    t = table(("a", 1, DAY1))
    assert t.finished_mark() is None
    for value in (None, -5, 1_700_000_000_000_000, DAY2):
        t.finished(HighWater(value))
        assert t.finished_mark().value == value
    assert len(t._marks()) == 1


def test_staging_goes_also_when_an_upsert_fails(spark, table, monkeypatch):
    from vaportrail.operators import tables

    path = fresh_path(spark, "test-staging")
    monkeypatch.setattr(tables, "fresh_path", lambda spark, label: path)
    t = table(("a", 1, DAY1))
    with pytest.raises(DuplicateKeyError):
        t.upsert(batch(spark, ("a", 2, DAY1), ("a", 3, DAY1)))
    assert not Path(path.removeprefix("file:")).exists()


def _failing_rename(tables, monkeypatch, step, how):
    """Let one rename fail: by False or an error, before or after the folder has moved."""
    real, calls = tables.rename_folder, []

    def rename(spark, path, target):
        calls.append((path, target))
        if len(calls) != step:
            return real(spark, path, target)
        if "after" in how:
            real(spark, path, target)
        if "raises" in how:
            raise OSError("the file system is gone")
        return False

    monkeypatch.setattr(tables, "rename_folder", rename)
    return calls


@pytest.mark.parametrize("how", ["false", "raises", "false after", "raises after"])
@pytest.mark.parametrize("step", [1, 2, 3, 4])
def test_no_row_is_lost_when_a_rename_fails(spark, table, monkeypatch, step, how):
    """Two days are replaced by four renames; one of them, or also the undoing of it, goes wrong."""
    from vaportrail.operators import tables

    t = table(("a", 1, DAY1), ("b", 2, DAY1), ("c", 3, DAY2), ("d", 4, DAY3))
    change = batch(spark, ("a", 10, DAY1), ("c", 30, DAY2), ("e", 5, DAY2))
    with monkeypatch.context() as patch:
        calls = _failing_rename(tables, patch, step, how)
        with pytest.raises((tables.PublishError, OSError)):
            t.upsert(change)
        assert len(calls) >= step
        # Readers find every key at any time, in old rows or new ones.
        again = LakeTable(spark, t.folder.rpartition("/")[0], SPEC)
        assert {"a", "b", "c", "d"} <= {row[0] for row in rows_of(again)}
        assert len(rows_of(again)) == len({row[0] for row in rows_of(again)})
        assert again.latest_day() == str(DAY3)
    # The next change finishes the one before.
    again.upsert(batch(spark, ("f", 6, DAY3)))
    expected = [("a", 10, DAY1), ("b", 2, DAY1), ("c", 30, DAY2), ("d", 4, DAY3), ("e", 5, DAY2), ("f", 6, DAY3)]
    assert rows_of(again) == expected
    assert not [*Path(t.folder).glob("pending-*"), *Path(t.folder).glob("replaced-*")]


@pytest.mark.parametrize("step", [1, 2, 3])
def test_no_row_is_lost_when_the_driver_dies(spark, table, monkeypatch, step):
    """Nothing is undone then: a day may be in the folder aside only."""
    from vaportrail.operators import tables

    t = table(("a", 1, DAY1), ("b", 2, DAY1), ("c", 3, DAY2))
    with monkeypatch.context() as patch:
        patch.setattr(LakeTable, "_put_back", lambda *_: None)
        _failing_rename(tables, patch, step, "false")
        with pytest.raises(tables.PublishError):
            t.upsert(batch(spark, ("a", 10, DAY1), ("c", 30, DAY2)))
    assert {row[0] for row in rows_of(t)} == {"a", "b", "c"}
    assert t.high_water("day").value == DAY2
    t.recover()
    assert rows_of(t) == [("a", 10, DAY1), ("b", 2, DAY1), ("c", 30, DAY2)]


def test_a_folder_in_the_way_is_left_alone(spark, table):
    from vaportrail.operators.tables import PublishError, move_folder

    t = table(("a", 1, DAY1), ("b", 2, DAY2))
    with pytest.raises(PublishError):
        move_folder(spark, f"{t.path}/day={DAY1}", f"{t.path}/day={DAY2}")
    assert rows_of(t) == [("a", 1, DAY1), ("b", 2, DAY2)]


def test_copies_that_were_not_removed(spark, table):
    """A driver that died between removing the one copy and the other."""
    t = table(("a", 1, DAY1), ("b", 2, DAY2))
    old = Path(t.folder) / "replaced-z"
    (old / f"day={DAY1}").mkdir(parents=True)
    assert rows_of(t) == [("a", 1, DAY1), ("b", 2, DAY2)]
    t.recover()
    assert not old.exists() and rows_of(t) == [("a", 1, DAY1), ("b", 2, DAY2)]
