"""Lake tables: versioned Parquet folders with day partitions and keyed upserts.

A table is a folder of versions. A full rebuild writes a new version and leaves
the old one in place, so readers never see half a table; the newest version
that finished is the current one. Incremental loads change the current version
by appending files or by replacing whole day partitions.

Plain Parquet has no transactions: one writer per table at a time.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence
from contextlib import suppress
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaportrail.operators.watermark import HighWater, largest
from vaportrail.schemas import TableSpec
from vaportrail.session import footer_session, fresh_path, shuffle_width, stored

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Holds the name of the load in tables whose rows are tagged.
LOAD = "_load"
# The table's instant as a number, whose maximum a file's footer tells; of timestamps it does not.
# Spark finds a column's statistics by its place in the file, so it is the first.
MICROS = "_micros"
# Stands for no instant there: files with nulls only have no maximum, and Spark refuses them.
NO_INSTANT = -(2**63)
# Partition values named one by one in a filter; beyond that they are joined.
LISTED_PARTITIONS = 1000


class DuplicateKeyError(ValueError):
    """A batch holds a key twice that the target has already."""


class PublishError(RuntimeError):
    """The file system did not put a folder where it belongs; nothing is lost."""


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a path, none when it does not exist."""
    files, place = _folder(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes under a path."""
    files, place = _folder(spark, path)
    return files.getContentSummary(place).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


def rename_folder(spark: SparkSession, path: str, target: str) -> bool:
    """Ask the file system to rename a folder; False, or an error of its own, when it did not."""
    files, place = _folder(spark, path)
    return files.rename(place, _folder(spark, target)[1])


def has_folder(spark: SparkSession, path: str) -> bool:
    files, place = _folder(spark, path)
    return files.exists(place)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to a name that is free, and see to it that this has happened."""
    if has_folder(spark, target):
        # A rename onto a folder that exists would put the one into the other.
        raise PublishError(f"{target} is in the way of {path}")
    files, place = _folder(spark, target)
    files.mkdirs(place.getParent())
    renamed = rename_folder(spark, path, target)
    if not renamed or has_folder(spark, path) or not has_folder(spark, target):
        raise PublishError(f"{path} could not be renamed to {target}")


def laid_out(df: DataFrame, partition: str | None, cluster: Sequence[str] = ()) -> DataFrame:
    """Rows grouped by partition into files of even size, ordered within each file.

    The rebalance shuffles by partition, so a task writes to few folders, and
    adaptive execution splits a partition that is too large for one task.
    """
    if partition is None:
        return df.hint("rebalance").sortWithinPartitions(*cluster) if cluster else df
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *cluster)


class LakeTable:
    """A table's folder. Besides versions it holds what makes loads repeatable:

    ``done-N=MARK~LOAD~ROWS~TAIL`` names how far the table was filled when its last load had
    finished, that load, the table's rows, and those of the mark's day and later ones; what
    is later than the mark comes from a load that died. ``pending-*`` holds whole
    partitions about to be put in place, ``replaced-*`` those that they replace, until
    all are in place. Found complete after a crash, they are put in place again.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.folder = f"{root.rstrip('/')}/{spec.name}"

    def _versions(self) -> list[str]:
        names = sorted(n for n in list_folder(self.spark, self.folder) if n.startswith("v"))
        return [n for n in names if "_SUCCESS" in list_folder(self.spark, f"{self.folder}/{n}")]

    def exists(self) -> bool:
        return bool(self._versions())

    @property
    def path(self) -> str:
        """Folder of the current version."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"table {self.spec.name} has not been built")
        return f"{self.folder}/{versions[-1]}"

    @property
    def _stored_schema(self) -> T.StructType:
        fields = list(self.spec.schema.fields)
        if self.spec.instant is not None:
            fields.insert(0, T.StructField(MICROS, T.LongType()))
        if self.spec.tagged:
            fields.append(T.StructField(LOAD, T.StringType()))
        if self.spec.partition_from is not None:
            fields.append(T.StructField(self.spec.partition, T.DateType()))
        return T.StructType(fields)

    def _stored(self) -> DataFrame:
        reader = self.spark.read.schema(self._stored_schema)
        stored = reader.parquet(self.path)
        for root, names in self._aside().items():
            more = self.spark.read.schema(self._stored_schema).option("basePath", root)
            stored = stored.unionByName(more.parquet(*[f"{root}/{name}" for name in names]))
        return stored

    def read(self, later_than: HighWater | None = None) -> DataFrame:
        """The table. ``later_than`` skips day folders before a mark on their timestamp."""
        stored = self._stored()
        if later_than is not None:
            stored = stored.where(later_than.on_day_or_later(F.col(self.spec.partition)))
        return stored.select(*self.spec.schema.names)

    def read_since(self, day: str | None) -> DataFrame:
        """Rows of a day and later ones; all rows without a day to start from."""
        stored = self._stored()
        if day is not None:
            stored = stored.where(F.col(self.spec.partition) >= F.lit(day).cast("date"))
        return stored.select(*self.spec.schema.names)

    def _with_day(self, df: DataFrame, load: str | None = None) -> DataFrame:
        df = df.select(*self.spec.schema.names)
        if self.spec.instant is not None:
            df = df.select(F.coalesce(F.unix_micros(self.spec.instant), F.lit(NO_INSTANT)).alias(MICROS), "*")
        if self.spec.tagged:
            df = df.withColumn(LOAD, F.lit(load).cast("string"))
        if self.spec.partition_from is None:
            return df
        return df.withColumn(self.spec.partition, F.to_date(self.spec.partition_from))

    def _write(self, stored_rows: DataFrame, path: str, mode: str) -> None:
        with shuffle_width(stored_rows):
            rows = laid_out(stored_rows, self.spec.partition, self.spec.cluster)
            writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
            if self.spec.partition is not None:
                writer = writer.partitionBy(self.spec.partition)
            writer.parquet(path)

    def _put(self, rows: DataFrame) -> None:
        """Replace the partitions that ``rows`` fill, so that a crash cannot lose any."""
        pending = f"{self.folder}/pending-{uuid.uuid4().hex}"
        self._write(rows, pending, "errorifexists")
        self._publish(pending)

    def _publish(self, pending: str) -> None:
        """Move whole partitions into place, one by one; may be begun again at any point.

        The old partition is renamed, not deleted, and readers find it where it is until
        the new one is in place. Whatever fails on the way, every row is in one of the
        three folders; both copies go only after all new partitions have been seen in place.
        Renaming a folder must be all or nothing, as it is on HDFS and local disks.
        """
        path, aside = self.path, f"{self.folder}/replaced-{_ticket(pending)}"
        names = [n for n in list_folder(self.spark, pending) if self._is_partition(n)]
        # Listed once: asking for each partition takes longer than moving it.
        old, kept_already = set(list_folder(self.spark, path)), set(list_folder(self.spark, aside))
        files, place = _folder(self.spark, aside)
        files.mkdirs(place)
        for name in names:
            place, kept = f"{path}/{name}", f"{aside}/{name}"
            if name in old and name in kept_already:
                raise PublishError(f"{kept} is in the way of {place}")
            if name in old and not rename_folder(self.spark, place, kept):
                raise PublishError(f"{place} could not be renamed to {kept}")
            try:
                if not rename_folder(self.spark, f"{pending}/{name}", place):
                    raise PublishError(f"{pending}/{name} could not be renamed to {place}")
            except Exception:
                self._put_back(kept, place)
                raise
        held = set(list_folder(self.spark, path))
        if missing := [name for name in names if name not in held]:
            raise PublishError(f"{path} lacks {missing}")
        remove_folder(self.spark, pending)
        remove_folder(self.spark, aside)

    def _put_back(self, kept: str, place: str) -> None:
        """Undo a move as far as possible; what stays aside is still read, and recovered later."""
        if has_folder(self.spark, kept) and not has_folder(self.spark, place):
            with suppress(Exception):
                move_folder(self.spark, kept, place)

    def _is_partition(self, name: str) -> bool:
        return self.spec.partition is not None and name.startswith(f"{self.spec.partition}=")

    def recover(self) -> None:
        """Finish or forget what a driver that died left half done; every change begins with it."""
        names = list_folder(self.spark, self.folder)
        pending = [name for name in names if name.startswith("pending-")]
        for name in pending:
            at = f"{self.folder}/{name}"
            if self.exists() and "_SUCCESS" in list_folder(self.spark, at):
                self._publish(at)
            else:
                remove_folder(self.spark, at)
        for name in names:
            if name.startswith("replaced-") and f"pending-{_ticket(name)}" not in pending:
                # All that was to take its place has been seen there.
                remove_folder(self.spark, f"{self.folder}/{name}")

    def _aside(self) -> dict[str, list[str]]:
        """Partitions that a move under way, or one that failed, has for now only in a folder of its own."""
        roots = [n for n in list_folder(self.spark, self.folder) if n.startswith("replaced-")]
        if not roots:
            return {}
        held = {root: list_folder(self.spark, f"{self.folder}/{root}") for root in roots}
        # Listed last: a partition put in place meanwhile is read there.
        placed = set(list_folder(self.spark, self.path))
        left = {root: [n for n in names if self._is_partition(n) and n not in placed] for root, names in held.items()}
        return {f"{self.folder}/{root}": names for root, names in left.items() if names}

    def _marks(self) -> list[tuple[int, str]]:
        names = [n for n in list_folder(self.spark, self.folder) if n.startswith("done-")]
        return sorted((int(n[5:].partition("=")[0]), n) for n in names)

    def finished(
        self, mark: HighWater, load: str | None = None, rows: int | None = None, tail: int | None = None
    ) -> None:
        """Note that the table is filled up to ``mark`` and no load is under way."""
        marks = self._marks()
        number = marks[-1][0] + 1 if marks else 1
        told = ["" if value is None else str(value) for value in (mark.value, load, rows, tail)]
        files, place = _folder(self.spark, f"{self.folder}/done-{number:08d}={'~'.join(told)}")
        files.mkdirs(place)
        for _, name in marks:
            remove_folder(self.spark, f"{self.folder}/{name}")

    def _finished(self) -> list[str] | None:
        marks = self._marks()
        if not marks:
            return None
        told = marks[-1][1].partition("=")[2].split("~")
        return told + [""] * (4 - len(told))

    def finished_mark(self) -> HighWater | None:
        """How far the last finished load came; none where no load has said so."""
        told = self._finished()
        if told is None:
            return None
        value = told[0]
        if "-" in value[1:]:
            return HighWater(datetime.date.fromisoformat(value))
        return HighWater(int(value) if value else None)

    def finished_load(self) -> str | None:
        """The name of the last finished load, if it had one."""
        told = self._finished()
        return told[1] or None if told else None

    def finished_rows(self) -> tuple[int, int] | None:
        """The table's rows after the last finished load, and those of its mark's day and later ones."""
        told = self._finished()
        return (int(told[2]), int(told[3])) if told and told[2] and told[3] else None

    def replace(self, df: DataFrame, load: str | None = None) -> None:
        """Full rebuild into a new version."""
        self.recover()
        numbers = [
            int(name[1:])
            for name in list_folder(self.spark, self.folder)
            if name[:1] == "v" and name[1:].isdigit()
        ]
        version = f"v{max(numbers, default=0) + 1:08d}"
        self._write(self._with_day(df, load), f"{self.folder}/{version}", "errorifexists")

    def replace_partitions(self, df: DataFrame) -> None:
        """Put rows in place of the partitions they belong to; others stay as they are."""
        self.recover()
        self._put(self._with_day(df))

    def drop_old_versions(self, keep: int = 1) -> None:
        """Delete all but the newest versions; no reader may be using the others."""
        for name in self._versions()[:-keep]:
            remove_folder(self.spark, f"{self.folder}/{name}")

    def append(self, df: DataFrame) -> None:
        self.recover()
        self._write(self._with_day(df), self.path, "append")

    def compact(self, *days: datetime.date) -> None:
        """Rewrite day partitions that many small loads have left in many small files."""
        self.recover()
        stored = self._stored().where(_one_of(F.col(self.spec.partition), list(days)))
        self._put(stored)

    def _days(self) -> list[str]:
        """Partition values, the latest first, read from the folder names alone."""
        names = [*list_folder(self.spark, self.path), *chain(*self._aside().values())]
        days = {
            name.removeprefix(f"{self.spec.partition}=")
            for name in names
            if self._is_partition(name) and not name.endswith(NULL_PARTITION)
        }
        return sorted(days, reverse=True)

    def latest_day(self) -> str | None:
        """Largest partition value."""
        return next(iter(self._days()), None)

    def _rows_of(self, day: str | None) -> DataFrame:
        stored = self._stored()
        held = F.lit(False) if day is None else F.col(self.spec.partition) == F.lit(day).cast("date")
        return stored.where(held).select(*self.spec.schema.names)

    def latest_rows(self) -> DataFrame:
        """Rows of the latest day only; no rows when no row has a day."""
        return self._rows_of(self.latest_day())

    def _folders_of(self, day: str | None) -> list[str]:
        """Where the rows of a day are; of a table without days, the table's folder."""
        if self.spec.partition is None:
            return [self.path]
        name = f"{self.spec.partition}={day}"
        roots = [self.path, *(root for root, names in self._aside().items() if name in names)]
        folders = [f"{root}/{name}" for root in roots]
        return [folder for folder in folders if has_folder(self.spark, folder)]

    def footers(self, day: str | None) -> DataFrame:
        """Largest instant (``top``, epoch microseconds) and number of ``rows`` of a day, told by footers.

        Only that day's folder is listed, and no row of it is read.
        """
        schema = T.StructType(self._stored_schema.fields[:1])
        files = footer_session(self.spark).read.schema(schema).parquet(*self._folders_of(day))
        top = F.lit(None).cast("long") if self.spec.instant is None else F.nullif(F.max(MICROS), F.lit(NO_INSTANT))
        return files.agg(top.alias("top"), F.count(F.lit(1)).alias("rows"))

    def high_water(self, column: str, empty_target: str = "admit_none") -> HighWater:
        """Maximum of the partition column, or of the timestamp it is derived from.

        That maximum lies in the latest day that has a value, so as a rule only
        that folder is looked at. Where a day was filled in for rows without a
        timestamp, the days before it are looked at, one after another. Footers tell the day
        and the table's instant; of other columns the rows are read.
        """
        partition, instant = self.spec.partition, self.spec.instant
        for day in self._days() if partition is not None else [None]:
            if column == partition:
                top = datetime.date.fromisoformat(day) if self.footers(day).first()["rows"] else None
            elif column == instant:
                top = self.footers(day).first()["top"]
            else:
                top = largest(self.read() if partition is None else self._rows_of(day), column)
            if top is not None:
                return HighWater(top, empty_target)
        return HighWater(None, empty_target)

    def upsert(self, batch: DataFrame, redo: Column | None = None) -> None:
        """Merge by key: a row with a known key replaces it, any other is added.

        A NULL in a key matches nothing, so such rows are always added. Keys
        determine their partition, hence only partitions the batch touches are
        looked at, and they are rewritten only if a key is known already. Old rows
        that ``redo`` holds for are taken out of those partitions: the batch has them anew.
        """
        self.recover()
        # The batch is read several times below; a stored copy is computed once
        # and outlives lost executors.
        staging = fresh_path(self.spark, f"batch-{self.spec.name}")
        try:
            self._merge(stored(self._with_day(batch), staging), redo)
        finally:
            remove_folder(self.spark, staging)

    def add(self, batch: DataFrame, load: str, redo: Column) -> None:
        """Add all rows of a batch, whatever their keys, in the name of a load.

        Rows that the same load has brought before, and those that ``redo`` holds for, give
        way: adding them again changes nothing. The table's rows must be tagged.
        """
        self.recover()
        staging = fresh_path(self.spark, f"batch-{self.spec.name}")
        try:
            staged = stored(self._with_day(batch, load), staging)
            if staged.isEmpty():
                return
            touched = self._touched(staged)
            gone = F.coalesce((F.col(LOAD) == load) | redo, F.lit(False))
            if touched.where(gone).isEmpty():
                self._write(staged, self.path, "append")
            else:
                names = self._stored_schema.names
                self._put(touched.where(~gone).select(*names).unionByName(staged))
        finally:
            remove_folder(self.spark, staging)

    def _touched(self, staged: DataFrame) -> DataFrame:
        """The table's rows in partitions that the batch has rows for."""
        old, partition = self._stored(), self.spec.partition
        if partition is None:
            return old
        days = staged.select(partition).distinct()
        listed = [row[0] for row in days.limit(LISTED_PARTITIONS + 1).collect()]
        if len(listed) <= LISTED_PARTITIONS:
            return old.where(_one_of(F.col(partition), listed))
        days = days.withColumnRenamed(partition, "_day")
        return old.join(days, F.col(partition).eqNullSafe(F.col("_day")), "left_semi")

    def _merge(self, staged: DataFrame, redo: Column | None) -> None:
        spec = self.spec
        if staged.isEmpty():
            return
        keys = list(spec.keys)
        has_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        counted = staged.where(has_keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        touched = self._touched(staged)
        old = touched if redo is None else touched.where(~F.coalesce(redo, F.lit(False)))
        candidates = old
        if spec.instant is not None:
            # A key fixes its instant, so earlier rows cannot have any key of the batch.
            first = staged.where(has_keys).agg(F.min(F.unix_micros(spec.instant))).first()[0]
            if first is not None:
                candidates = old.where(F.col(spec.instant) >= F.timestamp_micros(F.lit(first)))
        known = candidates.select(*keys).join(counted, keys)
        matched, copies = known.agg(F.count(F.lit(1)), F.max("copies")).first()
        if matched and copies > 1:
            raise DuplicateKeyError(f"{spec.name}: a batch holds a known key {copies} times")
        again = redo is not None and not touched.where(redo).isEmpty()
        if matched == 0 and not again:
            self._write(staged, self.path, "append")
            return
        kept = old.where(has_keys).join(counted.select(*keys), keys, "left_anti")
        # Rows without a key stay as they are and need not meet the batch.
        keyless = old.where(~has_keys)
        names = self._stored_schema.names
        merged = kept.select(*names).unionByName(keyless.select(*names)).unionByName(staged)
        if spec.partition is None:
            self.replace(merged)
        else:
            self._put(merged)


def _ticket(folder: str) -> str:
    """What the folders of one change have in common."""
    return folder.rpartition("/")[2].partition("-")[2]


def _one_of(column: Column, values: list) -> Column:
    """Membership that counts NULL as a value like any other."""
    present = [value for value in values if value is not None]
    member = column.isin(present)
    return member | column.isNull() if None in values else member
