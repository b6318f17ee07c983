"""The whole build: models in dependency order, with data tests as gates."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.operators.checks import Check
from vaportrail.operators.spatial import DEFAULTS, PolygonIndex, SpatialOptions, open_index
from vaportrail.operators.tables import LakeTable, list_folder, remove_folder
from vaportrail.operators.watermark import HighWater
from vaportrail.plans.gold import (
    active_flight_inventory,
    airspace_index,
    airspaces_digest,
    daily_fleet_utilization,
    flight_snapshots,
    hourly_traffic_heatmap,
    spatial_airspaces,
)
from vaportrail.plans.silver import (
    ERROR_REASONS,
    latest_contacts,
    quality_logs,
    stg_flights,
    typed_flights,
)
from vaportrail.schemas import (
    AIRSPACE_TABLE,
    FLEET_TABLE,
    FLIGHTS,
    FLIGHTS_TABLE,
    HEATMAP_TABLE,
    INVENTORY_TABLE,
    QUALITY_TABLE,
    SNAPSHOT_TABLE,
    SNAPSHOTS,
    TableSpec,
)
from vaportrail.session import configure

GATES = ("skip", "record", "raise")
TABLES = (
    FLIGHTS_TABLE,
    QUALITY_TABLE,
    AIRSPACE_TABLE,
    SNAPSHOT_TABLE,
    INVENTORY_TABLE,
    HEATMAP_TABLE,
    FLEET_TABLE,
)
CHECKS = {
    QUALITY_TABLE.name: (
        Check("unique", "log_id"),
        Check("not_null", "log_id"),
        Check("accepted_values", "primary_error_reason", ERROR_REASONS),
    ),
    SNAPSHOT_TABLE.name: (Check("unique", "snapshot_id"), Check("not_null", "snapshot_id")),
}
# Models of one wave do not depend on each other.
WAVES = (
    (FLIGHTS_TABLE, QUALITY_TABLE, AIRSPACE_TABLE),
    (SNAPSHOT_TABLE,),
    (INVENTORY_TABLE, HEATMAP_TABLE, FLEET_TABLE),
)
DEPENDS_ON = {
    SNAPSHOT_TABLE.name: (FLIGHTS_TABLE.name, AIRSPACE_TABLE.name),
    INVENTORY_TABLE.name: (SNAPSHOT_TABLE.name,),
    HEATMAP_TABLE.name: (SNAPSHOT_TABLE.name,),
    FLEET_TABLE.name: (SNAPSHOT_TABLE.name,),
}
RESULT = "step string, model string, status string, rows bigint"


class CheckFailed(RuntimeError):
    """A data test found failing rows and the gate is ``raise``."""


def _at(rows: DataFrame, mark: HighWater, column: str) -> DataFrame:
    """Rows of the marked instant itself."""
    return rows.where(mark.same_or_later(F.col(column)) & ~mark.later(F.col(column)))


def _content(flights: DataFrame) -> tuple:
    """What flight records with a key amount to, as flights or as snapshots."""
    shared = [name for name in FLIGHTS.names if name in SNAPSHOTS.names]
    keyed = flights.where(F.col("icao24").isNotNull()).select(F.xxhash64(*shared).alias("h"))
    return tuple(keyed.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first())


@dataclass
class Lake:
    """The tables of one lake and how to load them.

    ``gate`` says what a failed data test does: ``skip`` leaves out the models
    that depend on the tested one, ``record`` only reports, ``raise`` stops.
    ``empty_target`` decides whether a table that exists without rows can be
    filled by an incremental load: by default it cannot, since nothing is later
    than the maximum of no rows. Models that do not depend on each other are
    built side by side by up to ``threads`` driver threads. Of a table that is
    rebuilt, the newest ``keep_versions`` stay, so that running readers finish.
    """

    spark: SparkSession
    root: str
    gate: str = "skip"
    empty_target: str = "admit_none"
    as_of_date: datetime.date | None = None
    options: SpatialOptions = DEFAULTS
    threads: int = 4
    keep_versions: int = 3
    tables: dict[str, LakeTable] = field(init=False)

    def __post_init__(self):
        if self.gate not in GATES:
            raise ValueError(f"gate must be one of {GATES}")
        configure(self.spark)
        self.tables = {spec.name: LakeTable(self.spark, self.root, spec) for spec in TABLES}

    def table(self, spec: TableSpec) -> LakeTable:
        return self.tables[spec.name]

    def read(self, spec: TableSpec) -> DataFrame:
        return self.table(spec).read()

    def register_views(self) -> None:
        """Name every table that exists as a temporary view."""
        for name, table in self.tables.items():
            if table.exists():
                table.read().createOrReplaceTempView(name)

    def bronze_since(self, slack: datetime.timedelta) -> datetime.date | None:
        """First day of the raw lake that can hold records not loaded yet.

        Folders are named by the fetch clock. ``slack`` is how far that clock
        may lag behind the load time in the records; with it unknown, read all.
        """
        flights = self.table(FLIGHTS_TABLE)
        day = flights.latest_day() if flights.exists() else None
        return day and datetime.date.fromisoformat(day) - slack

    def _incremental(
        self,
        spec: TableSpec,
        mark: str,
        model: Callable,
        full: bool,
        again: Callable | None = None,
        *,
        added: Callable | None = None,
        load: str | None = None,
    ) -> None:
        """Build in full at first; afterwards add what is later than the mark.

        The mark is the one that the last finished load has noted. Rows later than
        it come from a load that died; they give way to what the batch has.
        With ``again`` the rows of the mark itself may be part of the load: it
        is called with the mark and the table's rows there, and what it makes stands in
        their place, unless it finds nothing new and makes none. With ``added`` such
        rows are added to those there are; the load must have a name then. A load
        that has finished under its name is not done again.
        """
        table = self.table(spec)
        table.recover()
        if load is not None and not full and table.exists() and table.finished_load() == load:
            return
        since = None
        if full or not table.exists():
            table.replace(model(None), load)
        else:
            top = table.high_water(mark, self.empty_target)
            done = table.finished_mark()
            done = top if done is None else HighWater(done.value, self.empty_target)
            column = F.col(mark)
            torn = done.value is not None and top.value != done.value
            since = done.day
            late = done.later(column) if torn else None
            anew = None
            if added is not None and load is not None and done.value is not None:
                table.add(added(done), load, F.lit(False) if late is None else late)
            else:
                if again is not None and done.value is not None:
                    anew = again(done, _at(table.read(later_than=done), done, mark))
                if anew is not None:
                    table.upsert(anew, done.same_or_later(column))
                elif mark == spec.instant and done.value is not None and not torn:
                    # Keys fix the instant, and all rows held are earlier: no key can be known.
                    table.append(model(done))
                else:
                    table.upsert(model(done), late)
        self._note(spec, table.high_water(mark, self.empty_target), since, load)

    def _note(self, spec: TableSpec, mark: HighWater, since: str | None, load: str | None = None) -> None:
        """Note a finished load with the table's rows, of which those before ``since`` are as they were."""
        table = self.table(spec)
        known = table.finished_rows() if since is not None else None
        rows = table.read() if known is None else table.read_since(since)
        later = F.lit(True) if mark.day is None else F.col(spec.partition) >= F.lit(mark.day).cast("date")
        if spec.partition_from is not None and mark.day is not None:
            later = F.to_date(spec.partition_from) >= F.lit(mark.day).cast("date")
        count, tail = rows.agg(F.count(F.lit(1)), F.count_if(later)).first()
        if known is not None:
            count += known[0] - known[1]
        table.finished(mark, load, count, tail)

    def load_flights(
        self, bronze: DataFrame, full: bool = False, *, split: bool = False, load: str | None = None
    ) -> None:
        """``split``: the batch may hold more records of the newest snapshot loaded."""

        def again(filled: HighWater, held: DataFrame) -> DataFrame | None:
            later = typed_flights(bronze).where(filled.same_or_later(F.col("loaded_at_timestamp")))
            if _at(later, filled, "loaded_at_timestamp").isEmpty():
                return None
            return latest_contacts(later.unionByName(held))

        self._incremental(
            FLIGHTS_TABLE,
            "loaded_at_timestamp",
            lambda filled: stg_flights(bronze, filled),
            full,
            again if split else None,
            load=load,
        )

    def load_quality_logs(
        self, bronze: DataFrame, full: bool = False, *, split: bool = False, load: str | None = None
    ) -> None:
        """A load with a name may be done again at any time: its rows are in the log once, those without key too."""

        def added(filled: HighWater) -> DataFrame:
            logs = quality_logs(bronze, as_of_date=self.as_of_date)
            return logs.where(filled.same_or_later(F.col("gcs_loaded_at")))

        def again(filled: HighWater, held: DataFrame) -> DataFrame | None:
            later = added(filled)
            if _at(later, filled, "gcs_loaded_at").isEmpty():
                return None
            return later.unionByName(held)

        self._incremental(
            QUALITY_TABLE,
            "gcs_loaded_at",
            lambda filled: quality_logs(bronze, filled, self.as_of_date),
            full,
            again if split else None,
            added=added if split else None,
            load=load,
        )

    def load_airspaces(self, seed: DataFrame) -> None:
        self.table(AIRSPACE_TABLE).replace(spatial_airspaces(seed, self.options.edges))

    def airspaces(self) -> PolygonIndex:
        """The index of the stored airspaces, kept beside them until they change."""
        stored, kept = self.read(AIRSPACE_TABLE), f"{self.root.rstrip('/')}/airspace_index"
        digest = airspaces_digest(stored, self.options)
        index = open_index(self.spark, f"{kept}/{digest}", self.options)
        if index is None:
            for name in list_folder(self.spark, kept):
                # Of other airspaces, or not finished.
                remove_folder(self.spark, f"{kept}/{name}")
            index = airspace_index(stored, self.options, f"{kept}/{digest}")
        return index

    def load_snapshots(
        self, full: bool = False, *, split: bool = False, load: str | None = None
    ) -> None:
        index = self.airspaces()
        flights = self.table(FLIGHTS_TABLE)

        def again(filled: HighWater, held: DataFrame) -> DataFrame | None:
            later = flights.read(later_than=filled)
            later = later.where(filled.same_or_later(F.col("loaded_at_timestamp")))
            if _content(_at(later, filled, "loaded_at_timestamp")) == _content(held):
                return None
            return flight_snapshots(later, index)

        self._incremental(
            SNAPSHOT_TABLE,
            "loaded_at_timestamp",
            lambda filled: flight_snapshots(flights.read(later_than=filled), index, filled),
            full,
            again if split else None,
            load=load,
        )

    def load_inventory(self) -> None:
        # The latest load time lies in the latest day, whose folder alone is read.
        snapshots = self.table(SNAPSHOT_TABLE).latest_rows()
        self.table(INVENTORY_TABLE).replace(active_flight_inventory(snapshots))

    def load_heatmap(self, full: bool = False) -> None:
        """New records are no earlier than the heatmap's last day: that day and later ones are done anew."""
        table = self.table(HEATMAP_TABLE)
        table.recover()
        day = table.latest_day() if table.exists() and not full else None
        if day is None:
            table.replace(hourly_traffic_heatmap(self.read(SNAPSHOT_TABLE)))
        else:
            since = F.col(SNAPSHOT_TABLE.partition) >= F.lit(day).cast("date")
            table.replace_partitions(hourly_traffic_heatmap(self.read(SNAPSHOT_TABLE).where(since)))
        last = table.latest_day()
        done = table.finished_mark()
        # The rows noted reach from the day noted then, which a load that died may have passed.
        since = done.day if day is not None and done is not None else None
        self._note(HEATMAP_TABLE, HighWater(last and datetime.date.fromisoformat(last)), since)

    def load_fleet(self, full: bool = False, *, load: str | None = None) -> None:
        self._incremental(
            FLEET_TABLE,
            "flight_date",
            lambda filled: daily_fleet_utilization(self.read(SNAPSHOT_TABLE), filled),
            full,
            # The last day is done again as a whole.
            lambda filled, held: daily_fleet_utilization(self.read(SNAPSHOT_TABLE), filled),
            load=load,
        )

    def build(
        self,
        bronze: DataFrame,
        seed: DataFrame,
        *,
        full: bool = False,
        split: bool = False,
        load: str | None = None,
    ) -> DataFrame:
        """Run every model and data test; returns one row per step.

        ``rows`` is the size of a model's table, the number of failing rows
        (or values) of a test, or of airspaces that have no usable shape. After an
        incremental load the tests look at the days it has touched; ``full`` builds and
        tests whole tables. ``split``: a snapshot may come in several builds. ``load`` names the
        build: a table that has finished it is left as it is when the build is done again.
        """
        loads = {
            FLIGHTS_TABLE: lambda: self.load_flights(bronze, full, split=split, load=load),
            QUALITY_TABLE: lambda: self.load_quality_logs(bronze, full, split=split, load=load),
            AIRSPACE_TABLE: lambda: self.load_airspaces(seed),
            SNAPSHOT_TABLE: lambda: self.load_snapshots(full, split=split, load=load),
            INVENTORY_TABLE: self.load_inventory,
            HEATMAP_TABLE: lambda: self.load_heatmap(full),
            FLEET_TABLE: lambda: self.load_fleet(full, load=load),
        }
        report: list[tuple] = []
        blocked: set[str] = set()
        for wave in WAVES:
            ready = [spec for spec in wave if not blocked & set(DEPENDS_ON.get(spec.name, ()))]
            for spec in wave:
                if spec not in ready:
                    blocked.add(spec.name)
                    report.append(("model", spec.name, "skipped", None))
            with ThreadPoolExecutor(self.threads) as pool:
                step = inheritable_thread_target(self.spark)(self._step)
                steps = [pool.submit(step, spec, loads[spec], full) for spec in ready]
            for spec, outcome in zip(ready, steps):
                rows = outcome.result()
                report += rows
                failed = [f"{row[0]} on {row[1]}" for row in rows if row[2] == "failed"]
                if failed and self.gate == "raise":
                    raise CheckFailed(", ".join(failed))
                if failed and self.gate == "skip":
                    blocked.add(spec.name)
        return self.spark.createDataFrame(report, RESULT)

    def _step(self, spec: TableSpec, load: Callable, full: bool) -> list[tuple]:
        """Build one model and test it."""
        table = self.table(spec)
        day = None
        if not full and spec.instant is not None and table.exists():
            mark = table.finished_mark()
            day = table.latest_day() if mark is None else mark.day
        load()
        table.drop_old_versions(self.keep_versions)
        stored, noted = table.read(), table.finished_rows()
        # Loads note how many rows there are; other tables are small or built anew.
        rows = [("model", spec.name, "built", noted[0] if noted else stored.count())]
        if spec is AIRSPACE_TABLE:
            shapeless = stored.where(F.col("airspace_polygon").isNull()).count()
            rows.append(("null_airspace_polygon", spec.name, "counted", shapeless))
        for check in CHECKS.get(spec.name, ()):
            # A key fixes its day, so a load can only break the tests on days it touched.
            failing = check.failures(table.read_since(day)).count()
            status = "failed" if failing else "passed"
            rows.append((check.name, spec.name, status, failing))
        return rows

    def keep_report(self, report: DataFrame) -> None:
        """Add what a build says of itself to the lake's ``build_reports``."""
        report.withColumn("reported_at", F.current_timestamp()).coalesce(1).write.mode(
            "append"
        ).json(f"{self.root.rstrip('/')}/build_reports")
