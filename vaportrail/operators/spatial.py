"""Point-in-polygon joins as equi-joins on grid cells of several sizes.

Every band of every polygon is listed under the grid cells it touches. A cell
that many bands touch is halved, by longitude or latitude, whichever parts the bands better, and
its halves likewise: a tree with small cells where outlines are small and many. A point lies in
one cell of that tree, so joining on the cell leaves a handful of bands to test, and
no point meets the same polygon twice.

The list of cells is broadcast as long as its measured size is small; then
points are never shuffled. Beyond that it is joined by a shuffle on the cell,
with busy cells spread by salts, as many as a histogram of the points asks for, and
by the adaptive skew join.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vaportrail.functions.geography import (
    BAND_FIELDS,
    band_holds,
    normal_longitude,
    point_basis,
    valid_latitude,
)
from vaportrail.operators.bands import polygon_bands
from vaportrail.operators.tables import has_folder
from vaportrail.session import fresh_path, shuffle_partitions, stored

ROW_BYTES = 96
BROADCAST_BYTES = 32 << 20
# Halves of a cell may have so many bands together; and the larger one so many, unless few are copied.
COPIED, PARTED, FEW_COPIED = 1.5, 0.8, 1.1
# Cells are halved so often in each direction at most, which the number of a cell has room for.
DEEPEST = 16
# Points of a cell that a task takes without a salt.
UNSALTED_ROWS = 10_000


@dataclass(frozen=True)
class SpatialOptions:
    """``cell_degrees`` is the size of cells that are not cut. Those with more than ``cell_bands`` bands
    are, up to ``depth`` times each way. ``shelf_bands`` is how many bands a row of the shelf holds at most.
    """

    edges: str = "geodesic"
    cell_degrees: float = 5.0
    broadcast_bytes: int = BROADCAST_BYTES
    cell_bands: int = 64
    depth: int = DEEPEST
    shelf_bands: int = 256

    def __post_init__(self):
        if 180 % self.cell_degrees:
            raise ValueError("cell_degrees must divide 180")
        if not 0 <= self.depth <= DEEPEST:
            raise ValueError(f"depth must lie between 0 and {DEEPEST}")

    def column_of(self, lon: str, halved: str = "0") -> str:
        """Halving is exact in floating point, so cells of one size nest in those of another."""
        return f"cast(floor(({lon} + 180) / {self.cell_degrees} * shiftleft(1L, {halved})) as bigint)"

    def row_of(self, lat: str, halved: str = "0") -> str:
        last = f"shiftleft({int(180 / self.cell_degrees)}L, {halved}) - 1"
        row = f"cast(floor(({lat} + 90) / {self.cell_degrees} * shiftleft(1L, {halved})) as bigint)"
        return f"least(greatest({row}, 0L), {last})"

    def cell(self, column: str, row: str, lon_halved: str = "0", lat_halved: str = "0") -> str:
        """One number: how often the cell has been halved each way, its column and its row."""
        across = f"shiftleft({int(360 / self.cell_degrees)}L, {lon_halved})"
        size = f"shiftleft({lon_halved} * 32L + {lat_halved}, 52)"
        return f"({size} + shiftleft(pmod({column}, {across}), 26) + {row})"


DEFAULTS = SpatialOptions()


@dataclass(frozen=True)
class PolygonIndex:
    """Bands of a set of polygons by grid cell, stored once and read by every join.

    ``columns`` are the polygon columns a join can add. ``cells`` has one row per
    cell and band. ``shelf`` has the bands of a cell in polygon order, a bounded
    number in each row. ``splits`` are the cells that have been cut, up to ``depth`` times one after
    another, and which way. All lie in ``folder``. ``small`` says that their measured size allows a broadcast, ``crowded`` that some
    cells have several rows in the shelf; they decide how points are joined, never what comes out.
    """

    folder: str
    cells: DataFrame
    shelf: DataFrame
    splits: DataFrame
    columns: tuple[str, ...]
    options: SpatialOptions
    depth: int
    small: bool
    small_splits: bool
    crowded: bool


# Rounding may put a point of the band a hair outside the computed range.
SOUTH, NORTH = "lat_from - 1e-9", "lat_to + 1e-9"


def _touched(bands: DataFrame, options: SpatialOptions) -> DataFrame:
    """One row per band and uncut cell it touches."""
    columns = f"sequence({options.column_of('lon_from')}, {options.column_of('lon_to')})"
    rows = f"sequence({options.row_of(SOUTH)}, {options.row_of(NORTH)})"
    found = bands.withColumn("_column", F.explode(F.expr(columns))).withColumn("_row", F.explode(F.expr(rows)))
    found = found.withColumns({"_lon_halved": F.lit(0), "_lat_halved": F.lit(0)})
    return found.withColumn("_cell", F.expr(options.cell("_column", "_row")))


def _cuts(listed: DataFrame, options: SpatialOptions) -> DataFrame:
    """Cells with too many bands that are worth halving, and whether to do so by longitude (``_by_lon``)."""
    lon, lat = "_lon_halved + 1", "_lat_halved + 1"
    halves = {
        "_west": f"{options.column_of('lon_from', lon)} <= 2 * _column",
        "_east": f"{options.column_of('lon_to', lon)} > 2 * _column",
        "_south": f"{options.row_of(SOUTH, lat)} <= 2 * _row",
        "_north": f"{options.row_of(NORTH, lat)} > 2 * _row",
    }
    sizes = (
        listed.groupBy("_cell", "_lon_halved", "_lat_halved")
        .agg(
            F.count(F.lit(1)).alias("_size"),
            *[F.count_if(F.expr(touches)).alias(name) for name, touches in halves.items()],
        )
        .where(F.col("_size") > options.cell_bands)
    )

    def worth(one: str, other: str, halved: str) -> str:
        both, larger = f"{one} + {other}", f"greatest({one}, {other})"
        return f"""({halved} < {options.depth} and {both} <= {COPIED} * _size
            and ({larger} <= {PARTED} * _size or {both} <= {FEW_COPIED} * _size))"""

    by_lon, by_lat = worth("_west", "_east", "_lon_halved"), worth("_south", "_north", "_lat_halved")
    better = """struct(_west + _east, greatest(_west, _east)) <= struct(_south + _north, greatest(_south, _north))"""
    return sizes.where(f"{by_lon} or {by_lat}").selectExpr(
        "_cell", f"{by_lon} and (not {by_lat} or {better}) as _by_lon"
    )


def _halved(listed: DataFrame, options: SpatialOptions) -> DataFrame:
    """One row per band and half it touches; ``_by_lon`` says which way its cell is cut."""

    def halves(of: str, low: str, high: str) -> str:
        return f"sequence(greatest(2 * {of}, {low}), least(2 * {of} + 1, {high}))"

    lon, lat = "_lon_halved + 1", "_lat_halved + 1"
    columns = halves("_column", options.column_of("lon_from", lon), options.column_of("lon_to", lon))
    rows = halves("_row", options.row_of(SOUTH, lat), options.row_of(NORTH, lat))
    places = f"""if(_by_lon,
        transform({columns}, c -> struct(c as _column, _row as _row)),
        transform({rows}, r -> struct(_column as _column, r as _row)))"""
    apart = listed.withColumn("_place", F.explode(F.expr(places))).withColumns(
        {
            "_column": F.col("_place._column"),
            "_row": F.col("_place._row"),
            "_lon_halved": F.expr("_lon_halved + cast(_by_lon as int)"),
            "_lat_halved": F.expr("_lat_halved + cast(not _by_lon as int)"),
        }
    )
    cell = F.expr(options.cell("_column", "_row", "_lon_halved", "_lat_halved"))
    return apart.drop("_place", "_by_lon").withColumn("_cell", cell)


def cell_tree(bands: DataFrame, options: SpatialOptions, folder: str) -> tuple[DataFrame, DataFrame, int]:
    """One row per band and cell it touches (``_cell``), the cells that were cut, and how often at most.

    A cell is halved if more than ``cell_bands`` bands touch it and the halves hold clearly fewer each, or
    few bands twice. Bands that all cover the cell, or cross it in the same place, would only be copied.
    Each round looks only at bands in cells that the one before has cut.
    """
    names = [name for name in bands.columns if name not in ("lat_from", "lat_to")]
    listed = stored(_touched(bands, options), f"{folder}/cells-0")
    final, cut = [], []
    while len(cut) < 2 * options.depth:
        splits = stored(_cuts(listed, options), f"{folder}/splits-{len(cut)}")
        if splits.isEmpty():
            break
        final.append(listed.join(splits, "_cell", "left_anti"))
        cut.append(splits)
        listed = stored(_halved(listed.join(splits, "_cell"), options), f"{folder}/cells-{len(cut)}")
    found = listed.select("_cell", *names)
    for part in final:
        found = found.unionByName(part.select("_cell", *names))
    cells = bands.sparkSession.createDataFrame([], "_cell long, _by_lon boolean")
    for part in cut:
        cells = cells.unionByName(part)
    return found, cells, len(cut)


def build_index(
    polygons: DataFrame,
    polygon: str = "airspace_polygon",
    options: SpatialOptions = DEFAULTS,
    folder: str | None = None,
) -> PolygonIndex:
    """Work out the cells, store them in ``folder``, by default in the shared one, and measure them."""
    folder = folder or fresh_path(polygons.sparkSession, "index")
    columns = [name for name in polygons.columns if name != polygon]
    bands = stored(polygon_bands(polygons, polygon, options.edges, f"{folder}/sweep"), f"{folder}/bands")
    cells, splits, depth = cell_tree(bands, options, folder)
    cells = stored(cells, f"{folder}/cells")
    splits = stored(splits, f"{folder}/splits")
    # Rows of a cell in polygon order, a bounded number in each row of the shelf.
    in_order = W.partitionBy("_cell").orderBy(*columns, *BAND_FIELDS)
    part = F.floor((F.row_number().over(in_order) - 1) / options.shelf_bands)
    entries = F.array_sort(F.collect_list(F.struct(*columns, *BAND_FIELDS))).alias("_bands")
    shelf = cells.withColumn("_part", part).groupBy("_cell", "_part").agg(entries)
    stored(shelf, f"{folder}/shelf")
    texts = [F.coalesce(F.length(F.col(name).cast("string")), F.lit(0)) for name in columns]
    size = cells.agg(F.sum(sum(texts, F.lit(ROW_BYTES)))).first()[0] or 0
    about = {
        "columns": columns,
        "depth": depth,
        "small": size <= options.broadcast_bytes,
        "small_splits": splits.count() * ROW_BYTES <= options.broadcast_bytes,
        "crowded": not polygons.sparkSession.read.parquet(f"{folder}/shelf").where("_part > 0").isEmpty(),
    }
    # Written last: an index without it is not complete.
    polygons.sparkSession.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.text(f"{folder}/about")
    return open_index(polygons.sparkSession, folder, options)


def open_index(spark: SparkSession, folder: str, options: SpatialOptions = DEFAULTS) -> PolygonIndex | None:
    """An index that was stored before with the same options; None where it is not there or not complete."""
    if not has_folder(spark, f"{folder}/about/_SUCCESS"):
        return None
    about = json.loads(spark.read.text(f"{folder}/about").first()[0])
    about["columns"] = tuple(about["columns"])
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in ("cells", "shelf", "splits")}
    return PolygonIndex(folder=folder, options=options, **tables, **about)


def _with_basis(points: DataFrame, lon: str, lat: str, options: SpatialOptions) -> DataFrame:
    """Add what the band test needs, each value computed once per point."""
    placed = points.withColumns(
        {"_lon": normal_longitude(F.col(lon)), "_lat": valid_latitude(F.col(lat))}
    )
    # Without both coordinates the cell is NULL and meets nothing.
    cell = options.cell(options.column_of("_lon"), options.row_of("_lat"))
    basis = point_basis("_lon", "_lat", options.edges)
    return placed.withColumns(
        {"_cell": F.expr(cell)} | {f"_{name}": value for name, value in basis.items()}
    )


def _placed(points: DataFrame, index: PolygonIndex, lon: str, lat: str) -> DataFrame:
    """Points with the band test's values, and the cell of the tree that they lie in.

    Cells that have been cut are looked up, once for each cut; without any nothing is joined.
    """
    options = index.options
    based = _with_basis(points, lon, lat, options)
    if not index.depth:
        return based
    based = based.withColumns({"_lon_halved": F.lit(0), "_lat_halved": F.lit(0)})
    splits = index.splits.select(F.col("_cell").alias("_split"), "_by_lon")
    halved = ("_lon_halved", "_lat_halved")
    cell = options.cell(options.column_of("_lon", halved[0]), options.row_of("_lat", halved[1]), *halved)
    for cut in range(index.depth):
        number = F.shiftright("_split", 52)
        ones = splits.where(F.floor(number / 32) + number % 32 == cut)
        based = based.join(F.broadcast(ones) if index.small_splits else ones, F.expr("_cell = _split"), "left")
        more = {name: f"{name} + cast(coalesce({by}, false) as int)" for name, by in zip(halved, ("_by_lon", "not _by_lon"))}
        based = based.withColumns({name: F.expr(value) for name, value in more.items()})
        based = based.withColumn("_cell", F.expr(f"if(_split is null, _cell, {cell})")).drop("_split", "_by_lon")
    return based


def _busy_cells(points: DataFrame, index: PolygonIndex) -> DataFrame | None:
    """Cells with more points than a task should have, and the number of ``_salts`` for each.

    They are no more than there are shuffle partitions, since each has more than
    its share of all points.
    """
    spark = points.sparkSession
    counts = points.where("_cell is not null").groupBy("_cell").agg(F.count(F.lit(1)).alias("_count"))
    counts = stored(counts, f"{index.folder}/histogram-{uuid.uuid4().hex}")
    width = shuffle_partitions(spark)
    share = max((counts.agg(F.sum("_count")).first()[0] or 0) / width, UNSALTED_ROWS)
    busy = counts.where(F.col("_count") > share).collect()
    if not busy:
        return None
    rows = [(row["_cell"], int(-(-row["_count"] // share))) for row in busy]
    return spark.createDataFrame(rows, "_cell long, _salts int")


def _spread(points: DataFrame, columns: Sequence[str], salts: int | Column) -> DataFrame:
    """Salt the points; those without a cell get one of many cells that no polygon has.

    The salt mixes the task into the hash, so exact copies of a point part ways
    as well. A task that is run again gives its rows the same salts.
    """
    mark = F.xxhash64(F.spark_partition_id(), *columns)
    alone = -1 - F.pmod(F.shiftright(mark, 16), F.lit(1 << 30))
    salts = F.lit(salts) if isinstance(salts, int) else salts
    return points.withColumns(
        {
            "_salt": F.pmod(mark, salts).cast("int"),
            "_cell": F.coalesce("_cell", alone),
        }
    )


def _dealt(
    points: DataFrame, shelf: DataFrame, columns: Sequence[str], busy: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a shuffled join with ``_salt``: points of a busy cell part ways, its bands are copied."""
    if busy is None:
        return _spread(points, columns, 1), shelf.withColumn("_salt", F.lit(0))
    salts = F.coalesce("_salts", F.lit(1))
    busy = F.broadcast(busy)
    points = _spread(points.join(busy, "_cell", "left"), columns, salts).drop("_salts")
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    return points, shelf.join(busy, "_cell", "left").withColumn("_salt", every).drop("_salts")


def spatial_join(
    points: DataFrame,
    index: PolygonIndex,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
    how: str = "left",
) -> DataFrame:
    """Points with the columns of every polygon that holds them.

    ``how`` is ``inner`` or ``left``. A point on an edge is not inside; a point
    without a usable position matches nothing.
    """
    based = _placed(points, index, lon, lat)
    same = "p._cell = c._cell"
    if index.small:
        cells = F.broadcast(index.cells)
    else:
        based, cells = _dealt(based, index.cells, points.columns, _busy_cells(based, index))
        same += " and p._salt = c._salt"
    inside = band_holds("c.", "p._", index.options.edges)
    return (
        based.alias("p")
        .join(cells.alias("c"), F.expr(f"{same} and {inside}"), how)
        .select(
            *[F.col(f"p.`{name}`") for name in points.columns],
            *[F.col(f"c.`{name}`") for name in index.columns],
        )
    )


def first_polygon(
    points: DataFrame,
    index: PolygonIndex,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
) -> DataFrame:
    """Each row of points once, with the columns of the first polygon that holds it.

    First is by the index columns in their order, NULLs before values. Rows need
    no key: where a cell has one row in the shelf, the join keeps one row per point,
    whether the shelf is broadcast or points are shuffled to it. Where a cell has several,
    its points are stored with a number, and the least of what their rows find is taken.
    """
    based, shelf = _placed(points, index, lon, lat), index.shelf
    holds = band_holds("b.", "_", index.options.edges)
    first = F.expr(f"get(filter(_bands, b -> {holds}), 0)")

    def answered(found: DataFrame) -> DataFrame:
        return found.select(*points.columns, *[f"_first.{name}" for name in index.columns])

    if index.small:
        # All of it is small, so a cell's rows may be one.
        whole = shelf.groupBy("_cell").agg(F.array_sort(F.flatten(F.collect_list("_bands"))).alias("_bands"))
        whole = F.broadcast(whole if index.crowded else shelf)
        return answered(based.join(whole, "_cell", "left").withColumn("_first", first))
    busy = _busy_cells(based, index)
    crowd = shelf.where("_part = 1").select("_cell")
    if index.crowded:
        alone, single = based.join(crowd, "_cell", "left_anti"), shelf.join(crowd, "_cell", "left_anti")
    else:
        alone, single = based, shelf
    alone, single = _dealt(alone, single, points.columns, busy)
    placed = answered(alone.join(single, ["_cell", "_salt"], "left").withColumn("_first", first))
    if not index.crowded:
        return placed
    among = based.join(crowd, "_cell", "left_semi").withColumn("_number", F.monotonically_increasing_id())
    among = stored(among, f"{index.folder}/crowd-{uuid.uuid4().hex}")
    dealt, rows = _dealt(among, shelf.join(crowd, "_cell", "left_semi"), points.columns, busy)
    found = dealt.join(rows, ["_cell", "_salt"]).withColumn("_first", first).where("_first is not null")
    least = found.groupBy("_number").agg(F.min("_first").alias("_first"))
    return placed.unionByName(answered(among.join(least, "_number", "left")))
