import math
import random

import pytest
from pyspark.sql import functions as F

from vaportrail.functions.geography import EDGE_KINDS, polygon_from_wkt
from vaportrail.operators.spatial import (
    SpatialOptions,
    _spread,
    _with_basis,
    build_index,
    first_polygon,
    spatial_join,
)
from vaportrail.plans.gold import spatial_airspaces
from vaportrail.schemas import SEED

MANY = 0  # broadcast limit in bytes that forces the shuffled join


def edge_latitude(p, q, lon, edges):
    (lon1, lat1), (lon2, lat2) = p, q
    if edges == "planar":
        return lat1 + (lat2 - lat1) * (lon - lon1) / (lon2 - lon1)
    x, x1, x2 = math.radians(lon), math.radians(lon1), math.radians(lon2)
    t1, t2 = math.tan(math.radians(lat1)), math.tan(math.radians(lat2))
    return math.degrees(
        math.atan((t1 * math.sin(x2 - x) + t2 * math.sin(x - x1)) / math.sin(x2 - x1))
    )


def holds(rings, lon, lat, edges):
    """Count the edges north of the point; points on an edge are outside."""
    crossings = 0
    for ring in rings:
        for p, q in zip(ring, ring[1:]):
            if p[0] == q[0]:
                if lon == p[0] and min(p[1], q[1]) <= lat <= max(p[1], q[1]):
                    return False
                continue
            if min(p[0], q[0]) <= lon <= max(p[0], q[0]):
                edge = edge_latitude(p, q, lon, edges)
                if abs(edge - lat) < 1e-9:
                    return False
                if (p[0] > lon) != (q[0] > lon) and edge > lat:
                    crossings += 1
    return crossings % 2 == 1


def wkt(*rings):
    texts = ["(" + ", ".join(f"{lon} {lat}" for lon, lat in ring) + ")" for ring in rings]
    return "POLYGON(" + ", ".join(texts) + ")"


def star(rng, lon, lat, size, corners):
    """A ring around a centre: simple, as a rule not convex."""
    corners = sorted(
        (rng.uniform(0, 2 * math.pi), size * rng.uniform(0.3, 1)) for _ in range(corners)
    )
    ring = [
        (round(lon + math.cos(angle) * reach, 2), round(lat + math.sin(angle) * reach, 2))
        for angle, reach in corners
    ]
    return [*ring, ring[0]]


SHAPES = {
    "notch": [[(0, 0), (10, 0), (10, 10), (5, 10), (5, 5), (0, 5), (0, 0)]],
    "hole": [
        [(20, 0), (40, 0), (40, 20), (20, 20), (20, 0)],
        [(25, 5), (25, 15), (35, 15), (35, 5), (25, 5)],
    ],
    "south": [[(-60, -50), (-20, -70), (10, -40), (-30, -20), (-60, -50)]],
}


def shapes_frame(spark, shapes):
    rows = [(name, name, wkt(*rings)) for name, rings in shapes.items()]
    return spatial_airspaces(spark.createDataFrame(rows, SEED))


def points_frame(spark, points):
    rows = [(i, float(lon), float(lat)) for i, (lon, lat) in enumerate(points)]
    return spark.createDataFrame(rows, "id int, longitude double, latitude double")


def hits(points, polygons, options):
    joined = spatial_join(points, build_index(polygons, options=options), how="inner")
    return sorted((row.id, row.airspace_id) for row in joined.collect())


def test_wkt(spark):
    texts = {
        "POLYGON((1 2))": None,
        "x": None,
        "POLYGON((0 0, 1 0, 1 1, 0 1))": None,
        "POLYGON((0 0, 1 0, 1 y, 0 0))": None,
        "POLYGON((0 0, 1 0, 1 90, 0 0))": None,
        "POLYGON((0 0 0, 1 0 0, 1 1 0, 0 0 0))": None,
        "POINT(1 2)": None,
        None: None,
        " polygon ( ( 0 0 , 1.5 0 , 1 -1e0 , 0 0 ) ) ": [[(0, 0), (1.5, 0), (1, -1), (0, 0)]],
        wkt(*SHAPES["hole"]): SHAPES["hole"],
    }
    df = spark.createDataFrame([(text,) for text in texts], "wkt string")
    parsed = df.select("wkt", polygon_from_wkt("wkt").alias("p"))
    found = {row.wkt: row.p for row in parsed.collect()}
    for text, rings in texts.items():
        got = found[text]
        assert (got and [[tuple(p) for p in ring] for ring in got.rings]) == rings, text


@pytest.mark.parametrize("edges", EDGE_KINDS)
@pytest.mark.parametrize("limit", [1 << 25, MANY])
def test_against_brute_force(spark, edges, limit):
    rng = random.Random(7)
    shapes = SHAPES | {
        f"star{i}": [star(rng, rng.uniform(-150, 150), rng.uniform(-60, 60), 20, 9)]
        for i in range(12)
    }
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(1500)]
    # On and around corners and edges, where the cuts between bands are.
    points += [(lon, lat) for lon in range(-1, 12) for lat in range(-1, 12)]
    points += [(lon, lat) for lon in range(20, 41, 5) for lat in range(0, 21, 5)]
    corners = [c for rings in shapes.values() for ring in rings for c in ring]
    points += [(lon, lat + rng.uniform(-8, 8)) for lon, lat in corners]
    expected = sorted(
        (i, name)
        for i, (lon, lat) in enumerate(points)
        for name, rings in shapes.items()
        if holds(rings, lon, lat, edges)
    )
    options = SpatialOptions(edges=edges, broadcast_bytes=limit)
    found = hits(points_frame(spark, points), shapes_frame(spark, shapes), options)
    assert found == expected
    assert len(expected) > 150


@pytest.mark.parametrize("edges", EDGE_KINDS)
def test_first_polygon_by_both_ways(spark, edges):
    rng = random.Random(11)
    shapes = {
        f"s{i:02}": [star(rng, rng.uniform(-20, 20), rng.uniform(-20, 20), 25, 7)]
        for i in range(20)
    }
    points = [(rng.uniform(-50, 50), rng.uniform(-50, 50)) for _ in range(600)]
    points += [(None, 1), (1, None), (float("nan"), 1), (1, 95)]
    rows = [(i, lon and float(lon), lat and float(lat)) for i, (lon, lat) in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, longitude double, latitude double")
    polygons = shapes_frame(spark, shapes).drop("airspace_id")
    expected = dict.fromkeys(range(len(points)))
    for i, (lon, lat) in enumerate(points[:600]):
        around = [name for name, rings in shapes.items() if holds(rings, lon, lat, edges)]
        expected[i] = min(around, default=None)
    for limit in (1 << 25, MANY):
        options = SpatialOptions(edges=edges, cell_degrees=10, broadcast_bytes=limit)
        index = build_index(polygons, options=options)
        assert index.small == bool(limit)
        found = first_polygon(df, index).collect()
        assert {row.id: row.airspace_name for row in found} == expected
        assert len(found) == len(points)


def test_first_polygon_keeps_repeated_and_keyless_rows(spark):
    polygons = shapes_frame(spark, SHAPES).drop("airspace_id")
    rows = [(None, 5.0, 5.0)] * 10 + [("a", 5.0, 5.0)] * 3 + [("a", None, 1.0), (None, None, None), ("b", -30.0, -45.0)]
    df = spark.createDataFrame(rows, "key string, longitude double, latitude double")
    found = []
    for limit in (1 << 25, MANY):
        index = build_index(polygons, options=SpatialOptions(broadcast_bytes=limit))
        found.append(sorted(map(tuple, first_polygon(df, index).collect()), key=repr))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_snapshots_are_alike_for_any_index_size(spark, bronze):
    from vaportrail.plans.gold import airspace_index, flight_snapshots, spatial_airspaces
    from vaportrail.plans.silver import stg_flights
    from vaportrail.sources.seeds import known_airspaces
    from tests.test_models import T0, record

    records = [record(a, T0, latitude=str(40 + i), longitude="-100") for i, a in enumerate("abc")]
    flights = stg_flights(bronze(*records, record(None, T0), record(None, "bad")))
    airspaces = spatial_airspaces(known_airspaces(spark))
    for source in (flights, flights.unionAll(flights)):
        for unique in (True, False):
            found = [
                sorted(map(tuple, flight_snapshots(source, index, unique_flights=unique).collect()), key=repr)
                for limit in (1 << 25, MANY)
                for index in [airspace_index(airspaces, SpatialOptions(broadcast_bytes=limit))]
            ]
            assert found[0] == found[1]


def test_shuffled_first_polygon_joins_once(spark):
    polygons = shapes_frame(spark, SHAPES).drop("airspace_id")
    index = build_index(polygons, options=SpatialOptions(broadcast_bytes=MANY))
    df = spark.createDataFrame([(1.0, 2.0)], "longitude double, latitude double")
    plan = first_polygon(df, index)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1 and "Window" not in plan


def test_crossing_outline_holds_nothing(spark):
    shapes = {"bow": [[(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]], "box": SHAPES["south"]}
    points = [(2, 5), (8, 5), (5, 2), (-30, -45)]
    found = hits(points_frame(spark, points), shapes_frame(spark, shapes), SpatialOptions())
    assert found == [(3, "box")]


def test_planar_boxes_wider_than_half_the_globe(spark):
    shapes = {"wide": [[(-100, 10), (100, 10), (100, 20), (-100, 20), (-100, 10)]]}
    points = [(0, 15), (170, 15), (-170, 15), (99, 15), (101, 15), (0, 25)]
    options = SpatialOptions(edges="planar")
    expected = [(i, "wide") for i, p in enumerate(points) if holds(shapes["wide"], *p, "planar")]
    assert hits(points_frame(spark, points), shapes_frame(spark, shapes), options) == expected
    assert [i for i, _ in expected] == [0, 3]


def test_rings_without_outline(spark):
    from vaportrail.functions.geography import has_outline

    texts = {
        "POLYGON((0 70, 90 70, 180 70, -90 70, 0 70))": (False, True),
        "POLYGON((-90 0, 90 0, 90 10, -90 10, -90 0))": (False, True),
        "POLYGON((170 -20, -170 -20, -170 -10, 170 -10, 170 -20))": (True, True),
        "POLYGON((0 0, 10 0, 10 10, 0 0))": (True, True),
        "POLYGON((": (None, False),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", polygon_from_wkt("t"))
    found = df.select("t", *[F.expr(has_outline("p", e)).alias(e) for e in ("geodesic", "planar")])
    assert {r.t: (r.geodesic, r.planar) for r in found.collect()} == texts


def test_date_line(spark):
    shapes = {"fiji": [[(170, -20), (-170, -20), (-170, -10), (170, -10), (170, -20)]]}
    points = [(lon, -15) for lon in (175, -175, 180, -180, 165, -165, 0, 185, 170)]
    found = hits(points_frame(spark, points), shapes_frame(spark, shapes), SpatialOptions())
    assert [i for i, _ in found] == [0, 1, 2, 3, 7]


def test_known_airspaces(spark, airspaces):
    points = {
        "Riyadh": (46.7, 24.7, "African Airspace"),
        "Miami": (-80.19, 25.76, None),
        "Winnipeg": (-97.14, 49.90, "United States Airspace"),
        "Edmonton": (-113.49, 53.55, None),
        "north border of the box": (-125.0, 30.0, None),
        "corner": (-125.0, 24.0, None),
        "bad latitude": (0.0, 95.0, None),
        "wrapped": (360 - 100.0, 40.0, "United States Airspace"),
    }
    df = spark.createDataFrame(
        [(name, lon, lat) for name, (lon, lat, _) in points.items()],
        "name string, longitude double, latitude double",
    )
    found = first_polygon(df, airspaces).collect()
    assert {row["name"]: row["airspace_name"] for row in found} == {
        name: expected for name, (_, _, expected) in points.items()
    }


def test_left_join_keeps_every_point(spark, airspaces):
    df = points_frame(spark, [(46.7, 24.7), (0, -89), (float("inf"), 0)])
    counts = {r.id: r["count"] for r in spatial_join(df, airspaces).groupBy("id").count().collect()}
    assert counts == {0: 2, 1: 1, 2: 1}


def test_many_small_polygons(spark):
    """As many polygons as points, by the shuffled join, against a range join."""
    rng = random.Random(5)
    centres = [(round(rng.uniform(-30, 30), 3), round(rng.uniform(-30, 30), 3)) for _ in range(400)]
    shapes = {
        f"b{i}": [[(x - 1, y - 1), (x + 1, y - 1), (x + 1, y + 1), (x - 1, y + 1), (x - 1, y - 1)]]
        for i, (x, y) in enumerate(centres)
    }
    # A third of the points share one place.
    points = centres + [(0.5, 0.5)] * 200
    expected = sorted(
        (i, f"b{j}")
        for i, (lon, lat) in enumerate(points)
        for j, (x, y) in enumerate(centres)
        if x - 1 < lon < x + 1 and y - 1 < lat < y + 1
    )
    options = SpatialOptions(edges="planar", cell_degrees=1, broadcast_bytes=MANY)
    assert hits(points_frame(spark, points), shapes_frame(spark, shapes), options) == expected


def test_copies_of_a_point_are_spread(spark):
    """A third of all points in one place, and a third without any, must not meet in one task."""
    place = F.when(F.col("id") % 3 == 0, 10.0).when(F.col("id") % 3 == 1, None)
    same = spark.range(0, 3000, 1, 64).select(
        place.otherwise(F.col("id") * 0.01).alias("longitude"), F.lit(40.0).alias("latitude")
    )
    based = _spread(_with_basis(same, "longitude", "latitude", SpatialOptions()), same.columns, 32)
    tasks = based.groupBy("longitude", "_cell", "_salt").count()
    assert tasks.agg(F.max("count")).first()[0] < 200


def ring_of(corners, lon=10.0, lat=20.0):
    """A jagged ring around a centre with very many corners."""
    ring = []
    for i in range(corners):
        angle = 2 * math.pi * i / corners
        reach = 8 + 0.5 * math.sin(40 * angle) + (0.0005 if i % 2 else 0)
        ring.append((lon + math.cos(angle) * reach, lat + math.sin(angle) * reach))
    return [*ring, ring[0]]


def crossings(ring, points):
    """``holds`` for planar edges, vectorised over the sides."""
    import numpy as np

    x, y = np.array(ring).T
    out = []
    for lon, lat in points:
        over = (x[:-1] > lon) != (x[1:] > lon)
        x1, x2, y1, y2 = x[:-1][over], x[1:][over], y[:-1][over], y[1:][over]
        out.append(int((y1 + (y2 - y1) * (lon - x1) / (x2 - x1) > lat).sum()) % 2 == 1)
    return out


def test_outline_with_a_hundred_thousand_corners(spark):
    ring, rng = ring_of(100_000), random.Random(3)
    points = [(10 + rng.uniform(-9, 9), 20 + rng.uniform(-9, 9)) for _ in range(400)]
    # Close to the outline, where a wrong band would show.
    points += [(lon + rng.uniform(-0.02, 0.02), lat + rng.uniform(-0.02, 0.02)) for lon, lat in rng.sample(ring, 400)]
    index = build_index(shapes_frame(spark, {"ring": [ring]}), options=SpatialOptions(edges="planar"))
    found = spatial_join(points_frame(spark, points), index, how="inner")
    expected = [i for i, inside in enumerate(crossings(ring, points)) if inside]
    assert sorted(row.id for row in found.collect()) == expected and 300 < len(expected) < 600
    # No row has held more than the few sides over one stretch.
    held = spark.read.parquet(f"{index.folder}/sweep/stretches").selectExpr("max(size(lines))").first()[0]
    assert held < 100
    # Where the outline runs north, its short bands lie one over another and are not parted further.
    assert index.cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 512
    assert index.cells.count() < 4 * 200_000


def test_which_outlines_cross(spark):
    """Sides that change places within a stretch or just at a cut cross; those that only meet do not."""
    crossing = {
        "through": [[(20, 0), (30, 0), (30, 10), (25, -1), (20, 10), (20, 0)]],
        "at a cut": [
            [(100, 0), (110, 10), (112, 5), (110, 0), (100, 10), (98, 12), (105, 20), (96, 20), (96, 0), (100, 0)]
        ],
    }
    meeting = {
        "touch": [[(0, 0), (10, 0), (10, 10), (5, 0), (0, 10), (0, 0)]],
        "corner": [[(40, 0), (45, 5), (50, 10), (50, 0), (45, 5), (40, 10), (40, 0)]],
        "plain": [[(60, 0), (70, 0), (70, 10), (60, 10), (60, 0)]],
    }
    points = [(x + 0.37, y + 0.11) for x in range(-2, 114) for y in range(-2, 20, 3)]
    found = hits(points_frame(spark, points), shapes_frame(spark, crossing | meeting), SpatialOptions(edges="planar"))
    assert found == sorted(
        (i, name)
        for i, point in enumerate(points)
        for name, rings in meeting.items()
        if holds(rings, *point, "planar")
    )


def small_boxes(count, size, origin=(0.0, 0.0), span=5.0, seed=1):
    rng = random.Random(seed)
    return [
        (origin[0] + rng.uniform(0, span - size), origin[1] + rng.uniform(0, span - size), size)
        for _ in range(count)
    ]


def box(x, y, size):
    return [[(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]]


@pytest.mark.parametrize("limit", [1 << 25, MANY])
def test_cells_of_several_sizes(spark, limit):
    """Many small outlines crowd one cell, with large ones over them; every point tests a few bands."""
    boxes = small_boxes(1200, 0.04) + [(-3.0, -3.0, 11.0), (1.0, 1.0, 2.5), (-60.0, -30.0, 90.0)]
    shapes = {f"b{i:04}": box(*b) for i, b in enumerate(boxes)}
    rng = random.Random(4)
    points = [(rng.uniform(-1, 6), rng.uniform(-1, 6)) for _ in range(1500)] + [(50, 50), (-40, -20)]
    options = SpatialOptions(edges="planar", cell_bands=12, broadcast_bytes=limit)
    index = build_index(shapes_frame(spark, shapes).drop("airspace_id"), options=options)
    assert index.depth >= 4 and index.small == bool(limit)
    # Some cells are left with more, where halving would copy most of their bands.
    assert index.cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 24
    expected = {
        i: [f"b{j:04}" for j, (x, y, size) in enumerate(boxes) if x < lon < x + size and y < lat < y + size]
        for i, (lon, lat) in enumerate(points)
    }
    df = points_frame(spark, points)
    pairs = sorted((row.id, row.airspace_name) for row in spatial_join(df, index, how="inner").collect())
    assert pairs == sorted((i, name) for i, names in expected.items() for name in names)
    first = {row.id: row.airspace_name for row in first_polygon(df, index).collect()}
    assert first == {i: min(names, default=None) for i, names in expected.items()}
    kept = spatial_join(df, index).groupBy("id").count().count()
    assert kept == len(points)


def test_a_million_small_outlines_in_one_cell(spark):
    from vaportrail.operators.spatial import cell_tree
    from vaportrail.session import fresh_path

    side = 1000
    x, y = F.col("id") % side, F.floor(F.col("id") / side)
    bands = spark.range(side * side).select(
        F.col("id").alias("name"),
        (x * 0.005).alias("lon_from"),
        (x * 0.005 + 0.004).alias("lon_to"),
        (y * 0.005).alias("lat_from"),
        (y * 0.005 + 0.004).alias("lat_to"),
    )
    cells, splits, depth = cell_tree(bands, SpatialOptions(), fresh_path(spark, "test-cells"))
    counts = cells.groupBy("_cell").count()
    assert counts.agg(F.max("count")).first()[0] <= 64
    # Small cells, without many copies: the bands that a border of a cell cuts.
    assert 8 <= depth <= 22 and side**2 <= cells.count() < 2.2 * side**2
    assert splits.count() < side**2 / 16


def test_copies_of_an_outline_are_not_cut(spark):
    """Cutting does not part them: the cell stays, and its bands fill several rows of the shelf."""
    shapes = {f"c{i:03}": box(1.1, 1.1, 2.0) for i in range(300)}
    options = SpatialOptions(edges="planar", shelf_bands=16, broadcast_bytes=MANY)
    index = build_index(shapes_frame(spark, shapes).drop("airspace_id"), options=options)
    assert index.crowded and index.cells.count() < 16 * 300
    assert index.shelf.selectExpr("max(size(_bands))").first()[0] <= 16


@pytest.mark.parametrize("limit", [1 << 25, MANY])
def test_first_of_very_many_outlines_over_one_place(spark, limit, monkeypatch):
    """Chunks of the shelf, salts from the histogram, and rows without any key."""
    from vaportrail.operators import spatial

    monkeypatch.setattr(spatial, "UNSALTED_ROWS", 5)
    nested = {f"n{i:03}": box(1.5 - i * 0.001, 1.5 - i * 0.001, 1 + i * 0.002) for i in range(120)}
    shapes = dict(reversed(nested.items())) | {"far": box(30, 30, 5), "a near": box(2.2, 2.2, 2)}
    rng = random.Random(9)
    rows = [(None, 2.0, 2.0)] * 40 + [(None, None, 1.0)] * 30 + [(str(i), 32.0, 32.0) for i in range(3)]
    rows += [(str(i), rng.uniform(0, 5), rng.uniform(0, 5)) for i in range(150)]
    df = spark.createDataFrame(rows, "key string, longitude double, latitude double")
    options = SpatialOptions(edges="planar", shelf_bands=8, broadcast_bytes=limit)
    index = build_index(shapes_frame(spark, shapes).drop("airspace_id"), options=options)
    assert index.crowded
    if not limit:
        busy = spatial._busy_cells(spatial._placed(df, index, "longitude", "latitude"), index)
        assert busy is not None and max(row["_salts"] for row in busy.collect()) > 1

    def first(lon, lat):
        if lon is None:
            return None
        names = [name for name, rings in shapes.items() if holds(rings, lon, lat, "planar")]
        return min(names, default=None)

    found = sorted(map(tuple, first_polygon(df, index).collect()), key=repr)
    assert found == sorted(((k, lon, lat, first(lon, lat)) for k, lon, lat in rows), key=repr)


def test_open_index(spark):
    from vaportrail.operators.spatial import open_index
    from vaportrail.session import fresh_path

    folder = fresh_path(spark, "test-index")
    assert open_index(spark, folder) is None
    built = build_index(shapes_frame(spark, SHAPES), folder=folder)
    again = open_index(spark, folder)
    assert (again.columns, again.small, again.depth) == (built.columns, True, 0)
    df = points_frame(spark, [(5, 2), (22, 2), (0, 80)])
    assert sorted(spatial_join(df, again).collect()) == sorted(spatial_join(df, built).collect())
