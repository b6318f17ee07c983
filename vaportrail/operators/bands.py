"""Polygons to bands, by a sweep over their sides in Spark.

A polygon is cut at the longitude of every corner. Sides find their first and last
cut by equi-joins, so every stretch between two neighbouring cuts gets the
sides over it, and those alone are sorted. No row holds more than the sides
over one stretch, whatever the number of corners, and one outline's
stretches are spread over tasks like those of many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vaportrail.functions.geography import TOLERANCE, Plane, has_outline, outline_sides
from vaportrail.session import stored


def _sorted(lines: str, lon: str, plane: Plane) -> str:
    """SQL for lines from south to north at a longitude; equal ones in the order of sides."""
    return f"""array_sort(transform({lines}, e -> named_struct(
        'h', {plane.at("e", lon)}, 'a', e.a, 'b', e.b, 'side', e.side)))"""


def _above(e: str, f: str, lon: str, plane: Plane) -> str:
    """SQL: is line ``e`` clearly north of line ``f`` at a longitude, beyond rounding?"""
    size = " + ".join(f"abs({line}.{part})" for line in (e, f) for part in "ab")
    if not plane.geodesic:
        size = f"({size}) * (1 + abs({lon}))"
    return f"{plane.at(e, lon)} - {plane.at(f, lon)} > {TOLERANCE} * (1 + {size})"


def _crossings(plane: Plane) -> str:
    """SQL: do any lines change places within the stretch, or from it to the one beyond?

    If any do, then so do two neighbours at either end of the stretch, or, of
    the lines that go on, two that are neighbours beyond.
    """
    ends = " or ".join(_above("e", "get(here, i + 1)", lon, plane) for lon in ("lon_from", "lon_to"))
    within = f"exists(transform(here, (e, i) -> get(here, i + 1) is not null and ({ends})), found -> found)"
    going_on = "array_intersect(transform({0}, e -> e.side), transform({1}, e -> e.side))"
    kept = f"filter(beyond, e -> array_contains({going_on.format('here', 'beyond')}, e.side))"
    pairs = f"""get(transform(array({kept}), lines -> filter(
        transform(lines, (e, i) -> named_struct('e', e, 'f', get(lines, i + 1))), p -> p.f is not null)), 0)"""
    middle, next_middle = "((lon_from + lon_to) / 2)", "((lon_to + lon_after) / 2)"
    across = f"""exists({pairs}, p ->
        {_above("p.e", "p.f", middle, plane)} and {_above("p.f", "p.e", next_middle, plane)})"""
    reordered = f"{going_on.format('here', 'beyond')} != {going_on.format('beyond', 'here')}"
    return f"{within} or ({reordered} and {across})"


def _pairs(lines: str) -> str:
    """SQL: first line with second, third with fourth, and so on."""
    return f"""filter(transform({lines}, (e, i) -> named_struct(
        'i', i, 'low', e, 'high', get({lines}, i + 1))), pair -> pair.i % 2 = 0)"""


def polygon_bands(polygons: DataFrame, polygon: str, edges: str, folder: str) -> DataFrame:
    """One row per band of each polygon; the other columns are repeated.

    Adds the band fields and the latitudes it spans, ``lat_from`` and
    ``lat_to``. A row with ``lon_from = lon_to`` stands for the inside part of
    a cut between two bands, since bands themselves are open.
    A polygon whose outline crosses itself has no inside, hence no bands.
    What is read several times is written to ``folder``.
    """
    plane = Plane(edges)
    others = [name for name in polygons.columns if name != polygon]
    # Edges along a meridian are dropped: the cuts already stand for them.
    lines = f"transform(filter({outline_sides(polygon, edges)}, s -> s.lon1 != s.lon2), s -> {plane.through('s')})"
    outlines = polygons.withColumn("_outline", F.monotonically_increasing_id())
    outlines = stored(
        outlines.where(f"{polygon} is not null and {has_outline(polygon, edges)}").selectExpr("_outline", *[f"`{n}`" for n in others], f"{lines} as _lines"),
        f"{folder}/outlines",
    )
    sides = outlines.selectExpr("_outline", "posexplode(_lines) as (side, line)")
    sides = sides.select("_outline", "side", "line.*")
    in_order = W.partitionBy("_outline").orderBy("lon_from")
    cuts = sides.select("_outline", F.explode(F.array("lon_from", "lon_to")).alias("lon_from")).distinct()
    cuts = cuts.select(
        "_outline",
        "lon_from",
        F.row_number().over(in_order).alias("cut"),
        F.lead("lon_from", 1).over(in_order).alias("lon_to"),
        F.lead("lon_from", 2).over(in_order).alias("lon_after"),
    )
    cuts = stored(cuts, f"{folder}/cuts")
    # From its first cut to its last, a side is over every stretch between.
    over = (
        sides.join(cuts.select("_outline", "lon_from", F.col("cut").alias("first")), ["_outline", "lon_from"])
        .join(cuts.select("_outline", F.col("lon_from").alias("lon_to"), F.col("cut").alias("end")), ["_outline", "lon_to"])
        .select("_outline", F.explode(F.expr("sequence(first, end - 1)")).alias("cut"), F.struct("a", "b", "side").alias("line"))
    )
    stretches = over.groupBy("_outline", "cut").agg(F.collect_list("line").alias("lines")).join(cuts, ["_outline", "cut"])
    stretches = stored(
        stretches.withColumn("lines", F.expr(_sorted("lines", "((lon_from + lon_to) / 2)", plane))),
        f"{folder}/stretches",
    )
    following = stretches.select("_outline", (F.col("cut") - 1).alias("cut"), F.col("lines").alias("beyond"))
    meeting = stretches.withColumnRenamed("lines", "here").join(following, ["_outline", "cut"], "left")
    # After the last stretch, and beyond a gap, there are no lines.
    none = "filter(here, e -> false)"
    meeting = meeting.withColumn("beyond", F.expr(f"coalesce(beyond, {none})"))
    crossed = meeting.where(_crossings(plane)).select("_outline").distinct()

    paired = meeting.selectExpr(
        "_outline", "cut", "lon_from", "lon_to", f"{_pairs('here')} as here", f"{_pairs('beyond')} as beyond"
    )
    # A pair of lines that goes on beyond a cut is one band.
    each = paired.selectExpr("_outline", "cut", "lon_from", "lon_to", "explode(here) as band")
    each = each.selectExpr("_outline", "cut", "lon_from", "lon_to", "band.low", "band.high")
    going_on = W.partitionBy("_outline", "low.side", "high.side").orderBy("cut")
    merged = (
        each.withColumn("run", F.col("cut") - F.row_number().over(going_on))
        .groupBy("_outline", "low.side", "high.side", "run")
        .agg(
            F.min("lon_from").alias("lon_from"),
            F.max("lon_to").alias("lon_to"),
            F.first("low").alias("low"),
            F.first("high").alias("high"),
        )
        .select("_outline", "lon_from", "lon_to", "low", "high")
    )
    low_at_cut = [plane.at(f"{side}.low", "lon_to") for side in ("l", "r")]
    high_at_cut = [plane.at(f"{side}.high", "lon_to") for side in ("l", "r")]
    # Of the others, those that end at a cut meet those that begin there.
    name = "concat(p.low.side, ' ', p.high.side)"
    names = {side: f"transform({side}, p -> {name})" for side in ("here", "beyond")}
    only = "filter({0}, p -> array_contains(array_except({1}, {2}), {3}))"
    ended = only.format("here", names["here"], names["beyond"], name)
    begun = only.format("beyond", names["beyond"], names["here"], name)
    at_cuts = (
        paired.selectExpr("_outline", "lon_to", f"{ended} as here", f"{begun} as beyond")
        .where("size(here) > 0 and size(beyond) > 0")
        .selectExpr(
            "_outline",
            "lon_to as lon_from",
            "lon_to",
            f"""explode(filter(
                flatten(transform(here, l -> transform(beyond, r -> named_struct(
                    'low', if({low_at_cut[0]} >= {low_at_cut[1]}, l.low, r.low),
                    'high', if({high_at_cut[0]} <= {high_at_cut[1]}, l.high, r.high))))),
                p -> {plane.at("p.low", "lon_to")} < {plane.at("p.high", "lon_to")})) as band""",
        )
        .select("_outline", "lon_from", "lon_to", "band.low", "band.high")
    )
    found = merged.unionByName(at_cuts).join(crossed, "_outline", "left_anti")
    return found.join(outlines.drop("_lines"), "_outline").selectExpr(
        *[f"`{name}`" for name in others],
        "lon_from",
        "lon_to",
        "low.a as low_a",
        "low.b as low_b",
        "high.a as high_a",
        "high.b as high_b",
        f"{plane.reach('low', 'lon_from', 'lon_to', 'least')} as lat_from",
        f"{plane.reach('high', 'lon_from', 'lon_to', 'greatest')} as lat_to",
    )
