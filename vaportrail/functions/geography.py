"""Polygons from WKT, and the band form that makes point-in-polygon scalar.

A ring edge is a geodesic. With ``h = tan(latitude)`` the great circle through
two points is ``h = a*cos(lon) + b*sin(lon)``, so one edge costs two
multiplications once the point carries its sine, cosine and tangent. (A planar
edge is ``lat = a + b*lon``, the same shape with another basis.)

A polygon is cut at the longitude of every vertex. Between two neighbouring
cuts no edge begins or ends, so the edges sorted by latitude bound the inside
pairwise: first to second, third to fourth. Each pair is one *band*, a row of
plain doubles. A point is inside the polygon exactly when one band holds it.

The text of SQL expressions is built here; ``operators/bands.py`` works out the bands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_KINDS = ("geodesic", "planar")
BAND_FIELDS = ("lon_from", "lon_to", "low_a", "low_b", "high_a", "high_b")

# A point this close to an edge (radians, or degrees when planar) lies on it.
TOLERANCE = 1e-12

WKT_POLYGON = r"(?i)^\s*POLYGON\s*\(((?:\s*,?\s*\([^()]*\))+)\s*\)\s*$"


def polygon_from_wkt(wkt: str) -> Column:
    """``POLYGON((lon lat, ...))`` in the named column to closed rings, NULL when malformed."""
    position = r"""
        named_struct(
            'lon', try_cast(get(split(trim(p), '\\s+'), 0) as double),
            'lat', try_cast(get(split(trim(p), '\\s+'), 1) as double),
            'words', size(split(trim(p), '\\s+')))"""
    rings = rf"""
        transform(
            regexp_extract_all(regexp_extract({wkt}, '{WKT_POLYGON}', 1), '\\(([^()]*)\\)', 1),
            ring -> transform(split(ring, ','), p -> {position}))""".replace(
        WKT_POLYGON, WKT_POLYGON.replace("\\", "\\\\")
    )
    # A vertex on a pole has no longitude, hence the strict bound on latitude.
    valid_ring = """
        size(r) >= 4 and get(r, 0) = element_at(r, -1) and forall(r, p ->
            p.words = 2 and coalesce(abs(p.lon) <= 180 and abs(p.lat) < 90, false))"""
    return F.expr(
        f"""
        get(transform(
            filter(array({rings}), rings -> size(rings) > 0 and forall(rings, r -> {valid_ring})),
            rings -> named_struct('rings', transform(rings, r -> transform(r, p ->
                named_struct('lon', p.lon, 'lat', p.lat))))), 0)"""
    )


@dataclass(frozen=True)
class Plane:
    """The basis in which an edge of the given kind is a straight line."""

    edges: str

    def __post_init__(self):
        if self.edges not in EDGE_KINDS:
            raise ValueError(f"edges must be one of {EDGE_KINDS}, not {self.edges!r}")

    @property
    def geodesic(self) -> bool:
        return self.edges == "geodesic"

    def at(self, line: str, lon: str) -> str:
        """Height of an edge at a longitude."""
        if self.geodesic:
            return f"({line}.a * cos(radians({lon})) + {line}.b * sin(radians({lon})))"
        return f"({line}.a + {line}.b * {lon})"

    def through(self, s: str) -> str:
        """The edge between the ends of side ``s``, which differ in longitude."""
        if self.geodesic:
            x1, x2 = f"radians({s}.lon1)", f"radians({s}.lon2)"
            h1, h2 = f"tan(radians({s}.lat1))", f"tan(radians({s}.lat2))"
            a = f"({h1} * sin({x2}) - {h2} * sin({x1})) / sin({x2} - {x1})"
            b = f"({h2} * cos({x1}) - {h1} * cos({x2})) / sin({x2} - {x1})"
        else:
            b = f"({s}.lat2 - {s}.lat1) / ({s}.lon2 - {s}.lon1)"
            a = f"{s}.lat1 - {b} * {s}.lon1"
        return f"""named_struct(
            'lon_from', least({s}.lon1, {s}.lon2), 'lon_to', greatest({s}.lon1, {s}.lon2),
            'a', {a}, 'b', {b})"""

    def reach(self, line: str, lon_from: str, lon_to: str, pick: str) -> str:
        """``greatest`` or ``least`` latitude of an edge over a longitude range."""
        ends = f"{pick}({self.at(line, lon_from)}, {self.at(line, lon_to)})"
        if not self.geodesic:
            return ends
        # The great circle turns where its sinusoid peaks, which may lie in the range.
        sign, turn = ("", 0) if pick == "greatest" else ("-", 180)
        peak = f"(degrees(atan2({line}.b, {line}.a)) + {turn})"
        inside = " or ".join(
            f"{peak} + {k} between {lon_from} and {lon_to}" for k in (-360, 0, 360)
        )
        size = f"{sign}sqrt({line}.a * {line}.a + {line}.b * {line}.b)"
        return f"degrees(atan(if({inside}, {size}, {ends})))"


def _sides(polygon: str) -> str:
    """SQL for the sides of all rings."""
    return f"""flatten(transform({polygon}.rings, r -> zip_with(
        slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1), (p, q) -> named_struct(
            'lon1', p.lon, 'lat1', p.lat, 'lon2', q.lon, 'lat2', q.lat))))"""


def outline_sides(polygon: str, edges: str) -> str:
    """SQL for the sides, those of a ring over the date line continued beyond 180 degrees.

    Only geodesics take the short way around; planar sides are as they are written.
    """
    if not Plane(edges).geodesic:
        return _sides(polygon)
    beyond = "if(all.over and s.{0} < 0, 360, 0)"
    return f"""get(transform(
        transform(array({_sides(polygon)}), sides -> named_struct(
            'sides', sides, 'over', exists(sides, s -> abs(s.lon2 - s.lon1) > 180))),
        all -> transform(all.sides, s -> named_struct(
            'lon1', s.lon1 + {beyond.format("lon1")}, 'lat1', s.lat1,
            'lon2', s.lon2 + {beyond.format("lon2")}, 'lat2', s.lat2))), 0)"""


def has_outline(polygon: str, edges: str = "geodesic") -> str:
    """SQL: do the sides say which way they go? False for a side half around the globe or more,
    and so for every ring around a pole; NULL for no polygon."""
    if not Plane(edges).geodesic:
        return f"{polygon} is not null"
    return f"forall({outline_sides(polygon, edges)}, s -> abs(s.lon2 - s.lon1) < 180)"


def normal_longitude(lon: Column) -> Column:
    """Longitudes beyond 180 degrees wrap; NaN and infinity become NULL."""
    wrapped = F.pmod(lon + 180, F.lit(360.0)) - 180
    return F.when(F.abs(lon) <= 180, lon).when(F.abs(lon) < 1e15, wrapped)


def valid_latitude(lat: Column) -> Column:
    return F.when(F.abs(lat) <= 90, lat)


def point_basis(lon: str, lat: str, edges: str) -> dict[str, Column]:
    """What a point must carry to be tested against bands; compute once per point."""
    if Plane(edges).geodesic:
        return {
            "height": F.expr(f"tan(radians({lat}))"),
            "cos_lon": F.expr(f"cos(radians({lon}))"),
            "sin_lon": F.expr(f"sin(radians({lon}))"),
        }
    return {"height": F.col(lat)}


def band_holds(band: str, point: str, edges: str) -> str:
    """SQL text: does the band hold the point strictly inside?

    ``band`` and ``point`` are prefixes of the field names, such as ``b.`` or ``_``.
    """
    # Bands of a polygon over the date line go up to 360 degrees.
    lon = f"({point}lon + if({point}lon < {band}lon_from, 360, 0))"
    h = f"{point}height"
    if Plane(edges).geodesic:
        low = f"{band}low_a * {point}cos_lon + {band}low_b * {point}sin_lon"
        high = f"{band}high_a * {point}cos_lon + {band}high_b * {point}sin_lon"
        slack = f"{TOLERANCE} * (1 + {h} * {h})"
    else:
        low = f"{band}low_a + {band}low_b * {lon}"
        high = f"{band}high_a + {band}high_b * {lon}"
        slack = f"{TOLERANCE}"
    return f"""(
        (({lon} > {band}lon_from and {lon} < {band}lon_to)
            or ({lon} = {band}lon_from and {lon} = {band}lon_to))
        and {h} - ({low}) > {slack} and ({high}) - {h} > {slack})"""
