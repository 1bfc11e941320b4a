"""Planar geometry as column expressions.

A polygon is ``array<array<struct<x:double,y:double>>>``: closed rings, parts
of a multipolygon flattened, holes by the even-odd rule.  ``edges`` is the same
polygon as a flat ``array<struct<ax,ay,bx,by>>``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring(*points: tuple[Column, Column]) -> Column:
    """Ring through the given points, closed by repeating the first."""
    closed = [*points, points[0]]
    return F.array(*[point(x, y) for x, y in closed])


# --- text forms -----------------------------------------------------------

def _oriented(rings: Column) -> Column:
    """Rings of one part: the first counter-clockwise, its holes clockwise."""
    return F.transform(
        rings,
        lambda r, i: F.when((_signed_area(r) >= 0) == (i == 0), r).otherwise(F.reverse(r)),
    )


def _signed_area(points: Column) -> Column:
    o = F.get(points, F.lit(0))
    steps = F.sequence(F.lit(1), F.greatest(F.size(points) - 1, F.lit(1)))

    def add(area: Column, i: Column) -> Column:
        p, q = F.get(points, i - 1), F.get(points, i)
        return (
            area
            + (p["x"] - o["x"]) * (q["y"] - o["y"])
            - (q["x"] - o["x"]) * (p["y"] - o["y"])
        )

    return F.aggregate(steps, F.lit(0.0), add)


def rings_from_wkt(wkt: Column) -> Column:
    """Rings of ``POLYGON`` or ``MULTIPOLYGON`` text, cut at the borders between rings."""
    text = F.trim(wkt)
    body = F.regexp_extract(text, r"(?is)^[A-Z]*POLYGON[^(]*\((.*)\)$", 1)
    body = F.regexp_replace(body, r"\s*([(),])\s*", "$1")
    body = F.when(text.rlike(r"(?i)^MULTI"), body).otherwise(F.concat(F.lit("("), body, F.lit(")")))
    inner = F.regexp_replace(body, r"^\(\(|\)\)$", "")

    def parse_point(point_text: Column) -> Column:
        xy = F.split(F.trim(point_text), r"\s+")
        return point(F.get(xy, F.lit(0)), F.get(xy, F.lit(1)))

    def parse_part(part: Column) -> Column:
        rings = F.split(part, r"\),\(")
        return _oriented(F.transform(rings, lambda t: F.transform(F.split(t, ","), parse_point)))

    parts = F.split(inner, r"\)\),\(\(")
    return F.when(body.rlike(r"^\(\([^()]"), F.flatten(F.transform(parts, parse_part)))


def rings_from_geojson(geometry: Column) -> Column:
    """Rings of a GeoJSON ``Polygon`` or ``MultiPolygon`` given as JSON text."""
    kind = F.get_json_object(geometry, "$.type")
    coords = F.get_json_object(geometry, "$.coordinates")

    def parse_part(rings: Column) -> Column:
        return _oriented(
            F.transform(
                rings,
                lambda r: F.transform(r, lambda p: point(F.get(p, F.lit(0)), F.get(p, F.lit(1)))),
            )
        )

    single = F.from_json(coords, "array<array<array<double>>>")
    multi = F.from_json(coords, "array<array<array<array<double>>>>")
    return F.when(kind == "Polygon", parse_part(single)).when(
        kind == "MultiPolygon", F.flatten(F.transform(multi, parse_part))
    )


# --- edges and boxes ------------------------------------------------------
# These take column names or SQL text and return SQL expressions: they run for
# every edge, and one parsed text is much cheaper to build than nested columns.


def _ring_edges(r: str) -> str:
    return (
        f"transform(sequence(1, greatest(size({r}) - 1, 1)), i -> named_struct("
        f"'ax', get({r}, i - 1).x, 'ay', get({r}, i - 1).y,"
        f" 'bx', get({r}, i).x, 'by', get({r}, i).y))"
    )


def edges(rings: str) -> Column:
    """All edges of a polygon; rings of fewer than two points have none."""
    return F.expr(
        f"flatten(transform(filter({rings}, r -> size(r) > 1), r -> {_ring_edges('r')}))"
    )


def box(rings: str) -> dict[str, Column]:
    """Bounding box as four columns ``minx, maxx, miny, maxy``."""
    return {
        f"{end}{axis}": F.expr(f"array_{end}(flatten({rings}).{axis})")
        for axis in ("x", "y")
        for end in ("min", "max")
    }


def _cross(e: str, x: str, y: str) -> str:
    return f"(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({e}.by - {e}.ay) * ({x} - {e}.ax))"


def on_edge(e: str, x: str, y: str) -> str:
    """Is the point on the segment?"""
    return (
        f"({x} BETWEEN least({e}.ax, {e}.bx) AND greatest({e}.ax, {e}.bx)"
        f" AND {y} BETWEEN least({e}.ay, {e}.by) AND greatest({e}.ay, {e}.by)"
        f" AND {_cross(e, x, y)} = 0)"
    )


def crosses_ray(e: str, x: str, y: str) -> str:
    """Does the segment cross the ray from the point to the right?

    The crossing point is compared by the sign of the cross product, without a
    division.
    """
    return (
        f"(({e}.ay > {y}) <> ({e}.by > {y})"
        f" AND ({_cross(e, x, y)} > 0) = ({e}.by > {e}.ay))"
    )


def touches_edges(edge_list: str, x: str, y: str) -> str:
    return f"exists({edge_list}, e -> {on_edge('e', x, y)})"


def strictly_inside(edge_list: str, x: str, y: str) -> str:
    """Even-odd test in one pass; a point on the boundary is not inside.

    The state counts the crossed edges and stays at -1 from a touched edge on.
    """
    crossed = (
        f"aggregate({edge_list}, 0, (s, e) -> CASE WHEN s < 0 OR {on_edge('e', x, y)} THEN -1"
        f" WHEN {crosses_ray('e', x, y)} THEN s + 1 ELSE s END)"
    )
    return f"(pmod(greatest({crossed}, 0), 2) = 1)"


def edges_for_box(edge_list: str, minx: str, miny: str, maxy: str) -> str:
    """The edges that can matter to ``strictly_inside`` for points of a box.

    An edge wholly above, below or to the left of the box is neither crossed by
    a ray to the right nor touched by a point of the box.
    """
    return (
        f"filter({edge_list}, e -> greatest(e.ay, e.by) >= {miny}"
        f" AND least(e.ay, e.by) <= {maxy} AND greatest(e.ax, e.bx) >= {minx})"
    )


def edge_meets_square(e: str, x: str, y: str, half: str) -> str:
    """Does the segment meet the square around ``x, y``?

    For edges whose heights overlap the square already.  The square must not
    lie on one side of the line; the last factor allows for rounding.
    """
    return (
        f"(least({e}.ax, {e}.bx) <= {x} + {half} AND greatest({e}.ax, {e}.bx) >= {x} - {half}"
        f" AND abs({_cross(e, x, y)})"
        f" <= {half} * (abs({e}.bx - {e}.ax) + abs({e}.by - {e}.ay)) * 1.000000001D)"
    )


def segment_distance_sq(e: str, x: str, y: str) -> str:
    """Squared distance from a point to a segment."""
    dx, dy = f"({e}.bx - {e}.ax)", f"({e}.by - {e}.ay)"
    t = (
        f"greatest(0D, least(1D, coalesce(try_divide(({x} - {e}.ax) * {dx}"
        f" + ({y} - {e}.ay) * {dy}, {dx} * {dx} + {dy} * {dy}), 0D)))"
    )
    return f"(pow({e}.ax + {t} * {dx} - {x}, 2) + pow({e}.ay + {t} * {dy} - {y}, 2))"


# --- measures -------------------------------------------------------------

def centroid(rings: str) -> Column:
    """Area-weighted planar centroid as ``struct<x,y>``.

    Outer rings and holes must run in opposite directions, so that the signed
    ring areas subtract holes.  Coordinates are shifted by the first vertex to
    keep precision.  Zero area gives the mean of the vertices.
    """
    ox, oy = f"get(get({rings}, 0), 0).x", f"get(get({rings}, 0), 0).y"
    ax, ay, bx, by = f"(e.ax - {ox})", f"(e.ay - {oy})", f"(e.bx - {ox})", f"(e.by - {oy})"
    w = f"({ax} * {by} - {bx} * {ay})"
    moments = (
        f"aggregate(flatten(transform(filter({rings}, r -> size(r) > 1), r -> {_ring_edges('r')})),"
        " named_struct('a', 0D, 'mx', 0D, 'my', 0D),"
        f" (m, e) -> named_struct('a', m.a + {w}, 'mx', m.mx + ({ax} + {bx}) * {w},"
        f" 'my', m.my + ({ay} + {by}) * {w}))"
    )
    # the last vertex of a ring repeats the first
    vertices = f"flatten(transform({rings}, r -> slice(r, 1, greatest(size(r) - 1, 0))))"
    mean = {
        c: f"try_divide(aggregate({vertices}.{c}, 0D, (s, v) -> s + v), size({vertices}))"
        for c in ("x", "y")
    }
    return F.expr(
        f"get(transform(array({moments}), m -> CASE WHEN m.a <> 0 THEN"
        f" named_struct('x', {ox} + try_divide(m.mx, 3 * m.a), 'y', {oy} + try_divide(m.my, 3 * m.a))"
        f" ELSE named_struct('x', {mean['x']}, 'y', {mean['y']}) END), 0)"
    )


def ring_area(r: str) -> str:
    """Signed area of a ring, positive when it runs counter-clockwise."""
    ox, oy = f"get({r}, 0).x", f"get({r}, 0).y"
    return (
        f"(aggregate(sequence(1, greatest(size({r}) - 1, 1)), 0D, (a, i) -> a"
        f" + (get({r}, i - 1).x - {ox}) * (get({r}, i).y - {oy})"
        f" - (get({r}, i).x - {ox}) * (get({r}, i - 1).y - {oy})) / 2)"
    )


def map_points(rings: Column, move) -> Column:
    """Apply ``move(x, y) -> (x, y)`` to every vertex."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: point(*move(p["x"], p["y"]))))


# --- projection -----------------------------------------------------------

# GRS80 ellipsoid and the North American equidistant conic
# (origin 40 N 96 W, standard parallels 20 N and 60 N).
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
CONIC = {"lat0": 40.0, "lon0": -96.0, "lat1": 20.0, "lat2": 60.0}


def _arc_terms(e2: float) -> tuple[float, float, float, float]:
    """Coefficients of the meridian arc series (Snyder 1987, 3-21)."""
    e4, e6 = e2 * e2, e2 * e2 * e2
    return (
        1 - e2 / 4 - 3 * e4 / 64 - 5 * e6 / 256,
        3 * e2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024,
        15 * e4 / 256 + 45 * e6 / 1024,
        35 * e6 / 3072,
    )


def conic_constants() -> dict[str, float]:
    """Constants of the projection (Snyder 1987, 16-1 to 16-4)."""
    e2 = GRS80_F * (2 - GRS80_F)
    c0, c2, c4, c6 = _arc_terms(e2)

    def arc(phi: float) -> float:
        return GRS80_A * (
            c0 * phi - c2 * math.sin(2 * phi) + c4 * math.sin(4 * phi) - c6 * math.sin(6 * phi)
        )

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    p0, p1, p2 = (math.radians(CONIC[k]) for k in ("lat0", "lat1", "lat2"))
    n = GRS80_A * (m(p1) - m(p2)) / (arc(p2) - arc(p1))
    ag = GRS80_A * m(p1) / n + arc(p1)
    return {"n": n, "ag": ag, "rho0": ag - arc(p0), "c0": c0, "c2": c2, "c4": c4, "c6": c6}


def to_conic(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to equidistant conic metres."""
    k = conic_constants()
    phi = F.radians(lat)
    arc = GRS80_A * (
        k["c0"] * phi
        - k["c2"] * F.sin(2 * phi)
        + k["c4"] * F.sin(4 * phi)
        - k["c6"] * F.sin(6 * phi)
    )
    rho = F.lit(k["ag"]) - arc
    theta = F.lit(k["n"]) * F.radians(lon - F.lit(CONIC["lon0"]))
    return rho * F.sin(theta), F.lit(k["rho0"]) - rho * F.cos(theta)
