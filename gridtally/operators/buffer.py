"""Polygons that lie inside the buffer of another polygon.

The buffer itself is never built: it is the area together with all points at most
d away from one of its edges.  A polygon is inside exactly if its outline is, and no
hole of the buffer lies within it.

* Along an edge of the polygon, the points at most d away from one edge of the area
  are one interval.  What the intervals leave over lies wholly inside the area or
  wholly outside, so one point of it tells.
* A hole of the buffer has corners: points at distance d from two edges of the area,
  and from none less.  It lies in a polygon whose outline is in the buffer if such
  a corner does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .cells import BOX
from .skew import lookup_join
from .staging import stage
from .within import no_pairs, points_in_boxes

EDGES_PER_STRIP = 16
#: Shares of a side, and of the distance, that rounding can amount to.
LEAST_GAP = 1e-12
SLACK = 1e-9


def _with_frame(areas: DataFrame, dist: float) -> DataFrame:
    """Cut each area, widened by ``dist``, into horizontal strips.

    More edges give more strips, so that a strip holds few edges whatever the
    size of the area, but none is lower than ``dist``.
    """
    strips = f"least(ceil(size(edges) / {EDGES_PER_STRIP}), floor(_height / {dist!r}D))"
    return areas.withColumn("_height", F.expr(f"maxy - miny + 2 * {dist!r}D")).withColumns(
        {
            "_strips": F.expr(f"CAST(greatest(1, {strips}) AS BIGINT)"),
            "_y0": F.expr(f"miny - {dist!r}D"),
        }
    )


def _strip(y: str) -> str:
    raw = f"floor(({y} - _y0) / _height * _strips)"
    return f"greatest(0L, least(_strips - 1, {raw}))"


def _strip_edges(framed: DataFrame, area: Sequence[str]) -> DataFrame:
    """Edges by strip; an edge nearer than a strip's height belongs to it too."""
    each = framed.select(*area, "_strips", "_y0", "_height", F.explode("edges").alias("e"))
    low = _strip("(least(e.ay, e.by) - _height / _strips)")
    high = _strip("(greatest(e.ay, e.by) + _height / _strips)")
    return each.selectExpr(*area, "e", f"explode(sequence({low}, {high})) AS _strip")


def _distance(
    probes: DataFrame,
    strips: tuple[DataFrame, int],
    frames: tuple[DataFrame, int],
    area: Sequence[str],
    probe: Sequence[str],
    dist: float,
) -> DataFrame:
    """Signed distance ``_d`` of each probe to its area.

    Positive outside and NULL beyond ``dist``; negative inside, and no lower
    than minus the height of a strip.
    """
    placed = lookup_join(probes, *frames, area, spread_by=probe).selectExpr(
        *area, *probe, "px_x", "px_y", f"{_strip('px_y')} AS _strip", "_height / _strips AS _cap"
    )
    met = lookup_join(placed, *strips, [*area, "_strip"], spread_by=probe, how="left")
    at = ("e", "px_x", "px_y")
    measured = met.groupBy(*area, *probe, "_cap").agg(
        F.expr(f"count_if({G.crosses_ray(*at)}) AS _crossed"),
        F.expr(f"count_if({G.on_edge(*at)}) AS _on"),
        F.expr(f"sqrt(min({G.segment_distance_sq(*at)})) AS _edge"),
    )
    signed = f"""CASE WHEN _on > 0 THEN 0D WHEN _crossed % 2 = 1 THEN -least(_edge, _cap)
                      WHEN _edge <= {dist!r}D THEN _edge END AS _d"""
    return measured.selectExpr(*area, *probe, signed)


def _near_parts(met: DataFrame, keep: Sequence[str], dist: float) -> DataFrame:
    """``keep, _low, _high``: the part of each side (ax, ay) to (bx, by) at most ``dist`` from the edge ``e``.

    These points are a strip of the edge's length and the discs around its ends; the
    union is convex, so the side meets it in one interval of its length.
    """
    # relative to the start of the edge: q + t * u, edge from 0 to w
    rows = met.selectExpr(
        *keep, "bx - ax AS ux", "by - ay AS uy", "ax - e.ax AS qx", "ay - e.ay AS qy",
        "e.bx - e.ax AS wx", "e.by - e.ay AS wy",
    ).selectExpr(
        "*", "ux * ux + uy * uy AS _a", "ux * qx + uy * qy AS _b0",
        f"qx * qx + qy * qy - {dist * dist!r}D AS _c0", "ux * (qx - wx) + uy * (qy - wy) AS _b1",
        f"(qx - wx) * (qx - wx) + (qy - wy) * (qy - wy) - {dist * dist!r}D AS _c1",
        "wx * wx + wy * wy AS _ww", "wx * qy - wy * qx AS _f0", "wx * uy - wy * ux AS _f1",
        "wx * qx + wy * qy AS _g0", "wx * ux + wy * uy AS _g1",
    ).selectExpr("*", f"{dist!r}D * sqrt(_ww) AS _dw")
    # least and greatest pass over NULL: a side along the edge is bounded by its ends alone, and so on
    rows = rows.selectExpr(
        *keep, "_a", "_c0", "_c1", "_b0 * _b0 - _a * _c0 AS _d0", "_b1 * _b1 - _a * _c1 AS _d1", "_b0", "_b1",
        "_ww > 0 AND (_f1 <> 0 OR abs(_f0) <= _dw) AND (_g1 <> 0 OR _g0 BETWEEN 0 AND _ww) AS _beside",
        "(-_dw - _f0) / nullif(_f1, 0D) AS _n0", "(_dw - _f0) / nullif(_f1, 0D) AS _n1",
        "-_g0 / nullif(_g1, 0D) AS _m0", "(_ww - _g0) / nullif(_g1, 0D) AS _m1",
    ).selectExpr(
        *keep, "_beside", "greatest(least(_n0, _n1), least(_m0, _m1), 0D) AS _l0",
        "least(greatest(_n0, _n1), greatest(_m0, _m1), 1D) AS _h0",
        *[f"_d{i} >= 0 AND (_a > 0 OR _c{i} <= 0) AS _round{i}" for i in (0, 1)],
        *[f"greatest((-_b{i} - sqrt(greatest(_d{i}, 0D))) / nullif(_a, 0D), 0D) AS _l{i + 1}" for i in (0, 1)],
        *[f"least((-_b{i} + sqrt(greatest(_d{i}, 0D))) / nullif(_a, 0D), 1D) AS _h{i + 1}" for i in (0, 1)],
    )
    known = [f"{flag} AND _l{i} <= _h{i}" for i, flag in enumerate(("_beside", "_round0", "_round1"))]
    low, high = (", ".join(f"if({ok}, {end}{i}, NULL)" for i, ok in enumerate(known)) for end in ("_l", "_h"))
    # a generator, since a filter would be pushed down with all that it is made of
    span = f"array(named_struct('_low', least({low}), '_high', greatest({high})))"
    return rows.selectExpr(*keep, f"inline(filter({span}, s -> s._low IS NOT NULL))")


def _outside(near: DataFrame, pair: Sequence[str], strips, frames, area: Sequence[str], own: Sequence[str], dist: float):
    """The pairs whose polygon has a point of its outline beyond the buffer."""
    side = [*own, "_k"]
    sides = near.select(*pair, F.posexplode("edges").alias("_k", "s")).selectExpr(
        *pair, "_k", *[f"s.{c} AS {c}" for c in ("ax", "ay", "bx", "by")]
    )
    low, high = _strip("least(ay, by)"), _strip("greatest(ay, by)")
    placed = lookup_join(sides, *frames, area, spread_by=side).withColumn(
        "_strip", F.expr(f"explode(sequence({low}, {high}))")
    )
    met = lookup_join(placed, *strips, [*area, "_strip"], spread_by=side).where(
        " AND ".join(
            f"least({a}, {b}) <= greatest(e.{a}, e.{b}) + {dist!r}D AND greatest({a}, {b}) >= least(e.{a}, e.{b}) - {dist!r}D"
            for a, b in (("ax", "bx"), ("ay", "by"))
        )
    )
    keep = [*pair, "_k", "ax", "ay", "bx", "by"]
    parts = _near_parts(met, keep, dist)
    # what is left before a part, and after the last one
    ends = sides.selectExpr(*keep, "1D AS _low", "1D AS _high")
    before = Window.partitionBy(*pair, "_k").orderBy("_low", "_high").rowsBetween(Window.unboundedPreceding, -1)
    gaps = (
        parts.unionByName(ends)
        .withColumn("_from", F.coalesce(F.max("_high").over(before), F.lit(0.0)))
        .where(F.col("_low") - F.col("_from") > LEAST_GAP)
        .withColumn("_t", (F.col("_low") + F.col("_from")) / 2)
        .selectExpr(*pair, "_k", "_t", "ax + _t * (bx - ax) AS px_x", "ay + _t * (by - ay) AS px_y")
    )
    far = _distance(gaps, strips, frames, area, [*side, "_t"], dist)
    return far.where("_d IS NULL").select(*pair).distinct()


def _edge_cells(edges: DataFrame, area: Sequence[str], dist: float) -> DataFrame:
    """Edges with the squares of side ``2 * dist`` that come within ``dist`` of them, row by row of squares."""
    size = 2 * dist
    rows = edges.withColumn(
        "_iy",
        F.expr(
            f"explode(sequence(CAST(floor((least(ay, by) - {dist!r}D) / {size!r}D) AS BIGINT),"
            f" CAST(floor((greatest(ay, by) + {dist!r}D) / {size!r}D) AS BIGINT)))"
        ),
    )
    # the part of the edge that is near enough to the row
    def at(y: str) -> str:
        return f"CASE WHEN by = ay THEN {{}} ELSE greatest(0D, least(1D, ({y} - ay) / (by - ay))) END"

    rows = rows.selectExpr(
        "*",
        at(f"(_iy * {size!r}D - {dist!r}D)").format("0D") + " AS _t0",
        at(f"((_iy + 1) * {size!r}D + {dist!r}D)").format("1D") + " AS _t1",
    ).selectExpr("*", "ax + _t0 * (bx - ax) AS _x0", "ax + _t1 * (bx - ax) AS _x1")
    return rows.withColumn(
        "_ix",
        F.expr(
            f"explode(sequence(CAST(floor((least(_x0, _x1) - {dist!r}D) / {size!r}D) AS BIGINT),"
            f" CAST(floor((greatest(_x0, _x1) + {dist!r}D) / {size!r}D) AS BIGINT)))"
        ),
    ).select(*area, "_n", "ax", "ay", "bx", "by", "_ix", "_iy")


def _corners(edges: DataFrame, area: Sequence[str], dist: float) -> DataFrame:
    """``area, x, y``: points at distance ``dist`` from two edges, in whose square both are near.

    The outline around an edge is two lines beside it and two circles around its
    ends; corners are where a line or circle of one edge meets one of another.
    """
    size, slack = 2 * dist, dist * SLACK
    cells = _edge_cells(edges, area, dist).selectExpr(
        "*", "bx - ax AS dx", "by - ay AS dy",
        f"try_divide({dist!r}D, sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))) AS _s",
    ).selectExpr(
        *area, "_ix", "_iy", "_n", "named_struct('ax', ax, 'ay', ay, 'bx', bx, 'by', by) AS e",
        """array(named_struct('x', ax - dy * _s, 'y', ay + dx * _s, 'u', dx, 'v', dy),
                 named_struct('x', ax + dy * _s, 'y', ay - dx * _s, 'u', dx, 'v', dy)) AS lines""",
        "array(named_struct('x', ax, 'y', ay), named_struct('x', bx, 'y', by)) AS ends",
    )
    cell = [*area, "_ix", "_iy"]
    others = cells.select(*cell, *[F.col(c).alias(f"{c}2") for c in ("_n", "e", "lines", "ends")])
    pairs = cells.join(others, cell).where("_n < _n2")

    def step(p: str, t: str) -> str:
        return f"named_struct('x', {p}.x + {t} * {p}.u, 'y', {p}.y + {t} * {p}.v)"

    cross = "(p.u * q.v - p.v * q.u)"
    lines = f"""flatten(transform(lines, p -> transform(lines2, q ->
        {step("p", f"try_divide((q.x - p.x) * q.v - (q.y - p.y) * q.u, {cross})")})))"""

    def line_and_circle(own: str, theirs: str) -> str:
        a, b = "(p.u * p.u + p.v * p.v)", "(p.u * (p.x - c.x) + p.v * (p.y - c.y))"
        under = f"({b} * {b} - {a} * (pow(p.x - c.x, 2) + pow(p.y - c.y, 2) - {dist * dist!r}D))"
        roots = [step("p", f"try_divide(-{b} {sign} sqrt(CASE WHEN {under} >= 0 THEN {under} END), {a})") for sign in "+-"]
        return f"flatten(transform({own}, p -> flatten(transform({theirs}, c -> array({', '.join(roots)})))))"

    half = f"sqrt(CASE WHEN pow(d.x - c.x, 2) + pow(d.y - c.y, 2) <= {4 * dist * dist!r}D THEN {dist * dist!r}D - (pow(d.x - c.x, 2) + pow(d.y - c.y, 2)) / 4 END)"
    rise = f"try_divide({half}, sqrt(pow(d.x - c.x, 2) + pow(d.y - c.y, 2)))"
    both = [
        f"named_struct('x', (c.x + d.x) / 2 {a} {rise} * (d.y - c.y), 'y', (c.y + d.y) / 2 {b} {rise} * (d.x - c.x))"
        for a, b in ("-+", "+-")
    ]
    circles = f"flatten(transform(ends, c -> flatten(transform(ends2, d -> array({', '.join(both)})))))"
    found = pairs.selectExpr(
        *area, "_ix", "_iy", "e", "e2",
        f"inline(concat({lines}, {line_and_circle('lines', 'ends2')}, {line_and_circle('lines2', 'ends')}, {circles}))",
    )
    here = f"floor(x / {size!r}D) = _ix AND floor(y / {size!r}D) = _iy"
    on = " AND ".join(
        f"abs(sqrt({G.segment_distance_sq(e, 'x', 'y')}) - {dist!r}D) <= {slack!r}D" for e in ("e", "e2")
    )
    return found.where(f"x IS NOT NULL AND y IS NOT NULL AND {here}").where(on).select(*area, "x", "y").distinct()


def _with_hole(kept: DataFrame, pair, strips, frames, theirs: DataFrame, area, own, dist: float) -> DataFrame | None:
    """The pairs whose polygon holds a hole of the buffer; None if that cannot be."""
    centre = kept.selectExpr(*pair, "(minx + maxx) / 2 AS px_x", "(miny + maxy) / 2 AS px_y")
    middle = _distance(centre, strips, frames, area, own, dist)
    # all points of a polygon whose middle is deep enough in the buffer are in it
    reach = "sqrt(pow(maxx - minx, 2) + pow(maxy - miny, 2)) / 2"
    wide = stage(
        kept.join(middle, pair).where(f"_d IS NULL OR _d + {reach} > {dist!r}D").drop("_d"), "wide"
    )
    ranges = wide.groupBy(*area).agg(*[F.expr(f"{c[:3]}({c}) AS _{c}") for c in BOX])
    edges = (
        theirs.select(*area, F.posexplode("edges").alias("_n", "e"))
        .join(ranges, list(area))
        .selectExpr(*area, "_n", "e.ax", "e.ay", "e.bx", "e.by", *[f"_{c}" for c in BOX])
        .where(
            f"greatest(ax, bx) >= _minx - {2 * dist!r}D AND least(ax, bx) <= _maxx + {2 * dist!r}D AND"
            f" greatest(ay, by) >= _miny - {2 * dist!r}D AND least(ay, by) <= _maxy + {2 * dist!r}D"
        )
    )
    corners = _corners(edges, area, dist).withColumn("_v", F.monotonically_increasing_id())
    corners = stage(corners.withColumnsRenamed({"x": "px_x", "y": "px_y"}), "corners")
    if corners.isEmpty():
        return None
    depth = _distance(corners, strips, frames, area, ["_v"], dist)
    free = depth.where(f"_d IS NULL OR _d >= {dist * (1 - SLACK)!r}D").select("_v")
    free = stage(corners.join(free, "_v"), "free-corners")
    boxes = wide.select(*pair, *BOX, "edges")
    found = points_in_boxes(free, boxes, "px_x", "px_y", area, ["_v"])
    if found is None:
        return None
    return found.where(G.strictly_inside("edges", "px_x", "px_y")).select(*pair).distinct()


def within_buffer(
    polygons: DataFrame,
    areas: DataFrame,
    dist: float = 1000.0,
    polygon_id: Sequence[str] = ("vintage", "geoid"),
    area_id: Sequence[str] = ("uace",),
    rings: str = "rings",
    project: Callable[[Column, Column], tuple[Column, Column]] | None = G.to_conic,
) -> DataFrame:
    """Pairs ``polygon_id, area_id`` where the polygon is in the area's buffer.

    Vertices are projected first (degrees to metres) unless ``project`` is None.
    Exact up to the rounding of coordinates; a point at distance ``dist`` is in the
    buffer, and each area counts for itself.
    """
    if dist <= 0:
        raise ValueError("dist must be positive")
    polygon_id, area_id = list(polygon_id), list(area_id)
    pair = [*polygon_id, *area_id]

    def prepared(df: DataFrame, ids: list[str]) -> DataFrame:
        shape = G.map_points(F.col(rings), project) if project else F.col(rings)
        out = df.select(*ids, shape.alias("_rings")).where(F.col("_rings").isNotNull())
        return out.withColumns({**G.box("_rings"), "edges": G.edges("_rings")})

    mine = stage(prepared(polygons, polygon_id).drop("_rings"), "polygons")
    theirs = stage(_with_frame(prepared(areas, area_id).drop("_rings"), dist), "areas")
    strips = stage(_strip_edges(theirs, area_id), "strips")
    strips = strips, strips.count()
    frames = theirs.select(*area_id, "_strips", "_y0", "_height"), theirs.count()

    # candidates: the polygon's box must lie in the area's box widened by dist
    centres = mine.selectExpr(
        *polygon_id,
        *[f"{c} AS p_{c}" for c in BOX],
        "(minx + maxx) / 2 AS p_x",
        "(miny + maxy) / 2 AS p_y",
    )
    wide = theirs.selectExpr(
        *area_id,
        *[f"{c} {'-' if c.startswith('min') else '+'} {dist!r}D AS {c}" for c in BOX],
    )
    near = points_in_boxes(centres, wide, "p_x", "p_y", (), polygon_id)
    if near is None:
        return no_pairs(polygons, polygon_id, areas, area_id)
    near = near.where(
        "p_minx >= minx AND p_maxx <= maxx AND p_miny >= miny AND p_maxy <= maxy"
    ).select(*pair)
    near = stage(near.join(mine, polygon_id), "pairs")
    out = _outside(near, pair, strips, frames, area_id, polygon_id, dist)
    kept = stage(near.join(out, pair, "left_anti"), "kept")
    holed = _with_hole(kept, pair, strips, frames, theirs, area_id, polygon_id, dist)
    inside = kept.select(*pair)
    return inside if holed is None else inside.join(holed, pair, "left_anti")
