"""Polygons whose rings cross: found, cut where they cross, and traced anew.

What a polygon covers is told by the even-odd rule: a point is inside if a ray from
it crosses the rings an odd number of times.  Edges are cut where they cross or touch,
found in horizontal strips that hold few edges each; pieces that lie on one another an
even number of times bound nothing.  Every other piece has the inside on one side, and
the pieces of a polygon are joined to rings that do not cross.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator, Sequence
from math import atan2

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from .staging import stage

# executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGES_PER_STRIP = 8
MOST_STRIPS = 1 << 16
#: Ends and crossings are rounded to 2 ** -40 of a polygon's size.
GRAIN_BITS = 40
#: Share of a polygon's box that an area may owe to rounding.
LEAST_AREA = 1e-13

Ring = list[tuple[float, float]]


def _ring_edges(polygons: DataFrame, key: str, rings: str) -> DataFrame:
    """``key, _n, ax, ay, bx, by``: all edges that have a length; open rings are closed."""
    finite = "abs(p.x) < double('Infinity') AND abs(p.y) < double('Infinity')"
    known = f"filter(transform({rings}, r -> filter(r, p -> {finite})), r -> size(r) > 1)"
    closed = "transform(_rings, r -> concat(r, array(get(r, 0))))"
    rows = polygons.withColumn("_rings", F.expr(known)).withColumn("_rings", F.expr(closed))
    edges = rows.select(key, F.posexplode(G.edges("_rings")).alias("_n", "e"))
    return edges.selectExpr(key, "_n", "e.ax", "e.ay", "e.bx", "e.by").where("ax <> bx OR ay <> by")


def _strips(edges: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """The strips of each polygon: ``key, _base, _tall, _many``, more where it has more edges."""
    many = f"least({MOST_STRIPS}L, greatest(1L, CAST(ceil(count(1) / {EDGES_PER_STRIP}) AS BIGINT)))"
    return edges.groupBy(key).agg(
        F.expr(f"min({low}) AS _base"), F.expr(f"max({high}) - min({low}) AS _tall"), F.expr(f"{many} AS _many")
    )


def _strip(y: str) -> str:
    raw = f"floor(coalesce(({y} - _base) / nullif(_tall, 0D), 0D) * _many)"
    return f"greatest(0L, least(_many - 1, {raw}))"


def _side(e: str, x: str, y: str) -> str:
    """On which side of the line of ``e`` a point lies."""
    return f"(({e}.bx - {e}.ax) * ({y} - {e}.ay) - ({e}.by - {e}.ay) * ({x} - {e}.ax))"


def _meeting(edges: DataFrame, key: str) -> DataFrame:
    """Pairs ``l``, ``r`` of edges of a polygon whose boxes meet, with the sides their ends lie on."""
    frames = _strips(edges, key, "least(ay, by)", "greatest(ay, by)")
    low, high = _strip("least(ay, by)"), _strip("greatest(ay, by)")
    placed = edges.join(frames, key).withColumn("_strip", F.expr(f"explode(sequence({low}, {high}))"))
    own = [c for c in ("ax", "ay", "bx", "by", "grain") if c in edges.columns]
    one = placed.select(key, "_strip", F.col("_n").alias("ln"), F.struct(*own).alias("l"))
    two = placed.select(key, "_strip", F.col("_n").alias("rn"), F.struct(*own).alias("r"))
    meets = " AND ".join(
        f"least(l.{a}, l.{b}) <= greatest(r.{a}, r.{b}) AND greatest(l.{a}, l.{b}) >= least(r.{a}, r.{b})"
        for a, b in (("ax", "bx"), ("ay", "by"))
    )
    pairs = one.join(two, [key, "_strip"]).where("ln < rn").where(meets)
    return pairs.selectExpr(
        key, "ln", "rn", "l", "r",
        f"{_side('l', 'r.ax', 'r.ay')} AS o1", f"{_side('l', 'r.bx', 'r.by')} AS o2",
        f"{_side('r', 'l.ax', 'l.ay')} AS o3", f"{_side('r', 'l.bx', 'l.by')} AS o4",
    )


_PROPER = "(signum(o1) * signum(o2) < 0 AND signum(o3) * signum(o4) < 0)"
_ALONG = "(o1 = 0 AND o2 = 0 AND (" + " OR ".join(
    f"least(greatest(l.{a}, l.{b}), greatest(r.{a}, r.{b})) > greatest(least(l.{a}, l.{b}), least(r.{a}, r.{b}))"
    for a, b in (("ax", "bx"), ("ay", "by"))
) + "))"


def crossing_polygons(polygons: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    """The ``key`` of polygons with edges that cross, or lie on one another along some length."""
    return _meeting(_ring_edges(polygons, key, rings), key).where(f"{_PROPER} OR {_ALONG}").select(key).distinct()


def _rounded(edges: DataFrame, key: str) -> DataFrame:
    """Edges with their ends rounded to a power of two, ``grain``, of the size of their polygon.

    So that lines which meet in one point meet there after rounding too.
    """
    size = "greatest(max(greatest(ax, bx)) - min(least(ax, bx)), max(greatest(ay, by)) - min(least(ay, by)))"
    sizes = edges.groupBy(key).agg(F.expr(f"pow(2D, floor(log2({size})) - {GRAIN_BITS}) AS grain"))
    ends = [f"round({c} / grain) * grain AS {c}" for c in ("ax", "ay", "bx", "by")]
    return edges.join(sizes, key).selectExpr(key, "_n", *ends, "grain").where("ax <> bx OR ay <> by")


def _pieces(edges: DataFrame, key: str) -> DataFrame:
    """``key, px, py, qx, qy``: edges cut where they meet, those that bound something, once each."""
    pairs = _meeting(edges, key)
    x, y = (f"l.a{c} + o3 / (o3 - o4) * (l.b{c} - l.a{c})" for c in "xy")
    at = f"named_struct('x', round(({x}) / l.grain) * l.grain, 'y', round(({y}) / l.grain) * l.grain)"

    def cut(edge: str, other: str, end: str, side: str) -> str:
        """An end of the other edge that lies on this one."""
        x, y = f"{other}.{end}x", f"{other}.{end}y"
        within = (
            f"{side} = 0 AND {x} BETWEEN least({edge}.ax, {edge}.bx) AND greatest({edge}.ax, {edge}.bx)"
            f" AND {y} BETWEEN least({edge}.ay, {edge}.by) AND greatest({edge}.ay, {edge}.by)"
        )
        return f"if({within}, named_struct('n', {edge}n, 'x', {x}, 'y', {y}), NULL)"

    touches = [cut("l", "r", "a", "o1"), cut("l", "r", "b", "o2"), cut("r", "l", "a", "o3"), cut("r", "l", "b", "o4")]
    both = [f"if({_PROPER}, named_struct('n', {n}, 'x', at.x, 'y', at.y), NULL)" for n in ("ln", "rn")]
    found = pairs.selectExpr("*", f"if({_PROPER}, {at}, NULL) AS at").selectExpr(
        key, f"inline(filter(array({', '.join(both + touches)}), c -> c IS NOT NULL))"
    )
    lines = edges.selectExpr(key, "_n", "ax", "ay", "bx - ax AS dx", "by - ay AS dy")
    ends = edges.selectExpr(key, "_n AS n", "inline(array(named_struct('x', ax, 'y', ay), named_struct('x', bx, 'y', by)))")
    points = found.unionByName(ends).distinct().withColumnsRenamed({"n": "_n"})
    along = Window.partitionBy(key, "_n").orderBy("_t", "x", "y")
    parts = (
        points.join(lines, [key, "_n"])
        .withColumn("_t", F.expr("(x - ax) * dx + (y - ay) * dy"))
        .withColumns({"x2": F.lead("x").over(along), "y2": F.lead("y").over(along)})
        .where("x2 IS NOT NULL AND (x <> x2 OR y <> y2)")
    )
    turned = "(x > x2 OR (x = x2 AND y > y2))"
    names = {"px": ("x2", "x"), "py": ("y2", "y"), "qx": ("x", "x2"), "qy": ("y", "y2")}
    parts = parts.selectExpr(key, *[f"if({turned}, {a}, {b}) AS {c}" for c, (a, b) in names.items()])
    odd = parts.groupBy(key, *names).agg(F.count(F.lit(1)).alias("_times")).where("_times % 2 = 1")
    return odd.drop("_times")


def _doubled_area(ring: Ring) -> float:
    (x0, y0) = ring[0]
    return sum((a - x0) * (d - y0) - (c - x0) * (b - y0) for (a, b), (c, d) in zip(ring, ring[1:]))


def _holds(ring: Ring, x: float, y: float) -> bool:
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and (((bx - ax) * (y - ay) - (by - ay) * (x - ax)) > 0) == (by > ay):
            hit = not hit
    return hit


def _loops(pieces: list[tuple]) -> list[Ring]:
    """Closed lines through all pieces, none of which crosses another or itself.

    At every point where pieces meet their number is even; they are sorted by direction
    and go on to their neighbour in that order, so that lines touch there and do not
    cross.  A line that comes back to a point closes a loop of its own.
    """
    around: dict[tuple, list[tuple[float, int, int]]] = defaultdict(list)
    for i, (px, py, qx, qy) in enumerate(pieces):
        around[px, py].append((atan2(qy - py, qx - px), i, 0))
        around[qx, qy].append((atan2(py - qy, px - qx), i, 1))
    partner = {}
    for ends in around.values():
        ends.sort()
        for (_, i, a), (_, j, b) in zip(ends[::2], ends[1::2]):
            partner[i, a], partner[j, b] = (j, b), (i, a)
    used, loops = [False] * len(pieces), []
    for first in range(len(pieces)):
        line, at, piece, end = [], {}, first, 0
        while not used[piece]:
            used[piece] = True
            point = pieces[piece][2 * end : 2 * end + 2]
            if point in at:
                loops.append([*line[at[point] :], point])
                for gone in line[at[point] + 1 :]:
                    del at[gone]
                del line[at[point] :]
            at[point] = len(line)
            line.append(point)
            piece, end = partner[piece, 1 - end]
        if line:
            loops.append([*line, line[0]])
    return loops


def trace(pieces: np.ndarray) -> list[Ring]:
    """Rings of pieces (px, py, qx, qy), each of which bounds the inside on one side.

    A loop is an outer ring if an even number of others goes around it, else a hole.
    Outer rings come counter-clockwise, the largest first, each followed by its holes,
    which run clockwise.  Loops that rounding has left without an area are dropped.
    """
    if not len(pieces):
        return []
    loops = _loops(sorted(map(tuple, pieces.tolist())))
    spans = pieces.reshape(-1, 2, 2)
    width, height = spans.max(axis=(0, 1)) - spans.min(axis=(0, 1))
    least = LEAST_AREA * width * height
    loops = sorted((r for r in loops if abs(_doubled_area(r)) > least), key=lambda r: (-abs(_doubled_area(r)), r))
    outer: list[int] = []
    holes: dict[int, list[Ring]] = defaultdict(list)
    for i, ring in enumerate(loops):
        x, y = (ring[0][0] + ring[1][0]) / 2, (ring[0][1] + ring[1][1]) / 2
        depth = [j for j in range(i) if _holds(loops[j], x, y)]
        turned = ring if (_doubled_area(ring) > 0) == (len(depth) % 2 == 0) else ring[::-1]
        if len(depth) % 2:
            holes[max(j for j in depth if j in outer)].append(turned)
        else:
            outer.append(i)
            holes[i].insert(0, turned)
    return [ring for i in outer for ring in holes[i]]


def _tracer(key: str):
    points = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def trace_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = []
            for edges in rows.column(1):
                flat = edges.values
                table = np.column_stack([flat.field(c) for c in ("px", "py", "qx", "qy")])
                rings = trace(table)
                found.append([[{"x": x, "y": y} for x, y in r] for r in rings] or None)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, points)], names=[key, "_traced"])

    return trace_rows


def polygon_repair(polygons: DataFrame, rings: str = "rings") -> DataFrame:
    """The polygons with rings that do not cross and cover what the even-odd rule covers.

    All columns are kept, and polygons that need no repair come back as they are.
    Rings that cross themselves or others, lie on one another, are open, have repeated
    points or no area are cut and traced anew, with coordinates rounded to 2 ** -40 of the
    size of the polygon; points that are not finite are left out.
    A polygon that covers nothing gets NULL.  Rows without rings stay.
    """
    key = "_polygon"
    rows = stage(polygons.withColumn(key, F.monotonically_increasing_id()), "polygons")
    repeated = "exists(sequence(1, size(r) - 1), i -> get(r, i - 1) = get(r, i))"
    finite = "forall(r, p -> abs(p.x) < double('Infinity') AND abs(p.y) < double('Infinity'))"
    sound = (
        f"forall({rings}, r -> size(r) >= 4 AND get(r, 0) = get(r, size(r) - 1) AND {finite}"
        f" AND {G.ring_area('r')} <> 0 AND NOT {repeated})"
    )
    there = rows.where(F.size(rings) > 0)
    broken = there.where(~F.coalesce(F.expr(sound), F.lit(False))).select(key)
    wrong = stage(crossing_polygons(there, key, rings).unionByName(broken).distinct(), "wrong-polygons")
    edges = _ring_edges(there.join(wrong, key, "left_semi"), key, rings)
    pieces = _pieces(stage(_rounded(edges, key), "ring-edges"), key)
    # the pieces of one polygon, which was one row before
    traced = (
        pieces.groupBy(key)
        .agg(F.collect_list(F.struct("px", "py", "qx", "qy")).alias("pieces"))
        .mapInArrow(_tracer(key), f"{key} long, _traced {G.RINGS_TYPE}")
    )
    # staged: callers that use the polygons more than once do not cut them anew
    traced = stage(traced, "traced")
    again = rows.join(wrong.withColumn("_wrong", F.lit(True)), key, "left").join(traced, key, "left")
    mended = F.when(F.col("_wrong"), F.col("_traced")).otherwise(F.col(rings))
    return again.withColumn(rings, mended).drop(key, "_wrong", "_traced").select(*polygons.columns)
