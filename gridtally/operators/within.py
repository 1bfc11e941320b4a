"""Points in polygons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from .cells import BITS_PER_LEVEL, BOX, build_pyramid, CellPyramid, is_place
from .skew import (
    BROADCAST_ROWS,
    ROWS_PER_SPLIT,
    hot_from_counts,
    hot_keys,
    lookup_join,
    spread_join,
)
from .staging import stage


def _starting_cells(shapes: DataFrame, pyramid: CellPyramid) -> DataFrame:
    """Level at which a shape's box covers about 2 x 2 cells, and that level's cells.

    Small shapes start at the finest level and need no descent at all.
    """
    extent = "greatest(maxx - minx, maxy - miny)"
    level = f"floor(log2({pyramid.side!r}D / {extent}) / {BITS_PER_LEVEL})"
    wanted = f"CASE WHEN {extent} > 0 THEN {level} ELSE {pyramid.depth} END"
    right, top = pyramid.x0 + pyramid.side, pyramid.y0 + pyramid.side
    return shapes.withColumn(
        "_level", F.expr(f"CAST(greatest(0, least({pyramid.depth}, {wanted})) AS INT)")
    ).where(
        f"maxx >= {pyramid.x0!r}D AND minx <= {right!r}D"
        f" AND maxy >= {pyramid.y0!r}D AND miny <= {top!r}D"
    )


def _covered(shapes: DataFrame, pyramid: CellPyramid, level: int) -> DataFrame:
    def span(axis: str) -> Column:
        low, high = (pyramid.index(f"{end}{axis}", axis, level) for end in ("min", "max"))
        return F.expr(f"explode(sequence({low}, {high}))")

    return (
        shapes.where(F.col("_level") == level)
        .drop("_level")
        .withColumn("ix", span("x"))
        .withColumn("iy", span("y"))
    )


def _descend(frontier: DataFrame, pyramid: CellPyramid, level: int) -> DataFrame:
    """Replace the cells of ``level`` by the occupied children a shape's box meets."""
    kids = pyramid.children(level + 1).withColumnsRenamed({"px": "ix", "py": "iy"})
    keys = [*pyramid.by, "ix", "iy"]
    joined = lookup_join(frontier, kids, pyramid.bound(level + 1), keys, ["_shape"]).where(
        "c_minx < maxx AND c_maxx > minx AND c_miny < maxy AND c_maxy > miny"
    )
    if "edges" in frontier.columns:
        near = G.edges_for_box("edges", "c_minx", "c_miny", "c_maxy")
        joined = joined.withColumn("edges", F.expr(near))
    moved = ("ix", "iy", "leaf_ix", "leaf_iy")
    return joined.select(
        *[F.col("c_" + c).alias(c) if c in moved else F.col(c) for c in frontier.columns]
    )


def _shape_cells(shapes: DataFrame, pyramid: CellPyramid) -> DataFrame:
    """Every shape with the finest cells its box may share with points."""
    # staged: one pass over the geometry serves every level; spread by their
    # place, since files of polygons are few and uneven
    shapes = _starting_cells(shapes, pyramid).repartition(*pyramid.by, *BOX)
    shapes = stage(shapes.withColumn("_shape", F.monotonically_increasing_id()), "shapes")
    levels = {r[0] for r in shapes.select("_level").distinct().collect()}  # <= depth + 1 values
    no_leaf = {c: F.lit(None).cast("long") for c in ("leaf_ix", "leaf_iy")}
    done, frontier = [_covered(shapes, pyramid, pyramid.depth)], None
    for level in range(min(levels, default=pyramid.depth), pyramid.depth):
        if level in levels:
            start = _covered(shapes, pyramid, level).withColumns(no_leaf)
            frontier = start if frontier is None else frontier.unionByName(start)
        if pyramid.bound(level + 1) > BROADCAST_ROWS:
            # cells with a single finest cell below need no further levels
            frontier = stage(frontier, "frontier")
            found = frontier.where("leaf_ix IS NOT NULL AND leaf_iy IS NOT NULL")
            done.append(found.withColumns({"ix": F.col("leaf_ix"), "iy": F.col("leaf_iy")}))
            frontier = frontier.where("leaf_ix IS NULL OR leaf_iy IS NULL")
        frontier = _descend(frontier, pyramid, level)
    if frontier is not None:
        done.append(frontier)
    done = [d.drop("leaf_ix", "leaf_iy") for d in done]
    return reduce(lambda a, b: a.unionByName(b), done)


def points_in_boxes(
    points: DataFrame,
    boxes: DataFrame,
    x: str,
    y: str,
    by: Sequence[str],
    point_id: Sequence[str],
    pyramid: CellPyramid | None = None,
) -> DataFrame | None:
    """Pairs of a point and a box that holds it strictly inside.

    ``points`` keeps all its columns; ``boxes`` has ``by``, the box columns
    ``minx, maxx, miny, maxy`` and any others.  None if there are no points.
    """
    pyramid = pyramid or build_pyramid(points, x, y, by)
    if pyramid is None:
        return None
    keys = [*by, "ix", "iy"]
    cells = _shape_cells(boxes, pyramid)
    located = points.where(is_place(x, y)).withColumns(
        pyramid.leaf_index(x, y)
    )
    if pyramid.n_points <= BROADCAST_ROWS:
        joined = cells.join(F.broadcast(located), keys)
    else:
        cells = stage(cells, "shape-cells")
        joined = spread_join(
            located,
            cells,
            keys,
            spread_by=point_id,
            hot=hot_from_counts(pyramid.leaves, keys, "n", ROWS_PER_SPLIT),
            hot_right=hot_keys(cells, keys, ROWS_PER_SPLIT),
            spread_right_by=["_shape"],
        )
    inside_box = f"{x} > minx AND {x} < maxx AND {y} > miny AND {y} < maxy"
    return joined.where(inside_box).drop("ix", "iy", "_shape")


def no_pairs(
    left: DataFrame, left_id: Sequence[str], right: DataFrame, right_id: Sequence[str]
) -> DataFrame:
    """An empty table with the columns of the pairs."""
    types = {c: F.lit(None).cast(right.schema[c].dataType) for c in right_id}
    return left.select(*left_id).limit(0).withColumns(types)


def points_within(
    points: DataFrame,
    polygons: DataFrame,
    by: Sequence[str] = ("region",),
    x: str = "lon",
    y: str = "lat",
    point_id: Sequence[str] = ("gridcell_idx",),
    polygon_id: Sequence[str] = ("geoid",),
    rings: str = "rings",
    keep: str = "inner",
    pyramid: CellPyramid | None = None,
) -> DataFrame:
    """Which polygons hold each point strictly inside.

    One row per (point, polygon); a point on a boundary is not inside, and a
    point in overlapping polygons gives several rows.  ``keep="left"`` adds the
    points without a polygon, with NULL polygon columns.  Points and polygons
    share one coordinate system and meet only within equal ``by`` columns.
    A ``pyramid`` of the points can be given if it is at hand.
    """
    by, point_id, polygon_id = list(by), list(point_id), list(polygon_id)
    boxes = polygons.select(*by, *polygon_id, F.col(rings).alias("_rings")).where(
        F.col("_rings").isNotNull()
    )
    boxes = boxes.withColumns({**G.box("_rings"), "edges": G.edges("_rings")})
    boxes = boxes.drop("_rings")
    probes = points.select(*dict.fromkeys([*by, *point_id, x, y]))
    pairs = points_in_boxes(probes, boxes, x, y, by, point_id, pyramid)
    ids = list(dict.fromkeys([*by, *point_id]))
    if pairs is None:
        found = no_pairs(points, ids, polygons, polygon_id)
    else:
        found = pairs.where(G.strictly_inside("edges", x, y)).select(
            *ids, *polygon_id
        )
    if keep == "inner":
        return found
    found = stage(found, "found")
    alone = points.select(*ids).join(found.select(*ids).distinct(), ids, "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)
