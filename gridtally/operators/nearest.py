"""Nearest grid points of each query location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import CellPyramid, build_pyramid, is_place
from .skew import BROADCAST_ROWS, lookup_join
from .staging import stage


def _reach() -> tuple[Column, Column]:
    """Squared distance bounds from a location to the points of a cell.

    The lower bound is the distance to the tight box.  The upper bound uses
    that every side of a tight box touches a point: the nearer side in one axis
    with the farther side in the other.  Both are formed by the same operations
    as a point distance, so rounding keeps their order.
    """

    def sq(v: str) -> str:
        return f"({v}) * ({v})"

    def gap(axis: str) -> str:
        return f"greatest(c_min{axis} - q{axis}, q{axis} - c_max{axis}, 0D)"

    def side(pick: str, axis: str) -> str:
        return f"{pick}({sq(f'q{axis} - c_min{axis}')}, {sq(f'q{axis} - c_max{axis}')})"

    low = f"{sq(gap('x'))} + {sq(gap('y'))}"
    high = (
        f"least({side('least', 'x')} + {side('greatest', 'y')},"
        f" {side('least', 'y')} + {side('greatest', 'x')})"
    )
    return F.expr(low), F.expr(high)


def _open_cells(frontier: DataFrame, pyramid: CellPyramid, level: int) -> DataFrame:
    """Replace each kept cell by its children and drop those out of reach."""
    kids = pyramid.children(level).withColumnsRenamed({"px": "ix", "py": "iy"})
    keys = [*pyramid.by, "ix", "iy"]
    if pyramid.bound(level) > BROADCAST_ROWS:
        frontier = stage(frontier, "frontier")
    opened = lookup_join(frontier, kids, pyramid.bound(level), keys, ["_row"])
    low, high = _reach()
    return (
        opened.withColumns({"_low": low, "_high": high})
        .withColumn("_best", F.expr("min(_high) OVER (PARTITION BY _row)"))
        .where("_low <= _best")
        .selectExpr("_row", *pyramid.by, "qx", "qy", "c_ix AS ix", "c_iy AS iy")
    )


def _open_cells_for(frontier: DataFrame, pyramid: CellPyramid, level: int, k: int) -> DataFrame:
    """The children of the kept cells without those that k nearer points are sure to lie before.

    Cells by their upper bound, counted up to k points, give a distance within which
    k points lie for sure; a cell that begins beyond it holds none of the k nearest.
    """
    kids = pyramid.children(level).withColumnsRenamed({"px": "ix", "py": "iy"})
    keys = [*pyramid.by, "ix", "iy"]
    if pyramid.bound(level) > BROADCAST_ROWS:
        frontier = stage(frontier, "frontier")
    opened = lookup_join(frontier, kids, pyramid.bound(level), keys, ["_row"])
    low, _ = _reach()
    # all points of a cell are at most as far as its farthest corner
    far = " + ".join(
        f"greatest((q{a} - c_min{a}) * (q{a} - c_min{a}), (q{a} - c_max{a}) * (q{a} - c_max{a}))" for a in "xy"
    )
    return (
        opened.withColumns({"_low": low, "_high": F.expr(far)})
        .withColumn("_sure", F.expr("sum(c_n) OVER (PARTITION BY _row ORDER BY _high)"))
        .withColumn("_best", F.expr(f"min(CASE WHEN _sure >= {k} THEN _high END) OVER (PARTITION BY _row)"))
        .where("_best IS NULL OR _low <= _best")
        .selectExpr("_row", *pyramid.by, "qx", "qy", "c_ix AS ix", "c_iy AS iy")
    )


def nearest_k(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    by: Sequence[str] = ("region", "urban_rural"),
    query_id: Sequence[str] = ("geoid",),
    qx: str = "cx",
    qy: str = "cy",
    x: str = "lon",
    y: str = "lat",
    idx: str = "gridcell_idx",
    pyramid: CellPyramid | None = None,
) -> DataFrame:
    """The k nearest points of each query row: ``by, query_id, rank, idx, distance``.

    Nearest first, of equally near points the smallest index first; points at one
    place are points of their own.  A group of fewer points gives them all.  A row
    without a location, or whose group has no points, is returned once with NULL
    rank, index and distance.  Repeated query rows are answered each.  The search
    is exact: a cell is dropped only when k nearer points are sure to lie in others.
    """
    if k < 1:
        raise ValueError("k must be positive")
    by, query_id = list(by), list(query_id)
    grid = points.select(
        *by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), idx
    ).where(is_place("x", "y"))
    # of many points at one place only the k smallest indices can be asked for; Spark
    # cuts them down before the shuffle too
    place = Window.partitionBy(*by, "x", "y").orderBy(idx)
    grid = grid.withColumn("_copy", F.row_number().over(place)).where(F.col("_copy") <= k).drop("_copy")
    ids = list(dict.fromkeys([*by, *query_id]))
    asked = queries.select(
        *ids,
        F.nanvl(F.col(qx).cast("double"), F.lit(None).cast("double")).alias("qx"),
        F.nanvl(F.col(qy).cast("double"), F.lit(None).cast("double")).alias("qy"),
    )
    pyramid = pyramid or build_pyramid(points, x, y, by)
    if pyramid is None:
        return asked.select(
            *ids, F.lit(None).cast("int").alias("rank"),
            F.lit(None).cast(points.schema[idx].dataType).alias(idx), F.lit(None).cast("double").alias("distance"),
        )
    asked = stage(asked.withColumn("_row", F.monotonically_increasing_id()), "queries")
    frontier = asked.where(is_place("qx", "qy")).select("_row", *by, "qx", "qy")
    frontier = frontier.withColumns(
        {"ix": F.expr(pyramid.index("qx", "x", 0)), "iy": F.expr(pyramid.index("qy", "y", 0))}
    )
    for level in range(1, pyramid.depth + 1):
        frontier = _open_cells_for(frontier, pyramid, level, k)
    binned = grid.withColumns(pyramid.leaf_index("x", "y"))
    if pyramid.n_points > BROADCAST_ROWS:
        frontier = stage(frontier, "frontier")
    reached = lookup_join(frontier, binned, pyramid.n_points, [*by, "ix", "iy"], ["_row"])
    order = Window.partitionBy("_row").orderBy("_d2", idx)
    best = (
        reached.select("_row", idx, F.expr("(x - qx) * (x - qx) + (y - qy) * (y - qy) AS _d2"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("_row", "rank", idx, F.sqrt("_d2").alias("distance"))
    )
    return asked.join(best, "_row", "left").select(*ids, "rank", idx, "distance")


def nearest_points(
    queries: DataFrame,
    points: DataFrame,
    by: Sequence[str] = ("region", "urban_rural"),
    query_id: Sequence[str] = ("geoid",),
    qx: str = "cx",
    qy: str = "cy",
    x: str = "lon",
    y: str = "lat",
    idx: str = "gridcell_idx",
    pyramid: CellPyramid | None = None,
) -> DataFrame:
    """The nearest point of each query row: ``by, query_id, idx, distance``.

    Planar distance in coordinate units; of equally near points the smallest
    index wins.  Exactly one row per query row; ``idx`` is NULL if the location
    is missing or its group has no points.  The search is exact: cells are
    opened from coarse to fine, and a cell is dropped only when another cell is
    sure to hold a nearer point.
    """
    by, query_id = list(by), list(query_id)
    grid = points.select(
        *by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), idx
    )
    # copies of a location cannot be told apart: the smallest index stands for all
    grid = grid.groupBy(*by, "x", "y").agg(F.min(idx).alias(idx))
    ids = list(dict.fromkeys([*by, *query_id]))
    asked = queries.select(
        *ids,
        F.nanvl(F.col(qx).cast("double"), F.lit(None).cast("double")).alias("qx"),
        F.nanvl(F.col(qy).cast("double"), F.lit(None).cast("double")).alias("qy"),
    )
    pyramid = pyramid or build_pyramid(grid, "x", "y", by)
    if pyramid is None:
        nothing = {
            idx: F.lit(None).cast(points.schema[idx].dataType),
            "distance": F.lit(None).cast("double"),
        }
        return asked.withColumns(nothing).select(*ids, idx, "distance")

    # staged, so that the row number is the same wherever it is used
    asked = stage(asked.withColumn("_row", F.monotonically_increasing_id()), "queries")
    frontier = asked.where("qx IS NOT NULL AND qy IS NOT NULL").select("_row", *by, "qx", "qy")
    frontier = frontier.withColumns(
        {"ix": F.expr(pyramid.index("qx", "x", 0)), "iy": F.expr(pyramid.index("qy", "y", 0))}
    )
    for level in range(1, pyramid.depth + 1):
        frontier = _open_cells(frontier, pyramid, level)

    binned = grid.where("x IS NOT NULL AND y IS NOT NULL").withColumns(
        pyramid.leaf_index("x", "y")
    )
    if pyramid.n_points > BROADCAST_ROWS:
        frontier = stage(frontier, "frontier")
    reached = lookup_join(frontier, binned, pyramid.n_points, [*by, "ix", "iy"], ["_row"])
    best = (
        reached.withColumn("_d2", F.expr("(x - qx) * (x - qx) + (y - qy) * (y - qy)"))
        .withColumn("_best", F.expr("min(_d2) OVER (PARTITION BY _row)"))
        .where("_d2 = _best")
        .groupBy("_row")
        .agg(F.min(idx).alias(idx), F.sqrt(F.min("_d2")).alias("distance"))
    )
    return asked.join(best, "_row", "left").select(*ids, idx, "distance")
