"""Cell pyramid over a set of points, shared by the spatial joins.

Space is cut into squares; each level quarters the sides of the level above.
Only occupied cells are kept, with the number of points and their tight box.
A join then walks from coarse to fine cells and opens only those that can hold
a match, so a dense spot or a huge polygon costs what its matches cost.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import BROADCAST_ROWS
from .staging import stage

BOX = ("minx", "maxx", "miny", "maxy")
BITS_PER_LEVEL = 2
MAX_BITS = 48
POINTS_PER_CELL = 16


@dataclass(frozen=True)
class CellPyramid:
    """Occupied cells of ``points`` within each group ``by``."""

    by: list[str]
    x0: float
    y0: float
    side: float
    depth: int  # number of levels below the root
    n_points: int
    n_groups: int
    leaves: DataFrame  # by, ix, iy, n, minx, maxx, miny, maxy at the finest level
    _built: dict[int, DataFrame] = field(default_factory=dict, compare=False, repr=False)

    def cell_size(self, level: int) -> float:
        return self.side / (1 << (BITS_PER_LEVEL * level))

    def index(self, value: str, axis: str, level: int) -> str:
        """Cell number along one axis, kept within the frame."""
        origin = self.x0 if axis == "x" else self.y0
        last = (1 << (BITS_PER_LEVEL * level)) - 1
        raw = f"floor(({value} - ({origin!r}D)) / {self.cell_size(level)!r}D)"
        return f"greatest(0L, least({last}L, {raw}))"

    def leaf_index(self, x: str, y: str) -> dict[str, Column]:
        return {
            "ix": F.expr(self.index(x, "x", self.depth)),
            "iy": F.expr(self.index(y, "y", self.depth)),
        }

    def bound(self, level: int) -> int:
        """Proven upper bound of the number of occupied cells of a level."""
        return min(self.n_points, self.n_groups << (2 * BITS_PER_LEVEL * level))

    def _coarser(self, finer: DataFrame, levels: int) -> DataFrame:
        """Cells that many levels up, from the cells of a finer level."""
        if not levels:
            return finer
        up = BITS_PER_LEVEL * levels
        return (
            finer.withColumns(
                {"ix": F.expr(f"shiftright(ix, {up})"), "iy": F.expr(f"shiftright(iy, {up})")}
            )
            .groupBy(*self.by, "ix", "iy")
            .agg(
                F.expr("sum(n) AS n"),
                *[F.expr(f"{c[:3]}({c}) AS {c}") for c in BOX],
                *[
                    F.expr(f"CASE WHEN count({c}) = count(1) AND min({c}) = max({c}) THEN min({c}) END AS {c}")
                    for c in ("leaf_ix", "leaf_iy")
                ],
            )
        )

    def _cells(self, level: int) -> DataFrame:
        """The cells of a level.

        Each level comes from the next finer one and is written once, up to the
        first that is small; coarser ones are cheap from there.
        """
        if self.depth not in self._built:
            both = {"leaf_ix": F.col("ix"), "leaf_iy": F.col("iy")}
            self._built[self.depth] = self.leaves.withColumns(both)
        finest = min(self._built)
        while finest > level and self.bound(finest) > BROADCAST_ROWS:
            coarser = self._coarser(self._built[finest], 1)
            finest -= 1
            self._built[finest] = stage(coarser, "cells")
        source = min(k for k in self._built if k >= level)
        return self._coarser(self._built[source], source - level)

    def children(self, level: int) -> DataFrame:
        """Cells of ``level`` keyed by their parent, with columns ``c_*``.

        ``c_leaf_ix, c_leaf_iy`` name the finest cell if there is but one below.
        """
        cells = self._cells(level).selectExpr(
            *[f"`{c}`" for c in self.by],
            f"shiftright(ix, {BITS_PER_LEVEL}) AS px",
            f"shiftright(iy, {BITS_PER_LEVEL}) AS py",
            *[f"{c} AS c_{c}" for c in ("ix", "iy", "n", "leaf_ix", "leaf_iy", *BOX)],
        )
        return F.broadcast(cells) if self.bound(level) <= BROADCAST_ROWS else cells


def is_place(x: str, y: str) -> str:
    """SQL: both coordinates are finite numbers.  All other rows lie nowhere."""
    return " AND ".join(f"(abs({c}) < double('Infinity'))" for c in (x, y))


def build_pyramid(
    points: DataFrame,
    x: str,
    y: str,
    by: Sequence[str] = (),
    points_per_cell: int = POINTS_PER_CELL,
) -> CellPyramid | None:
    """Measure the points and stage their finest cells; None without any point.

    The depth follows from the number of points and is raised while some cell
    is still crowded by points that differ.  It changes the cost, never the
    result.
    """
    by = list(by)
    known = points.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    known = known.where(is_place("x", "y"))
    measures = ["min(x) AS minx", "max(x) AS maxx", "min(y) AS miny", "max(y) AS maxy"]
    groups = known.groupBy(*by).agg(F.expr("count(1) AS n"), *[F.expr(e) for e in measures])
    m = groups.selectExpr(
        "count(1) AS groups", "sum(n) AS n", *[f"{c[:3]}({c}) AS {c}" for c in BOX]
    ).first()
    if not m["n"]:
        return None
    width, height = m["maxx"] - m["minx"], m["maxy"] - m["miny"]
    side = 2.0 ** math.ceil(math.log2(max(width, height, 1e-9)))
    per_group = m["n"] / max(m["groups"], 1)
    area = max(width, side / (1 << 20)) * max(height, side / (1 << 20))
    wanted = math.sqrt(area * points_per_cell / max(per_group, 1))
    bits = math.log2(side / wanted) if wanted < side else 0

    while True:
        depth = max(1, round(bits / BITS_PER_LEVEL))
        shape = CellPyramid(
            by, m["minx"], m["miny"], side, depth, m["n"], m["groups"], leaves=known
        )
        leaves = stage(
            known.withColumns(shape.leaf_index("x", "y"))
            .groupBy(*by, "ix", "iy")
            .agg(F.expr("count(1) AS n"), *[F.expr(e) for e in measures]),
            "cells",
        )
        crowd = (
            leaves.where("minx < maxx OR miny < maxy").selectExpr("max(n)").first()[0]
            or 0
        )
        if crowd <= 8 * points_per_cell or BITS_PER_LEVEL * depth >= MAX_BITS:
            break
        bits = min(
            MAX_BITS,
            BITS_PER_LEVEL * depth + math.log(crowd / points_per_cell, 4) + BITS_PER_LEVEL / 2,
        )
    return CellPyramid(by, m["minx"], m["miny"], side, depth, m["n"], m["groups"], leaves)
