"""The stages in sequence, from polygons and predictions to parent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.geoid import PARENT_LEVELS
from ..operators.aggregate import aggregate_blocks, aggregate_parents
from ..operators.cells import build_pyramid
from ..operators.nearest import nearest_points
from ..operators.regions import polygon_centroids
from ..operators.staging import stage
from ..operators.within import points_within


def crosswalks(
    blocks: DataFrame,
    grid: DataFrame,
    by: Sequence[str] = (),
    block: Sequence[str] = ("geoid",),
) -> tuple[DataFrame, DataFrame]:
    """Within and nearest crosswalk of block polygons and grid points.

    Both are written once: they serve every species and year.
    """
    block = list(block)
    pyramid = build_pyramid(grid, "lon", "lat", by)
    within = points_within(grid, blocks, by=by, polygon_id=block, pyramid=pyramid)
    centres = polygon_centroids(blocks.select(*dict.fromkeys([*by, *block, "rings"])))
    nearest = nearest_points(centres, grid, by=by, query_id=block, pyramid=pyramid)
    return stage(within, "within"), stage(nearest, "nearest")


def block_values(
    blocks: DataFrame,
    grid: DataFrame,
    panel: DataFrame,
    by: Sequence[str] = (),
    block: Sequence[str] = ("geoid",),
    species: Sequence[str] | None = None,
) -> DataFrame:
    within, nearest = crosswalks(blocks, grid, by, block)
    return aggregate_blocks(panel, within, nearest, by, block, grid=grid, species=species)


def parent_values(
    blocks: DataFrame,
    grid: DataFrame,
    panel: DataFrame,
    block_class: DataFrame,
    levels: Sequence[str] = PARENT_LEVELS,
    species: Sequence[str] | None = None,
) -> DataFrame:
    """Population-weighted means of every parent area and year."""
    values = block_values(blocks, grid, panel, species=species)
    return aggregate_parents(values, block_class, levels, by=["species"], block=["geoid"])
