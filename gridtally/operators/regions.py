"""Regional subsets, centroids and polygon checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geoid import in_regions, region_of
from .repair import crossing_polygons
from .staging import stage


def regional_subset(
    areas: DataFrame, geoid: str = "geoid", regions: Sequence[str] | None = None
) -> DataFrame:
    """Areas that belong to a region, with the region as a column.

    One table for all regions: write it partitioned by ``region`` and a filter
    on the region reads only its own files.
    """
    kept = areas.where(in_regions(F.col(geoid), regions))
    return kept.withColumn("region", region_of(F.col(geoid)))


def polygon_centroids(
    polygons: DataFrame, rings: str = "rings", x: str = "cx", y: str = "cy"
) -> DataFrame:
    """Replace the polygon by its area-weighted centroid."""
    return (
        polygons.withColumn("_c", G.centroid(rings))
        .withColumns({x: F.col("_c.x"), y: F.col("_c.y")})
        .drop("_c", rings)
    )


def polygon_validity(
    polygons: DataFrame, polygon_id: Sequence[str] = ("geoid",), rings: str = "rings"
) -> DataFrame:
    """Screening report, one row per polygon; ``repair.polygon_repair`` mends what it finds.

    ``crosses`` tells of edges that cross or lie on one another along some length.
    """
    polygons = stage(polygons.withColumn("_polygon", F.monotonically_increasing_id()), "polygons")
    repeated = "get(r, i - 1) = get(r, i)"
    checks = {
        "n_rings": f"coalesce(size({rings}), 0)",
        "n_points": f"coalesce(size(flatten({rings})), 0)",
        "all_closed": f"forall({rings}, r -> get(r, 0) = get(r, size(r) - 1))",
        "enough_points": f"forall({rings}, r -> size(r) >= 4)",
        "has_area": f"exists({rings}, r -> {G.ring_area('r')} <> 0)",
        "repeated_points": f"exists({rings}, r -> size(r) > 1 AND exists(sequence(1, size(r) - 1),"
        f" i -> {repeated}))",
    }
    wrong = crossing_polygons(polygons.where(F.size(rings) > 0), "_polygon", rings)
    marked = polygons.join(wrong.withColumn("_crosses", F.lit(True)), "_polygon", "left")
    checked = [F.expr(v).alias(k) for k, v in checks.items()]
    out = marked.select(*polygon_id, *checked, F.coalesce("_crosses", F.lit(False)).alias("crosses"))
    ok = (
        (F.col("n_rings") > 0)
        & F.col("all_closed")
        & F.col("enough_points")
        & F.col("has_area")
        & ~F.col("repeated_points")
        & ~F.col("crosses")
    )
    return out.withColumn("valid", F.coalesce(ok, F.lit(False)))
