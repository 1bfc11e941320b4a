"""The grid of points behind a prediction panel, and the panel's cell numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import number_rows

COORDINATE_STEPS = 1e7  # steps per degree, about a centimetre


def coordinate_key(value: Column) -> Column:
    """Coordinate as a whole number, so that equal places compare equal."""
    return F.round(value * F.lit(COORDINATE_STEPS)).cast("long")


def sample_files(
    catalog: DataFrame, sample_species: str = "no3", by: Sequence[str] = ("region",)
) -> DataFrame:
    """Files from which a region's grid is read.

    Those of the sampled species in the smallest year in the names; all of them
    where no name carries a year.
    """
    keys = [*by, "species"]
    files = catalog.where(F.col("species") == sample_species)
    first = files.groupBy(*keys).agg(F.min("year").alias("_year"))
    return (
        files.join(first, keys)
        .where(F.col("_year").isNull() | (F.col("year") == F.col("_year")))
        .drop("_year")
    )


def first_year_rows(panel: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the smallest year of each group; a group without years is kept whole."""
    year = F.col("year").alias("_year")
    first = panel.groupBy(*by).agg(F.min("year").alias("_year"))
    first = first.withColumnsRenamed({c: f"_first_{c}" for c in by})
    rows = panel.select("*", year)
    same = rows["_year"].eqNullSafe(first["_year"])
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_first_{c}"))
    return rows.join(first, same, "left_semi").drop("_year")


def extract_grid(
    panel: DataFrame,
    sample_species: str | None = "no3",
    by: Sequence[str] = ("region", "urban_rural"),
    order: Sequence[str] = ("part_number", "lon", "lat"),
    idx: str = "gridcell_idx",
) -> DataFrame:
    """Grid points of each group, numbered 1..n: ``by, idx, lon, lat``.

    Taken from one species (the grid is the same for all) and its first year.
    """
    if sample_species is not None and "species" in panel.columns:
        panel = panel.where(F.col("species") == sample_species)
    order = [c for c in order if c in panel.columns]
    if "part_number" in order:
        # parts are numbers: 10 comes after 9
        panel = panel.withColumn("part_number", F.col("part_number").try_cast("int"))
    rows = first_year_rows(panel.select(*dict.fromkeys([*by, *order, "year"])), by)
    return number_rows(rows, by, order, idx).select(*by, idx, "lon", "lat")


def attach_cells(
    panel: DataFrame,
    grid: DataFrame,
    by: Sequence[str] = ("region", "urban_rural"),
    idx: str = "gridcell_idx",
) -> DataFrame:
    """Panel rows with the number of their grid cell, matched by coordinates.

    Order of rows plays no part.  Coordinates must be unique within a grid
    (``quality.panel_check`` reports it); of repeated ones the smallest number
    is taken, so that the panel never multiplies.
    """
    place = {"_kx": coordinate_key(F.col("lon")), "_ky": coordinate_key(F.col("lat"))}
    keys = [*by, "_kx", "_ky"]
    cells = grid.withColumns(place).groupBy(*keys).agg(F.min(idx).alias(idx))
    rows = panel.drop(idx).withColumns(place)
    # rows without a place match nothing and need not meet in one task
    placed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    nowhere = rows.where(~placed).withColumn(idx, F.lit(None).cast(cells.schema[idx].dataType))
    return rows.where(placed).join(cells, keys, "left").unionByName(nowhere).drop("_kx", "_ky")


def require_unique_places(grid: DataFrame, by: Sequence[str] = ("region", "urban_rural")) -> None:
    """Refuse a grid in which two cells share a place: joins by place would mix them up."""
    place = [coordinate_key(F.col(c)).alias(f"_k{c}") for c in ("lon", "lat")]
    repeated = grid.groupBy(*by, *place).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = repeated.count()
    if found:
        raise ValueError(f"{found} places of the grid hold more than one cell; see panel_check")


def number_by_position(
    panel: DataFrame,
    position: Sequence[str],
    by: Sequence[str] = ("region", "urban_rural", "species"),
    idx: str = "gridcell_idx",
) -> DataFrame:
    """Cell numbers 1..n within every year, for panels without coordinates.

    ``position`` are columns that give the row order of the files; all values
    of the panel are kept.
    """
    group = [*by, "year"]
    rest = [c for c in panel.columns if c not in group and c not in position and c != idx]
    return number_rows(panel, group, [*position, *rest], idx)
