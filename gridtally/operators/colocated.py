"""Panel and crosswalk links stored in buckets by place: their join needs no shuffle.

The panel is by far the largest table, and every species, vintage and year is
joined to it by place.  Stored once in buckets of the place, sorted by it, each
bucket of the links meets its bucket of the panel where both lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import nan_to_null
from .aggregate import link_table, summarise_links
from .grid import coordinate_key, require_unique_places
from .skew import hot_keys, merged, spread_join
from .staging import stage

#: Columns of the place in the stored tables.
PLACE = ("kx", "ky")


def store_bucketed(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    buckets: int,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Write a table in buckets of ``keys``, one sorted file per bucket and folder.

    Rows are dealt as the buckets are, so that no task writes many small files.
    ``path`` names the folder of the table, by default the warehouse has it.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def store_panel(
    panel: DataFrame,
    name: str,
    by: Sequence[str] = ("region", "urban_rural"),
    buckets: int = 200,
    path: str | None = None,
) -> DataFrame:
    """The panel (``by, species, year, lon, lat, predicted``) in buckets of its places.

    Species are folders, so that a query on one species reads no other.
    """
    by = list(by)
    rows = nan_to_null(panel).select(
        *by, coordinate_key(F.col("lon")).alias("kx"), coordinate_key(F.col("lat")).alias("ky"),
        "year", F.col("predicted").cast("double").alias("predicted"), "species",
    )
    return store_bucketed(rows, name, [*by, *PLACE], buckets, ["species"], path)


@dataclass(frozen=True)
class StoredLinks:
    """Links of both crosswalks: those of ordinary cells in buckets, those of hot cells apart."""

    ordinary: DataFrame
    hot: DataFrame | None
    hot_places: DataFrame | None
    by: list[str]
    block: list[str]


def store_links(
    within: DataFrame,
    nearest: DataFrame,
    grid: DataFrame,
    name: str,
    by: Sequence[str] = ("region", "urban_rural"),
    block: Sequence[str] = ("vintage", "geoid"),
    buckets: int = 200,
    path: str | None = None,
) -> StoredLinks:
    """Both crosswalks with the places of their cells, in buckets like the panel's.

    The links of a cell that is the nearest of very many blocks would all lie in
    one bucket; they are kept apart, and joined in pieces.
    """
    by, block = list(by), list(block)
    cell = [*by, "gridcell_idx"]
    require_unique_places(grid, by)
    links = link_table(within, nearest, cell, block)
    hot = stage(hot_keys(links.select(*cell), cell), "hot-cells")
    place = [coordinate_key(F.col(c)).alias(k) for c, k in zip(("lon", "lat"), PLACE)]
    spots = grid.select(*cell, *place)
    placed = spread_join(links, spots, cell, spread_by=block, how="left", hot=hot)
    keys = [*by, *PLACE]
    if hot.isEmpty():
        return StoredLinks(store_bucketed(placed, name, keys, buckets, path=path), None, None, by, block)
    few = F.broadcast(hot)  # at most MOST_PIECES rows
    ordinary = store_bucketed(placed.join(few, cell, "left_anti"), name, keys, buckets, path=path)
    apart = stage(placed.join(few, cell, "left_semi"), "hot-links")
    hot_places = stage(
        hot.join(spots, cell).groupBy(*keys).agg(F.max("_splits").alias("_splits")), "hot-places"
    )
    return StoredLinks(ordinary, apart, hot_places, by, block)


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    renamed = {k: f"_r_{k}" for k in keys}
    same: Column = reduce(lambda a, b: a & b, [F.col(k) == F.col(r) for k, r in renamed.items()])
    return left.join(merged(right.withColumnsRenamed(renamed)), same, how).drop(*renamed.values())


def aggregate_stored(panel: DataFrame, links: StoredLinks, species: Sequence[str]) -> DataFrame:
    """Block values per species and year like ``aggregate_blocks``, from stored tables.

    Links are joined once for all ``species`` and not copied for each; a second
    pass over the places of the panel, in the same buckets, finds the species that
    a cell has no prediction of, which give a NULL year and value.
    """
    by, block, names = links.by, links.block, list(species)
    keys = [*by, *PLACE]
    panel = panel.where(F.col("species").isin(names))
    wanted = F.array(*[F.lit(s) for s in names])

    def joined(side: DataFrame, values: DataFrame, there: DataFrame, join) -> DataFrame:
        found = join(side, values).drop(*PLACE)
        # the species that are not there, all of them where the place is unknown
        lost = F.array_except(wanted, F.coalesce("_there", F.array().cast("array<string>")))
        missing = join(side, there, "left").withColumn("species", F.explode(lost)).drop("_there", *PLACE)
        return found.unionByName(missing, allowMissingColumns=True)

    def present(rows: DataFrame) -> DataFrame:
        # a set of at most as many values as there are species
        return rows.select(*keys, "species").distinct().groupBy(*keys).agg(F.collect_set("species").alias("_there"))

    found = joined(
        links.ordinary, panel, present(panel), lambda a, b, how="inner": _match(a, b, keys, how)
    )
    if links.hot is not None:
        few = F.broadcast(links.hot_places.select(*keys))
        near = panel.join(few, keys, "left_semi")
        pieces = links.hot_places
        found = found.unionByName(
            joined(
                links.hot, near, present(near),
                lambda a, b, how="inner": spread_join(a, b, keys, block, how, pieces),
            )
        )
    return summarise_links(found, [*by, "species", *block, "year"])
