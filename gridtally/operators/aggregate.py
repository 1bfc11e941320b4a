"""Predictions onto blocks, and blocks onto their parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geoid import LEVEL_LENGTHS, PARENT_LEVELS, area_prefix, parent_codes
from ..functions.nulls import first_present, n_rows
from .grid import coordinate_key, require_unique_places
from .skew import hot_keys, merged, spread_join


def best_prediction() -> Column:
    """The within mean if there is one, the nearest value if not."""
    return first_present(F.col("predicted_within"), F.col("predicted_nearest"))


#: Links that one task joins and sums up, on average, where there are many of them.
LINKS_PER_TASK = 250_000
#: Up to so many tasks Spark joins partitions as it likes.
FEW_TASKS = 16

#: More values than this are no species.
MOST_SPECIES = 10_000


def _species_of(panel: DataFrame) -> list:
    """The species of a panel, which are as few as its value columns were."""
    found = panel.select("species").distinct().limit(MOST_SPECIES + 1).collect()
    if len(found) > MOST_SPECIES:
        raise ValueError(f"the panel has more than {MOST_SPECIES} species; name those that are wanted")
    return [r[0] for r in found]


def link_table(
    within: DataFrame, nearest: DataFrame, cell: Sequence[str], block: Sequence[str]
) -> DataFrame:
    """Both crosswalks in one table, so that the panel is joined once."""
    return (
        within.where(F.col(block[-1]) != "")
        .select(*cell, *block, F.lit(None).cast("double").alias("distance"))
        .withColumn("_near", F.lit(False))
        .unionByName(nearest.select(*cell, *block, "distance").withColumn("_near", F.lit(True)))
    )


def aggregate_blocks(
    panel: DataFrame,
    within: DataFrame,
    nearest: DataFrame,
    by: Sequence[str] = ("region", "urban_rural"),
    block: Sequence[str] = ("vintage", "geoid"),
    grid: DataFrame | None = None,
    species: Sequence[str] | None = None,
) -> DataFrame:
    """Block values per year from both crosswalks.

    ``panel``: ``by, [species], year, predicted`` and ``gridcell_idx`` (or
    ``lon, lat`` together with ``grid``).  ``within`` and ``nearest``: ``by,
    block, gridcell_idx``, the latter with ``distance``.

    Every row of a crosswalk is kept; a cell without predictions gives NULL
    year and value.  The result has one row for each row of the nearest join,
    with the mean and number of the cells within the block beside it.

    With ``grid`` the crosswalks, which are small, take the coordinates of
    their cells, and the panel is joined by coordinate: its rows are shuffled
    once and never need a number of their own.  A grid with two cells at one
    place is refused then.
    """
    by, block = list(by), list(block)
    cell = [*by, "gridcell_idx"]
    links = link_table(within, nearest, cell, block)
    copies = 1
    hot = hot_keys(links.select(*cell), cell)
    keys = cell
    if grid is not None:
        require_unique_places(grid, by)
        place = {"_kx": coordinate_key(F.col("lon")), "_ky": coordinate_key(F.col("lat"))}
        spots = grid.withColumns(place).select(*cell, "_kx", "_ky")
        keys = [*by, "_kx", "_ky"]
        links = spread_join(links, spots, cell, spread_by=block, how="left", hot=hot)
        hot = spots.join(F.broadcast(hot), cell).groupBy(*keys).agg(F.max("_splits").alias("_splits"))
        panel = panel.withColumns(place)
    extra = []
    if "species" in panel.columns:
        extra = ["species"]
        keys = [*keys, *extra]
        names = list(species) if species is not None else _species_of(panel)
        copies = len(names)
        links = links.withColumn("species", F.explode(F.array(*[F.lit(s) for s in names])))
        if species is not None:
            panel = panel.where(F.col("species").isin(names))
    values = panel.select(*keys, "year", F.col("predicted").cast("double").alias("predicted"))
    tasks = within.count() + nearest.count()
    tasks = -(-tasks * copies // LINKS_PER_TASK)
    usual = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = spread_join(
        links, values, keys, spread_by=block, how="left", hot=hot,
        partitions=max(tasks, usual) if tasks > FEW_TASKS else None,
    )
    return summarise_links(found, [*by, *extra, *block, "year"])


def summarise_links(found: DataFrame, group: Sequence[str]) -> DataFrame:
    """Block values from links with predictions: ``group, _near, predicted, distance``.

    Links are summed up by plain sums and counts, equal ones of the nearest join as
    one row with their number; only these few rows of a group are laid side by side.
    """
    group = list(group)
    inside = F.when(~F.col("_near"), F.col("predicted"))
    partial = found.groupBy(
        *group,
        "_near",
        F.when(F.col("_near"), F.col("predicted")).alias("_value"),
        F.when(F.col("_near"), F.col("distance")).alias("_distance"),
    ).agg(
        F.sum(inside).alias("_sum"), F.count(inside).alias("_known"), F.count(F.lit(1)).alias("_rows")
    )
    whole = Window.partitionBy(*group)
    n_inside = F.sum(F.when(~F.col("_near"), F.col("_rows"))).over(whole)
    known = F.sum("_known").over(whole)
    return (
        partial.withColumns(
            {"_n_inside": n_inside, "_n_known": known, "_total": F.sum("_sum").over(whole)}
        )
        .where("_near")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
        .select(
            *group,
            F.when(F.col("_n_known") == F.col("_n_inside"), F.try_divide("_total", "_n_known")).alias(
                "predicted_within"
            ),
            F.col("_n_inside").alias("n_gridcells_within"),
            F.col("_value").alias("predicted_nearest"),
            F.col("_distance").alias("distance_nearest"),
        )
    )


def finest(levels: Sequence[str]) -> str:
    return max(levels, key=LEVEL_LENGTHS.__getitem__)


def roll_up(partial: DataFrame, levels: Sequence[str], sums: Sequence[str], group: Sequence[str]):
    """Sums per parent area at every level, from sums at the finest level.

    ``partial`` holds one row per area of the finest level; only this small
    table is copied once per level.
    """
    return (
        partial.withColumn("_up", F.explode(parent_codes(F.col("geoid"), levels)))
        .groupBy(*group, "_up.level", "_up.geoid")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def aggregate_parents(
    block_values: DataFrame,
    block_class: DataFrame,
    levels: Sequence[str] = PARENT_LEVELS,
    by: Sequence[str] = ("region", "urban_rural", "species", "vintage"),
    block: Sequence[str] = ("vintage", "geoid"),
) -> DataFrame:
    """Population-weighted means of the parent areas, every level from blocks.

    ``by, level, year, geoid, predicted, pct_pop_predicted``.  A missing value
    or population makes the parent's value NULL, and so does a population of
    zero.  ``pct_pop_predicted`` is the share of blocks with a within value.
    """
    by, block = list(by), list(block)
    people = block_class.select(*block, "population")
    rows = block_values.join(merged(people), block, "left").withColumn("predicted", best_prediction())
    weighted = F.col("predicted") * F.col("population")
    sums = {
        "_pw": F.sum(weighted),
        "_pw_n": F.count(weighted),
        "_w": F.sum(F.col("population").cast("double")),
        "_w_n": F.count("population"),
        "_in": F.count(first_present(F.col("predicted_within"))),
        "_n": n_rows(),
    }
    group = [*by, "year"]
    partial = rows.groupBy(*group, area_prefix(F.col("geoid"), finest(levels)).alias("geoid")).agg(
        *[v.alias(k) for k, v in sums.items()]
    )
    total = roll_up(partial, levels, list(sums), group)
    return total.select(
        *by,
        "level",
        "year",
        "geoid",
        F.when(
            (F.col("_pw_n") == F.col("_n")) & (F.col("_w_n") == F.col("_n")),
            F.try_divide("_pw", "_w"),
        ).alias("predicted"),
        (F.col("_in") / F.col("_n")).alias("pct_pop_predicted"),
    )
