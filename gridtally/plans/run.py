"""All stages from input files to distribution tables.

Each stage writes below one output folder and is skipped, or completed, if its
result is there already.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geoid import PARENT_LEVELS
from ..operators.aggregate import aggregate_blocks, aggregate_parents
from ..operators.buffer import within_buffer
from ..operators.classify import classify_blocks, classify_parents
from ..operators.distribute import distribute
from ..operators.grid import extract_grid, require_unique_places
from ..operators.quality import coverage, inconsistent_groups, panel_check, yearly_counts
from ..operators.regions import polygon_centroids, regional_subset
from ..operators.skew import BROADCAST_ROWS
from ..operators.staging import staging_scope
from ..operators.within import points_within
from ..sources.catalog import file_catalog, list_files
from ..sources.readers import (
    read_blocks,
    read_counts,
    read_layer,
    read_panel,
    read_polygons,
    read_population,
    read_predictions,
    union_all,
)
from ..sources.tasks import open_tasks, restrict, task_grid, write_tasks
from ..sources.writers import with_file_codes
from .pipeline import crosswalks

KIND = ["region", "urban_rural"]
TASK = [*KIND, "vintage", "species"]
Make = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Inputs:
    """Where the inputs are and what is to be made of them."""

    predictions: Mapping[str, str]  # urban / rural -> folder
    blocks: Mapping[int, str]  # vintage -> polygon files
    population: Mapping[int, str]  # vintage -> CSV
    urban_areas: str
    species: Sequence[str]
    sample_species: str = "no3"
    predictions_format: str = "parquet"
    polygons_format: str = "geojson"
    urban_columns: Mapping[str, str] = field(
        default_factory=lambda: {"UACE10": "uace", "NAME10": "name"}
    )
    buffer: float = 1000.0
    exclude_regions: Sequence[str] = ()
    levels: Sequence[str] = PARENT_LEVELS
    panel: str | None = None  # a partitioned panel instead of prediction files
    csv: bool = False  # also write the values as CSV.gz with the code columns of the vintage


def run(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    """Run all stages; returns the tables that were written, by name.

    Every table is a set of tasks (region, kind, vintage, species, level); a
    later run does those that are not finished, also where a region, a species
    or a vintage has come since.
    """
    # folder names are text: codes and regions must not be read as numbers
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        with staging_scope(spark):
            return _run(spark, inputs, out)
    finally:
        spark.conf.set(setting, before)


def _run(spark: SparkSession, inputs: Inputs, out: str) -> dict[str, DataFrame]:
    tables: dict[str, DataFrame] = {}

    def product(name: str, wanted: DataFrame, keys: Sequence[str], make: Make) -> DataFrame:
        """The table ``name``, completed by the tasks that are not finished yet."""
        todo = open_tasks(spark, wanted, f"{out}/{name}", keys)
        if todo is not None:
            write_tasks(make(todo), todo, f"{out}/{name}")
        tables[name] = _typed(read_layer(spark, out, name))
        return tables[name]

    def values_of(**domains) -> DataFrame:
        return task_grid(spark, {k: list(v) for k, v in domains.items()})

    # what there is: files by region, kind and species
    extension = inputs.predictions_format
    if inputs.panel is not None:
        panel = read_panel(spark, inputs.panel).where(F.col("species").isin(list(inputs.species)))
        # from the names of the folders, without reading a file
        files = (
            list_files(spark, inputs.panel, "*.parquet", folders=[*KIND, "species"])
            .where(F.col("species").isin(list(inputs.species)))
            .distinct()
        )
    else:
        panel = union_all(
            read_predictions(spark, path, inputs.species, kind, inputs.predictions_format)
            for kind, path in inputs.predictions.items()
        )
        files = union_all(
            file_catalog(list_files(spark, path, f"*.{extension}*"), extension).withColumn(
                "urban_rural", F.lit(kind)
            )
            for kind, path in inputs.predictions.items()
        ).where(F.col("species").isin(list(inputs.species)))
    tables["coverage"] = coverage(files, ["urban_rural", "region", "species"])
    kept = ~F.col("region").isin(list(inputs.exclude_regions))
    files, panel = files.where(kept), panel.where(kept)
    group = [*KIND, "species"]

    todo = open_tasks(spark, files, f"{out}/diagnostics", group)
    if todo is not None:
        counted = yearly_counts(restrict(panel, todo)).select(*group, "year", "n")
        write_tasks(
            counted, todo, f"{out}/diagnostics", "csv", {"header": "true", "sep": " "}
        )
    tables["inconsistent"] = inconsistent_groups(read_counts(spark, f"{out}/diagnostics"))

    tables["panel_check"] = panel_check(panel)

    # grids: one per region and kind, from the sampled species
    sampled = files.where(F.col("species") == inputs.sample_species)
    grid = product(
        "grid", sampled, KIND,
        lambda todo: extract_grid(restrict(panel, todo), inputs.sample_species),
    )
    require_unique_places(grid, KIND)

    # polygons and their classes: one per vintage
    block = ["vintage", "geoid"]
    vintages = values_of(vintage=inputs.blocks)
    blocks = product(
        "blocks", vintages, ["vintage"],
        lambda todo: read_blocks(
            spark,
            {v: p for v, p in inputs.blocks.items() if str(v) in {r[0] for r in todo.collect()}},
            inputs.polygons_format,
        ),
    )
    urban = product(
        "urban_areas", values_of(part=["all"]), ["part"],
        lambda todo: read_polygons(
            spark, inputs.urban_areas, dict(inputs.urban_columns), inputs.polygons_format
        ).withColumn("part", F.lit("all")),
    ).drop("part")

    def block_classes(todo: DataFrame) -> DataFrame:
        chosen = restrict(blocks, todo)
        in_urban = points_within(
            polygon_centroids(chosen), urban, by=(), x="cx", y="cy", point_id=block, polygon_id=["uace"]
        )
        covered = within_buffer(chosen, urban, inputs.buffer, block, ["uace"])
        people = union_all(
            read_population(spark, path, vintage) for vintage, path in inputs.population.items()
        )
        return classify_blocks(chosen, in_urban, covered, people, block)

    classes = product("block_classes", vintages, ["vintage"], block_classes)
    levels = values_of(vintage=inputs.blocks, level=inputs.levels)
    parent_classes = product(
        "parent_classes", levels, ["vintage", "level"],
        lambda todo: classify_parents(restrict(classes, todo.select("vintage")), inputs.levels),
    )

    # crosswalks: one per grid and vintage
    parts = [*KIND, "vintage"]
    each_vintage = F.explode(F.array(*[F.lit(str(v)) for v in inputs.blocks])).alias("vintage")
    grids = grid.select(*KIND).distinct()
    regional = regional_subset(blocks).join(_counted_broadcast(grids), "region")
    made: list[tuple[DataFrame, DataFrame]] = []

    def both(todo: DataFrame, side: int) -> DataFrame:
        if not made:
            made.append(crosswalks(restrict(regional, todo), restrict(grid, todo), KIND, block))
        return made[0][side]

    wanted = grids.select(*KIND, each_vintage)
    within = product("crosswalk_within", wanted, parts, lambda todo: both(todo, 0))
    if made:
        made.clear()  # the other side may have other tasks left
    nearest = product("crosswalk_nearest", wanted, parts, lambda todo: both(todo, 1))

    # values: for every species that has files
    wanted = files.select(*group).distinct().join(grids, KIND).select("*", each_vintage)
    values = product(
        "block_values", wanted, TASK,
        lambda todo: aggregate_blocks(
            *(restrict(t, todo) for t in (panel, within, nearest)), KIND, block,
            restrict(grid, todo), list(inputs.species),
        ),
    )
    per_level = [*TASK, "level"]
    names = F.explode(F.array(*[F.lit(n) for n in inputs.levels]))
    wanted_levels = wanted.withColumn("level", names)
    parents = product(
        "parent_values", wanted_levels, per_level,
        lambda todo: aggregate_parents(restrict(values, todo), classes, inputs.levels),
    )

    # distribution: urban predictions hold for urban areas only
    area = ["vintage", "level", "geoid"]
    blocks_level = F.lit("blocks").alias("level")
    sides = [
        (values.select("*", blocks_level), classes.select("*", blocks_level)),
        (parents, parent_classes),
    ]

    def distribution(todo: DataFrame) -> DataFrame:
        return union_all(
            distribute(
                restrict(side, todo).where(
                    (F.col("urban_rural") == "urban") == F.lit(urban_only)
                ),
                labels, urban_only, by=group, area=area,
            )
            for side, labels in sides
            for urban_only in (True, False)
        )

    wanted_areas = wanted_levels.unionByName(wanted.withColumn("level", F.lit("blocks")))
    product("distribution", wanted_areas, per_level, distribution)
    if inputs.csv:
        _write_csv(spark, inputs, tables, out)
    return tables


def _write_csv(
    spark: SparkSession, inputs: Inputs, tables: Mapping[str, DataFrame], out: str
) -> None:
    """The values as CSV.gz: below ``csv/table/vintage/level``, one folder per task."""
    for name in ("block_values", "parent_values", "distribution"):
        values = tables[name]
        levels = {"block_values": ["blocks"], "parent_values": list(inputs.levels)}.get(
            name, ["blocks", *inputs.levels]
        )
        for vintage in inputs.blocks:
            for level in levels:
                rows = values.where(F.col("vintage") == int(vintage))
                if "level" in values.columns:
                    rows = rows.where(F.col("level") == level).drop("level")
                keys = [*KIND, "species"]
                path = f"{out}/csv/{name}/{vintage}/{level}"
                todo = open_tasks(spark, rows, path, keys)
                if todo is not None:
                    write_tasks(
                        with_file_codes(rows.drop("vintage"), vintage, level), todo, path, "csv",
                        {"header": "true", "compression": "gzip", "nullValue": "NA"},
                    )


def _counted_broadcast(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint, if its rows are few enough."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("vintage", F.col("vintage").cast("int")) if "vintage" in df.columns else df
