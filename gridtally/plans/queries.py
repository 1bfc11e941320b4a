"""Queries over the given tables, one per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geoid import PARENT_LEVELS, pad_code
from ..functions.wkb import with_rings_of_wkb, with_wkb_of_rings
from ..operators import quality
from ..operators.aggregate import aggregate_parents
from ..operators.buffer import within_buffer
from ..operators.classify import classify_blocks, classify_parents, clean_population
from ..operators.colocated import aggregate_stored, store_links, store_panel
from ..operators.distribute import distribute
from ..operators.grid import attach_cells, extract_grid, number_by_position, sample_files
from ..operators.maintained import change_sums, parent_sums, parents_of_sums, read_sums, write_sums
from ..operators.nearest import nearest_k, nearest_points
from ..operators.regions import polygon_centroids, polygon_validity, regional_subset
from ..operators.repair import polygon_repair
from ..operators.skew import merged
from ..operators.staging import checkpoint_folder, stage
from ..operators.within import points_within
from ..sources import readers, writers
from ..sources.catalog import file_catalog, in_order, list_files
from ..sources.readers import union_all, whole_number
from ..sources.spatial import indexed_points_within, write_points, write_polygons
from ..sources.tasks import open_tasks, pending, preferred_first, restrict, task_grid
from ..streaming.arrivals import arrived_counts, arriving_panel, count_arrivals
from . import views
from .pipeline import block_values, crosswalks

SPECIES = ("ec", "no3")
KIND = ("region", "urban_rural")


def _round(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _block_values(spark: SparkSession, folder: str) -> DataFrame:
    panel = views.predictions(spark, folder).drop("region", "urban_rural", "gridcell_idx")
    return block_values(
        views.blocks(spark, folder), views.grid(spark, folder), panel, species=SPECIES
    )


def block_aggregate(spark, folder):
    return _round(_block_values(spark, folder), "predicted_within")


def bucketed_block_aggregate(spark, folder):
    """The same from a panel and links that are stored in buckets of their places."""
    path, suffix = _scratch(spark), uuid.uuid4().hex
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, grid = views.blocks(spark, folder), views.grid(spark, folder)
    within, nearest = crosswalks(blocks, grid)
    links = store_links(
        within, nearest, grid, f"gridtally_links_{suffix}", (), ["geoid"], buckets, f"{path}/links"
    )
    panel = store_panel(
        views.predictions(spark, folder), f"gridtally_panel_{suffix}", (), buckets, f"{path}/panel"
    )
    return _round(aggregate_stored(panel, links, SPECIES), "predicted_within")


def _parents(spark, folder, levels=PARENT_LEVELS):
    return aggregate_parents(
        _block_values(spark, folder),
        views.block_classes(spark, folder),
        levels,
        by=["species"],
        block=["geoid"],
    )


def parent_aggregate_all_levels(spark, folder):
    return _round(_parents(spark, folder), "predicted", "pct_pop_predicted")


def parent_update(spark, folder):
    """Parent values kept up to date: blocks come, go, change and lose their value."""
    path = f"{_scratch(spark)}/sums"
    marks = views.blocks(spark, folder).select("q", "geoid", "population")
    rows = stage(_block_values(spark, folder).join(merged(marks), "geoid"), "block-rows")
    late, gone, lost, moved = (F.expr(e) for e in ("q % 19 = 3", "q % 17 = 2", "q % 23 = 4", "q % 13 = 1"))
    by = ["species"]
    write_sums(parent_sums(rows.where(~late), by=by), path)
    changed = gone | lost | moved
    values = {
        c: F.when(~lost, F.col(c) + F.when(moved, F.lit(1.0)).otherwise(F.lit(0.0)))
        for c in ("predicted_within", "predicted_nearest")
    }
    after = rows.where((changed | late) & ~gone).withColumns(values)
    sums = change_sums(read_sums(spark, path), rows.where(changed & ~late), after, by=by)
    return _round(parents_of_sums(write_sums(sums, path), by), "predicted", "pct_pop_predicted")


def county_means(spark, folder):
    """Population-weighted mean per county, species and year."""
    return _round(_parents(spark, folder, ["counties"]), "predicted", "pct_pop_predicted")


def _centres(spark, folder):
    return polygon_centroids(views.blocks(spark, folder).select("geoid", "rings"))


def _urban_blocks(spark, folder):
    return points_within(
        _centres(spark, folder),
        views.urban_areas(spark, folder),
        by=(),
        x="cx",
        y="cy",
        point_id=["geoid"],
        polygon_id=["uace"],
    )


def _buffered(spark, folder):
    return within_buffer(
        views.blocks(spark, folder),
        views.urban_areas(spark, folder),
        polygon_id=["geoid"],
    )


def classify_blocks_query(spark, folder):
    blocks = views.blocks(spark, folder)
    return classify_blocks(
        blocks,
        _urban_blocks(spark, folder),
        _buffered(spark, folder),
        blocks.select("geoid", "population"),
        block=["geoid"],
    )


def _parent_classes(spark, folder, levels=PARENT_LEVELS):
    return classify_parents(views.block_classes(spark, folder), levels, by=())


def classify_parents_query(spark, folder):
    return _round(_parent_classes(spark, folder), "pct_population_urban")


def _distributed(spark, folder, urban_only):
    blocks = distribute(
        _block_values(spark, folder),
        views.block_classes(spark, folder),
        urban_only,
        by=["species"],
        area=["geoid"],
    )
    return _round(blocks, "predicted")


def distribute_urban(spark, folder):
    return _distributed(spark, folder, True)


def distribute_all(spark, folder):
    return _distributed(spark, folder, False)


def distribute_urban_parents(spark, folder):
    out = distribute(
        _parents(spark, folder),
        _parent_classes(spark, folder),
        True,
        by=["species"],
        area=["level", "geoid"],
    )
    return _round(out, "predicted")


def points_within_query(spark, folder):
    return points_within(
        views.grid(spark, folder), views.blocks(spark, folder), by=(), keep="left"
    )


def centroids_urban(spark, folder):
    return _urban_blocks(spark, folder)


def nearest_points_query(spark, folder):
    return nearest_points(_centres(spark, folder), views.grid(spark, folder), by=())


def nearest_k_query(spark, folder):
    """The five nearest grid points of every block in its region, by kind of grid."""
    found = nearest_k(_regional(_centres(spark, folder)), views.regional_grid(spark, folder), 5, by=KIND)
    return _round(found, "distance", digits=9)


def indexed_points_within_query(spark, folder):
    """Points within polygons, of layers that are stored along a curve in 32 files."""
    path, grid = _scratch(spark), views.grid(spark, folder)
    blocks = views.blocks(spark, folder).select("geoid", "rings")
    points = write_points(grid, f"{path}/grid", rows_per_file=-(-grid.count() // 32))
    areas = write_polygons(blocks, f"{path}/blocks", rows_per_file=-(-blocks.count() // 32))
    return indexed_points_within(points, areas, keep="left")


def _regional(areas):
    """Areas of the regions, once for each kind of grid."""
    kinds = F.explode(F.array(F.lit("rural"), F.lit("urban")))
    return regional_subset(areas).withColumn("urban_rural", kinds)


def _scratch(spark) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/round-trip-{uuid.uuid4().hex}"


def csv_round_trip(spark, folder):
    """Compressed CSV by folders with the codes of a vintage, written and read."""
    path = _scratch(spark)
    rows = writers.with_file_codes(views.block_classes(spark, folder), 2000)
    writers.write_csv(rows, path, ["urban"], "NA", sort_by=["BLKIDFP00"])
    schema = "BLKIDFP00 STRING, fully_predicted INT, population BIGINT, urban INT"
    return readers.read_table(spark, path, schema, "NA", "BLKIDFP00")


def counts_round_trip(spark, folder):
    path = _scratch(spark)
    counts = quality.yearly_counts(views.panel_rows(spark, folder))
    writers.write_counts(counts, path, quality.PANEL_GROUP)
    return readers.read_counts(spark, path)


def layer_round_trip(spark, folder):
    path = _scratch(spark)
    areas = regional_subset(views.blocks(spark, folder).select("geoid", "population"))
    writers.write_layer(areas, path, "areas", ["region"])
    return readers.read_layer(spark, path, "areas")


def query_export(spark, folder):
    """The result of a SQL query as CSV."""
    path = _scratch(spark)
    views.block_classes(spark, folder).createOrReplaceTempView("gridtally_block_classes")
    query = "SELECT geoid, population FROM gridtally_block_classes WHERE population > :least"
    writers.export_query(spark, query, path, {"least": 100})
    return readers.read_table(spark, path, "geoid STRING, population BIGINT")


def points_within_by_region(spark, folder):
    areas = _regional(views.blocks(spark, folder).select("geoid", "rings"))
    return points_within(views.regional_grid(spark, folder), areas, by=KIND)


def nearest_by_region(spark, folder):
    found = nearest_points(
        _regional(_centres(spark, folder)), views.regional_grid(spark, folder), by=KIND
    )
    return _round(found, "distance", digits=9)


def _ring_report(areas):
    return polygon_centroids(
        areas.withColumns(
            {
                "n_rings": F.size("rings"),
                "area": F.expr(f"aggregate(rings, 0D, (a, r) -> a + {G.ring_area('r')})"),
            }
        )
    )


def wkt_rings(spark, folder):
    """Polygons, polygons with a hole and multipolygons from text."""
    areas = views.polygon_texts(spark, folder)
    return _ring_report(areas.select("geoid", G.rings_from_wkt(F.col("wkt")).alias("rings")))


def geojson_rings(spark, folder):
    areas = views.polygon_texts(spark, folder)
    return _ring_report(areas.select("geoid", G.rings_from_geojson(F.col("geojson")).alias("rings")))


def wkb_rings(spark, folder):
    """The same polygons written as binary and read again."""
    areas = views.polygon_texts(spark, folder)
    binary = with_wkb_of_rings(areas.select("geoid", G.rings_from_wkt(F.col("wkt")).alias("rings")))
    return _ring_report(with_rings_of_wkb(binary.drop("rings")).drop("wkb"))


def split_features(spark, folder):
    """Collections of many features, cut between the features while they are read."""
    path = _scratch(spark)
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"GEOID10":"'), "geoid", F.lit('"},"geometry":'), "geojson", F.lit("}")
    )
    areas = views.polygon_texts(spark, folder).select("geoid", feature.alias("feature"))
    # bounded collections: a file is a few of them, one after the other
    groups = areas.groupBy(F.substring("geoid", 1, 12)).agg(F.concat_ws(", ", F.collect_list("feature")).alias("features"))
    texts = groups.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "features", F.lit("]}")))
    texts.write.text(path)
    return _ring_report(readers.read_polygons(spark, path, {"GEOID10": "geoid"}, "geojson_split"))


def prediction_files(spark, folder):
    """Panels as prediction files with a value column per species, listed and read by their names."""
    path = _scratch(spark)
    panel = views.predictions(spark, folder)
    for name in SPECIES:
        rows = panel.where(F.col("species") == name).select(
            "region", "urban_rural", "year", "lon", "lat", F.col("predicted").alias(f"{readers.VALUE_PREFIX}{name}")
        )
        rows.write.partitionBy("urban_rural", "region").parquet(f"{path}/{name}")
        _name_files(spark, f"{path}/{name}", name, path)
    found = [
        readers.read_predictions(spark, f"{path}/{kind}", SPECIES, kind) for kind in ("urban", "rural")
    ]
    return union_all(found).select("region", "urban_rural", "species", "year", "lon", "lat", "predicted")


def _name_files(spark, source, species, target):
    """Move files of ``urban_rural=, region=`` folders to names like 2000.NE1.ec.part1.parquet."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(target).getFileSystem(spark._jsc.hadoopConfiguration())
    listed = list_files(spark, source, "*.parquet").orderBy("path").collect()  # names of files only
    for number, row in enumerate(listed):
        kind, region = (part.split("=")[1] for part in row.path.split("/")[-3:-1])
        files.mkdirs(at(f"{target}/{kind}"))
        files.rename(at(row.path), at(f"{target}/{kind}/{region}.{species}.part{number}.parquet"))


def imported_layers(spark, folder):
    """Layers of two vintages imported as one table, a table made by SQL from it, and the import dropped."""
    blocks = views.blocks(spark, folder).select("geoid", "population")
    suffix = uuid.uuid4().hex
    layers = {2010: blocks, 2000: blocks.where("population > 100")}
    writers.import_layers(spark, f"gridtally_layers_{suffix}", layers)
    query = f"SELECT vintage, geoid, population FROM gridtally_layers_{suffix} WHERE population >= :least"
    made = writers.create_table(spark, f"gridtally_people_{suffix}", query, {"least": 50}, ["vintage"])
    writers.drop_tables(spark, f"gridtally_layers_{suffix}")
    return made.select("vintage", "geoid", "population")


def wanted_tasks(spark, folder):
    """Every file with every combination of the parameters of a run."""
    grid = task_grid(spark, {"vintage": [2000, 2010], "level": ["counties", "tracts"]})
    return _file_tasks(spark, folder).crossJoin(F.broadcast(grid))  # four rows


def arriving_counts(spark, folder):
    """Yearly counts of a panel whose files arrive in two parts, counted as they come."""
    path, rows = _scratch(spark), views.panel_rows(spark, folder)
    late = F.col("year") % 3 == 0
    for part in (~late, late):
        rows.where(part).write.mode("append").partitionBy(*quality.PANEL_GROUP).parquet(f"{path}/panel")
        count_arrivals(arriving_panel(spark, f"{path}/panel"), f"{path}/out")
    return arrived_counts(spark, f"{path}/out")


def population_text(spark, folder):
    """Populations written in several ways."""
    text = F.expr(
        """CASE q % 7 WHEN 1 THEN concat(population, '.0') WHEN 2 THEN concat(' ', population)
             WHEN 3 THEN concat(q % 9 + 1, 'e2') WHEN 4 THEN 'n/a' WHEN 5 THEN '1.5'
             ELSE CAST(population AS STRING) END"""
    )
    return views.blocks(spark, folder).select("q", whole_number(text).alias("population"))


def polygon_centroids_query(spark, folder):
    areas = views.blocks(spark, folder).select("geoid", "rings")
    return polygon_centroids(regional_subset(areas))


def conic_projection(spark, folder):
    x, y = G.to_conic(F.col("lon"), F.col("lat"))
    grid = views.grid(spark, folder)
    return grid.select("gridcell_idx", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


def within_buffer_query(spark, folder):
    return _buffered(spark, folder)


def extract_grid_query(spark, folder):
    return extract_grid(views.predictions(spark, folder).drop("gridcell_idx"))


def panel_cells(spark, folder):
    panel = views.predictions(spark, folder).drop("gridcell_idx")
    out = attach_cells(panel, extract_grid(panel))
    return out.select("region", "urban_rural", "species", "year", "gridcell_idx", "predicted")


def position_cells(spark, folder):
    panel = views.predictions(spark, folder).select("region", "urban_rural", "species", "year", "lat", "lon", "predicted")
    return number_by_position(panel, ["lat", "lon"])


def yearly_counts_query(spark, folder):
    return quality.yearly_counts(views.panel_rows(spark, folder))


def inconsistent_groups_query(spark, folder):
    return quality.inconsistent_groups(quality.yearly_counts(views.panel_rows(spark, folder)))


def coverage_matrix(spark, folder):
    return quality.coverage(views.order_files(spark, folder))


def coverage_wide_query(spark, folder):
    years = range(1992, 1998)  # the last year of the table falls under other
    wide = quality.coverage_wide(views.order_files(spark, folder), years)
    return wide.withColumnsRenamed({str(y): f"y{y}" for y in years})


def _catalog(spark, folder):
    return file_catalog(views.paths(spark, folder))


def catalog_from_names(spark, folder):
    return in_order(_catalog(spark, folder))


def sample_files_query(spark, folder):
    return sample_files(_catalog(spark, folder))


def missing_population_query(spark, folder):
    return quality.missing_population(views.block_classes(spark, folder))


def supplied_population_query(spark, folder):
    supplied = views.blocks(spark, folder).select("geoid", F.expr("q % 3").alias("value"))
    return quality.supplied_population(views.block_classes(spark, folder), supplied)


def geoid_pad(spark, folder):
    blocks = views.blocks(spark, folder)
    return blocks.select(
        "q", pad_code(F.expr("CASE WHEN q % 50 = 7 THEN 'n/a' ELSE CAST(CAST(geoid AS BIGINT) AS STRING) END")).alias("geoid")
    )


def region_subset_query(spark, folder):
    areas = views.blocks(spark, folder).select("geoid", "population")
    return regional_subset(areas)


def margins(spark, folder):
    return _round(quality.shares_with_total(views.block_classes(spark, folder), "urban"), "percent")


def totals_agree_query(spark, folder):
    own = _parent_classes(spark, folder, ["tracts"])
    published = (
        views.blocks(spark, folder)
        .groupBy(F.substring("geoid", 1, 11).alias("geoid"))
        .agg(F.sum(F.col("population") + F.expr("CASE WHEN q % 40 = 9 THEN 1 ELSE 0 END")).alias("population"))
    )
    return quality.totals_agree(published, own)


def clean_population_query(spark, folder):
    return clean_population(views.block_classes(spark, folder), first_dropped_state="45")


def union_by_name(spark, folder):
    customers = views.table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    suppliers = views.table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_acctbal AS balance"
    )
    return union_all([customers, suppliers])


def _file_tasks(spark, folder):
    """Tasks from the names of the prediction files: number of the file and species."""
    number = F.element_at(F.split("path", "/"), 3).cast("long").alias("number")
    return _catalog(spark, folder).select(number, "region", "species")


def _finished_tasks(spark, folder):
    """Tasks that the orders have finished."""
    return views.table(spark, folder, "orders").selectExpr(
        "o_custkey AS number", "element_at(array('ec', 'no3', 'so4'), CAST(o_orderkey % 3 + 1 AS INT)) AS species"
    )


def pending_tasks(spark, folder):
    wanted, done = _file_tasks(spark, folder), _finished_tasks(spark, folder)
    return preferred_first(pending(wanted, done, ["number", "species"]), "species", "ec")


def restarted_counts(spark, folder):
    """Yearly counts of the groups that are left: of a stored panel only their folders are read."""
    path = _scratch(spark)
    panel = views.predictions(spark, folder).select(*KIND, "species", "year", "lon", "lat", "predicted")
    writers.write_layer(panel, path, "panel", [*KIND, "species"])
    wanted = list_files(spark, f"{path}/panel", "*.parquet", [*KIND, "species"])
    done = wanted.where("region = 'MA2' OR (region = 'NE1' AND species = 'ec')").distinct()
    done.write.parquet(f"{path}/counts-finished")
    left = open_tasks(spark, wanted, f"{path}/counts", [*KIND, "species"])
    return quality.yearly_counts(restrict(readers.read_panel(spark, f"{path}/panel"), left))


def panel_check_query(spark, folder):
    return quality.panel_check(views.predictions(spark, folder))


def panel_fingerprints_query(spark, folder):
    """A panel with years whose cells were exchanged, moved or put in another order."""
    swapped = "year = 2002 AND region = 'NE1' AND p % 2 = 0 AND p % 50 < 16"
    partner = "year = 2002 AND region = 'NE1' AND p % 2 = 1 AND p % 50 < 17"
    place = f"CASE WHEN {swapped} THEN p + 1 WHEN {partner} THEN p - 1 ELSE p END"
    moved = "CASE WHEN year = 2003 AND region = 'P9' AND p % 100 = 40 THEN lon + 0.5D ELSE lon END"
    panel = views.predictions(spark, folder).selectExpr(
        "region", "urban_rural", "species", "year", "lat", "gridcell_idx - 1 AS p", "lon"
    )
    panel = panel.selectExpr("*", f"{place} AS place", f"{moved} AS at")
    panel = panel.where("NOT (year = 2004 AND region = 'MA2' AND p % 500 = 20)").drop("lon")
    found = quality.panel_fingerprints(panel.withColumnRenamed("at", "lon"), position="place")
    return found.drop("cells", "ordered")


def _bow_tie(ring):
    """A diamond with two corners exchanged: two triangles that meet in the middle."""
    return F.concat(F.slice(ring, 1, 1), F.slice(ring, 3, 1), F.slice(ring, 2, 1), F.slice(ring, 4, 2))


def polygon_repair_query(spark, folder):
    """Bow-ties, diamonds with a hole that reaches beyond them, and sound diamonds."""
    ring = F.get("rings", F.lit(0))
    moved = F.transform(ring, lambda p: G.point(p["x"] + F.col("hx"), p["y"]))
    rings = F.when(F.expr("q % 3 = 0"), F.array(_bow_tie(ring))).when(F.expr("q % 3 = 1"), F.array(ring, moved))
    areas = views.blocks(spark, folder).withColumn("rings", rings.otherwise(F.array(ring)))
    mended = polygon_repair(areas.select("geoid", "rings"))
    report = _ring_report(mended).drop("cx", "cy")
    return report.join(polygon_validity(mended).select("geoid", "crosses", "valid"), "geoid")


def polygon_validity_query(spark, folder):
    """Diamonds, some of them broken in the ways the report looks for."""
    ring = F.get("rings", F.lit(0))
    broken = (
        F.when(F.expr("q % 10 = 1"), F.slice(ring, 1, 4))
        .when(F.expr("q % 10 = 2"), F.concat(F.slice(ring, 1, 2), F.slice(ring, 1, 1)))
        .when(F.expr("q % 10 = 3"), F.transform(ring, lambda p: G.point(p["x"], F.col("y"))))
        .when(F.expr("q % 10 = 4"), F.concat(F.slice(ring, 1, 1), ring))
        .when(F.expr("q % 10 = 5"), _bow_tie(ring))
        .otherwise(ring)
    )
    areas = views.blocks(spark, folder).withColumn("rings", F.array(broken))
    return polygon_validity(areas)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "block_aggregate": block_aggregate,
    "bucketed_block_aggregate": bucketed_block_aggregate,
    "parent_aggregate_all_levels": parent_aggregate_all_levels,
    "parent_update": parent_update,
    "county_means": county_means,
    "classify_blocks": classify_blocks_query,
    "classify_parents": classify_parents_query,
    "distribute_urban": distribute_urban,
    "distribute_all": distribute_all,
    "distribute_urban_parents": distribute_urban_parents,
    "points_within": points_within_query,
    "indexed_points_within": indexed_points_within_query,
    "centroids_urban": centroids_urban,
    "nearest_points": nearest_points_query,
    "nearest_k": nearest_k_query,
    "csv_round_trip": csv_round_trip,
    "counts_round_trip": counts_round_trip,
    "layer_round_trip": layer_round_trip,
    "query_export": query_export,
    "points_within_by_region": points_within_by_region,
    "nearest_by_region": nearest_by_region,
    "wkt_rings": wkt_rings,
    "geojson_rings": geojson_rings,
    "wkb_rings": wkb_rings,
    "split_features": split_features,
    "prediction_files": prediction_files,
    "imported_layers": imported_layers,
    "wanted_tasks": wanted_tasks,
    "arriving_counts": arriving_counts,
    "population_text": population_text,
    "polygon_centroids": polygon_centroids_query,
    "conic_projection": conic_projection,
    "within_buffer": within_buffer_query,
    "extract_grid": extract_grid_query,
    "panel_cells": panel_cells,
    "position_cells": position_cells,
    "yearly_counts": yearly_counts_query,
    "inconsistent_groups": inconsistent_groups_query,
    "coverage_matrix": coverage_matrix,
    "coverage_wide": coverage_wide_query,
    "catalog_from_names": catalog_from_names,
    "sample_files": sample_files_query,
    "missing_population": missing_population_query,
    "supplied_population": supplied_population_query,
    "geoid_pad": geoid_pad,
    "region_subset": region_subset_query,
    "margins": margins,
    "totals_agree": totals_agree_query,
    "clean_population": clean_population_query,
    "union_by_name": union_by_name,
    "pending_tasks": pending_tasks,
    "restarted_counts": restarted_counts,
    "panel_check": panel_check_query,
    "panel_fingerprints": panel_fingerprints_query,
    "polygon_validity": polygon_validity_query,
    "polygon_repair": polygon_repair_query,
}
