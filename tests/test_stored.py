"""Stored layouts: buckets by place, spatial layers."""

import os

import pytest
from pyspark.sql import functions as F

from gridtally.functions import geometry as G
from gridtally.operators import colocated, skew
from gridtally.operators.aggregate import aggregate_blocks
from gridtally.operators.colocated import aggregate_stored, store_links, store_panel
from gridtally.operators.within import points_within
from gridtally.sources.spatial import indexed_points_within, morton_key, open_layer, write_points, write_polygons

BY = ["region", "urban_rural"]


@pytest.fixture
def plain_joins(spark):
    """No broadcast of small test tables, and plans as they are before execution."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tables(spark):
    """A panel with gaps, and crosswalks with cells that the panel does not have."""
    grid = [("NE1", k, i + 1, float(i % 7), float(i // 7)) for k in ("urban", "rural") for i in range(40)]
    panel = [
        (*g[:2], s, y, g[3], g[4], None if (g[2] + y) % 13 == 0 else g[2] * 4.0 + y % 3)
        for g in grid
        for s in ("ec", "no3", "so4")
        for y in (2000, 2001)
        # some cells lack a species, one cell lacks all
        if g[2] != 40 and not (s == "no3" and g[2] % 9 == 4)
    ]
    within = [(*g[:3], 2000, f"b{g[2] % 6}") for g in grid] + [("NE1", "urban", 999, 2000, "b1"), ("NE1", "urban", 1, 2000, "")]
    nearest = [("NE1", k, 5 if i < 25 else i, 2000, f"b{i}", i / 2) for k in ("urban", "rural") for i in range(41)]
    make = spark.createDataFrame
    return (
        make(panel, "region STRING, urban_rural STRING, species STRING, year INT, lon DOUBLE, lat DOUBLE, predicted DOUBLE"),
        make(grid, "region STRING, urban_rural STRING, gridcell_idx LONG, lon DOUBLE, lat DOUBLE"),
        make(within, "region STRING, urban_rural STRING, gridcell_idx LONG, vintage INT, geoid STRING"),
        make(nearest, "region STRING, urban_rural STRING, gridcell_idx LONG, vintage INT, geoid STRING, distance DOUBLE"),
    )


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("hot_from", [200_000, 10])
def test_buckets_give_the_same_values(spark, tmp_path, monkeypatch, hot_from):
    monkeypatch.setattr(colocated, "hot_keys", lambda df, keys: skew.hot_keys(df, keys, hot_from))
    panel, grid, within, nearest = tables(spark)
    wanted = aggregate_blocks(panel, within, nearest, BY, grid=grid)
    name = f"stored_{hot_from}"
    stored = store_panel(panel, f"{name}_panel", BY, 4, str(tmp_path / "panel"))
    links = store_links(within, nearest, grid, f"{name}_links", BY, buckets=4, path=str(tmp_path / "links"))
    assert (links.hot is not None) == (hot_from == 10)
    found = aggregate_stored(stored, links, ["ec", "no3", "so4"])
    assert rows(found) == rows(wanted)
    # one file per bucket and species
    assert len(list((tmp_path / "panel").rglob("*.parquet"))) <= 4 * 3
    one = aggregate_stored(stored, links, ["ec"])
    assert rows(one) == rows(wanted.where("species = 'ec'"))


def below(plan, node):
    """The lines of the tree below every node of that name."""
    lines, out, depth = plan.splitlines(), [], None
    for line in lines:
        indent = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if depth is not None and indent > depth:
            out.append(line)
            continue
        depth = indent if node in line else None
    return out


def test_join_of_the_panel_has_no_exchange(spark, tmp_path, plain_joins):
    panel, grid, within, nearest = tables(spark)
    stored = store_panel(panel, "exchange_panel", BY, 4, str(tmp_path / "panel"))
    links = store_links(within, nearest, grid, "exchange_links", BY, buckets=4, path=str(tmp_path / "links"))
    found = aggregate_stored(stored, links, ["ec", "no3", "so4"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    under = below(plan, "SortMergeJoin")
    assert sum("FileScan" in line for line in under) == 4  # both tables, for values and for gaps
    assert not any("Exchange" in line for line in under), plan
    # a species reads its own folder only
    one = aggregate_stored(stored, links, ["ec"])._jdf.queryExecution().executedPlan().toString()
    assert any("species" in part.split("]")[0] for part in one.split("PartitionFilters: [")[1:])
    assert found.select(F.count("*")).first()[0] > 0


def places(spark, n=4000):
    rows = [(i, "a" if i % 3 else "b", (i * 37 % 1009) / 8.0, (i * 53 % 997) / 8.0) for i in range(n)]
    rows += [(n + i, "a", 5.0, 5.0) for i in range(500)] + [(-1, "a", None, 1.0), (-2, "b", float("nan"), 1.0)]
    return spark.createDataFrame(rows, "gridcell_idx LONG, region STRING, lon DOUBLE, lat DOUBLE")


def squares(spark):
    rows = [(f"s{i}", "a" if i % 2 else "b", float(i * 7 % 120), float(i * 13 % 118), 1 + i % 4) for i in range(150)]
    rows += [("everything", "a", -10.0, -10.0, 400)]
    df = spark.createDataFrame(rows, "geoid STRING, region STRING, x DOUBLE, y DOUBLE, s INT")
    ring = F.array(G.ring(*[(F.col("x") + a * F.col("s"), F.col("y") + b * F.col("s")) for a, b in
                            ((0, 0), (1, 0), (1, 1), (0, 1))]))
    none = spark.createDataFrame([("none", "a")], "geoid STRING, region STRING")
    return df.select("geoid", "region", ring.alias("rings")).unionByName(none, allowMissingColumns=True)


@pytest.mark.parametrize("by", [[], ["region"]])
def test_stored_layers_give_the_same_pairs(spark, tmp_path, by):
    points, areas = places(spark), squares(spark)
    # points of a crowded place fill several files
    layer = write_points(points, str(tmp_path / "p"), by=by, rows_per_file=200)
    polygons = write_polygons(areas, str(tmp_path / "a"), by=by, rows_per_file=10)
    assert rows(layer.read()) == rows(points)
    assert layer.files.agg(F.max("n")).first()[0] < 500
    for keep in ("inner", "left"):
        wanted = points_within(points, areas, by, keep=keep)
        assert rows(indexed_points_within(layer, polygons, keep=keep)) == rows(wanted)
    again = open_layer(spark, str(tmp_path / "p"), by)
    assert again == layer
    few = indexed_points_within(again, open_layer(spark, str(tmp_path / "a"), by), chosen=F.col("geoid") == "s7")
    assert rows(few) == rows(points_within(points, areas.where("geoid = 's7'"), by))


def test_only_files_that_can_match_are_read(spark, tmp_path):
    points, areas = places(spark), squares(spark)
    layer = write_points(points, str(tmp_path / "p"), rows_per_file=200)
    corner = spark.createDataFrame([(100.0, 110.0, 100.0, 110.0)], "minx DOUBLE, maxx DOUBLE, miny DOUBLE, maxy DOUBLE")
    near = layer.near(corner)
    files, all_files = set(near.inputFiles()), set(layer.read().inputFiles())
    assert files < all_files and len(files) <= len(all_files) / 4
    inside = "lon BETWEEN 100 AND 110 AND lat BETWEEN 100 AND 110"
    assert rows(near.where(inside)) == rows(points.where(inside))
    far = spark.createDataFrame([(500.0, 501.0, 500.0, 501.0)], corner.schema)
    assert layer.files_near(far) == [] and layer.near(far).count() == 0
    # a join with one square reads few files: the others can be broken
    polygons = write_polygons(areas.where("geoid <> 'everything'"), str(tmp_path / "a"), rows_per_file=10)
    wanted = rows(points_within(points, areas.where("geoid = 's7'"), ()))
    box = polygons.read().where("geoid = 's7'").withColumns(G.box("rings"))
    needed = {os.path.basename(f) for f in layer.files_near(box)}
    assert len(needed) <= len(all_files) / 4
    for file in (tmp_path / "p" / "rows").glob("*.parquet"):
        if file.name not in needed:
            file.write_bytes(b"broken")
    found = indexed_points_within(layer, polygons, chosen=F.col("geoid") == "s7")
    assert wanted and rows(found) == wanted


def test_empty_layers(spark, tmp_path):
    points, areas = places(spark), squares(spark)
    none = write_points(points.limit(0), str(tmp_path / "p"))
    some = write_points(points.where("gridcell_idx < 10"), str(tmp_path / "q"))
    no_areas = write_polygons(areas.limit(0), str(tmp_path / "a"))
    some_areas = write_polygons(areas, str(tmp_path / "b"))
    assert indexed_points_within(none, some_areas).collect() == []
    assert indexed_points_within(some, no_areas).collect() == []
    assert indexed_points_within(some, no_areas, keep="left").count() == some.read().count()


def test_morton_keys(spark):
    pairs = [(x, y) for x in (0, 1, 5, 2**31 - 1) for y in (0, 3, 2**30, 2**31 - 1)]
    df = spark.createDataFrame(pairs, "x LONG, y LONG").withColumn("key", morton_key(F.col("x"), F.col("y")))
    for r in df.collect():
        assert r.key == sum((r.x >> i & 1) << 2 * i | (r.y >> i & 1) << 2 * i + 1 for i in range(31))
