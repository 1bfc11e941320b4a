"""Files in temporary folders: readers, writers, catalogue, restartable runs."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from gridtally.functions.geometry import rings_from_wkt
from gridtally.functions.geoid import code_column, pad_code, region_of
from gridtally.functions.names import base_name, strip_extension
from gridtally.operators.grid import extract_grid
from gridtally.operators.quality import inconsistent_groups, yearly_counts
from gridtally.sources import catalog, readers, tasks, writers

GROUP = ["region", "urban_rural", "species"]


def write(path, text, zipped=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    with (gzip.open if zipped else open)(path, "wt") as f:
        f.write(text)
    return str(path)


def test_catalog_lists_files_without_reading_them(spark, tmp_path):
    for name in ("2001.NE1.ec.rds", "NEC3.no3.part2.rds", "WSC7.so4.rds", "notes.txt"):
        write(tmp_path / "a" / name, "x")
    rows = catalog.file_catalog(catalog.list_files(spark, str(tmp_path))).collect()
    got = {r.path.rsplit("/", 1)[1]: (r.year, r.region, r.part_number, r.species) for r in rows}
    assert got == {
        "2001.NE1.ec.rds": ("2001", "NE1", None, "ec"),
        "NEC3.no3.part2.rds": (None, "NEC3", "2", "no3"),
        "WSC7.so4.rds": (None, "WSC7", None, "so4"),
    }


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_predictions_of_several_species(spark, tmp_path, fmt):
    for name, column, values in (
        ("2000.NE1.ec", "ec", [1.0, float("nan")]),
        ("2001.NE1.ec.part1", "ec", [3.0]),
        ("NE1.no3", "no3", [5.0, None]),
    ):
        rows = [(2000 + i, 0.5, 1.5, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "year INT, lon DOUBLE, lat DOUBLE, v DOUBLE")
        df = df.withColumnRenamed("v", f"final.predicted.{column}")
        part = tmp_path / f"w-{name}"
        writer = df.coalesce(1).write
        if fmt == "csv":
            writer = writer.option("header", True).option("nullValue", "NA")
        writer.format(fmt).save(str(part))
        data = next(p for p in part.iterdir() if p.name.endswith("." + fmt) and p.name[0] != ".")
        target = tmp_path / "in" / f"{name}.{fmt}"
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(data.read_bytes())
    panel = readers.read_predictions(spark, str(tmp_path / "in"), ["ec", "no3"], "urban", fmt)
    got = sorted(
        (r.species, r.region, r.part_number or "", r.year, r.predicted or 0) for r in panel.collect())
    assert got == [
        ("ec", "NE1", "", 2000, 1.0), ("ec", "NE1", "", 2001, 0), ("ec", "NE1", "1", 2000, 3.0),
        ("no3", "NE1", "", 2000, 5.0), ("no3", "NE1", "", 2001, 0),
    ]
    assert panel.where("isnan(predicted)").count() == 0
    if fmt == "parquet":
        plan = panel.select("year", "lon", "lat")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<year:int,lon:double,lat:double>" in plan


def test_polygons_from_geojson_wkt_and_parquet(spark, tmp_path):
    ring = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    feature = {"type": "Feature", "properties": {"GEOID10": "01", "ALAND": 5},
               "geometry": {"type": "Polygon", "coordinates": [ring]}}
    multi = {"type": "Feature", "properties": {"GEOID10": "02"},
             "geometry": {"type": "MultiPolygon", "coordinates": [[ring[::-1]], [ring]]}}
    write(tmp_path / "g" / "s1.json", json.dumps(feature) + "\n")
    write(tmp_path / "g" / "s2.json", json.dumps(multi) + "\n")
    write(tmp_path / "w" / "b.csv", 'GEOID10,geometry\n03,"POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"\n')
    columns = {"GEOID10": "geoid"}
    features = readers.read_polygons(spark, str(tmp_path / "g" / "*.json"), columns)
    text = readers.read_polygons(spark, str(tmp_path / "w"), columns, fmt="wkt")
    everything = readers.union_all([features, text])
    got = {r.geoid: [len(p) for p in r.rings] for r in everything.collect()}
    assert got == {"01": [5], "02": [5, 5], "03": [5]}
    writers.write_layer(everything, str(tmp_path / "layers"), "blocks")
    again = readers.read_polygons(
        spark, str(tmp_path / "layers" / "blocks"), {"geoid": "geoid"}, "parquet", "rings",
        centroids_only=True)
    assert {(r.geoid, r.cx, r.cy) for r in again.collect()} == {
        ("01", 1.0, 1.0), ("02", 1.0, 1.0), ("03", 1.0, 1.0)}
    assert readers.read_layer(spark, str(tmp_path / "layers"), "blocks").count() == 3
    blocks = readers.read_blocks(spark, {2010: str(tmp_path / "g" / "*.json")})
    assert {(r.vintage, r.geoid) for r in blocks.collect()} == {(2010, "01"), (2010, "02")}


def test_population_codes_are_padded(spark, tmp_path):
    path = write(
        tmp_path / "p.csv.gz", "GEOID,population\n90010001001000,5\n120010001001000,NA\n", True)
    got = {(r.geoid, r.population, r.vintage) for r in
           readers.read_population(spark, path, 2000).collect()}
    assert got == {("090010001001000", 5, 2000), ("120010001001000", None, 2000)}


def test_long_codes_are_not_cut(spark):
    df = spark.createDataFrame([("1234567890123456",), ("7",), ("x",), ("9.0010001001e13",)], "c STRING")
    got = [r[0] for r in df.select(pad_code(F.col("c"))).collect()]
    assert got == ["1234567890123456", "000000000000007", None, "090010001001000"]


def test_code_names_and_regions(spark):
    assert code_column(2000) == "BLKIDFP00" and code_column(2000, "tracts") == "CTIDFP00"
    assert code_column(2010, "counties") == "GEOID10" and code_column(2020) == "GEOID20"
    df = spark.createDataFrame([("09xx",), ("02xx",), (None,)], "g STRING")
    assert [r[0] for r in df.select(region_of(F.col("g"))).collect()] == ["NE1", None, None]


def test_file_names(spark):
    df = spark.createDataFrame([("/a/b/urban_2010.gpkg",)], "p STRING")
    assert df.select(strip_extension(base_name(F.col("p")))).first()[0] == "urban_2010"


@pytest.mark.parametrize("null_value", ["", "NA"])
def test_csv_keeps_zeroes_and_missing_values(spark, tmp_path, null_value):
    df = spark.createDataFrame(
        [("NE1", "09", 1.5), ("NE1", "01", None), ("P9", "06", 2.5)],
        "region STRING, geoid STRING, predicted DOUBLE")
    path = str(tmp_path / "out")
    named = writers.with_file_codes(df, 2000)
    writers.write_csv(named, path, ["region"], null_value, sort_by=["BLKIDFP00"])
    files = [f for _, _, fs in os.walk(path) for f in fs if f.startswith("part")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    back = readers.read_table(
        spark, path, "BLKIDFP00 STRING, predicted DOUBLE, region STRING", null_value, "BLKIDFP00")
    assert {tuple(r) for r in back.select("region", "geoid", "predicted").collect()} == {
        ("NE1", "09", 1.5), ("NE1", "01", None), ("P9", "06", 2.5)}


def test_count_diagnostics_round_trip(spark, tmp_path):
    rows = [("NE1", "urban", "ec", y) for y in (2000, 2000, 2001, None)]
    rows += [("P9", "rural", "ec", y) for y in (2000, 2001)]
    panel = spark.createDataFrame(rows, "region STRING, urban_rural STRING, species STRING, year INT")
    writers.write_counts(yearly_counts(panel), str(tmp_path / "d"), GROUP)
    counts = readers.read_counts(spark, str(tmp_path / "d"))
    assert {(r.region, r.year, r.n) for r in counts.collect()} == {
        ("NE1", 2000, 2), ("NE1", 2001, 1), ("P9", 2000, 1), ("P9", 2001, 1)}
    assert [r.region for r in inconsistent_groups(counts).collect()] == ["NE1"]


def test_tables_from_queries(spark, tmp_path):
    spark.createDataFrame(
        [("09a", 1), ("06b", 2)], "geoid STRING, v INT").createOrReplaceTempView("all_blocks")
    query = "SELECT * FROM all_blocks WHERE array_contains(:states, substr(geoid, 1, 2))"
    args = {"states": F.array(F.lit("09"), F.lit("23"))}
    assert writers.create_table(spark, "blocks_ne1", query, args).count() == 1
    writers.export_query(spark, "SELECT * FROM blocks_ne1", str(tmp_path / "q"))
    assert spark.read.option("header", True).csv(str(tmp_path / "q")).first().geoid == "09a"
    both = writers.import_layers(
        spark, "layers", {2010: spark.table("all_blocks"), 2000: spark.table("blocks_ne1")})
    assert {(r.vintage, r["count"]) for r in both.groupBy("vintage").count().collect()} == {
        (2000, 1), (2010, 2)}
    writers.drop_tables(spark, "blocks_ne1", "layers", "never_there")
    assert not spark.catalog.tableExists("blocks_ne1")


def test_second_run_writes_only_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("NE1", "ec", 1), ("NE1", "no3", 2), ("a b+c", "ec", 3), (None, "ec", 4)]
    df = spark.createDataFrame(rows, "region STRING, species STRING, v INT")
    keys = ["region", "species"]
    files = lambda: sorted(str(p) for p in (tmp_path / "out").rglob("part*"))
    todo = tasks.open_tasks(spark, df.where("species = 'ec'"), path, keys)
    tasks.write_tasks(df, todo, path)
    before = files()
    assert len(before) == 3
    # a task without rows is finished too, one that is left over comes alone
    empty = spark.createDataFrame([("M8", "ec")], "region STRING, species STRING")
    todo = tasks.open_tasks(spark, df.select(*keys).unionByName(empty), path, keys)
    assert {tuple(r) for r in todo.collect()} == {("NE1", "no3"), ("M8", "ec")}
    tasks.write_tasks(df, todo, path)
    assert set(before) < set(files()) and len(files()) == 4
    assert tasks.open_tasks(spark, df.select(*keys).unionByName(empty), path, keys) is None
    assert spark.read.parquet(path).agg(F.sum("v")).first()[0] == 10


def test_folders_of_a_broken_run_are_replaced(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    df.where("k = 'a'").write.partitionBy("k").parquet(path)  # written, but not marked
    (tmp_path / "out-finished").mkdir()
    tasks.write_tasks(df, tasks.open_tasks(spark, df, path, ["k"]), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2]


def test_parts_are_numbers(spark, tmp_path):
    for part in range(1, 13):
        df = spark.createDataFrame([(2000, float(part), 1.0, float(part))],
                                   "year INT, lon DOUBLE, lat DOUBLE, `final.predicted.ec` DOUBLE")
        df.coalesce(1).write.parquet(str(tmp_path / "tmp" / str(part)))
        file = next((tmp_path / "tmp" / str(part)).glob("part-*.parquet"))
        write(tmp_path / "in" / f"2000.NE1.ec.part{part}.parquet", "")
        (tmp_path / "in" / f"2000.NE1.ec.part{part}.parquet").write_bytes(file.read_bytes())
    panel = readers.read_predictions(spark, str(tmp_path / "in"), ["ec"], "urban")
    assert sorted(r.predicted for r in panel.collect()) == [float(p) for p in range(1, 13)]
    cells = extract_grid(panel, "ec").collect()
    assert [r.lon for r in sorted(cells, key=lambda r: r.gridcell_idx)] == [float(p) for p in range(1, 13)]


def test_feature_collections_and_rejected_lines(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    one = {"type": "Feature", "properties": {"GEOID10": "01"},
           "geometry": {"type": "Polygon", "coordinates": [ring]}}
    both = {"type": "FeatureCollection", "features": [one, {**one, "properties": {"GEOID10": "02"}}]}
    write(tmp_path / "a.json", json.dumps(both) + "\n" + json.dumps(one) + "\nbroken\n\n")
    path = str(tmp_path / "a.json")
    rows = readers.read_polygons(spark, path, {"GEOID10": "geoid"}).collect()
    assert sorted(r.geoid for r in rows) == ["01", "01", "02"] and all(r.rings for r in rows)
    assert readers.rejected_lines(spark, path) == 1
    write(tmp_path / "b.json", json.dumps(both, indent=2))
    rows = readers.read_polygons(spark, str(tmp_path / "b.json"), {"GEOID10": "geoid"}, "geojson_files")
    assert rows.count() == 2


def test_wkt_with_many_rings(spark):
    rings = ", ".join(f"(({i} 0, {i + 1} 0, {i + 1} 1, {i} 0))" for i in range(20_000))
    df = spark.createDataFrame([(f"MULTIPOLYGON ({rings})",), ("POLYGON EMPTY",), (None,),
                                ("polygon((0 0,4 0,4 4,0 0) , (1 1, 2 1, 2 2, 1 1))",)], "w STRING")
    sizes = [r[0] for r in df.select(F.size(rings_from_wkt(F.col("w")))).collect()]
    assert sizes[0] == 20_000 and sizes[1] in (-1, None) and sizes[3] == 2


def test_populations_are_numbers(spark, tmp_path):
    path = write(tmp_path / "p.csv", "GEOID,population\n1,12\n2,12.0\n3,1e3\n4,NA\n5,1.5\n6,x\n")
    found = {r.geoid[-1]: r.population for r in readers.read_population(spark, path).collect()}
    assert found == {"1": 12, "2": 12, "3": 1000, "4": None, "5": None, "6": None}


def test_task_grid(spark):
    grid = tasks.task_grid(spark, {"region": ["NE1", "P9"], "species": ["no3", "ec", "bc"]})
    assert grid.count() == 6
    done = spark.createDataFrame([("P9", "ec")], "region STRING, species STRING")
    left = tasks.preferred_first(tasks.pending(grid, done, ["region", "species"]), "species", "ec")
    assert [r.species for r in left.collect()] == ["ec", "bc", "bc", "no3", "no3"]
