"""The whole run from files, on the hand-worked fixture in real coordinates."""

import gzip
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gridtally.plans.run import Inputs, run
from gridtally.sources import tasks
from gridtally.sources.catalog import list_files
from gridtally.sources.readers import read_predictions, union_all

A, B, C, D = "090010001001000", "090010001001001", "090010001002000", "090010002001000"


def feature(properties, x1, y1, x2, y2):
    # a tenth of a degree per unit, around 96 W 40 N
    ring = [[-96 + x / 10, 40 + y / 10] for x, y in
            ((x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1))]
    return json.dumps({"type": "Feature", "properties": properties,
                       "geometry": {"type": "Polygon", "coordinates": [ring]}}) + "\n"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    shapes = {A: (0, 0, 2, 1), B: (0, 1, 2, 2), C: (3, 0, 4, 1), D: (1.5, 0, 2.5, 1)}
    (root / "blocks.json").write_text(
        "".join(feature({"BLKIDFP00": g}, *box) for g, box in shapes.items()))
    (root / "urban.json").write_text(feature({"UACE10": "1", "NAME10": "x"}, 0, 0, 2, 2))
    people = {A: 100, B: 300, C: 0, D: 50}
    (root / "people.csv").write_text(
        "GEOID,population\n" + "".join(f"{int(g)},{n}\n" for g, n in people.items()))
    cells = [(0.5, 0.5), (1.5, 0.5), (0.5, 1.5), (1.5, 1.5)]
    for kind in ("urban", "rural"):
        for species, factor in (("ec", 1), ("no3", 2)):
            folder = root / kind
            folder.mkdir(exist_ok=True)
            lines = [f"year,lon,lat,final.predicted.{species}"]
            for i, (x, y) in enumerate(cells):
                for year, vs in ((2000, [1, 2, 3, 4]), (2001, [10, 20, 30, "NA"])):
                    v = vs[i] if vs[i] == "NA" else vs[i] * factor
                    lines.append(f"{year},{-96 + x / 10},{40 + y / 10},{v}")
            (folder / f"NE1.{species}.csv").write_text("\n".join(lines) + "\n")
    return root, Inputs(
        predictions={k: str(root / k) for k in ("urban", "rural")},
        blocks={2000: str(root / "blocks.json")},
        population={2000: str(root / "people.csv")},
        urban_areas=str(root / "urban.json"),
        species=["ec", "no3"],
        predictions_format="csv",
    )


def test_run_and_second_run(spark, inputs):
    root, given = inputs
    out = str(root / "out")
    tables = run(spark, given, out)
    assert tables["inconsistent"].count() == 0
    # grid numbers follow part, longitude, latitude here: 1 and 2 are the western cells
    assert tables["grid"].count() == 8
    classes = {r.geoid: (r.urban, r.fully_predicted, r.population)
               for r in tables["block_classes"].collect()}
    assert classes == {A: (1, 1, 100), B: (1, 1, 300), C: (0, 0, 0), D: (0, 0, 50)}
    within = tables["crosswalk_within"].where("urban_rural = 'urban'").groupBy("geoid").count()
    # floating-point borders: cell (1.5, 0.5) may fall in D or on its border
    assert {r.geoid: r["count"] for r in within.collect() if r.geoid != D} == {A: 2, B: 2}
    values = {(r.species, r.geoid, r.year): r.predicted_within
              for r in tables["block_values"].where("urban_rural = 'rural'").collect()}
    assert values[("ec", A, 2000)] == 1.5 and values[("no3", A, 2000)] == 3.0
    assert values[("ec", B, 2001)] is None and len(values) == 16
    county = tables["parent_values"].where("level = 'counties' AND species = 'ec'")
    assert {r.geoid for r in county.collect()} == {"09001"}
    made = tables["distribution"]
    assert {r.geoid for r in made.where("urban_rural = 'urban' AND level = 'blocks'").collect()} == {A, B}
    assert made.where("urban_rural = 'rural' AND level = 'blocks'").count() == 16
    assert {(r.region, r.n) for r in tables["coverage"].collect()} == {("NE1", 1)}
    stays = lambda p: "finished" not in str(p)
    files = sorted(p for p in (root / "out").rglob("*.parquet") if stays(p))
    stamps = [p.stat().st_mtime_ns for p in files]
    run(spark, replace(given, csv=True), out)
    assert sorted(p for p in (root / "out").rglob("*.parquet") if stays(p)) == files
    assert [p.stat().st_mtime_ns for p in files] == stamps
    named = list((root / "out" / "csv").rglob("*.csv.gz"))
    header = {p.relative_to(root / "out" / "csv").parts[:3]: gzip.open(p, "rt").readline() for p in named}
    assert "BLKIDFP00" in header["block_values", "2000", "blocks"]
    assert "CNTYIDFP00" in header["parent_values", "2000", "counties"]
    assert "CTIDFP00" in header["distribution", "2000", "tracts"]


def rows(df):
    return sorted(map(str, df.collect()))


def test_what_comes_later_is_completed(spark, inputs, tmp_path):
    root, given = inputs
    work = tmp_path / "in"
    for kind in ("urban", "rural"):
        (work / kind).mkdir(parents=True)
    for kind in ("urban", "rural"):
        (work / kind / "NE1.no3.csv").write_text((root / kind / "NE1.no3.csv").read_text())
    folders = {k: str(work / k) for k in ("urban", "rural")}
    early = replace(given, predictions=folders, species=["no3"])
    out = str(tmp_path / "out")
    run(spark, early, out)
    # a species, then a region, then a vintage
    late = replace(early, species=["ec", "no3"])
    for kind in ("urban", "rural"):
        (work / kind / "NE1.ec.csv").write_text((root / kind / "NE1.ec.csv").read_text())
    run(spark, late, out)
    for species in ("ec", "no3"):
        (work / "rural" / f"MA2.{species}.csv").write_text((root / "rural" / f"NE1.{species}.csv").read_text())
    moved = (root / "blocks.json").read_text().replace("BLKIDFP00", "GEOID10")
    (work / "blocks10.json").write_text(moved)
    late = replace(
        late,
        blocks={**given.blocks, 2010: str(work / "blocks10.json")},
        population={**given.population, 2010: given.population[2000]},
    )
    found = run(spark, late, out)
    fresh = run(spark, late, str(tmp_path / "fresh"))
    assert found["grid"].select("region").distinct().count() == 2
    assert set(found) == set(fresh)
    for name in found:
        assert rows(found[name].select(*sorted(found[name].columns))) == rows(
            fresh[name].select(*sorted(fresh[name].columns))
        ), name


def test_partitioned_panel_gives_the_same(spark, inputs, tmp_path):
    _, given = inputs
    panel = union_all(
        read_predictions(spark, path, given.species, kind, "csv") for kind, path in given.predictions.items()
    )
    panel.write.partitionBy("region", "urban_rural", "species").parquet(str(tmp_path / "panel"))
    found = run(spark, replace(given, panel=str(tmp_path / "panel")), str(tmp_path / "a"))
    wanted = run(spark, given, str(tmp_path / "b"))
    for name in wanted:
        assert rows(found[name]) == rows(wanted[name]), name


def test_restart_reads_only_what_is_open(spark, inputs, tmp_path):
    _, given = inputs
    panel = union_all(
        read_predictions(spark, path, given.species, kind, "csv") for kind, path in given.predictions.items()
    )
    more = panel.withColumn("region", F.lit("MA2"))
    panel.unionByName(more).write.partitionBy("region", "urban_rural", "species").parquet(str(tmp_path / "panel"))
    given = replace(given, panel=str(tmp_path / "panel"))
    out = str(tmp_path / "out")
    run(spark, replace(given, exclude_regions=["MA2"]), out)
    # the files of the finished region cannot be read any more
    broken = list((tmp_path / "panel" / "region=NE1").rglob("*.parquet"))
    for file in broken:
        file.write_bytes(b"broken")
    found = run(spark, given, out)
    assert broken and {r.region for r in found["grid"].select("region").distinct().collect()} == {"NE1", "MA2"}
    assert found["coverage"].count() == 8 and found["parent_values"].where("region = 'NE1'").count() == 48


def test_scan_of_the_panel_is_pruned_by_the_open_tasks(spark, inputs, tmp_path):
    rows = [(f"R{r}", s, y, r * 10.0 + y) for r in range(6) for s in ("ec", "no3") for y in range(3)]
    panel = spark.createDataFrame(rows, "region STRING, species STRING, year INT, predicted DOUBLE")
    panel.write.partitionBy("region", "species").parquet(str(tmp_path / "panel"))
    stored = spark.read.schema(panel.schema).parquet(str(tmp_path / "panel"))
    wanted = list_files(spark, str(tmp_path / "panel"), "*.parquet", ["region", "species"])
    wanted.where("region <> 'R4'").distinct().write.parquet(str(tmp_path / "out-finished"))
    todo = tasks.open_tasks(spark, wanted, str(tmp_path / "out"), ["region", "species"])
    chosen = tasks.restrict(stored, todo)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "year" in line)
    assert "dynamicpruning" in scan and "region" in scan.split("PartitionFilters")[1]
    for file in (tmp_path / "panel").rglob("*.parquet"):
        if "region=R4" not in str(file):
            file.write_bytes(b"broken")
    assert sorted((r.region, r.species, r.year) for r in chosen.collect()) == [
        ("R4", s, y) for s in ("ec", "no3") for y in range(3)]
    # the pruning alone, without the values as literals
    monkey = tasks.LITERAL_TASKS
    tasks.LITERAL_TASKS = 0
    try:
        assert tasks.restrict(stored, todo).count() == 6
    finally:
        tasks.LITERAL_TASKS = monkey


def test_files_are_skipped_by_name(spark, inputs, tmp_path):
    root, given = inputs
    for region in ("NE1", "MA2"):
        (tmp_path / f"{region}.ec.csv").write_text((root / "urban" / "NE1.ec.csv").read_text())
    panel = read_predictions(spark, str(tmp_path), ["ec"], "urban", "csv")
    todo = spark.createDataFrame([("MA2", "urban", "ec")], "region STRING, urban_rural STRING, species STRING")
    chosen = tasks.restrict(panel, todo)
    (tmp_path / "NE1.ec.csv").unlink()
    assert {r.region for r in chosen.collect()} == {"MA2"}


def test_tasks_of_several_types_and_without_names(spark):
    rows = [("a", 2000, 1), ("a", 2010, 2), (None, 2000, 3), (None, None, 4), ("b", 2000, 5)]
    df = spark.createDataFrame(rows, "region STRING, vintage INT, v INT")
    todo = spark.createDataFrame(
        [("a", "2010"), (None, "2000"), (None, None), ("c", "x")], "region STRING, vintage STRING")
    assert sorted(r.v for r in tasks.restrict(df, todo).collect()) == [2, 3, 4]
    assert sorted(r.v for r in tasks.restrict(df, todo.select("region")).collect()) == [1, 2, 3, 4]
    assert tasks.restrict(df, todo.select(F.col("region").alias("other"))) is df
