"""Hand-worked fixture: four blocks, four grid cells, two years."""

import math

import pytest
from pyspark.sql import functions as F

from gridtally.functions import geometry as G
from gridtally.operators.aggregate import aggregate_blocks, aggregate_parents
from gridtally.operators.classify import classify_blocks, classify_parents
from gridtally.operators.distribute import distribute
from gridtally.operators.nearest import nearest_points
from gridtally.operators.regions import polygon_centroids
from gridtally.operators.within import points_within

A, B, C, D = "090010001001000", "090010001001001", "090010001002000", "090010002001000"
BY = ["region", "urban_rural"]


def rectangle(x1, y1, x2, y2):
    return f"POLYGON (({x1} {y1}, {x2} {y1}, {x2} {y2}, {x1} {y2}, {x1} {y1}))"


@pytest.fixture(scope="module")
def data(spark):
    grid = spark.createDataFrame(
        [("NE1", "urban", 1, 0.5, 0.5), ("NE1", "urban", 2, 1.5, 0.5),
         ("NE1", "urban", 3, 0.5, 1.5), ("NE1", "urban", 4, 1.5, 1.5)],
        "region STRING, urban_rural STRING, gridcell_idx BIGINT, lon DOUBLE, lat DOUBLE",
    )
    values = {2000: [1.0, 2.0, 3.0, 4.0], 2001: [10.0, 20.0, 30.0, None]}
    panel = spark.createDataFrame(
        [("NE1", "urban", "ec", y, i + 1, grid_lon, grid_lat, v)
         for y, vs in values.items()
         for i, (v, (grid_lon, grid_lat)) in enumerate(
             zip(vs, [(0.5, 0.5), (1.5, 0.5), (0.5, 1.5), (1.5, 1.5)]))],
        "region STRING, urban_rural STRING, species STRING, year INT, gridcell_idx BIGINT,"
        " lon DOUBLE, lat DOUBLE, predicted DOUBLE",
    )
    blocks = spark.createDataFrame(
        [(A, rectangle(0, 0, 2, 1), 100), (B, rectangle(0, 1, 2, 2), 300),
         (C, rectangle(3, 0, 4, 1), 0), (D, rectangle(1.5, 0, 2.5, 1), 50)],
        "geoid STRING, wkt STRING, population BIGINT",
    ).select(
        F.lit(2000).alias("vintage"), "geoid", "population", F.lit("NE1").alias("region"),
        F.lit("urban").alias("urban_rural"), G.rings_from_wkt(F.col("wkt")).alias("rings"),
    )
    within = points_within(grid, blocks, by=BY, polygon_id=["vintage", "geoid"])
    centres = polygon_centroids(blocks.select(*BY, "vintage", "geoid", "rings"))
    nearest = nearest_points(centres, grid, by=BY, query_id=["vintage", "geoid"])
    urban_area = spark.createDataFrame([("1", rectangle(0, 0, 2, 2))], "uace STRING, wkt STRING")
    urban_area = urban_area.select("uace", G.rings_from_wkt(F.col("wkt")).alias("rings"))
    urban = points_within(
        centres, urban_area, by=[], x="cx", y="cy",
        point_id=["vintage", "geoid"], polygon_id=["uace"],
    )
    predicted = blocks.where(F.col("geoid").isin(A, B, D))
    classes = classify_blocks(blocks, urban, predicted, blocks)
    values = aggregate_blocks(panel, within, nearest)
    parents = aggregate_parents(values, classes)
    return locals()


def test_centroids(data):
    got = {r.geoid: (r.cx, r.cy) for r in data["centres"].collect()}
    assert got == {A: (1.0, 0.5), B: (1.0, 1.5), C: (3.5, 0.5), D: (2.0, 0.5)}


def test_within_leaves_out_the_boundary(data):
    got = sorted((r.gridcell_idx, r.geoid) for r in data["within"].collect())
    assert got == [(1, A), (2, A), (3, B), (4, B)]


def test_nearest_takes_smallest_index_of_ties(data):
    got = {r.geoid: (r.gridcell_idx, r.distance) for r in data["nearest"].collect()}
    assert got == {A: (1, 0.5), B: (3, 0.5), C: (2, 2.0), D: (2, 0.5)}


EXPECTED_VALUES = {
    (2000, A): (1.5, 2, 1.0, 0.5), (2000, B): (3.5, 2, 3.0, 0.5),
    (2000, C): (None, None, 2.0, 2.0), (2000, D): (None, None, 2.0, 0.5),
    (2001, A): (15.0, 2, 10.0, 0.5), (2001, B): (None, 2, 30.0, 0.5),
    (2001, C): (None, None, 20.0, 2.0), (2001, D): (None, None, 20.0, 0.5),
}


def _values(df):
    return {
        (r.year, r.geoid): (
            r.predicted_within, r.n_gridcells_within, r.predicted_nearest, r.distance_nearest)
        for r in df.collect()
    }


def test_block_values(data):
    assert _values(data["values"]) == EXPECTED_VALUES


def test_block_values_by_coordinates(data):
    panel = data["panel"].drop("gridcell_idx")
    got = aggregate_blocks(panel, data["within"], data["nearest"], grid=data["grid"])
    assert _values(got) == EXPECTED_VALUES


def test_parent_values(data):
    got = {(r.level, r.geoid, r.year): (r.predicted, r.pct_pop_predicted)
           for r in data["parents"].collect()}
    third = 1 / 3
    expected = {
        ("block_groups", "090010001001"): [(3.0, 1.0), (26.25, 0.5)],
        ("block_groups", "090010001002"): [(None, 0.0), (None, 0.0)],
        ("block_groups", "090010002001"): [(2.0, 0.0), (20.0, 0.0)],
        ("tracts", "09001000100"): [(3.0, 2 * third), (26.25, third)],
        ("tracts", "09001000200"): [(2.0, 0.0), (20.0, 0.0)],
        ("counties", "09001"): [(1300 / 450, 0.5), (11500 / 450, 0.25)],
    }
    assert len(got) == 12
    for (level, geoid), rows in expected.items():
        for year, (value, share) in zip((2000, 2001), rows):
            v, s = got[(level, geoid, year)]
            assert (v is None) == (value is None)
            assert value is None or math.isclose(v, value)
            assert math.isclose(s, share)


def test_block_classes(data):
    got = {r.geoid: (r.urban, r.fully_predicted, r.population) for r in data["classes"].collect()}
    assert got == {A: (1, 1, 100), B: (1, 1, 300), C: (0, 0, 0), D: (0, 1, 50)}


def test_parent_classes(data):
    got = {
        r.geoid: (r.population, r.population_urban, r.pct_population_urban,
                  r.fully_predicted, r.urban)
        for r in classify_parents(data["classes"]).collect()
    }
    assert got == {
        "090010001001": (400, 400, 1.0, 1, 1),
        "090010001002": (0, 0, None, 0, None),
        "090010002001": (50, 0, 0.0, 1, 0),
        "09001000100": (400, 400, 1.0, 0, 1),
        "09001000200": (50, 0, 0.0, 1, 0),
        "09001": (450, 400, 400 / 450, 0, 1),
    }


def test_distribution(data):
    blocks = distribute(data["values"], data["classes"], urban_only=True)
    got = sorted((r.geoid, r.year, r.predicted) for r in blocks.collect())
    assert got == [(A, 2000, 1.5), (A, 2001, 15.0), (B, 2000, 3.5), (B, 2001, 30.0)]
    parents = distribute(
        data["parents"], classify_parents(data["classes"]), True, area=["vintage", "level", "geoid"])
    got = {(r.geoid, r.year): r.predicted for r in parents.collect()}
    assert got == {
        ("090010001001", 2000): 3.0, ("090010001001", 2001): 26.25,
        ("09001000100", 2000): 3.0, ("09001000100", 2001): 26.25,
        ("09001", 2000): pytest.approx(1300 / 450), ("09001", 2001): pytest.approx(11500 / 450),
    }
    everything = distribute(data["values"], data["classes"], urban_only=False)
    assert everything.count() == 8
    labelled = distribute(data["values"], data["classes"], False, with_classification=["urban"])
    assert {r.urban for r in labelled.where(F.col("geoid") == C).collect()} == {0}


def test_exactly_three_quarters_is_not_urban(spark):
    rows = spark.createDataFrame(
        [("090010001001000", 1, 1, 75), ("090010001001001", 0, 1, 25)],
        "geoid STRING, urban INT, fully_predicted INT, population BIGINT")
    assert classify_parents(rows, ["counties"], by=()).first().urban == 0
    assert classify_parents(rows, ["counties"], by=(), inclusive=True).first().urban == 1


def test_missing_population_poisons_the_parents(data, spark):
    classes = data["classes"].withColumn(
        "population", F.when(F.col("geoid") != A, F.col("population")))
    parents = aggregate_parents(data["values"], classes, ["counties", "tracts"])
    got = {(r.geoid, r.year): r.predicted for r in parents.collect()}
    assert got[("09001", 2000)] is None and got[("09001000200", 2000)] == 2.0
    top = classify_parents(classes, ["counties"]).first()
    assert (top.population, top.population_urban, top.urban) == (None, None, None)


def test_missing_flag_is_unknown_unless_another_is_zero(spark):
    rows = spark.createDataFrame(
        [("09001" + "0" * 10, 1, None, 1), ("09001" + "1" * 10, 1, 1, 1),
         ("09003" + "0" * 10, 1, None, 1), ("09003" + "1" * 10, 1, 0, 1)],
        "geoid STRING, urban INT, fully_predicted INT, population BIGINT")
    got = {r.geoid: r.fully_predicted for r in classify_parents(rows, ["counties"], by=()).collect()}
    assert got == {"09001": None, "09003": 0}


def test_crosswalk_rows_without_prediction_stay(data):
    panel = data["panel"].where("gridcell_idx <> 2")
    got = {(r.year, r.geoid): (r.predicted_within, r.n_gridcells_within, r.predicted_nearest)
           for r in aggregate_blocks(panel, data["within"], data["nearest"]).collect()}
    assert got[(None, C)] == (None, None, None)
    assert got[(2000, A)] == (1.0, 1, 1.0)


def test_null_year_meets_null_year(data, spark):
    panel = data["panel"].where("gridcell_idx > 2")  # nothing for block A at all
    got = {(r.year, r.geoid): (r.predicted_within, r.n_gridcells_within)
           for r in aggregate_blocks(panel, data["within"], data["nearest"]).collect()}
    assert got[(None, A)] == (None, 2)


def test_repeated_nearest_rows_are_all_kept(data):
    twice = data["nearest"].unionByName(data["nearest"])
    got = aggregate_blocks(data["panel"], data["within"], twice)
    assert got.count() == 16


def test_hole_and_overlap(spark):
    shapes = spark.createDataFrame(
        [("ring", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"),
         ("over", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
         ("two", "MULTIPOLYGON (((5 0, 6 0, 6 1, 5 1, 5 0)), ((7 0, 8 0, 8 1, 7 1, 7 0)))")],
        "geoid STRING, wkt STRING",
    ).select("geoid", G.rings_from_wkt(F.col("wkt")).alias("rings"))
    points = spark.createDataFrame(
        [(1, 2.0, 2.0), (2, 0.5, 0.5), (3, 7.5, 0.5), (4, 1.0, 2.0), (5, 6.5, 0.5)],
        "gridcell_idx BIGINT, lon DOUBLE, lat DOUBLE")
    got = sorted((r.gridcell_idx, r.geoid) for r in
                 points_within(points, shapes, by=()).collect())
    assert got == [(2, "over"), (2, "ring"), (3, "two")]
    left = points_within(points, shapes, by=(), keep="left")
    assert {r.gridcell_idx for r in left.where("geoid IS NULL").collect()} == {1, 4, 5}
    centre = {r.geoid: (r.cx, r.cy) for r in polygon_centroids(shapes).collect()}
    assert centre == {"ring": (2.0, 2.0), "over": (0.5, 0.5), "two": (6.5, 0.5)}
