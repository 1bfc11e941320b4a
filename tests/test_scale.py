"""What grows with the data is not broadcast, held by one task or made twice."""

import pytest
from pyspark.sql import functions as F

from gridtally.functions import geometry as G
from gridtally.operators import numbering
from gridtally.operators.aggregate import aggregate_parents, summarise_links
from gridtally.operators.classify import classify_blocks
from gridtally.operators.distribute import distribute
from gridtally.operators.repair import polygon_repair
from gridtally.operators.skew import spread_join
from gridtally.plans import views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_panel_made_from_a_small_file_is_not_broadcast(spark, tmp_path):
    spark.range(500).write.parquet(f"{tmp_path}/cells")
    cells = spark.read.parquet(f"{tmp_path}/cells")
    panel = cells.selectExpr("id AS cell", "explode(sequence(1, 40)) AS year")
    links = cells.selectExpr("id * 2 AS cell", "id AS block")
    joined = spread_join(links, panel, ["cell"], ["block"], how="left")
    assert "SortMergeJoin" in plan(joined)
    assert joined.count() == 250 * 40 + 250


@pytest.mark.parametrize("step", ["parents", "distribute", "classify"])
def test_tables_of_all_blocks_are_not_broadcast(spark, tmp_path, step):
    spark.range(300).selectExpr(
        "lpad(CAST(id AS STRING), 15, '0') AS geoid", "id AS population", "CAST(id % 2 AS INT) AS urban"
    ).write.parquet(f"{tmp_path}/blocks")
    blocks = spark.read.parquet(f"{tmp_path}/blocks")
    values = blocks.selectExpr("geoid", "2000 AS year", "1D AS predicted_within", "2D AS predicted_nearest")
    if step == "parents":
        out = aggregate_parents(values, blocks, ["counties"], by=(), block=["geoid"])
    elif step == "distribute":
        out = distribute(values, blocks, True, area=["geoid"])
    else:
        out = classify_blocks(blocks, values.limit(0), values.limit(0), blocks, block=["geoid"])
    assert "SortMergeJoin" in plan(out)
    assert out.count() == {"parents": 1, "distribute": 150, "classify": 300}[step]


def test_links_are_summed_without_lists(spark):
    rows = [
        ("a", 2000, False, 1.0, None), ("a", 2000, False, 2.0, None), ("a", 2000, True, 5.0, 0.5),
        ("a", 2000, True, 5.0, 0.5), ("a", 2000, True, None, 0.5), ("b", None, True, None, 0.1),
        ("b", None, False, None, None), ("c", 2000, False, 3.0, None), ("d", 2001, True, 7.0, 0.2),
    ]
    found = spark.createDataFrame(rows, "geoid string, year int, _near boolean, predicted double, distance double")
    out = summarise_links(found, ["geoid", "year"])
    assert "collect_list" not in plan(out)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [
            ("a", 2000, 1.5, 2, 5.0, 0.5), ("a", 2000, 1.5, 2, 5.0, 0.5), ("a", 2000, 1.5, 2, None, 0.5),
            ("b", None, None, 1, None, 0.1), ("d", 2001, None, None, 7.0, 0.2),
        ],
        key=repr,
    )


def test_ranges_follow_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 50)
    ranges = []

    def staged(df, name):
        ranges.append(df.select("_range").distinct().count())
        return df.localCheckpoint()

    monkeypatch.setattr(numbering, "stage", staged)
    rows = spark.range(1000).selectExpr("id % 2 AS g", "id div 4 AS v")
    out = numbering.number_rows(rows, ["g"], ["v"], "n")
    assert ranges[0] > 10
    want = sorted((i % 2, i // 4) for i in range(1000))
    assert sorted((r.g, r.n, r.v) for r in out.collect()) == [
        (g, 1 + k % 500, v) for k, (g, v) in enumerate(want)
    ]


def test_mended_polygons_are_traced_once(spark):
    at = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    ring = F.array(*[G.point(F.lit(x), F.lit(y)) for x, y in at])
    mended = polygon_repair(spark.range(1).withColumn("rings", F.array(ring)))
    assert "MapInArrow" not in plan(mended)
    assert len(mended.first()["rings"]) == 2


def test_tables_in_one_small_file_are_dealt_out(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("id AS c_custkey", "1D AS c_acctbal")
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert views.blocks(spark, str(tmp_path)).rdd.getNumPartitions() == 3
