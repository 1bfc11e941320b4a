"""The given tables read as blocks, grid, panel and file names.

The tables have no geometry, so every view is computed from keys and amounts of
whole tables.  All coordinates are binary fractions and thus exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a table from which one task makes geometry or a panel.
ROWS_PER_TASK = 20_000


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table whose rows each make much more than was read, dealt to tasks by number.

    A compressed file of a few MB is read by one task, whatever its rows grow into.
    """
    rows = table(spark, folder, name)
    tasks = -(-rows.count() // ROWS_PER_TASK)
    return rows.repartition(tasks) if tasks > 1 else rows


def _diamond(x, y, hx, hy):
    return F.array(G.ring((x + hx, y), (x, y + hy), (x - hx, y), (x, y - hy)))


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """One diamond-shaped block per customer."""
    rows = spread_table(spark, folder, "customer").selectExpr(
        "c_custkey AS q",
        """concat(lpad(CAST(c_custkey % 56 + 1 AS STRING), 2, '0'),
                  lpad(CAST((c_custkey div 56) % 2 + 1 AS STRING), 3, '0'),
                  lpad(CAST(c_custkey div 1120 AS STRING), 6, '0'),
                  CAST((c_custkey div 112) % 2 + 1 AS STRING),
                  lpad(CAST((c_custkey div 224) % 5 AS STRING), 3, '0')) AS geoid""",
        """CASE WHEN c_custkey % 97 = 13 THEN NULL WHEN c_acctbal < 0 THEN 0
                ELSE CAST(floor(c_acctbal / 10) AS BIGINT) END AS population""",
        "-125.0D + ((c_custkey * 37) % 6400) / 128.0D AS x",
        "25.0D + ((c_custkey * 53) % 384) / 128.0D AS y",
        "0.5D * pow(2.0D, c_custkey % 3) AS hx",
        "0.125D * pow(2.0D, c_custkey % 3) AS hy",
    )
    ring = _diamond(F.col("x"), F.col("y"), F.col("hx"), F.col("hy"))
    return rows.withColumn("rings", ring)


def block_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Flags and population of the blocks."""
    return blocks(spark, folder).select(
        "geoid",
        F.expr("CASE WHEN q % 4 = 0 THEN 0 ELSE 1 END").alias("urban"),
        F.expr("CASE WHEN q % 11 = 3 THEN 0 ELSE 1 END").alias("fully_predicted"),
        "population",
    )


def urban_areas(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "nation").selectExpr(
        "lpad(CAST(n_nationkey AS STRING), 5, '0') AS uace",
        "n_name AS name",
        "-125.0D + 2 * n_nationkey AS x",
        "25.0D + (n_nationkey % 6) / 2.0D AS y",
    )
    ring = _diamond(F.col("x"), F.col("y"), F.lit(2.0), F.lit(1.0))
    return rows.select("uace", "name", ring.alias("rings"))


def grid(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey + 1 AS gridcell_idx",
        "-125.0D + p_partkey % 50 AS lon",
        "25.0D + (p_partkey div 50) / 16.0D AS lat",
    )


def regional_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The grid points with their region and kind."""
    return (
        predictions(spark, folder)
        .where("year = 2000 AND species = 'ec'")
        .select("region", "urban_rural", "gridcell_idx", "lon", "lat")
    )


def polygon_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks as text: diamonds, diamonds with a hole, and pairs of diamonds."""

    def ring(x: str, scale: str, between: str, left: str, right: str) -> str:
        corners = [
            (f"{x} + hx * {scale}", "y"), (x, f"y + hy * {scale}"),
            (f"{x} - hx * {scale}", "y"), (x, f"y - hy * {scale}"),
        ]
        points = [
            f"'{left}', CAST({a} AS STRING), '{between}', CAST({b} AS STRING), '{right}'"
            for a, b in [*corners, corners[0]]
        ]
        return "concat(" + ", ', ', ".join(points) + ")"

    def texts(opening: str, closing: str, between: str, left: str, right: str) -> list[str]:
        one, hole, far = (
            f"concat('{opening}', {ring(x, scale, between, left, right)}, '{closing}')"
            for x, scale in (("x", "1"), ("x", "0.5D"), ("(x + 4 * hx)", "1"))
        )
        return [one, f"concat({one}, ' , ', {hole})", one, far]

    w, j = texts("(", ")", " ", "", ""), texts("[", "]", ",", "[", "]")
    return blocks(spark, folder).selectExpr(
        "geoid",
        f"""CASE q % 3 WHEN 0 THEN concat('POLYGON (', {w[0]}, ')')
              WHEN 1 THEN concat('POLYGON(', {w[1]}, ')')
              ELSE concat('MULTIPOLYGON ((', {w[2]}, '), (', {w[3]}, '))') END AS wkt""",
        f"""CASE q % 3 WHEN 0 THEN concat('{{"type":"Polygon","coordinates":[', {j[0]}, ']}}')
              WHEN 1 THEN concat('{{"type":"Polygon","coordinates":[', {j[1]}, ']}}')
              ELSE concat('{{"type":"MultiPolygon","coordinates":[[', {j[2]}, '],[', {j[3]}, ']]}}')
            END AS geojson""",
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Two species in five years on every grid point."""
    cells = spread_table(spark, folder, "part").selectExpr(
        "p_partkey AS p",
        "CASE WHEN p_partkey % 50 < 17 THEN 'NE1' WHEN p_partkey % 50 < 34 THEN 'MA2' "
        "ELSE 'P9' END AS region",
        "CASE WHEN (p_partkey div 50) % 2 = 0 THEN 'rural' ELSE 'urban' END AS urban_rural",
        "CAST((p_partkey div 500) % 3 + 1 AS STRING) AS part_number",
        "p_partkey + 1 AS gridcell_idx",
        "-125.0D + p_partkey % 50 AS lon",
        "25.0D + (p_partkey div 50) / 16.0D AS lat",
    )
    years = cells.selectExpr("*", "explode(array(2000, 2001, 2002, 2003, 2004)) AS year")
    each = years.selectExpr("*", "explode(array('ec', 'no3')) AS species")
    return each.selectExpr(
        "region", "urban_rural", "part_number", "gridcell_idx", "lon", "lat", "year", "species",
        """CASE WHEN p % 211 = 5 THEN NULL
                ELSE ((p * 7 + (year - 2000) * 13 + CASE species WHEN 'ec' THEN 0 ELSE 5 END) % 101)
                     / 4.0D END AS predicted""",
    )


def panel_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_returnflag AS region",
        "l_linestatus AS urban_rural",
        "'all' AS species",
        "year(l_shipdate) AS year",
    )


def order_files(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderstatus AS region", "o_orderpriority AS species", "year(o_orderdate) AS year"
    )


def paths(spark: SparkSession, folder: str) -> DataFrame:
    """File names, some without a year or a part number."""
    return table(spark, folder, "part").selectExpr(
        """concat('/d/', p_partkey, '/',
                  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat(2000 + p_partkey % 5, '.') END,
                  element_at(array('NE1', 'MA2', 'NEC3', 'WNC4', 'SA5', 'ESC6', 'WSC7', 'M8', 'P9'),
                             CAST(p_partkey % 9 + 1 AS INT)),
                  '.',
                  element_at(array('ec', 'no3', 'so4'), CAST((p_partkey div 9) % 3 + 1 AS INT)),
                  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat('.part', p_partkey % 12) END,
                  '.rds') AS path"""
    )
