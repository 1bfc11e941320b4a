"""Readers with explicit schemas: area codes are text and keep their zeroes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.geoid import code_column, pad_code
from ..functions.names import file_attributes
from ..functions.nulls import nan_to_null
from ..functions.wkb import with_rings_of_wkb
from ..operators.regions import polygon_centroids

VALUE_PREFIX = "final.predicted."  # fixed value


def union_all(tables: Iterable[DataFrame]) -> DataFrame:
    """All rows by column name; a column that a table lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_predictions(
    spark: SparkSession,
    path: str,
    species: Sequence[str],
    urban_rural: str | None = None,
    fmt: str = "parquet",
    coordinates: bool = True,
) -> DataFrame:
    """Prediction files of several species as one panel.

    Each species has its own value column; the file names give region, part and
    species.  One scan per species reads all of its files; region and species
    filters of the caller prune columns and rows as usual.
    """
    places = ["lon", "lat"] if coordinates else []

    def one(name: str) -> DataFrame:
        reader = spark.read.option("recursiveFileLookup", "true")
        reader = reader.option("pathGlobFilter", f"{{*.,}}{name}{{.part*,}}.{fmt}*")
        if fmt == "csv":
            reader = reader.option("header", True).option("nullValue", "NA").schema(
                f"year INT, lon DOUBLE, lat DOUBLE, `{VALUE_PREFIX}{name}` DOUBLE"
            )
        data = reader.format(fmt).load(path)
        at = file_attributes(F.col("_metadata.file_path"), fmt)
        return data.select(
            at["region"].alias("region"),
            at["part_number"].alias("part_number"),
            at["species"].alias("species"),
            F.col("year").cast("int").alias("year"),
            *places,
            F.col(f"`{VALUE_PREFIX}{name}`").cast("double").alias("predicted"),
        ).where(F.col("species") == name)

    panel = nan_to_null(union_all(one(s) for s in species))
    return panel if urban_rural is None else panel.withColumn("urban_rural", F.lit(urban_rural))


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """A panel in folders ``region=, urban_rural=, species=``, values in ``predicted``.

    Filters on these columns read only their folders.
    """
    columns = "year INT, lon DOUBLE, lat DOUBLE, predicted DOUBLE, part_number STRING"
    folders = "region STRING, urban_rural STRING, species STRING"
    return nan_to_null(spark.read.schema(f"{columns}, {folders}").parquet(path))


def read_polygons(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    fmt: str = "geojson",
    geometry: str = "geometry",
    centroids_only: bool = False,
) -> DataFrame:
    """Polygons of all files matching ``path`` with the chosen attributes.

    ``columns`` maps attribute names of the files to column names of the
    result.  ``geojson`` expects a feature or a collection of features on each
    line, ``geojson_files`` one in each file, which a task reads whole;
    ``geojson_split`` cuts collections of any size between their features while
    reading.  Lines without a feature are left out, see :func:`rejected_lines`.
    ``wkt`` is a CSV file with header, ``parquet`` has ``rings``, WKT text or WKB.
    """
    if fmt.startswith("geojson"):
        features = _features(spark, path, list(columns), fmt).where("f.geometry IS NOT NULL")
        rings = G.rings_from_geojson(F.col("f.geometry"))
        attributes = [F.col(f"f.properties.`{c}`").alias(n) for c, n in columns.items()]
        out = features.select(*attributes, rings.alias("rings"))
    else:
        if fmt == "wkt":
            # all columns as text: area codes keep their zeroes
            rows = spark.read.option("header", True).csv(path)
        else:
            rows = spark.read.parquet(path)
        kind = dict(rows.dtypes)[geometry]
        if kind == "binary":
            rows = with_rings_of_wkb(rows, geometry, "_rings")
            geometry = "_rings"
        rings = G.rings_from_wkt(F.col(geometry)) if kind == "string" else F.col(geometry)
        out = rows.select(
            *[F.col(f"`{c}`").alias(n) for c, n in columns.items()], rings.alias("rings")
        )
    return polygon_centroids(out) if centroids_only else out


def _features(
    spark: SparkSession, path: str, attributes: Sequence[str], fmt: str = "geojson"
) -> DataFrame:
    """One row ``f`` per feature; a line without any has one NULL."""
    fields = ", ".join(f"`{c}`: STRING" for c in attributes) or "`_`: STRING"
    feature = f"STRUCT<properties: STRUCT<{fields}>, geometry: STRING>"
    if fmt == "geojson_split":
        lines = _feature_texts(spark, path)
    else:
        lines = spark.read.text(path, wholetext=fmt == "geojson_files").where(F.trim("value") != "")
    shape = f"type STRING, properties STRUCT<{fields}>, geometry STRING, features ARRAY<{feature}>"
    parsed = lines.select(F.from_json("value", shape).alias("j"))
    own = F.array(F.struct("j.properties", "j.geometry"))
    return parsed.select(F.explode_outer(F.coalesce("j.features", own)).alias("f"))


#: How a feature begins: its type comes first.
_FEATURE_START = r'\{\s*"type"\s*:\s*"Feature"'


def _feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per feature of collections, or of lines, of any size.

    The files are cut where features begin, spelled as in the first one found, so that
    a file is read by many tasks.  Features spelled with other white space are cut
    within the row.  What follows a feature in its row is not part of it.  A feature
    whose type is not its first member cannot be cut out: an error.
    """
    opening = F.regexp_extract("value", r'(\{\s*"type"\s*:\s*)$', 1).alias("opening")
    pieces = spark.read.option("lineSep", '"Feature"').text(path)
    first = pieces.select(opening).where("opening <> ''").limit(1).collect()
    if not first and pieces.count() > 1:
        raise ValueError("features must begin with their type")
    start = f'{first[0].opening if first else ""}"Feature"'
    cut = spark.read.option("lineSep", start).text(path)
    cut = cut.select(F.explode(F.split("value", _FEATURE_START)).alias("value"))
    # the rest of a feature goes on with a comma or a brace; all else comes before the first one
    cut = cut.where(F.col("value").rlike(r"^\s*[,}]"))
    later = F.col("value").rlike(r'"type"\s*:\s*"Feature"')
    text = F.concat(F.lit('{"type":"Feature"'), "value")
    error = F.raise_error(F.lit("a feature does not begin with its type"))
    return cut.select(F.when(later, error.cast("string")).otherwise(text).alias("value"))


def rejected_lines(spark: SparkSession, path: str, fmt: str = "geojson") -> int:
    """Number of lines and features without a geometry, which ``read_polygons`` leaves out."""
    return _features(spark, path, [], fmt).where("f.geometry IS NULL").count()


def read_blocks(
    spark: SparkSession, paths: dict[int, str], fmt: str = "geojson", **options
) -> DataFrame:
    """Block polygons of several vintages in one table."""
    return union_all(
        read_polygons(spark, p, {code_column(v): "geoid"}, fmt, **options).withColumn(
            "vintage", F.lit(int(v))
        )
        for v, p in paths.items()
    )


def whole_number(text: Column) -> Column:
    """A number written as ``12``, ``12.0`` or ``1e3``; NULL if it is no whole number."""
    value = text.try_cast("double")
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(2.0**53))
    return F.coalesce(text.try_cast("bigint"), F.when(whole, value.cast("bigint")))


def read_population(spark: SparkSession, path: str, vintage: int | None = None) -> DataFrame:
    """Block populations; codes that were written as numbers are padded."""
    rows = spark.read.option("header", True).option("nullValue", "NA").csv(path)
    out = rows.select(
        pad_code(F.col("GEOID")).alias("geoid"),
        whole_number(F.col("population")).alias("population"),
    )
    return out if vintage is None else out.withColumn("vintage", F.lit(int(vintage)))


def read_table(
    spark: SparkSession,
    path: str,
    schema: str,
    null_value: str = "NA",
    code: str | None = None,
) -> DataFrame:
    """CSV with header and a declared schema; ``code`` is renamed to ``geoid``."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", null_value)
        .csv(path)
    )
    rows = nan_to_null(rows)
    return rows.withColumnRenamed(code, "geoid") if code else rows


def read_layer(spark: SparkSession, folder: str, layer: str) -> DataFrame:
    """A named layer written by ``write_layer``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{layer}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Diagnostics of all groups; the groups are partition folders."""
    # the group values come from the folder names and are text
    return (
        spark.read.schema(
            "year INT, n BIGINT, region STRING, urban_rural STRING, species STRING"
        )
        .option("header", True)
        .option("sep", " ")
        .csv(path)
    )
