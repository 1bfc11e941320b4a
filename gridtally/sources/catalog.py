"""The file catalogue: what a prediction file is about, from its path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import file_attributes


def list_files(
    spark: SparkSession, path: str, name_glob: str = "*.rds", folders: Sequence[str] = ()
) -> DataFrame:
    """Paths of the files below a folder; their contents are not read.

    With ``folders``, the values that ``name=value`` folders give these columns,
    one row per file, instead of the paths.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", name_glob)
    if folders:
        return reader.load(path).select(*[F.col(c).cast("string").alias(c) for c in folders])
    return reader.option("recursiveFileLookup", "true").load(path).select("path")


def file_catalog(paths: DataFrame, extension: str = "rds") -> DataFrame:
    """``path, year, region, part_number, species``; NULL where a name has none."""
    return paths.select("path", *[
        v.alias(k) for k, v in file_attributes(F.col("path"), extension).items()
    ])


def in_order(catalog: DataFrame) -> DataFrame:
    """The catalogue sorted by path."""
    return catalog.orderBy("path")
