"""Yearly counts of prediction files as they arrive.

A file is read once: the stream's checkpoint knows the files that were counted, its
state holds one number per group and year.  Each call counts what has come since
the last one and ends; a call that finds nothing new reads nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import file_attributes
from ..operators.quality import PANEL_GROUP, yearly_counts
from ..sources.writers import newest_version


def arriving_predictions(
    spark: SparkSession,
    path: str,
    urban_rural: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of ``region, urban_rural, species, year`` of the rows in prediction files.

    Region and species come from the file names, and of the files only the year is
    read.  ``files_per_batch`` bounds what one batch reads.
    """
    reader = spark.readStream.schema("year INT").option("recursiveFileLookup", "true")
    if fmt == "csv":
        # columns of text files are found by their place, so that the whole header is needed
        raise ValueError("arriving files need a format with named columns")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.option("pathGlobFilter", f"*.{fmt}*").format(fmt).load(path)
    at = file_attributes(F.col("_metadata.file_path"), fmt)
    return rows.select(
        at["region"].alias("region"), F.lit(urban_rural).alias("urban_rural"), at["species"].alias("species"), "year"
    )


def arriving_panel(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same of a panel in folders ``region=, urban_rural=, species=``."""
    reader = spark.readStream.schema("year INT, region STRING, urban_rural STRING, species STRING")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(*PANEL_GROUP, "year")


def count_arrivals(stream: DataFrame, out: str, by: Sequence[str] = PANEL_GROUP) -> int:
    """Add the rows of all files that have arrived to the counts below ``out``; returns how many rows were read.

    Every batch writes the counts of all groups as a version of its own, named by the
    batch: one that is done again after a failure writes the same version again.  The
    table has a row per group and year.  Rows without a year are not counted.
    """
    out = out.rstrip("/")
    columns = [*by, "year", "n"]

    def keep(counts: DataFrame, batch: int) -> None:
        counts.select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/version={batch}")

    query = (
        yearly_counts(stream, by)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def arrived_counts(spark: SparkSession, out: str) -> DataFrame:
    """The counts so far: ``by, year, n``."""
    return spark.read.parquet(newest_version(spark, f"{out.rstrip('/')}/counts"))
