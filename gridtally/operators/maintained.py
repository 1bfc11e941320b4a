"""Parent values that are kept up to date from the blocks that changed.

What is stored per parent are sums that can be added to and taken from: weighted
values, weights, and numbers of members and of known values.  A change is its old
rows with sign -1 and its new ones with +1; no other block is read again.  Sums
are fixed-point numbers, so that what is taken away leaves no rounding behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geoid import PARENT_LEVELS, area_prefix
from ..functions.nulls import first_present
from ..sources.writers import complete_versions, gathered, newest_version
from .aggregate import best_prediction, finest, roll_up

#: Fixed-point sums: 26 digits before and 12 after the point.
SUM_TYPE = "decimal(38,12)"
TERM_TYPE = "decimal(28,12)"
#: Stored columns: weighted value and weight, how many of each are known, blocks with a within value, blocks.
SUMS = ("weighted", "n_weighted", "weight", "n_weight", "n_within", "n")


def parent_sums(
    rows: DataFrame,
    levels: Sequence[str] = PARENT_LEVELS,
    by: Sequence[str] = ("region", "urban_rural", "species", "vintage"),
    sign: int = 1,
) -> DataFrame:
    """Sums per ``by, year, level, geoid`` of block rows with their ``population``.

    ``rows``: ``by, year, geoid, predicted_within, predicted_nearest, population``.
    """
    people = F.col("population")
    weighted = (best_prediction() * people).cast(TERM_TYPE)
    weight = people.cast(TERM_TYPE)
    one = F.lit(sign).cast("long")
    terms = {
        "weighted": weighted if sign > 0 else -weighted,
        "n_weighted": F.when(weighted.isNotNull(), one),
        "weight": weight if sign > 0 else -weight,
        "n_weight": F.when(weight.isNotNull(), one),
        "n_within": F.when(first_present(F.col("predicted_within")).isNotNull(), one),
        "n": one,
    }
    group = [*by, "year"]
    code = area_prefix(F.col("geoid"), finest(levels)).alias("geoid")
    sums = [F.coalesce(F.sum(t), F.lit(0)).alias(c) for c, t in terms.items()]
    partial = rows.groupBy(*group, code).agg(*sums)
    return _typed(roll_up(partial, levels, SUMS, group), by)


def _typed(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    kinds = {c: SUM_TYPE if c in ("weighted", "weight") else "long" for c in SUMS}
    return sums.select(*by, "year", "level", "geoid", *[F.col(c).cast(t).alias(c) for c, t in kinds.items()])


def change_sums(
    sums: DataFrame,
    before: DataFrame,
    after: DataFrame,
    levels: Sequence[str] = PARENT_LEVELS,
    by: Sequence[str] = ("region", "urban_rural", "species", "vintage"),
) -> DataFrame:
    """The sums after some blocks changed.

    ``before`` holds the rows of the changed blocks as they were counted, ``after`` as
    they are now: a new block is in ``after`` only, a deleted one in ``before`` only.
    Parents without any block left are dropped.  A parent that has less than nothing
    left of a count was given rows that had not been counted: an error.
    """
    group = [*by, "year", "level", "geoid"]
    deltas = parent_sums(before, levels, by, -1).unionByName(parent_sums(after, levels, by))
    total = sums.unionByName(deltas).groupBy(*group).agg(*[F.sum(c).alias(c) for c in SUMS])
    wrong = F.least(*[F.col(c) for c in SUMS if c.startswith("n")]) < 0
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("rows that were never counted below "), "geoid")))
    total = total.withColumn("n", F.coalesce(checked.cast("long"), "n"))
    return _typed(total.where("n <> 0"), by)


def parents_of_sums(
    sums: DataFrame, by: Sequence[str] = ("region", "urban_rural", "species", "vintage")
) -> DataFrame:
    """Parent values like ``aggregate_parents`` gives them."""
    known = (F.col("n_weighted") == F.col("n")) & (F.col("n_weight") == F.col("n"))
    return sums.select(
        *by,
        "level",
        "year",
        "geoid",
        F.when(known, F.try_divide(F.col("weighted").cast("double"), F.col("weight").cast("double"))).alias("predicted"),
        (F.col("n_within") / F.col("n")).alias("pct_pop_predicted"),
    )


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of stored sums."""
    return spark.read.parquet(newest_version(spark, path))


def write_sums(sums: DataFrame, path: str) -> DataFrame:
    """Store the sums as the next version; the one before stays readable for who reads it.

    A write that breaks off leaves no complete version and is replaced by the next.
    """
    spark = sums.sparkSession
    number = max(complete_versions(spark, path), default=0) + 1
    gathered(sums, ["level"]).write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={number}")
    return read_sums(spark, path)
