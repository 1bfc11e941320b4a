"""Checks of the inputs and of the results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geoid import in_regions, state_of
from ..functions.nulls import n_rows
from .grid import coordinate_key

PANEL_GROUP = ("region", "urban_rural", "species")


def yearly_counts(panel: DataFrame, by: Sequence[str] = PANEL_GROUP) -> DataFrame:
    """Number of rows per group and year; rows without a year are left out."""
    return panel.where(F.col("year").isNotNull()).groupBy(*by, "year").agg(n_rows().alias("n"))


def inconsistent_groups(counts: DataFrame, by: Sequence[str] = PANEL_GROUP) -> DataFrame:
    """Groups whose yearly counts differ."""
    return (
        counts.groupBy(*by)
        .agg(
            F.count_distinct("n").alias("distinct_counts"),
            F.min("n").alias("min_n"),
            F.max("n").alias("max_n"),
        )
        .where(F.col("distinct_counts") > 1)
    )


def frequency(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """One-way frequency table; missing values are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(n_rows().alias(out))


def coverage(catalog: DataFrame, keys: Sequence[str] = ("region", "year", "species")) -> DataFrame:
    """Contingency table over ``keys`` with a row for every combination.

    Rows with a missing key are left out.  Each value of the first key meets the
    domains of the others (years, species), which are short lists, and unfolds
    them: the combinations are made where the values of the first key are.
    """
    keys = list(keys)
    known = catalog.dropna(subset=keys)
    counts = known.groupBy(*keys).agg(n_rows().alias("n"))
    frame = counts.select(keys[0]).distinct().repartition(keys[0])
    for k in keys[1:]:
        frame = frame.withColumn(k, F.explode(counts.select(F.collect_set(k)).scalar()))
    return frame.join(counts, keys, "left").fillna({"n": 0})


def coverage_wide(
    catalog: DataFrame, years: Sequence, keys: Sequence[str] = ("region", "species")
) -> DataFrame:
    """The same counts with one column per year, and ``other`` for all other years and none."""
    year = F.when(F.col("year").isin(list(years)), F.col("year").cast("string")).otherwise("other")
    named = catalog.withColumn("year", year)
    return named.groupBy(*keys).pivot("year", [*map(str, years), "other"]).count().fillna(0)


def missing_population(block_class: DataFrame) -> DataFrame:
    """Blocks without population per state, for the states of the regions."""
    lost = block_class.where(F.col("population").isNull())
    return (
        lost.where(in_regions(F.col("geoid")))
        .groupBy(state_of(F.col("geoid")).alias("state"))
        .agg(n_rows().alias("n"))
    )


def supplied_population(
    block_class: DataFrame, supplied: DataFrame, block: Sequence[str] = ("geoid",)
) -> DataFrame:
    """What another source says about the blocks without population.

    Frequency of the supplied ``value``; all zero means that the missing
    populations can be read as nobody.
    """
    lost = block_class.where(F.col("population").isNull()).select(*block)
    return frequency(lost.join(supplied.select(*block, "value"), list(block), "left"), "value")


def totals_agree(
    published: DataFrame, own: DataFrame, keys: Sequence[str] = ("geoid",)
) -> DataFrame:
    """How many published totals agree with our own sums.

    Areas for which either side has no number are left out.
    """
    theirs = published.select(*keys, F.col("population").alias("_theirs"))
    joined = theirs.join(own.select(*keys, "population"), list(keys), "left")
    return frequency(joined.withColumn("agree", F.col("population") == F.col("_theirs")), "agree")


def shares_with_total(df: DataFrame, column: str) -> DataFrame:
    """Percent of rows per value, and a total row with a NULL value.

    Missing values count towards the base of the percentages only.
    """
    counts = df.groupBy(column).agg(n_rows().alias("_n"))  # one row per value
    base = counts.select(F.sum("_n")).scalar()
    totals = counts.rollup(column).agg(
        F.sum("_n").alias("_n"),
        F.sum(F.when(F.col(column).isNotNull(), F.col("_n"))).alias("_known"),
        F.grouping_id().alias("_group"),
    )
    return (
        totals.withColumn("_all", base)
        .where((F.col("_group") == 1) | F.col(column).isNotNull())
        .select(
            column,
            (F.coalesce("_known", F.lit(0)) * 100 / F.col("_all")).alias("percent"),
        )
    )


#: Bits of a piece of a fingerprint: sums of pieces are exact up to 2 ** 39 rows.
_PIECE_BITS = 24


def _fingerprint(*columns: str) -> Column:
    """A hash of a multiset of rows: the same whatever their order, others if one row is not the same.

    Sums of four independent pieces of 24 bits, so that partial sums of any rows add
    up; repeated rows count as often as they occur.
    """
    values = [F.col(c) for c in columns]
    # a NULL adds nothing to a hash, so its place is hashed too
    known = F.concat(*[F.when(v.isNull(), F.lit("0")).otherwise(F.lit("1")) for v in values])
    sums = []
    for seed in (1, 2):
        mixed = F.xxhash64(F.lit(seed), known, *values)
        for shift in (0, _PIECE_BITS):
            piece = F.shiftrightunsigned(mixed, shift).bitwiseAND(F.lit((1 << _PIECE_BITS) - 1))
            sums.append(F.sum(piece))
    return F.concat_ws("-", *[F.hex(s) for s in sums])


def panel_fingerprints(
    panel: DataFrame,
    by: Sequence[str] = PANEL_GROUP,
    position: str | None = None,
    cell: Sequence[str] = ("lon", "lat"),
) -> DataFrame:
    """Do all years of a group have the same cells, in the same order?

    One row per ``by, year``: ``n`` rows, ``cells`` and ``ordered`` fingerprints, and
    whether the number of rows, the cells and their order are those of most years of
    the group (of equally many, those of the earliest year).  ``cell`` columns of type
    double are compared as coordinates.  ``position`` names the place of a row within
    its year; without it the order is NULL.  A missing year is a year of its own.

    Rows are hashed where they are and only sums per group and year are shuffled, so
    this sees cells that were swapped, moved or exchanged between years without
    sorting or gathering them.
    """
    by = list(by)
    keys = []
    for i, c in enumerate(cell):
        value = coordinate_key(F.col(c)) if dict(panel.dtypes)[c] == "double" else F.col(c)
        keys.append(value.alias(f"_c{i}"))
    names = [f"_c{i}" for i in range(len(keys))]
    place = F.col(position) if position is not None else F.lit(None).cast("long")
    years = (
        panel.select(*by, "year", *keys, place.alias("_at"))
        .groupBy(*by, "year")
        .agg(
            n_rows().alias("n"),
            _fingerprint(*names).alias("cells"),
            (_fingerprint("_at", *names) if position is not None else F.lit(None).cast("string")).alias("ordered"),
        )
    )
    # one row per group and year from here on
    out = years
    for name in ("n", "cells", "ordered"):
        same = Window.partitionBy(*by, name)
        usual = Window.partitionBy(*by).orderBy(F.desc("_votes"), F.asc_nulls_last("_first"))
        out = (
            out.withColumns({"_votes": F.count(F.lit(1)).over(same), "_first": F.min("year").over(same)})
            .withColumn("_usual", F.first(name).over(usual))
            .withColumn(f"same_{name}", F.col(name) == F.col("_usual"))
            .drop("_votes", "_first", "_usual")
        )
    return out.select(
        *by, "year", "n", "cells", "ordered", F.col("same_n").alias("same_count"), "same_cells",
        F.col("same_ordered").alias("same_order"),
    )


def panel_check(panel: DataFrame, by: Sequence[str] = PANEL_GROUP) -> DataFrame:
    """Is the panel rectangular: every cell exactly once in every year?

    A missing year counts as a year of its own.  ``divisible`` is the weaker
    rule that rows divide evenly by years; ``n_missing`` counts NULL values.
    """
    by, shown = list(by) or ["_all"], list(by)
    if not shown:
        panel = panel.withColumn("_all", F.lit(1))
    cells = panel.groupBy(
        *by, coordinate_key(F.col("lon")).alias("_kx"), coordinate_key(F.col("lat")).alias("_ky")
    ).agg(
        n_rows().alias("_n"),
        F.sum(F.col("predicted").isNull().cast("long")).alias("_missing"),
    )
    per_group = cells.groupBy(*by).agg(
        n_rows().alias("n_cells"),
        F.sum("_n").alias("n_rows"),
        F.min("_n").alias("_least"),
        F.max("_n").alias("_most"),
        F.sum("_missing").alias("n_missing"),
    )
    years = panel.groupBy(*by, "year").agg(n_rows().alias("_n"))
    years = years.groupBy(*by).agg(n_rows().alias("n_years"))
    return per_group.join(years, by).select(
        *shown,
        "n_rows",
        "n_years",
        "n_cells",
        "n_missing",
        (F.col("n_rows") % F.col("n_years") == 0).alias("divisible"),
        (
            (F.col("_least") == F.col("n_years"))
            & (F.col("_most") == F.col("n_years"))
        ).alias("rectangular"),
    )
