"""Urban and fully-predicted flags of blocks and their parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geoid import PARENT_LEVELS, area_prefix, state_of
from ..functions.nulls import n_rows
from .aggregate import finest, roll_up
from .skew import merged

URBAN_CUTOFF = 0.75  # fixed value


def mark(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Add ``flag`` = 1 where the key occurs in ``members``, else 0."""
    found = members.select(*keys).distinct().withColumn("_found", F.lit(1))
    return (
        df.join(found, list(keys), "left")
        .withColumn(flag, F.coalesce("_found", F.lit(0)))
        .drop("_found")
    )


def classify_blocks(
    blocks: DataFrame,
    urban: DataFrame,
    fully_predicted: DataFrame,
    population: DataFrame,
    block: Sequence[str] = ("vintage", "geoid"),
) -> DataFrame:
    """``block, urban, fully_predicted, population``, one row per block.

    ``urban`` and ``fully_predicted`` list the blocks that carry the flag, each
    for its own vintage; blocks without a known population keep NULL.
    """
    block = list(block)
    out = mark(blocks.select(*block), urban, block, "urban")
    out = mark(out, fully_predicted, block, "fully_predicted")
    return out.join(merged(population.select(*block, "population")), block, "left")


def classify_parents(
    block_class: DataFrame,
    levels: Sequence[str] = PARENT_LEVELS,
    cutoff: float = URBAN_CUTOFF,
    by: Sequence[str] = ("vintage",),
    inclusive: bool = False,
) -> DataFrame:
    """Population, its urban share and the flags of every parent area.

    A parent is urban if the share is above the cutoff; ``inclusive`` also
    accepts the cutoff itself.  A parent is fully predicted if all its blocks
    are.  Missing population gives NULL, and so does a share of nobody.
    """
    by = list(by)
    in_urban = F.col("population") * F.col("urban")
    sums = {
        "_p": F.sum("population"),
        "_p_n": F.count("population"),
        "_u": F.sum(in_urban),
        "_u_n": F.count(in_urban),
        "_no": F.count(F.when(F.col("fully_predicted") != 1, 1)),
        "_f_n": F.count("fully_predicted"),
        "_n": n_rows(),
    }
    partial = block_class.groupBy(
        *by, area_prefix(F.col("geoid"), finest(levels)).alias("geoid")
    ).agg(*[v.alias(k) for k, v in sums.items()])
    total = roll_up(partial, levels, list(sums), by).select(
        *by,
        "level",
        "geoid",
        F.when(F.col("_p_n") == F.col("_n"), F.col("_p")).alias("population"),
        F.when(F.col("_u_n") == F.col("_n"), F.col("_u")).alias("population_urban"),
        F.when(F.col("_no") > 0, 0)
        .when(F.col("_f_n") == F.col("_n"), 1)
        .alias("fully_predicted"),
    )
    share = F.try_divide(
        F.col("population_urban").cast("double"), F.col("population").cast("double")
    )
    pct = F.col("pct_population_urban")
    above = pct >= cutoff if inclusive else pct > cutoff
    return total.withColumn("pct_population_urban", share).select(
        *by,
        "level",
        "geoid",
        "population",
        "population_urban",
        "pct_population_urban",
        "fully_predicted",
        above.cast("int").alias("urban"),
    )


def clean_population(block_class: DataFrame, first_dropped_state: str = "60") -> DataFrame:
    """Drop the territories and read a missing population as nobody."""
    kept = block_class.where(state_of(F.col("geoid")) < first_dropped_state)
    return kept.fillna({"population": 0})
