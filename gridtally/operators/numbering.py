"""Dense numbering 1..n within groups, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

COPIES_PER_ROW = 10_000
#: Rows that one task sorts and numbers, on average.
ROWS_PER_RANGE = 250_000


def _repeat(df: DataFrame, n: str, out: str) -> DataFrame:
    """Each row ``n`` times with ``out`` = 0..n-1; long runs are cut and spread."""
    short = df.where(F.col(n) <= COPIES_PER_ROW).withColumn(
        out, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    )
    runs = df.where(F.col(n) > COPIES_PER_ROW).withColumn(
        "_from",
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(COPIES_PER_ROW).cast("long"))
        ),
    )
    spread = runs.repartition("_from", *[c for c in df.columns if c != n])
    long = spread.withColumn(
        out,
        F.explode(
            F.sequence(
                F.col("_from"), F.least(F.col("_from") + COPIES_PER_ROW, F.col(n)) - F.lit(1)
            )
        ),
    ).drop("_from")
    return short.unionByName(long)


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "idx"
) -> DataFrame:
    """``group``, ``order`` and the row's place 1..n within its group.

    The rows are sorted by ranges over all groups together; each range adds the
    number of rows that earlier ranges hold for the group.  Rows equal in all
    columns are counted first and written out again at the end, so neither a
    huge group nor a row with many copies ends up in one task.  The number of ranges
    follows from the number of rows, so that what a task sorts and holds is bounded
    whatever their files or shuffles are compressed to.
    """
    group, order = list(group), list(order)
    cols = [*group, *[c for c in order if c not in group]]
    ranges = max(1, -(-df.count() // ROWS_PER_RANGE))
    runs = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    ranged = stage(
        runs.repartitionByRange(ranges, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_range", F.spark_partition_id()),
        "numbering",
    )
    # one row per range and group: as many as there are partitions and groups
    sizes = ranged.groupBy("_range", *group).agg(F.sum("_n").alias("_size"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        F.col("_range").alias("_r"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
    )
    above = Window.partitionBy("_range", *group).orderBy(*cols).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = ranged.repartition(ranges, "_range", *group).withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    same = [F.col("_range") == F.col("_r")]
    same += [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]
    placed = placed.join(offsets, reduce(lambda a, b: a & b, same))
    return _repeat(placed.select(*cols, "_n", "_offset", "_above"), "_n", "_copy").select(
        *cols, (F.col("_offset") + F.col("_above") + F.col("_copy") + 1).alias(out)
    )
