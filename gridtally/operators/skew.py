"""Joins that stay balanced when single keys hold much of the left side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 200_000
# A key is hot from this share of all rows on, so there are never more hot keys,
# nor more pieces of one.
MOST_PIECES = 50_000
# Tables up to this many short rows (a few MB) are broadcast; the callers count
# first, or know a bound.
BROADCAST_ROWS = 100_000


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """The heaviest keys with the number of pieces to split each into.

    A key is heavy above ``rows_per_split`` rows or 1/``MOST_PIECES`` of all rows,
    whichever is more.  So there are at most ``MOST_PIECES`` of them, which
    bounds the list; it steers the work only and never changes a result.
    """
    weights = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return hot_from_counts(weights, keys, "_n", rows_per_split)


def hot_from_counts(
    counts: DataFrame, keys: Sequence[str], n: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """``hot_keys`` for counts that are known already."""
    share = counts.select((F.sum(n) / MOST_PIECES).alias("_share")).scalar()
    least = F.greatest(F.lit(float(rows_per_split)), share)
    return counts.where(F.col(n) > least).select(
        *keys, F.ceil(F.col(n) / least).cast("int").alias("_splits")
    )


def merged(right: DataFrame) -> DataFrame:
    """The right side of a join that is sorted and merged, never broadcast.

    For tables that grow with the data: Spark's estimate of an expression over a
    file is the file's compressed size, which knows nothing of rows that are made
    or unpacked on the way, and a broadcast passes through the driver.
    """
    return right.hint("merge")


def _pieces(df: DataFrame, hot: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Add the number of pieces of each row's key, 1 for ordinary keys.

    ``hot`` may name some of the keys only.
    """
    found = df.join(F.broadcast(hot), [k for k in keys if k in hot.columns], "left")
    return found.withColumn(out, F.coalesce("_splits", F.lit(1))).drop("_splits")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    hot_right: DataFrame | None = None,
    spread_right_by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Equi-join whose left side may have hot keys.

    Rows of a hot key are spread over pieces by a hash of ``spread_by``; the
    right rows of that key are copied once per piece.  All other keys join as
    usual.  Left rows with a NULL key never match and are spread too, instead
    of meeting in one task of an outer join.

    The right side may be of any size and is not broadcast.

    ``partitions`` is the number of tasks, for callers that know how much the join makes.

    An inner join may also name the hot keys of the right side, which are
    spread by ``spread_right_by`` in the same way.
    """
    if how not in ("inner", "left") or (hot_right is not None and how != "inner"):
        raise ValueError("spread_join supports inner and left, both sides for inner only")
    hot = hot if hot is not None else hot_keys(left, keys)

    def digest(columns: Sequence[str]) -> Column:
        return F.xxhash64(*[F.col(c) for c in columns])

    def copies(pieces: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(pieces) - 1))

    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    pieces = F.when(no_key, F.lit(MOST_PIECES)).otherwise(F.col("_k"))
    salted = _pieces(left, hot, keys, "_k")
    salted = salted.withColumn("_salt", F.pmod(digest(spread_by), pieces).cast("int")).drop("_k")
    copied = _pieces(right, hot, keys, "_k").withColumn("_salt", copies("_k")).drop("_k")
    on = [*keys, "_salt"]
    if hot_right is not None:
        on.append("_salt2")
        salted = _pieces(salted, hot_right, keys, "_k").withColumn("_salt2", copies("_k"))
        copied = _pieces(copied, hot_right, keys, "_k").withColumn(
            "_salt2", F.pmod(digest(spread_right_by), F.col("_k")).cast("int")
        )
        salted, copied = salted.drop("_k"), copied.drop("_k")
    if partitions is not None:
        salted = salted.repartition(partitions, *on)
    renamed = {k: f"_r_{k}" for k in on}
    matched = reduce(lambda a, b: a & b, [F.col(k) == F.col(r) for k, r in renamed.items()])
    joined = salted.join(merged(copied.withColumnsRenamed(renamed)), matched, how)
    return joined.drop("_salt", "_salt2", *renamed.values())


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    n_right: int,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Equi-join with a right side of counted (or bounded) size.

    Small ones are broadcast, which needs no shuffle of the left side and knows
    no hot keys; larger ones go through ``spread_join``.
    """
    if n_right <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), list(keys), how)
    return spread_join(left, right, keys, spread_by, how)
