"""Null rules of the statistics: one missing value makes a sum or mean missing.

Spark's own ``sum`` and ``avg`` skip nulls, so the strict forms compare the
number of values with the number of rows.  All of them are plain aggregate
expressions and keep Spark's map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def n_rows() -> Column:
    """Number of rows, nulls included."""
    return F.count(F.lit(1))


def strict_sum(value: Column) -> Column:
    """Sum, or NULL if any value of the group is NULL."""
    return F.when(F.count(value) == n_rows(), F.sum(value))


def strict_avg(value: Column) -> Column:
    """Mean, or NULL if any value of the group is NULL."""
    return F.when(F.count(value) == n_rows(), F.avg(value))


def weighted_mean(value: Column, weight: Column) -> Column:
    """``sum(value * weight) / sum(weight)``; NULL on missing input or zero weight."""
    return F.try_divide(strict_sum(value * weight), strict_sum(weight))


def first_present(*values: Column) -> Column:
    """First value that is neither NULL nor NaN."""
    return F.coalesce(*[F.nanvl(v, F.lit(None).cast("double")) for v in values])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column.

    Missing values have one spelling downstream: ``coalesce``, ``count`` and
    comparisons all treat NaN as a value.
    """
    fixed = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df
