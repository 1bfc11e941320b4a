"""Tables for distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import best_prediction
from .skew import merged


def distribute(
    values: DataFrame,
    classification: DataFrame,
    urban_only: bool,
    by: Sequence[str] = (),
    area: Sequence[str] = ("vintage", "geoid"),
    with_classification: Sequence[str] = (),
) -> DataFrame:
    """``by, area, year, predicted``; only urban areas if ``urban_only``.

    Block tables still hold both predictions and get the better one; parent
    tables have a single value already.  ``with_classification`` names columns
    of the classification to add.
    """
    by, area = list(by), list(area)
    if urban_only:
        urban = classification.where(F.col("urban") == 1).select(*area)
        values = values.join(merged(urban), area, "left_semi")
    if "predicted_within" in values.columns:
        values = values.withColumn("predicted", best_prediction())
    out = values.select(*dict.fromkeys([*by, *area, "year", "predicted"]))
    if with_classification:
        out = out.join(merged(classification.select(*area, *with_classification)), area, "left")
    return out
