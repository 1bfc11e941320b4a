"""What the two text regressions share: a bounded sample, and scoring of all texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import share_of_hash, texts
from .ordinal import Ordinal

#: A text to (distinct features, their values).
Featurizer = Callable[[str], tuple[np.ndarray, np.ndarray]]
#: The most frequent grades are learned, at most so many.
MOST_GRADES = 16


def labelled_sample(
    docs: DataFrame, grades: DataFrame, per_grade: int, id_col: str, text_col: str, grade_col: str
) -> DataFrame:
    """(grade, text) of at most ``per_grade`` documents of each grade, chosen by a hash of the id.

    At most ``MOST_GRADES`` grades are sampled, the most frequent ones, so the sample
    is bounded.  NULL ids, texts and grades are left out; an id that repeats counts
    once, with its smallest grade and its smallest text.
    """
    rated = grades.select(
        F.col(id_col).cast("long").alias("_id"), F.col(grade_col).cast("int").alias("_grade")
    ).dropna()
    rated = rated.groupBy("_id").agg(F.min("_grade").alias("_grade"))
    chosen = None
    mix = F.xxhash64("_id")
    counts = rated.groupBy("_grade").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.orderBy(F.desc("n"), "_grade").limit(MOST_GRADES)
    for grade, n in sorted(map(tuple, counts.collect())):
        few = rated.where((F.col("_grade") == grade) & share_of_hash(mix, per_grade, n))
        part = few.orderBy(mix, "_id").limit(per_grade)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = rated
    found = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return (
        found.where("_text IS NOT NULL")
        .join(F.broadcast(chosen), "_id")
        .groupBy("_id", "_grade")
        .agg(F.min("_text").alias("_text"))
    )


#: (row, feature, value) triples and a grade per row to a model.
Trainer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Ordinal]


def fit_sample(sample: DataFrame, make: Callable[[], Featurizer], train: Trainer) -> Ordinal:
    """The model of a bounded sample: one task gathers its features and trains.

    The driver receives the model alone.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = make()
        for rows in batches:
            pairs = [featurize(text) for text in texts(rows.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    rows.column(1),
                    pa.array([f.astype("<i4").tobytes() for f, _ in pairs], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary()),
                ],
                names=["id", "grade", "features", "values"],
            )

    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(
            (row for rows in batches for row in rows.to_pylist()), key=lambda r: (r["id"], r["grade"])
        )
        columns = [np.frombuffer(r["features"], "<i4") for r in found]
        values = [np.frombuffer(r["values"], "<f4") for r in found]
        if found:
            model = train(
                np.repeat(np.arange(len(found)), [len(c) for c in columns]),
                np.concatenate(columns),
                np.concatenate(values).astype(float),
                np.array([r["grade"] for r in found]),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([model.weights.astype("<f8").tobytes()], pa.binary()),
                    pa.array([model.thresholds.astype("<f8").tobytes()], pa.binary()),
                ],
                names=["weights", "thresholds"],
            )

    rows = sample.mapInArrow(features, "id long, grade int, features binary, values binary")
    found = rows.repartition(1).mapInArrow(fit_rows, "weights binary, thresholds binary").collect()
    if not found:
        none = np.empty(0, int)
        return train(none, none, np.empty(0), none)
    return Ordinal(
        np.frombuffer(found[0]["weights"], "<f8"), np.frombuffer(found[0]["thresholds"], "<f8")
    )


def with_scores(
    docs: DataFrame, model: Ordinal, make: Callable[[], Featurizer], text_col: str, names: list[str]
) -> DataFrame:
    """All columns of ``docs``, and the expected grade and tail probabilities under ``names``.

    ``names`` has the column of the expected grade, then one for each grade
    above the lowest.  A NULL text counts as empty.
    """
    at = docs.columns.index(text_col)
    weights = model.weights.astype(np.float32)
    model = Ordinal(np.empty(0), model.thresholds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = make()
        for rows in batches:
            scores = np.zeros(rows.num_rows)
            for i, text in enumerate(texts(rows.column(at))):
                features, values = featurize(text)
                scores[i] = float(weights[features] @ values) if len(features) else 0.0
            tails = model.tails(scores)
            columns = [model.expected(scores), *tails.T]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *(pa.array(c, pa.float64()) for c in columns)],
                names=[*rows.schema.names, *names],
            )

    added = [StructField(name, DoubleType()) for name in names]
    return docs.mapInArrow(score, StructType([*docs.schema.fields, *added]))
