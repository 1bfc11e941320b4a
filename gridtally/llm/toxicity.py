"""Toxicity: expected severity by cumulative-link regression on word features.

Features are hashed words and beginnings of words (four and five bytes) with
``log(1 + count)``, not divided by length: an insult weighs the same in a long
text, and its inflected forms share their beginning.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ordinal
from .graded import fit_sample, labelled_sample, with_scores

FEATURES = 1 << 18
GRADES = 4
BEGINNINGS = (4, 5)
#: Bound of the sample: labelled documents of each class.
PER_CLASS = 3000
#: Words whose features a task remembers at most.
KNOWN_WORDS = 1_000_000
#: Share of documents with a word, toxic to other, above which it marks severity.
MARKER_RATIO = 20.0
#: What sets a telling feature apart: standard errors, and the ratio of the shares.
STANDARD_ERRORS = 4.0
SHARE_RATIO = 3.0

# everything but letters parts words; bytes above 127 belong to letters
_LETTERS = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def make_featurizer():
    """A function from a text to its hashed words and their weights."""
    known: dict[bytes, tuple[int, ...]] = {}

    def numbers(word: bytes) -> tuple[int, ...]:
        starts = [word[:n] + b"*" for n in BEGINNINGS if len(word) > n]
        return tuple(xxhash.xxh3_64_intdigest(w) % FEATURES for w in [word, *starts])

    def featurize(text: str) -> tuple[np.ndarray, np.ndarray]:
        if len(known) > KNOWN_WORDS:
            known.clear()
        counts: dict[int, int] = {}
        for word, n in Counter(text.lower().encode().translate(_LETTERS).split()).items():
            columns = known.get(word)
            if columns is None:
                columns = known[word] = numbers(word)
            for column in columns:
                counts[column] = counts.get(column, 0) + n
        values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
        return np.fromiter(counts, np.int32, len(counts)), values

    return featurize


def markers(rows: np.ndarray, features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which features are in ``MARKER_RATIO`` times as large a share of the toxic documents."""
    bad = np.bincount(features[toxic[rows] > 0], minlength=FEATURES)
    good = np.bincount(features[toxic[rows] == 0], minlength=FEATURES)
    n_bad, n_good = max(1, int((toxic > 0).sum())), max(1, int((toxic == 0).sum()))
    return (bad >= 4) & (bad / n_bad > MARKER_RATIO * (good + 1) / n_good)


def severity(rows: np.ndarray, features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades of labelled documents: 0 not toxic, else 1 to 3 by the number of marker words.

    The thirds of the toxic documents by their number of distinct markers are the
    grades 1, 2 and 3.
    """
    if not toxic.any():
        return np.zeros(len(toxic), int)
    hits = np.bincount(
        rows, markers(rows, features, toxic)[features].astype(float), minlength=len(toxic)
    )
    cuts = np.quantile(hits[toxic > 0], [1 / 3, 2 / 3])
    return np.where(toxic > 0, 1 + np.searchsorted(cuts, hits, side="left"), 0)


def telling(rows: np.ndarray, features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which features occur in clearly different shares of toxic and other documents.

    The difference is ``STANDARD_ERRORS`` or more, one share is ``SHARE_RATIO``
    times the other, and one document is added to each for and against; markers
    tell as well.  The rest would only add noise in long texts.
    """
    bad = np.bincount(features[toxic[rows] > 0], minlength=FEATURES) + 1
    good = np.bincount(features[toxic[rows] == 0], minlength=FEATURES) + 1
    n_bad, n_good = int((toxic > 0).sum()) + 2, int((toxic == 0).sum()) + 2
    p, q = bad / n_bad, good / n_good
    error = np.sqrt(p * (1 - p) / n_bad + q * (1 - q) / n_good)
    apart = np.maximum(p, q) >= SHARE_RATIO * np.minimum(p, q)
    return (apart & (np.abs(p - q) >= STANDARD_ERRORS * error)) | markers(rows, features, toxic)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
) -> ordinal.Ordinal:
    """Fit on at most ``per_class`` toxic and as many other labelled documents."""
    sample = labelled_sample(docs, labels, per_class, id_col, text_col, label_col)

    def train(rows, features, values, toxic) -> ordinal.Ordinal:
        grades = severity(rows, features, toxic)
        kept = telling(rows, features, toxic)[features]
        return ordinal.fit(
            rows[kept],
            features[kept],
            values[kept],
            grades,
            FEATURES,
            GRADES,
            steps=200,
            rate=0.05,
            balanced=False,
        )

    return fit_sample(sample, make_featurizer, train)


def rate(
    docs: DataFrame, model: ordinal.Ordinal, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, expected_severity (0 to 3), p_toxic, p_severe, toxic.

    ``p_toxic`` is P(grade >= 1), ``p_severe`` P(grade = 3); ``toxic`` says that
    the former is at least one half.  NULL and empty texts have no word and get
    the model's base rate; NULL ids stay; repeated rows are rated each; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["expected_severity", "p_toxic", "p_medium", "p_severe"]
    return (
        with_scores(rows, model, make_featurizer, "text", names)
        .withColumn("toxic", F.col("p_toxic") >= 0.5)
        .select("doc_id", "expected_severity", "p_toxic", "p_severe", "toxic")
    )
