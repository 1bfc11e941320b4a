"""Quality: cumulative-link regression on graded ratings.

The ratings 0 (poor), 1 (usable, but toxic) and 2 (good) share one vector of
hashed-text weights.  Features are relative frequencies: hashed words, the shape
of every token, pairs of shapes, and repeats of the token before.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordinal
from .common import free_names
from .graded import fit_sample, labelled_sample, with_scores

FEATURES = 1 << 18
GRADES = 3
#: Bound of the sample: rated documents of each grade.
PER_GRADE = 2500
#: Tokens whose shape and feature a task remembers at most.
KNOWN_TOKENS = 1_000_000

TOKEN = re.compile(r"\w+|[^\w\s]+")


def shape(token: str) -> str:
    """Letters as x or X, digits as 9, runs as one, other signs as they are."""
    if token.isalpha():
        if token.islower():
            return "x"
        if token.isupper():
            return "X" if len(token) == 1 else "XX"
        return "Xx" if token[1:].islower() else "xX"
    if token.isdigit():
        return "9"
    if token[0].isalnum() or token[0] == "_":
        return "x9"
    return token[:3]


def make_featurizer():
    """A function from a text to its hashed features and their values."""
    tokens: dict[str, tuple[int, str]] = {}
    pairs: dict[tuple[str, str], int] = {}

    def number(name: str) -> int:
        return xxhash.xxh3_64_intdigest(name) % FEATURES

    def featurize(text: str) -> tuple[np.ndarray, np.ndarray]:
        if len(tokens) > KNOWN_TOKENS:
            tokens.clear()
        if len(pairs) > KNOWN_TOKENS:
            pairs.clear()
        found = TOKEN.findall(text)
        if not found:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        words = Counter(found)
        for token in [t for t in words if t not in tokens]:
            tokens[token] = (number("w " + token.lower()), shape(token))
        shapes = [tokens[t][1] for t in found]
        shape_pairs = Counter(zip(shapes, shapes[1:], strict=False))
        for pair in [p for p in shape_pairs if p not in pairs]:
            pairs[pair] = number("p " + " ".join(pair))
        counts: dict[int, int] = {}
        for token, n in words.items():
            column = tokens[token][0]
            counts[column] = counts.get(column, 0) + n
        for name, n in Counter(shapes).items():
            column = number("s " + name)
            counts[column] = counts.get(column, 0) + 4 * n
        for pair, n in shape_pairs.items():
            counts[pairs[pair]] = counts.get(pairs[pair], 0) + 4 * n
        same = sum(a == b for a, b in zip(found, found[1:], strict=False))
        repeats = number("r")
        counts[repeats] = counts.get(repeats, 0) + 8 * same
        columns = np.fromiter(counts.keys(), np.int32, len(counts))
        values = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)) / len(found))
        return columns, values.astype(np.float32)

    return featurize


def rating(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Grade of a labelled document: 0 poor, 1 usable but toxic, 2 good."""
    return F.when(F.col(quality) == 0, 0).when(F.col(toxic) == 1, 1).when(F.col(quality) == 1, 2)


def fit(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    per_grade: int = PER_GRADE,
) -> ordinal.Ordinal:
    """Fit on at most ``per_grade`` rated documents of each grade."""
    sample = labelled_sample(docs, ratings, per_grade, id_col, text_col, grade_col)

    def train(rows, features, values, grades) -> ordinal.Ordinal:
        spread = np.bincount(features, minlength=FEATURES)
        kept = spread[features] >= 5
        return ordinal.fit(
            rows[kept],
            features[kept],
            values[kept],
            grades,
            FEATURES,
            GRADES,
            steps=150,
            rate=0.1,
            ridge=1e-4,
        )

    return fit_sample(sample, make_featurizer, train)


def rate(docs: DataFrame, model: ordinal.Ordinal, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_expected``, ``_p_usable``, ``_p_good``.

    The expected grade from 0 to 2, P(grade >= 1) and P(grade = 2); the names get
    further underscores where ``docs`` has them.  A NULL text counts as empty: no
    feature, the model's base rate.  Repeated rows are rated each; an empty table
    gives an empty result.
    """
    names = free_names(docs, "_expected", "_p_usable", "_p_good")
    return with_scores(docs, model, make_featurizer, text_col, names)


def select_quality(
    docs: DataFrame, model: ordinal.Ordinal, text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """The rows whose tail probability P(grade >= 1) is at least ``least``.

    Rows without a word go: nothing can be said for them.
    """
    usable = free_names(docs, "_p_usable")[0]
    rated = rate(docs, model, text_col)
    return rated.where((F.col(usable) >= least) & F.col(text_col).rlike(r"[\p{L}\p{N}]")).select(
        *docs.columns
    )
