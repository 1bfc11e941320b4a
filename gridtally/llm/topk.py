"""Exact top-k search: exhaustive term-at-a-time accumulation.

Vectors are sparse rows of whole weights over their components, the terms.  For
a block of candidates each term has its postings (candidate, weight), made once for
all queries; a query scatters its weight times each posting into a dense array of
scores, term by term, and a partial selection keeps the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from .vectors import best_of, search

#: Weights and scores are longs.
LIMIT = float(1 << 63)


def weights(matrix: np.ndarray, scale: float) -> np.ndarray:
    """Whole weights; one that is no long is an error."""
    with np.errstate(over="ignore"):
        found = np.floor(matrix * scale)
    if not (np.abs(found) < LIMIT).all():
        raise OverflowError("a weight leaves the range of a long")
    return found.astype(np.int64)


def _check_scores(asked: np.ndarray, given: np.ndarray, q_ids: np.ndarray, c_ids: np.ndarray) -> None:
    """Whether the terms of every score stay longs, however they are summed."""
    if not asked.size or not given.size:
        return
    top = [np.abs(side.astype(np.float64)).max(axis=0) for side in (asked, given)]
    if (top[0] * top[1]).sum() < LIMIT / 2:
        return
    # whole numbers without a limit, for the rare vectors near it
    largest = np.abs(given.astype(object)).max(axis=0)
    for own, query in zip(q_ids, np.abs(asked.astype(object)), strict=True):
        if (query * largest).sum() >= 1 << 63:
            for candidate in np.abs(given[c_ids != own].astype(object)):
                if (query * candidate).sum() >= 1 << 63:
                    raise OverflowError("a score may leave the range of a long")


def _finder(k: int, scale: float):
    def prepare(c_ids: np.ndarray, c_matrix: np.ndarray, stored: bytes):
        given = weights(c_matrix, scale)
        postings = []
        for column in given.T:
            rows = np.flatnonzero(column)
            # a term that every candidate has needs no list of rows
            whole = len(rows) == len(column)
            postings.append((slice(None) if whole else rows, np.ascontiguousarray(column[rows])))

        def find(q_ids: np.ndarray, q_matrix: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            asked = weights(q_matrix, scale)
            _check_scores(asked, given, q_ids, c_ids)
            for at, query in enumerate(asked):
                scores = np.zeros(len(c_ids), np.int64)
                for term in np.flatnonzero(query):
                    rows, weight = postings[term]
                    scores[rows] += query[term] * weight
                others = np.flatnonzero(c_ids != q_ids[at])
                best = others[best_of(scores[others], c_ids[others], k)]
                yield at, c_ids[best], scores[best]

        return find

    return prepare


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: float = 1024.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) by the inner product of ``floor(scale * x)``.

    Exact: where a weight, or the sum of a score's terms without their signs,
    leaves the range of a long, the query fails.  For nulls, ties, repeated rows, vectors of different lengths and empty tables
    see :func:`vectors.search`; an empty vector scores 0 with everything.
    """
    return search(vectors, is_query, _finder(k, scale), k, "long", id_col, vector_col)
