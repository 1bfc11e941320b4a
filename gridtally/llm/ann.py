"""Approximate nearest neighbours by collision counting.

The index holds ``PROJECTIONS`` sorted arrays, each of one random projection of all
vectors, cut into blocks that are built and stored once.  A query opens a window
around its own projection in each array, and a vector that lies in ``THRESHOLD`` of
the windows is verified by its cosine.  Virtual rehashing widens the windows from
round to round.  A query is done when the k-th of all that were verified, in whatever
block, is nearer than the radius that the windows stand for; only the others go into
the next round.  The last one verifies all; there is no cap on what is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .vectors import (
    CANDIDATES,
    QUERIES,
    answers,
    best_answers,
    best_of,
    block_counts,
    blocks_of,
    few_copies,
    usable_rows,
)

PROJECTIONS = 32
#: Collisions that make a vector a candidate.
THRESHOLD = 20
#: Half the width of a window at radius 1, in standard deviations of the projection.
WIDTH = 1.1
#: Radii of the rounds, as distances of vectors of length 1; beyond the last all are verified.
FIRST_RADIUS, RATIO, ROUNDS = 0.33, 1.5, 4
RADII = tuple(FIRST_RADIUS * RATIO**i for i in range(ROUNDS))


def _axes(width: int) -> np.ndarray:
    """Random axes; a longer vector has the same ones and further components."""
    return np.stack([np.random.default_rng([11, i]).normal(size=PROJECTIONS) for i in range(width)] or [np.zeros(PROJECTIONS)])


def _unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / norms[:, None], norms


def sorted_arrays(matrix: np.ndarray) -> bytes:
    """The projections of a block in order, and whose they are."""
    projected = _unit(matrix)[0] @ _axes(matrix.shape[1])[: matrix.shape[1]]
    order = np.argsort(projected, axis=0, kind="stable").T.astype("<i4")
    arrays = np.sort(projected, axis=0).T.astype("<f8")
    return order.tobytes() + np.ascontiguousarray(arrays).tobytes()


def _finder(k: int, radius: float | None):
    """Answers at one radius; None verifies every vector."""

    def prepare(c_ids: np.ndarray, c_matrix: np.ndarray, stored: bytes):
        n = len(c_ids)
        order = np.frombuffer(stored, "<i4", PROJECTIONS * n).reshape(PROJECTIONS, n).astype(np.intp)
        arrays = np.frombuffer(stored, "<f8", PROJECTIONS * n, 4 * PROJECTIONS * n).reshape(PROJECTIONS, n)
        c_norms = np.sqrt((c_matrix * c_matrix).sum(axis=1))

        def find(q_ids: np.ndarray, q_matrix: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            unit, q_norms = _unit(q_matrix)
            if radius is not None:
                centres = (unit @ _axes(q_matrix.shape[1])[: q_matrix.shape[1]]).T
                reach = WIDTH * radius
                left, right = (
                    np.array([np.searchsorted(a, c + r, side) for a, c in zip(arrays, centres, strict=True)])
                    for r, side in ((-reach, "left"), (reach, "right"))
                )
            for at in range(len(q_ids)):
                if radius is None:
                    near = np.arange(n)
                else:
                    ends = zip(order, left[:, at].tolist(), right[:, at].tolist(), strict=True)
                    entered = np.concatenate([own[low:high] for own, low, high in ends])
                    near = np.flatnonzero(np.bincount(entered, minlength=n) >= THRESHOLD)
                near = near[c_ids[near] != q_ids[at]]
                if not len(near):
                    continue
                scores = np.einsum("ij,j->i", c_matrix[near], q_matrix[at]) / (c_norms[near] * q_norms[at])
                best = best_of(scores, c_ids[near], k)
                yield at, c_ids[near[best]], scores[best]

        return find

    return prepare


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score) by the largest cosine found, in double precision.

    Vectors without length take no part.  For nulls, ties, repeated rows,
    vectors of different lengths and empty tables see :func:`vectors.search`.
    """
    rows = usable_rows(vectors, is_query, id_col, vector_col).where(F.exists("vector", lambda x: x != 0))
    n_blocks, n_asked = block_counts(rows, candidates, queries)
    index = stage(blocks_of(few_copies(rows, k), n_blocks, sorted_arrays), "projections")
    left = stage(rows.where("is_query").dropDuplicates(["id", "uid"]).select("id", "uid", "vector"), "queries")
    done = None
    for radius in (*RADII, None):
        n_left = left.count()
        if not n_left:
            break
        asked = blocks_of(left, min(n_asked, max(1, -(-n_left // queries))))
        found = answers(asked, n_asked, index, n_blocks, _finder(k, radius), "double")
        best = stage(best_answers(found, k), "best")
        if radius is not None:
            # the distance of vectors of length 1 whose cosine is the score
            far = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * F.col("score")))
            settled = best.where((F.col("rank") == k) & (far <= radius)).select("query_id", "uid")
            best = best.join(settled, ["query_id", "uid"], "left_semi")
            settled = settled.withColumnsRenamed({"query_id": "id"})
            left = stage(left.join(settled, ["id", "uid"], "left_anti"), "queries")
        done = best if done is None else done.unionByName(best)
    if done is None:
        done = best_answers(
            rows.select(F.col("id").alias("query_id"), "uid", F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0), k
        )
    return done.select("query_id", "rank", "vec_id", "score")
