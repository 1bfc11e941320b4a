"""Cumulative-link (proportional odds) regression on sparse features.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one weight vector for all
grades, thresholds in ascending order.  Fitted in numpy by full-batch gradient
steps on a bounded sample; the model is a weight vector and a few thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K - 1, one row per document."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])

    def expected(self, score: np.ndarray) -> np.ndarray:
        """The expected grade, from 0 to K - 1."""
        return self.tails(score).sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit(
    rows: np.ndarray,
    features: np.ndarray,
    values: np.ndarray,
    grades: np.ndarray,
    n_features: int,
    n_grades: int,
    steps: int = 200,
    rate: float = 0.1,
    ridge: float = 1e-4,
    balanced: bool = True,
) -> Ordinal:
    """Fit on triples (row, feature, value) and a grade per row.

    Thresholds are a first one plus positive steps, so they stay in order.
    Grades that do not occur are allowed; without any row the model is even.
    """
    n = len(grades)
    weights = np.zeros(n_features)
    gaps = np.zeros(n_grades - 1)
    if not n:
        return Ordinal(weights, np.arange(n_grades - 1, dtype=float))
    counts = np.bincount(grades, minlength=n_grades)
    share = np.where(counts > 0, n / np.maximum(counts, 1) / (counts > 0).sum(), 0.0)
    weight = (share[grades] if balanced else np.ones(n)) / n
    used, column = np.unique(features, return_inverse=True)
    own = np.zeros(len(used))
    params = np.concatenate([own, gaps])
    params[len(used)] = -0.5 * (n_grades - 2)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    at = np.arange(n)
    for step in range(1, steps + 1):
        own, gaps = params[: len(used)], params[len(used) :]
        widths = np.exp(gaps[1:])
        cuts = gaps[0] + np.concatenate([[0.0], np.cumsum(widths)])
        score = np.bincount(rows, values * own[column], minlength=n)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper = _sigmoid(edges[grades + 1] - score)
        lower = _sigmoid(edges[grades] - score)
        inside = np.maximum(upper - lower, 1e-9)
        slope_upper = upper * (1 - upper) / inside * weight
        slope_lower = lower * (1 - lower) / inside * weight
        by_score = slope_upper - slope_lower
        by_cut = np.zeros((n, n_grades + 1))
        by_cut[at, grades + 1] -= slope_upper
        by_cut[at, grades] += slope_lower
        by_cut = by_cut.sum(axis=0)[1:-1]
        after = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(column, values * by_score[rows], minlength=len(used)) + ridge * own,
                [after[0]],
                after[1:] * widths,
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        params = params - rate * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    weights[used] = params[: len(used)]
    gaps = params[len(used) :]
    return Ordinal(weights, gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))]))
