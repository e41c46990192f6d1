"""Labelled rows for the classifiers, bounded and chosen by a hash, and logistic fits on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on at most; the ones with the smallest hash of their id.
FIT_ROWS = 20_000


def fit_rows(labels: DataFrame, column: str, held_out, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, label`` of at most ``rows`` documents outside the held-out fold.

    Rows without label or id are left out; where an id has several labels, the majority counts, 1 on a tie.
    """
    known = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out)
    one = known.groupBy("doc_id").agg((F.avg(column) >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1-penalised logistic model, by accelerated proximal gradient.

    Columns are scaled inside, so the penalty treats a rare rule as a frequent one.
    """
    rate = float(y.mean()) if len(y) else 0.5
    start = float(np.log((rate * len(y) + 0.5) / ((1 - rate) * len(y) + 0.5)))
    if not len(y) or rate in (0.0, 1.0) or not x.shape[1]:
        return np.zeros(x.shape[1]), start
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = ((x - mean) / scale).astype(np.float32)
    probe = np.ones(z.shape[1], np.float32)
    for _ in range(20):
        probe = z.T @ (z @ probe)
        top = float(np.linalg.norm(probe))
        probe /= top + 1e-12
    step = 4 * len(y) / (top + len(y))
    w, b = np.zeros(z.shape[1], np.float32), start
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(z @ v + c)))
        g = (p - y).astype(np.float32)
        new = v - step * (z.T @ g) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * float(g.mean())
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / new_t * (new - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new, new_b, new_t
    weights = w.astype(float) / scale
    weights[w == 0] = 0
    return weights, b - float(weights @ mean)
