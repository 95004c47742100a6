"""What the two classifiers share: learning rows, and a logistic map from a margin to a probability."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.scratch import maybe_broadcast, written


def held_out(doc_id: Column) -> Column:
    """One row in five, by the checksum of its id; labels of these rows are never learned from. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def learning_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label 0/1) of the rows that may be learned from; rows without id or label are left out, and of an id
    with several labels the larger counts. Broadcast when small."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    return maybe_broadcast(written(rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")), "labels"))


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve through weighted points, by Newton's method; targets are smoothed so that
    separable points have a finite answer. Without both classes the curve is the constant rate."""
    n1, n0 = float(weight[y == 1].sum()), float(weight[y == 0].sum())
    if not n1 or not n0:
        return 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = weight * (target - p), weight * np.maximum(p * (1 - p), 1e-9)
        m = np.array([[np.sum(h * x * x) + 1e-6, np.sum(h * x)], [np.sum(h * x), np.sum(h) + 1e-6]])
        step = np.linalg.solve(m, np.array([np.sum(g * x), np.sum(g)]))
        step *= min(1.0, 5 / max(1e-9, float(np.abs(step).max())))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)
