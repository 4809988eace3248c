"""What the two classifiers share: the bounded sample of labelled rows, and logistic regression on sparse rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import is_held_out, written

#: Most labelled rows that a classifier is fitted on; which ones a hash of the id decides.
FIT_ROWS = 20_000


def fit_sample(
    docs: DataFrame, labels: DataFrame, label: str, fit_rows: int = FIT_ROWS, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, text, y) of at most ``fit_rows`` labelled ids outside the held-out fold, one row an id.

    Ids labelled several times keep one label (the largest), ids without a label or without an id drop out; of rows
    that share an id the least text stays. The chosen ids, ``fit_rows`` at most, are sent to the texts.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull() & ~is_held_out(F.col(doc)))
        .groupBy(F.col(doc).alias("id_"))
        .agg(F.max(F.col(label)).cast("int").alias("y"))
        .orderBy(F.xxhash64("id_"), "id_")
        .limit(fit_rows)
    )
    rows = docs.select(F.col(doc).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    met = rows.join(F.broadcast(written(chosen, "chosen")), F.col("doc_id") == F.col("id_"))
    return met.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


class Adam:
    """Steps of a parameter vector along its gradient, each coordinate scaled by its running size."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-9)


def logistic(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, targets: np.ndarray, n_columns: int,
    penalty: float = 1e-4, steps: int = 300, rate: float = 0.05,
) -> np.ndarray:
    """Weights, the intercept last, of a regression on sparse rows with targets between 0 and 1."""
    n = len(targets)
    weights, adam = np.zeros(n_columns + 1), Adam(n_columns + 1, rate)
    for _ in range(steps):
        score = np.bincount(rows, values * weights[columns], minlength=n) + weights[-1]
        error = (sigmoid(score) - targets) / n
        gradient = np.bincount(columns, values * error[rows], minlength=n_columns + 1) + penalty * weights
        gradient[-1] = error.sum()
        weights -= adam.step(gradient)
    return weights
