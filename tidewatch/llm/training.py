"""Labelled rows that models learn from, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is kept from training; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """`text`, `n_chars` and `label` of at most `limit` labelled documents outside the fold.

    The rows are those with the smallest hashes of their ids, so the choice doesn't depend on the
    order of the tables. Ids that carry both labels are left out.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .where(~held_out()).groupBy("doc_id")
             .agg(F.min(label).alias("label"), F.max(label).alias("__high"))
             .where("label = __high").drop("__high")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # at most `limit` ids and labels
    return docs.select("doc_id", "text", "n_chars").join(F.broadcast(known), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "n_chars", F.col("label").cast("int"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50):
    """Weights and bias of a ridge logistic regression, by Newton's method."""
    if not len(y):
        return np.zeros(x.shape[1]), -2.0
    full = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(full.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-3])
    for _ in range(steps):
        p = sigmoid(full @ w)
        step = np.linalg.solve((full * (p * (1 - p))[:, None]).T @ full + ridge,
                               full.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])
