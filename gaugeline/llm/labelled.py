"""Bounded samples of labelled rows, and a small logistic regression for calibration and scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every fifth label, by the checksum of the id, is never learnt from.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def bounded(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """About most rows at the most, chosen by a hash of doc_id: all of a smaller table."""
    there = rows.count()
    if there <= most:
        return rows
    return rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 34) < F.lit(int(most / there * (1 << 30))))


def learnt(labels: DataFrame, column: str, most: int, seed: int = 5) -> DataFrame:
    """(doc_id, y) of at most about most rows that aren't held out; a null label or id is left out, of several labels the largest counts."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    return bounded(rows, most, seed)


@dataclass
class Logistic:
    """Ridge logistic regression on standardized columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
        mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-3
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = _sigmoid(z @ w)
            hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hessian, z.T @ (y - p) - penalty * w)
            w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:])


def _sigmoid(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))
