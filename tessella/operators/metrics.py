"""Costs, accuracies and gradients as aggregate expressions, so any number of them share one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import dot, sigmoid, softplus, star


def half_mse(e: Column) -> Column:
    return F.avg(e * e) / 2


def rmse(e: Column) -> Column:
    return F.sqrt(F.avg(e * e))


def mae(e: Column) -> Column:
    return F.avg(F.abs(e))


def log_loss(y: Column, z: Column) -> Column:
    """Negative log-likelihood of labels in {0, 1}, summed over the rows, finite for every score."""
    return F.sum(softplus(z) - y * z)


def penalty(weights: Sequence[float], lam: float) -> float:
    return lam / 2.0 * float(np.dot(weights, weights))


def rmse_stars(rating: Column, prediction: Column) -> Column:
    """RMSE after the prediction is made a valid star value."""
    return rmse(rating - star(prediction))


def accuracy(y: Column, label: Column) -> Column:
    return F.avg(F.when(y == label, 1.0).otherwise(0.0))


def weighted_accuracy(parts: DataFrame, group: str, split: str, hit: Column, shares: Mapping[str, float],
                      out: str = "accuracy") -> DataFrame:
    """Accuracy per group, weighted by group size over N * share of the split (N over all splits).

    The nominal share is the divisor, not the split's true size, so the sum may miss 1 by rounding.
    """
    per = parts.groupBy(split, group).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("acc"))
    n_all = parts.count()
    share = F.create_map(*[F.lit(v) for kv in shares.items() for v in kv])[F.col(split)]
    return per.groupBy(split).agg(F.sum(F.col("n") / (F.lit(n_all) * share) * F.col("acc")).alias(out))


def squared_gradient(df: DataFrame, cols: Sequence[str], y: str, w: Sequence[float]) -> np.ndarray:
    """-X'e / n."""
    e = F.col(y) - dot(cols, w)
    row = df.agg(*[(-F.sum(F.col(c) * e) / F.count(F.lit(1))).alias(c) for c in cols]).first()
    return np.array([row[c] for c in cols])


def logistic_gradient(df: DataFrame, cols: Sequence[str], y: str, w: Sequence[float]) -> np.ndarray:
    """X'(sigmoid(Xw) - y), not divided by n."""
    r = sigmoid(dot(cols, w)) - F.col(y)
    row = df.agg(*[F.sum(F.col(c) * r).alias(c) for c in cols]).first()
    return np.array([row[c] for c in cols])


def best(df: DataFrame, error: str, tie: str, by: Sequence[str] = ()) -> DataFrame:
    """The row of least error per group; NaN never wins, ties go to the smallest ``tie``."""
    row = F.min_by(F.struct(*df.columns), F.struct(F.col(error), F.col(tie)))
    return df.where(~F.isnan(error)).groupBy(*by).agg(row.alias("_r")).select("_r.*")
