"""Blending model predictions: every subset of models, ridge-weighted, judged on valid star values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import dot, star
from .gram import Moments, moments, solve
from .metrics import best

SLICE = 4096  # subsets that one pass over the rows scores
CELLS_AT_ONCE = 1 << 20  # rows x subsets of one product inside a task


def align(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per (user, item) with a column per model, joined by key; a missing prediction is NULL.

    If a model has several rows for a pair, the largest prediction counts.
    """
    return predictions.groupBy("user", "item").pivot("model", list(models)).agg(F.max("prediction"))


def subsets(n_models: int, least: int = 1) -> list[int]:
    """Bit masks of all subsets of at least ``least`` models."""
    return [m for m in range(1, 1 << n_models) if m.bit_count() >= least]


def members(mask: int, models: Sequence[str]) -> list[str]:
    return [m for i, m in enumerate(models) if mask >> i & 1]


def evaluate_subsets(wide: DataFrame, models: Sequence[str], rating: str = "rating", lam: float = 0.001,
                     least: int = 1) -> DataFrame:
    """``mask, size, members, weights, rmse, n`` for every subset, over the rows all models predict.

    One moment matrix of all models holds the normal equations of every subset. The rounded RMSE comes from a further
    pass for each ``SLICE`` subsets, which multiplies rows by their weight matrix: one pass for up to 12 models.
    """
    models = list(models)
    masks = subsets(len(models), least)
    rows = wide.select(rating, *models).dropna()
    m = moments(rows, models, rating)[None]
    return reduce(DataFrame.unionByName, [_evaluate(rows, models, rating, lam, m, masks[at:at + SLICE])
                                          for at in range(0, len(masks), SLICE)])


def _evaluate(rows: DataFrame, models: list[str], rating: str, lam: float, m: Moments, masks: list[int]) -> DataFrame:
    step = max(1, CELLS_AT_ONCE // len(masks))
    weights = np.zeros((len(models), len(masks)))
    for s, mask in enumerate(masks):
        idx = [i for i in range(len(models)) if mask >> i & 1]
        part = m.pick(idx)
        weights[idx, s] = solve(part.xx + 2 * m.n * lam * np.eye(len(idx)), part.xy)

    def errors(batches):
        sse, n = np.zeros(len(masks)), 0
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in models])
            y = b.column(rating).to_numpy(zero_copy_only=False)
            for at in range(0, len(y), step):
                stars = np.clip(np.rint(x[at:at + step] @ weights), 1.0, 5.0)
                sse += ((y[at:at + step, None] - stars) ** 2).sum(axis=0)
            n += len(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(masks, dtype=np.int64)), pa.array(sse),
                                          pa.array(np.full(len(masks), n))], names=["mask", "sse", "n"])

    scored = rows.mapInArrow(errors, "mask BIGINT, sse DOUBLE, n BIGINT").groupBy("mask").agg(
        F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse"), F.sum("n").alias("n"))
    spec = rows.sparkSession.createDataFrame(
        [(mask, mask.bit_count(), members(mask, models), [float(weights[i, s]) for i in range(len(models)) if mask >> i & 1])
         for s, mask in enumerate(masks)], "mask BIGINT, size INT, members ARRAY<STRING>, weights ARRAY<DOUBLE>")
    return spec.join(scored, "mask")


def best_subset(evaluated: DataFrame) -> DataFrame:
    return best(evaluated, "rmse", "mask")


def best_by_size(evaluated: DataFrame) -> DataFrame:
    return best(evaluated, "rmse", "mask", by=["size"])


def weigh(wide: DataFrame, models: Sequence[str], weights: Sequence[float]) -> DataFrame:
    """``user, item, prediction``: the weighted sum as an integer star value."""
    return wide.select("user", "item", star(dot(models, weights)).cast("int").alias("prediction"))


def weigh_all(wide: DataFrame, models: Sequence[str], evaluated: DataFrame, otherwise: float) -> DataFrame:
    """``user, item, prediction, mask``: every row gets an integer star value.

    A row is weighed by the best subset of those models that predicted it (``mask``); a row that no model predicted gets
    ``otherwise`` and mask 0. What comes to the driver is a row for each evaluated subset, which was made there, and one
    for each combination of present models.
    """
    models = list(models)
    have = F.expr(" + ".join(f"IF(`{m}` IS NULL, 0L, {1 << i}L)" for i, m in enumerate(models)))
    rows = wide.select("user", "item", *models, have.alias("_have"))
    best_first = evaluated.select("mask", "rmse", "weights").collect()
    best_first.sort(key=lambda r: (r["rmse"], r["mask"]))
    chosen = []
    for r in rows.select("_have").distinct().collect():
        top = next((e for e in best_first if e["mask"] & ~r["_have"] == 0), None)
        if top is not None:
            own = iter(top["weights"])
            chosen.append((r["_have"], top["mask"], [next(own) if top["mask"] >> i & 1 else 0.0 for i in range(len(models))]))
    # at most a row for each subset of the models
    plan = wide.sparkSession.createDataFrame(chosen, "_have BIGINT, mask BIGINT, _w ARRAY<DOUBLE>")
    score = " + ".join(f"IF(_w[{i}] = 0D, 0D, `{m}` * _w[{i}])" for i, m in enumerate(models))
    joined = rows.join(F.broadcast(plan), "_have", "left")
    value = F.coalesce(F.expr(score), F.lit(float(otherwise)))
    return joined.select("user", "item", star(value).cast("int").alias("prediction"), F.coalesce("mask", F.lit(0)).cast("bigint").alias("mask"))
