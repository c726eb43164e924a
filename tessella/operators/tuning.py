"""Parameter ranges and grid search over recommenders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .means import Recommender
from .splits import fold_exact, parts, split_bernoulli

# fixed values: the default grids of the tabular models
GD_GAMMAS = [v / 10 for v in range(1, 20)]
RIDGE_LAMBDAS = [10.0 ** (-12 + 11 * i / 19) for i in range(20)]
LOGISTIC_GAMMAS = [v / 100 for v in range(1, 20)]
LOGISTIC_LAMBDAS = [1000.0 * v for v in range(1, 11)]


def steps(text: str, kind: type = float) -> list:
    """``start:end:step`` with both ends; counted in whole steps, so no value passes the end."""
    start, end, step = map(kind, text.split(":"))
    return [kind(start + i * step) for i in range(int(np.floor((end - start) / step + 1e-9)) + 1)]


def grid(ranges: Mapping[str, Sequence | None]) -> list[dict]:
    """All combinations of the given ranges; a parameter without a range is left out."""
    ranges = {k: v for k, v in ranges.items() if v is not None}
    return [dict(zip(ranges, values)) for values in product(*ranges.values())]


def _rmse(model: Recommender, test: DataFrame) -> float:
    e = F.col("rating") - F.col("prediction")
    return model.transform(test).agg(F.sqrt(F.avg(e * e))).first()[0]


def tune(ratings: DataFrame, make: Callable[..., Recommender], ranges: Mapping[str, Sequence], ratio: float = 0.9,
         seed: int = 988, parallelism: int = 2) -> tuple[dict, DataFrame]:
    """One split, every combination; gives the best parameters and ``config, params..., rmse``.

    ``parallelism`` configurations are submitted at a time, so small ones fill each other's gaps.
    """
    marked = split_bernoulli(ratings, ratio, seed, "user", "item").persist(StorageLevel.MEMORY_AND_DISK)
    train, test = parts(marked)
    configs = grid(ranges)
    with ThreadPoolExecutor(parallelism) as pool:
        errors = list(pool.map(lambda c: _rmse(make(**c).fit(train), test), configs))
    marked.unpersist()
    return _report(ratings, configs, errors)


def cross_tune(ratings: DataFrame, make: Callable[..., Recommender], ranges: Mapping[str, Sequence], folds: int = 5,
               seed: int = 988, parallelism: int = 2) -> tuple[dict, DataFrame]:
    """Every combination on every fold; the error is the mean of the folds' RMSE."""
    keyed = ratings.withColumn("_key", F.concat_ws("_", "user", "item"))
    marked = fold_exact(keyed, folds, seed, "_key").drop("_key").persist(StorageLevel.MEMORY_AND_DISK)
    configs = grid(ranges)
    jobs = [(c, f) for c in configs for f in range(folds)]

    def run(job):
        config, f = job
        train = marked.where(F.col("fold") != f).drop("fold")
        return _rmse(make(**config).fit(train), marked.where(F.col("fold") == f).drop("fold"))

    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(run, jobs))
    marked.unpersist()
    return _report(ratings, configs, [float(np.mean(scores[i * folds:(i + 1) * folds])) for i in range(len(configs))])


def _report(ratings: DataFrame, configs: list[dict], errors: list[float]) -> tuple[dict, DataFrame]:
    valid = [(e, i) for i, e in enumerate(errors) if e is not None and not np.isnan(e)]
    if not valid:
        raise ValueError("every configuration diverged")
    rows = [(i, *c.values(), float("nan") if e is None else e) for i, (c, e) in enumerate(zip(configs, errors))]
    table = ratings.sparkSession.createDataFrame(rows, ["config", *configs[0], "rmse"])
    return configs[min(valid)[1]], table
