"""The tabular workflow: repair, expand, scale, fit, validate, pick the best setting, predict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import MISSING, class_label, digest, dot, sigmoid
from ..operators import features as ft
from ..operators import linear as lm
from ..operators import tuning
from ..operators.gram import Moments, complete_rows, moments
from ..operators.metrics import penalty, weighted_accuracy
from ..operators.lookup import Held
from ..operators.ranking import exact_medians, grouped_thresholds
from ..operators.splits import fold_exact, split_exact
from ..sources.features import encode_label, submission

AT_ONCE = 40  # accuracy expressions per pass

GRIDS = {
    "gd": {"gamma": tuning.GD_GAMMAS},
    "sgd": {"gamma": tuning.GD_GAMMAS},
    "least": {},
    "ridge": {"lam": tuning.RIDGE_LAMBDAS},
    "logistic": {"gamma": tuning.LOGISTIC_GAMMAS},
    "logistic_l2": {"lam": tuning.LOGISTIC_LAMBDAS, "gamma": tuning.LOGISTIC_GAMMAS},
}


@dataclass
class Preparation:
    """Statistics fitted on the training table and applied to any table.

    ``missing``: ``keep`` NULLs (the scaling turns them into 0; without scaling, incomplete rows take no part in a fit),
    ``median``, ``marker`` (the number that marks a missing value stays a value), or ``drop`` incomplete features.
    """

    cols: Sequence[str]
    degree: int = 1
    scale: bool = True
    missing: str = "keep"
    out: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame) -> Preparation:
        self.used = ft.complete_columns(df, self.cols) if self.missing == "drop" else list(self.cols)
        self.medians = exact_medians(df, self.used) if self.missing == "median" else {}
        wide, self.out = self._expand(df)
        self.scales = ft.scales(wide, [c for c in self.out if c != ft.BIAS]) if self.scale else None
        return self

    def _expand(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        rows = ft.impute(df, self.medians) if self.medians else df
        if self.missing == "marker":
            rows = rows.fillna(MISSING, list(self.used))
        return ft.expand_powers(rows.drop(*[c for c in self.cols if c not in self.used]), self.used, self.degree)

    def transform(self, df: DataFrame, refit: bool = False) -> DataFrame:
        """``refit`` takes the statistics from ``df`` itself, as a test table of its own would."""
        if refit:
            return Preparation(self.cols, self.degree, self.scale, self.missing).fit(df).transform(df)
        wide, out = self._expand(df)
        return ft.standardise(wide, out, self.scales) if self.scale else wide


@dataclass
class Outcome:
    """The chosen setting with its validation scores, and the scores of every setting tried."""

    params: dict
    model: lm.Linear
    error: float
    accuracy: float
    train_accuracy: float
    trials: list[dict]
    left_out: int = 0  # training rows with a gap in a column of the model


class Experiment:
    """One model family, validated by an exact split (``ratio``) or by exact folds (``folds``)."""

    def __init__(self, family: str, cols: Sequence[str], *, degree: int = 1, scale: bool = True, missing: str = "keep",
                 ratio: float | None = None, folds: int | None = None, params: Mapping | None = None,
                 ranges: Mapping[str, Sequence] | None = None, tune: bool = False, steps: int = 100,
                 newton: bool = False, seed: int = 1, warm: float = 0.1, batch: int = 1):
        if (ratio is None) == (folds is None):
            raise ValueError("give either a split ratio or a number of folds")
        if ratio is not None and not 0.0 < ratio < 1.0:
            raise ValueError("the split ratio must leave rows to validate on")
        if folds is not None and folds < 2:
            raise ValueError("cross-validation needs two folds or more")
        self.family, self.logistic = family, family.startswith("logistic")
        self.ratio, self.folds, self.seed = ratio, folds, seed
        self.params = dict(params or {})
        self.ranges = ranges if ranges is not None else (GRIDS[family] if tune else None)
        self.steps, self.newton, self.warm, self.batch = steps, newton, warm, batch
        self.prep = Preparation(list(cols), degree, scale, missing)

    def _part(self, i: int) -> Column:
        """Rows that validate the i-th fit."""
        return ~F.col("_part") if self.folds is None else F.col("_part") == i

    def run(self, train: DataFrame) -> Outcome:
        raw = train.select("id", "label", *self.prep.cols).persist(StorageLevel.MEMORY_AND_DISK)
        self.prep.fit(raw)
        cols = self.prep.out
        rows = self.prep.transform(raw).withColumn("y", encode_label(logistic=self.logistic)).select("id", "y", *cols)
        whole = complete_rows(rows, ["y", *cols])
        rows = split_exact(whole, self.ratio, self.seed, mark="_part") if self.folds is None else \
            fold_exact(whole, self.folds, self.seed, mark="_part")
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            outcome = self._search(rows, cols)
            outcome.left_out = raw.count() - rows.count()
            return outcome
        finally:
            rows.unpersist()
            raw.unpersist()

    def _search(self, rows: DataFrame, cols: list[str]) -> Outcome:
        by = moments(rows, cols, "y", by="_part")  # one pass serves the warm start, every part and every setting
        whole = sum(list(by.values())[1:], list(by.values())[0])
        held_out: list[Moments] = [by[False]] if self.folds is None else [by[i] for i in range(self.folds)]
        w0 = lm.ridge(whole, cols, self.warm).w
        configs = [{**self.params, **c} for c in tuning.grid(self.ranges)] if self.ranges is not None else [self.params]
        fits, losses = self._fit_all(rows, whole, held_out, cols, w0, configs)
        scores = self._accuracies(rows, fits)
        trials = []
        for c, models, costs, (acc_train, acc_test) in zip(configs, fits, losses, scores):
            errors = [self._cost(held_out[i], m.w, c, costs[i]) for i, m in enumerate(models)]
            trials.append({"params": c, "error": float(np.mean(errors)), "accuracy": acc_test,
                           "train_accuracy": acc_train, "model": models[-1]})
        valid = [t for t in trials if not np.isnan(t["error"])]
        if not valid:
            raise ValueError("every setting diverged")
        chosen = min(valid, key=lambda t: t["error"])
        model = chosen["model"]
        if self.folds is not None:  # the folds only chose the setting
            model = self._fit(rows, whole, cols, w0, chosen["params"])
        return Outcome(chosen["params"], model, chosen["error"], chosen["accuracy"], chosen["train_accuracy"], trials)

    def _fit_all(self, rows: DataFrame, whole: Moments, held_out: list[Moments], cols: list[str], w0: np.ndarray,
                 configs: list[dict]) -> tuple[list[list[lm.Linear]], list[list[float]]]:
        """A model for each setting and held-out part, and its log loss there where the family has one.

        The rows are read a number of times that doesn't grow with the settings: moments serve all squared losses, one
        draw all stochastic descents, and one pass for each step all logistic models.
        """
        parts = range(len(held_out))
        if self.logistic:
            part = (~F.col("_part")).cast("int") - 1 if self.folds is None else F.col("_part")  # a split holds out part 0
            asked = [(c["gamma"], c.get("lam", 0.0), i) for c in configs for i in parts]
            done = lm.logistic_grid(rows.withColumn("_held", part.cast("int")), cols, "y", w0, self.steps, asked, "_held",
                                    newton=self.newton, stop=lm.STOP_BELOW if self.family == "logistic_l2" else None)
            rows_of = [done[at:at + len(held_out)] for at in range(0, len(done), len(held_out))]
            return [[m for m, _ in r] for r in rows_of], [[e for _, e in r] for r in rows_of]
        none = [[float("nan")] * len(held_out) for _ in configs]
        if self.family == "sgd":
            done = [lm.descend_stochastic(rows.where(~self._part(i)), cols, "y", w0, self.steps, [c["gamma"] for c in configs],
                                          self.seed, batch=self.batch) for i in parts]
            return [[done[i][s] for i in parts] for s in range(len(configs))], none
        return [[self._fit(rows, whole - held_out[i], cols, w0, c) for i in parts] for c in configs], none

    def _fit(self, rows: DataFrame, m: Moments, cols: list[str], w0: np.ndarray, c: Mapping) -> lm.Linear:
        if self.family == "least":
            return lm.least_squares(m, cols)
        if self.family == "ridge":
            return lm.ridge(m, cols, c["lam"])
        if self.family == "gd":
            return lm.descend(m, cols, w0, self.steps, c["gamma"])
        if self.family == "sgd":
            return lm.descend_stochastic(rows, cols, "y", w0, self.steps, [c["gamma"]], self.seed, batch=self.batch)[0]
        if self.family == "logistic":
            return lm.logistic(rows, cols, "y", w0, self.steps, c["gamma"], newton=self.newton)
        if self.family == "logistic_l2":
            return lm.logistic(rows, cols, "y", w0, self.steps, c["gamma"], lam=c["lam"], newton=self.newton,
                               stop=lm.STOP_BELOW)
        raise ValueError(self.family)

    def _cost(self, m: Moments, w: np.ndarray, c: Mapping, loss: float) -> float:
        if self.logistic:
            return loss + (penalty(w, c["lam"]) if self.family == "logistic_l2" else 0.0)
        return lm.rmse_of(m, w) if self.family == "ridge" else m.sse(w) / m.n / 2

    def label(self, w: np.ndarray) -> Column:
        z = dot(self.prep.out, w)
        return class_label(sigmoid(z) if self.logistic else z, self.logistic)

    def _accuracies(self, rows: DataFrame, fits: list[list[lm.Linear]]) -> list[tuple[float, float]]:
        """(train, validation) accuracy of every setting, averaged over its parts."""
        asked = []
        for s, models in enumerate(fits):
            for i, m in enumerate(models):
                hit = F.when(F.col("y") == self.label(m.w), 1.0).otherwise(0.0)
                asked.append(F.avg(F.when(~self._part(i), hit)).alias(f"a{s}_{i}"))
                asked.append(F.avg(F.when(self._part(i), hit)).alias(f"b{s}_{i}"))
        got: dict = {}
        for at in range(0, len(asked), AT_ONCE):
            got |= rows.agg(*asked[at:at + AT_ONCE]).first().asDict()
        return [tuple(float(np.mean([got[f"{k}{s}_{i}"] for i in range(len(models))])) for k in "ab")
                for s, models in enumerate(fits)]

    def predict(self, outcome: Outcome, test: DataFrame, refit: bool = False) -> DataFrame:
        """``Id, Prediction`` of a table with ``id`` and the raw features."""
        rows = self.prep.transform(test, refit)
        return submission(rows.select("id", self.label(outcome.model.w).alias("prediction")))


@dataclass
class SegmentPlan:
    cols: list[str]
    degree: int
    lam: float


class SegmentedRidge:
    """One ridge model per segment, each with its own columns, degree and penalty.

    All segments share one pass: the moments of the union of their columns, grouped by segment and
    split, from which each segment picks its own. ``missing``: a gap becomes ``zero``, or the ``marker`` stays a value.
    A row of a segment without a model gets the more frequent class of the training rows.
    """

    def __init__(self, segment: Column, plans: Mapping[int, SegmentPlan], ratio: float = 0.8, seed: int = 155,
                 missing: str = "zero"):
        self.segment, self.plans, self.ratio, self.seed = segment, dict(plans), ratio, seed
        self.fill = {"zero": 0.0, "marker": MISSING}[missing]
        self.degrees: dict[str, int] = {}
        for p in self.plans.values():
            for c in p.cols:
                self.degrees[c] = max(self.degrees.get(c, 0), p.degree)

    def _wide(self, df: DataFrame) -> DataFrame:
        base = df.withColumn("_seg", self.segment)
        filled = base.select("id", *[c for c in ("label",) if c in df.columns], "_seg",
                             *[F.coalesce(F.col(c), F.lit(self.fill)).alias(c) for c in self.degrees])
        wide, self.all_cols = ft.expand_powers(filled, list(self.degrees), self.degrees)
        return wide

    def _own(self, seg: int) -> list[str]:
        p = self.plans[seg]
        return [ft.BIAS, *[f"{c}_p{d}" for c in p.cols for d in range(1, p.degree + 1)]]

    def fit(self, df: DataFrame) -> SegmentedRidge:
        wide = self._wide(df).withColumn("y", encode_label())
        spark, self.kind = df.sparkSession, dict(wide.dtypes)["_seg"]
        planned = spark.createDataFrame([(int(s),) for s in self.plans], "_seg BIGINT")
        keyed = wide.select("id", F.col("_seg").cast("bigint").alias("_seg")).join(F.broadcast(planned), "_seg", "left_semi") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        limits = Held.of(grouped_thresholds(keyed, "_seg", "id", self.seed, self.ratio))
        keyed.unpersist()
        # rows of a segment without a plan are no training rows
        placed = limits.join_to(wide.withColumn("_seg", F.col("_seg").cast("bigint")), "_seg")
        # read by the fit and by every score of it
        self.rows = placed.withColumn("is_train", F.coalesce(digest(self.seed, "id") < F.col("limit"), F.lit(False))) \
            .drop("limit").persist(StorageLevel.MEMORY_AND_DISK)
        by = moments(self.rows.where("is_train"), self.all_cols, "y", by="_seg")
        bias = self.all_cols.index(ft.BIAS)
        self.lean = sum(m.xy[bias] for m in by.values())
        self.models = {}
        for s, p in self.plans.items():
            own = self._own(s)
            if s in by:
                self.models[s] = lm.ridge(by[s].pick([self.all_cols.index(c) for c in own]), own, p.lam)
        # weights by segment as a table, so that a score is one join however many segments there are
        weights = [(int(s), [float(dict(zip(m.cols, m.w, strict=True)).get(c, 0.0)) for c in self.all_cols]) for s, m in self.models.items()]
        self.weights = Held.of(spark.createDataFrame(weights, "_seg BIGINT, _w ARRAY<DOUBLE>"))
        return self

    def _labelled(self, wide: DataFrame) -> DataFrame:
        """``wide`` with ``_class``, the predicted class."""
        rows = self.weights.join_to(wide.withColumn("_seg", F.col("_seg").cast("bigint")), "_seg", row_bytes=32 + 8 * len(self.all_cols))
        score = sum((F.col(c) * F.col("_w")[i] for i, c in enumerate(self.all_cols)), F.lit(0.0))
        return rows.withColumn("_class", class_label(F.coalesce(score, F.lit(float(self.lean))))).drop("_w")

    def accuracies(self) -> DataFrame:
        """``segment, is_train, n, accuracy`` on the fitted table."""
        hit = F.when(F.col("y") == F.col("_class"), 1.0).otherwise(0.0)
        return self._labelled(self.rows).groupBy(F.col("_seg").cast(self.kind).alias("segment"), "is_train").agg(
            F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))

    def overall(self) -> DataFrame:
        hit = F.when(F.col("y") == F.col("_class"), 1.0).otherwise(0.0)
        return weighted_accuracy(self._labelled(self.rows), "_seg", "is_train", hit, {True: self.ratio, False: 1 - self.ratio})

    def predict(self, df: DataFrame) -> DataFrame:
        return submission(self._labelled(self._wide(df)).select("id", F.col("_class").alias("prediction")))
