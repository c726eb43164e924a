"""Neighbourhood models and Slope One on the tile kernels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import dense
from .lookup import Held
from .means import Recommender, entity_means, global_mean
from .tiles import Grid, both_ways, neighbour_sums, neighbour_top, pair_moments

FLAT = 1e-12  # a sum of squares below this has no direction


def pearson(moments: DataFrame, least: int = 2) -> DataFrame:
    """Pearson correlation over the common raters; 0 with fewer than ``least`` or without spread."""
    n, sii, sjj = F.col("n"), F.col("sii"), F.col("sjj")
    vi, vj = n * sii - F.col("si") * F.col("si"), n * sjj - F.col("sj") * F.col("sj")
    cov = n * F.col("sij") - F.col("si") * F.col("sj")
    flat = (n < least) | (vi < FLAT) | (vj < FLAT)
    return moments.withColumn("sim", F.when(flat, 0.0).otherwise(cov / F.sqrt(vi * vj)))


def shrunk_correlation(moments: DataFrame, shrinkage: float = 100.0, least: int = 2) -> DataFrame:
    """Correlation of residuals about zero, times (n - 1) / (n - 1 + shrinkage)."""
    n, sii, sjj = F.col("n"), F.col("sii"), F.col("sjj")
    flat = (n < least) | (sii < FLAT) | (sjj < FLAT)
    rho = F.col("sij") / F.sqrt(sii * sjj)
    return moments.withColumn("sim", F.when(flat, 0.0).otherwise((n - 1) / (n - 1 + F.lit(shrinkage)) * rho))


class Baselines:
    """Rating = mu + user offset + item offset, by alternating shrunken means."""

    def __init__(self, epochs: int = 10, reg_user: float = 15.0, reg_item: float = 10.0):
        self.epochs, self.reg_user, self.reg_item = epochs, reg_user, reg_item

    def fit(self, ratings: DataFrame) -> Baselines:
        self.mu = global_mean(ratings)
        users = None
        for _ in range(self.epochs):
            items = self._offsets(ratings, "item", "user", users, self.reg_item)
            users = self._offsets(ratings, "user", "item", items, self.reg_user)
        self.users, self.items = users, items
        return self

    def _offsets(self, ratings: DataFrame, key: str, other: str, known: Held | None, reg: float) -> Held:
        left = F.col("rating") - F.lit(self.mu)
        rows = ratings
        if known is not None:
            rows = known.join_to(ratings, other)
            left = left - F.col(f"{other}_off")
        count = F.count(F.lit(1))
        return Held.of(rows.groupBy(key).agg((F.sum(left) / (F.lit(reg) + count)).alias(f"{key}_off"), count.alias("n")))

    def attach(self, pairs: DataFrame, out: str = "base") -> DataFrame:
        """Adds the baseline of each pair; an unseen user or item has offset 0."""
        rows = self.items.join_to(self.users.join_to(pairs, "user"), "item")
        base = F.lit(self.mu) + F.coalesce("user_off", F.lit(0.0)) + F.coalesce("item_off", F.lit(0.0))
        return rows.select(*pairs.columns, base.alias(out))


def _middle(low: float | None, high: float | None) -> float:
    """The whole number halfway between two ratings; 0 without any."""
    if low is None or high is None or not math.isfinite(low + high):
        return 0.0
    return float(round((low + high) / 2))


class Neighbours(Recommender):
    """k nearest neighbours among users or items.

    ``style`` is ``means`` (centred ratings), ``zscore`` (standardised ratings) or ``baseline``
    (residuals of ``Baselines`` with shrunken correlations). Only positive similarities count; ties
    go to the lower id. Unseen users or items get the global mean, or the baseline.

    Similarities are made and used in one task for each pair of blocks (see ``dense``) where a block's cells fit one;
    otherwise they are added up over chunks of the other axis and kept as a table.
    """

    def __init__(self, k: int, entity: str = "user", style: str = "means", *, baselines: Baselines | None = None,
                 shrinkage: float = 100.0, least: int = 2, grid: Grid | None = None):
        self.k, self.entity, self.style = k, entity, style
        self.other = "item" if entity == "user" else "user"
        self.baselines = baselines or Baselines()
        self.shrinkage, self.least, self.grid = shrinkage, least, grid

    def fit(self, ratings: DataFrame) -> Neighbours:
        ratings = ratings.select("user", "item", "rating").persist(StorageLevel.MEMORY_AND_DISK)
        self.grid = self.grid or Grid.of(ratings, self.entity, self.other)
        key = self.entity
        self.fused = dense.fits(ratings, key, self.grid)
        self.means = entity_means(ratings, key)
        self.others = Held.of(ratings.select(self.other).distinct().withColumn("_seen", F.lit(True)))
        if self.style == "baseline":
            self.baselines.fit(ratings)
            base = self.baselines.attach(ratings)
            cells, self.units = base.withColumn("r", F.col("rating") - F.col("base")), None
        else:
            self.mu, self.sd, *ends = ratings.agg(F.avg("rating"), F.stddev_pop("rating"), F.min("rating"), F.max("rating")).first()
            # correlations are those of the ratings themselves, from smaller sums
            middle = F.lit(_middle(*ends))
            cells = ratings.withColumn("r", F.col("rating") - middle)
            unit = self._scale() if self.style == "zscore" else F.lit(1.0)
            shift = (F.col(f"{key}_mean") - middle).alias("shift")
            self.units = Held(self.means.df.select(key, shift, unit.alias("unit")), self.means.rows)
        self.cells = cut_lineage(cells.select("user", "item", "r"))
        if not self.fused:
            self._link()
        ratings.unpersist()
        return self

    def _link(self) -> None:
        """The table of positive similarities, in both directions."""
        moments = pair_moments(self.cells, self.entity, self.other, "r", grid=self.grid)
        sims = shrunk_correlation(moments, self.shrinkage, self.least) if self.style == "baseline" else pearson(moments, self.least)
        near = sims.where(F.col("sim") > 0).select("i", "j", F.col("sim").alias("w"), F.lit(0.0).alias("d"))
        self.links = cut_lineage(both_ways(near))

    def _similarity(self) -> dense.Similarity:
        least, shrinkage = self.least, self.shrinkage
        if self.style == "baseline":
            return partial(dense.shrunk, least=least, shrinkage=shrinkage)
        return partial(dense.pearson, least=least)

    def _scale(self) -> Column:
        std = F.col(f"{self.entity}_std")
        return F.when(std > 0, std).otherwise(F.lit(self.sd))

    def _sums(self, wanted: DataFrame) -> DataFrame:
        """num and den of each wanted pair's k nearest neighbours."""
        if self.fused:
            return dense.neighbour_scores(wanted, self.cells, self.entity, self.other, self.k, self._similarity(), self.grid,
                                          self.units)
        cells = dense.with_values(self.cells, self.entity, self.units)
        sums = neighbour_sums(wanted, cells, self.links, self.entity, self.other, "x", grid=self.grid)
        sums = cut_lineage(sums)
        over = sums.where(F.col("cnt") > self.k).select("user", "item")
        if not over.isEmpty():
            # only the pairs with more than k neighbours need them ranked
            top = neighbour_top(over, cells, self.links, self.entity, self.other, "x", self.k, grid=self.grid)
            best = top.groupBy("user", "item").agg(F.sum(F.col("w") * F.col("x")).alias("top_num"),
                                                   F.sum("w").alias("top_den"))
            sums = sums.join(best, ["user", "item"], "left").select(
                "user", "item", F.coalesce("top_num", "num").alias("num"), F.coalesce("top_den", "den").alias("den"))
        return sums.select("user", "item", "num", "den")

    def raw(self, pairs: DataFrame) -> DataFrame:
        sums = self._sums(pairs.select("user", "item"))
        shift = F.when(F.col("den") > 0, F.col("num") / F.col("den")).otherwise(F.lit(0.0))
        rows = pairs.join(sums, ["user", "item"], "left")
        if self.style == "baseline":
            rows = self.baselines.attach(rows)
            return rows.select(*pairs.columns, (F.col("base") + shift).alias("prediction"))
        rows = self.others.join_to(self.means.join_to(rows, self.entity), self.other)
        mean = F.col(f"{self.entity}_mean")
        scaled = shift * self._scale() if self.style == "zscore" else shift
        known = mean.isNotNull() & F.col("_seen").isNotNull()
        return rows.select(*pairs.columns, F.when(known, mean + scaled).otherwise(F.lit(self.mu)).alias("prediction"))


class SlopeOne(Recommender):
    """User mean plus the average deviation of the item from the items the user rated."""

    def __init__(self, grid: Grid | None = None):
        self.grid = grid

    def fit(self, ratings: DataFrame) -> SlopeOne:
        ratings = ratings.select("user", "item", "rating").persist(StorageLevel.MEMORY_AND_DISK)
        self.grid = self.grid or Grid.of(ratings, "item", "user")
        self.mu = global_mean(ratings)
        self.means = entity_means(ratings, "user")
        self.items = Held.of(ratings.select("item").distinct().withColumn("_seen", F.lit(True)))
        devs = pair_moments(ratings, "item", "user", "rating", squares=False, grid=self.grid).select(
            "i", "j", F.lit(1.0).alias("w"), ((F.col("si") - F.col("sj")) / F.col("n")).alias("d"))
        self.links = cut_lineage(both_ways(devs))
        # every linked item adds its deviation and nothing of the rating itself
        self.cells = cut_lineage(ratings.select("user", "item", F.lit(0.0).alias("x")))
        ratings.unpersist()
        return self

    def raw(self, pairs: DataFrame) -> DataFrame:
        sums = neighbour_sums(pairs.select("user", "item"), self.cells, self.links, "item", "user", "x", grid=self.grid)
        shift = F.when(F.col("cnt") > 0, F.col("num") / F.col("cnt")).otherwise(F.lit(0.0))
        rows = self.items.join_to(self.means.join_to(pairs.join(sums, ["user", "item"], "left"), "user"), "item")
        known = F.col("user_mean").isNotNull() & F.col("_seen").isNotNull()
        return rows.select(*pairs.columns,
                           F.when(known, F.col("user_mean") + shift).otherwise(F.lit(self.mu)).alias("prediction"))


def tune_k(ratings: DataFrame, ks: Sequence[int], fold: str, entity: str = "item", least: int = 2,
           grid: Grid | None = None) -> DataFrame:
    """``k, rmse`` of mean-centred neighbours for each k: the mean over the folds of the fold's RMSE.

    The fold is a group key of the kernels: all folds' similarities and scores are one job each, and
    one ranked neighbour list serves every k.
    """
    other = "item" if entity == "user" else "user"
    folds = [r[0] for r in ratings.select(fold).distinct().orderBy(fold).collect()]
    grid = grid or Grid.of(ratings, entity, other)
    # fold f trains on the rows of every other fold
    train = ratings.withColumnRenamed(fold, "_own").withColumn(
        fold, F.explode(F.array(*[F.lit(f) for f in folds]))).where(F.col(fold) != F.col("_own")).drop("_own")
    train = cut_lineage(train)
    means = train.groupBy(fold, entity).agg(F.avg("rating").alias("mean"))
    cells = train.join(means, [fold, entity]).withColumn("x", F.col("rating") - F.col("mean"))
    sims = pearson(pair_moments(train, entity, other, "rating", by=fold, grid=grid), least)
    near = sims.where(F.col("sim") > 0).select(fold, "i", "j", F.col("sim").alias("w"), F.lit(0.0).alias("d"))
    links = both_ways(near, fold)
    pairs = ratings.select(fold, "user", "item")
    top = neighbour_top(pairs, cells, links, entity, other, "x", max(ks), grid=grid, by=fold)
    within = [F.sum(F.when(F.col("place") <= k, F.col("w") * F.col("x"))).alias(f"num{k}") for k in ks]
    weight = [F.sum(F.when(F.col("place") <= k, F.col("w"))).alias(f"den{k}") for k in ks]
    sums = top.groupBy(fold, "user", "item").agg(*within, *weight)
    known = train.select(fold, F.col(other)).distinct().withColumn("_seen", F.lit(True))
    mus = train.groupBy(fold).agg(F.avg("rating").alias("mu"))  # one row per fold
    rows = (ratings.join(sums, [fold, "user", "item"], "left").join(means, [fold, entity], "left")
            .join(known, [fold, other], "left").join(F.broadcast(mus), fold))
    both = F.col("mean").isNotNull() & F.col("_seen").isNotNull()
    errors = []
    for k in ks:
        est = F.when(both, F.col("mean") + F.coalesce(F.col(f"num{k}") / F.col(f"den{k}"), F.lit(0.0))).otherwise(F.col("mu"))
        est = F.greatest(F.least(est, F.lit(5.0)), F.lit(1.0))
        errors.append(F.sqrt(F.avg((F.col("rating") - est) * (F.col("rating") - est))).alias(f"rmse{k}"))
    wide = rows.groupBy(fold).agg(*errors)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"rmse{k}").alias("e")) for k in ks]))
    return wide.select(each.alias("s")).groupBy(F.col("s.k").alias("k")).agg(F.avg("s.e").alias("rmse"))
