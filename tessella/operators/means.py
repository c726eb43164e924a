"""The recommender protocol and the mean baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip
from .lookup import Held


class Recommender:
    """``fit(ratings)`` then ``transform(pairs)``, which keeps the pairs' columns and adds ``prediction``.

    (user, item) is unique in both tables. ``clipped`` models answer within [1, 5].
    """

    clipped = True

    def fit(self, ratings: DataFrame) -> Recommender:
        raise NotImplementedError

    def raw(self, pairs: DataFrame) -> DataFrame:
        raise NotImplementedError

    def transform(self, pairs: DataFrame) -> DataFrame:
        out = self.raw(pairs)
        return out.withColumn("prediction", clip(F.col("prediction"))) if self.clipped else out


def global_mean(ratings: DataFrame) -> float:
    return ratings.agg(F.avg("rating")).first()[0]


def entity_means(ratings: DataFrame, key: str) -> Held:
    """Count, mean and population deviation of each user's (or item's) ratings."""
    return Held.of(ratings.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg("rating").alias(f"{key}_mean"), F.stddev_pop("rating").alias(f"{key}_std")))


class GlobalMean(Recommender):
    clipped = False

    def fit(self, ratings: DataFrame) -> GlobalMean:
        self.mu = global_mean(ratings)
        return self

    def raw(self, pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("prediction", F.lit(self.mu))


class EntityMean(Recommender):
    """Mean rating of the user or of the item; unseen ones are NULL, or the global mean if ``fallback``."""

    clipped = False

    def __init__(self, key: str, fallback: bool = False):
        self.key, self.fallback = key, fallback

    def fit(self, ratings: DataFrame) -> EntityMean:
        self.means = entity_means(ratings, self.key)
        self.mu = global_mean(ratings) if self.fallback else None
        return self

    def raw(self, pairs: DataFrame) -> DataFrame:
        mean: Column = F.col(f"{self.key}_mean")
        if self.fallback:
            mean = F.coalesce(mean, F.lit(self.mu))
        joined = self.means.join_to(pairs, self.key)
        return joined.select(*pairs.columns, mean.alias("prediction"))


def holdout_rmse(scored: DataFrame) -> DataFrame:
    """RMSE of scored test ratings under two denominators: all test cells, and the predicted ones only.

    An unseen user or item has no prediction and adds no error to either.
    """
    e = F.col("rating") - F.col("prediction")
    return scored.agg(F.sqrt(F.sum(e * e) / F.count(F.lit(1))).alias("rmse_all"),
                      F.sqrt(F.avg(e * e)).alias("rmse_seen"))
