"""Co-clustering: users and items are assigned to clusters, ratings are explained by cluster averages."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import digest
from ..session import cut_lineage
from .lookup import Held
from .means import Recommender, global_mean


class CoClustering(Recommender):
    """r = A[g, h] + (user mean - mean of g) + (item mean - mean of h).

    The averages are user_clusters x item_clusters numbers; they travel as literals. A user's squared
    errors under all candidate clusters are sums of one aggregation, and ties go to the lower cluster.
    """

    def __init__(self, user_clusters: int = 2, item_clusters: int = 7, epochs: int = 150, seed: int = 988):
        self.ku, self.ki, self.epochs, self.seed = user_clusters, item_clusters, epochs, seed

    def _start(self, ratings: DataFrame, key: str, k: int) -> DataFrame:
        head = F.conv(F.substring(digest(self.seed, F.lit(key), F.col(key)), 1, 8), 16, 10).cast("bigint")
        return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias(f"{key}_mean")).select(
            key, "n", f"{key}_mean", F.pmod(head, F.lit(k)).cast("int").alias(f"{key}_cl"))

    def fit(self, ratings: DataFrame) -> CoClustering:
        ratings = ratings.select("user", "item", "rating").persist(StorageLevel.MEMORY_AND_DISK)
        self.mu = global_mean(ratings)
        users, items = cut_lineage(self._start(ratings, "user", self.ku)), cut_lineage(self._start(ratings, "item", self.ki))
        self.n_users, self.n_items = users.count(), items.count()
        for _ in range(self.epochs):
            self._averages(ratings, users, items)
            users = self._assign(ratings, users, items, "user", self.ku)
            items = self._assign(ratings, users, items, "item", self.ki)
        self._averages(ratings, users, items)
        ratings.unpersist()
        self.users, self.items = users, items
        return self

    def _attach(self, rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        return Held(items, self.n_items).join_to(Held(users, self.n_users).join_to(rows, "user"), "item")

    def _averages(self, ratings: DataFrame, users: DataFrame, items: DataFrame) -> None:
        cells = self._attach(ratings, users, items).groupBy("user_cl", "item_cl").agg(
            F.sum("rating").alias("s"), F.count(F.lit(1)).alias("c")).collect()  # ku x ki rows
        got = {(r["user_cl"], r["item_cl"]): (r["s"], r["c"]) for r in cells}

        def mean(keys) -> float:
            s, c = map(sum, zip(*[got.get(k, (0.0, 0)) for k in keys]))
            return s / c if c else self.mu

        self.cell = [mean([(g, h)]) for g in range(self.ku) for h in range(self.ki)]
        self.user_avg = [mean([(g, h) for h in range(self.ki)]) for g in range(self.ku)]
        self.item_avg = [mean([(g, h) for g in range(self.ku)]) for h in range(self.ki)]

    def _estimate(self, g: Column, h: Column) -> Column:
        def at(values: list[float], i: Column) -> Column:
            return F.get(F.array(*[F.lit(float(v)) for v in values]), i)

        return (at(self.cell, g * self.ki + h) + F.col("user_mean") - at(self.user_avg, g)
                + F.col("item_mean") - at(self.item_avg, h))

    def _assign(self, ratings: DataFrame, users: DataFrame, items: DataFrame, key: str, k: int) -> DataFrame:
        rows = self._attach(ratings, users, items)
        g, h = F.col("user_cl"), F.col("item_cl")

        def sse(c: int) -> Column:
            est = self._estimate(F.lit(c), h) if key == "user" else self._estimate(g, F.lit(c))
            return F.sum((F.col("rating") - est) * (F.col("rating") - est))

        errors = rows.groupBy(key).agg(*[sse(c).alias(f"_e{c}") for c in range(k)])
        least = F.least(*[F.col(f"_e{c}") for c in range(k)]) if k > 1 else F.col("_e0")
        pick = F.coalesce(*[F.when(F.col(f"_e{c}") == least, F.lit(c)) for c in range(k)])
        table = users if key == "user" else items
        return cut_lineage(table.drop(f"{key}_cl").join(errors.select(key, pick.alias(f"{key}_cl")), key))

    def raw(self, pairs: DataFrame) -> DataFrame:
        rows = self._attach(pairs, self.users, self.items)
        both = self._estimate(F.col("user_cl"), F.col("item_cl"))
        return rows.select(*pairs.columns,
                           F.coalesce(both, F.col("user_mean"), F.col("item_mean"), F.lit(self.mu)).alias("prediction"))
