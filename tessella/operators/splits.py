"""Random splits as columns: the data stays where it is and gets a mark.

Randomness is the hash order of a key, so a split is the same on every run and every engine.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import digest, total, uniform
from .ranking import HOT_ROWS, grouped_hash_rank, hash_cuts, hash_rank, sorted_rank


PLACE = "_place"  # place of a row among those of its key


def split_exact(df: DataFrame, ratio: float, seed: int = 1, key: str = "id", mark: str = "is_train") -> DataFrame:
    """Exactly floor(ratio * n) rows get ``mark`` true, also if a key repeats."""
    cut = int(math.floor(ratio * df.count()))
    df, (beyond,) = _beyond(df, key, seed, [cut])
    return df.withColumn(mark, ~beyond).drop(PLACE)


def fold_exact(df: DataFrame, k: int, seed: int = 1, key: str = "id", mark: str = "fold") -> DataFrame:
    """k - 1 folds of floor(n / k) rows; the last takes the rest. Exact also if a key repeats."""
    rows = df.count() // k
    df, beyond = _beyond(df, key, seed, [rows * i for i in range(1, k)])
    return df.withColumn(mark, total([b.cast("int") for b in beyond]) if beyond else F.lit(0)).drop(PLACE)


def _beyond(df: DataFrame, key: str, seed: int, positions: list[int]) -> tuple[DataFrame, list[Column]]:
    """Whether a row is not among the first m in hash order, for each position m.

    With a unique key this compares digests, and no row moves. If a position falls between rows of one key, those rows
    alone are ordered by a hash of their values and get their place in ``PLACE``.
    """
    cuts = hash_cuts(df, key, seed, positions)
    h = digest(seed, key)
    tied = sorted({d for d, inside in cuts if inside})
    if not tied:
        return df, [h >= F.lit(d) for d, _ in cuts]
    mine = df.where(h.isin(tied))
    order = [digest(seed, key), F.xxhash64(*df.columns)]
    sizes = {r["h"]: r["count"] for r in mine.groupBy(h.alias("h")).count().collect()}  # a row for each position at most
    starts = dict(zip(tied, [0, *accumulate(sizes[d] for d in tied)]))
    start = F.create_map(*[F.lit(v) for pair in starts.items() for v in pair])[h]
    placed = sorted_rank(mine, order, PLACE).withColumn(PLACE, (F.col(PLACE) - start).cast("bigint"))
    rest = df.where(h.isNull() | ~h.isin(tied)).withColumn(PLACE, F.lit(0).cast("bigint"))
    both = rest.unionByName(placed.select(*rest.columns))
    return both, [(h > F.lit(d)) | ((h == F.lit(d)) & (F.col(PLACE) >= inside)) for d, inside in cuts]


def minibatches(df: DataFrame, size: int, batches: int = 1, seed: int = 1, key: str = "id",
                shuffle: bool = True, mark: str = "batch") -> DataFrame:
    """The rows of the first ``batches`` runs of ``size`` rows, in hash order or key order."""
    wanted = size * batches
    if shuffle:
        ranked = hash_rank(df, key, seed, "_rank", below=wanted)
    else:  # few rows are cut off before they are numbered; many are more than one task should gather
        few = df.orderBy(key).limit(wanted) if wanted <= HOT_ROWS else df
        ranked = sorted_rank(few, [F.col(key)], "_rank").where(F.col("_rank") < wanted)
    return ranked.withColumn(mark, F.floor(F.col("_rank") / size).cast("int")).drop("_rank")


def split_per_user(ratings: DataFrame, ratio: float = 0.9, seed: int = 988, mark: str = "is_train") -> DataFrame:
    """int(n_u * ratio) ratings of every user get ``mark`` true, drawn without replacement."""
    ranked = grouped_hash_rank(ratings, "user", "item", seed, "_rank", "_size")
    return ranked.withColumn(mark, F.col("_rank") < _share("_size", ratio)).drop("_rank", "_size")


def split_bernoulli(df: DataFrame, ratio: float, seed: int, *keys: str, mark: str = "is_train") -> DataFrame:
    """Each row is drawn on its own with probability ``ratio``."""
    return df.withColumn(mark, uniform(seed, *keys) < F.lit(ratio))


def holdout_with_replacement(ratings: DataFrame, p_test: float = 0.1, seed: int = 988,
                             mark: str = "is_test") -> DataFrame:
    """int(n_u * p) test draws per user WITH replacement, so repeats shrink the test set.

    The first int(n_u * p) rows of a user each make one draw of a rank; the drawn ranks are the test
    rows. No list of draws is built anywhere, so a huge user is no special case.
    """
    ranked = grouped_hash_rank(ratings, "user", "item", seed, "_rank", "_size")
    draws = (ranked.where(F.col("_rank") < _share("_size", p_test))
             .select("user", F.floor(uniform(seed, F.col("user"), F.col("_rank") + 1) * F.col("_size")).alias("_rank"))
             .distinct().withColumn(mark, F.lit(True)))
    return (ranked.join(draws, ["user", "_rank"], "left")
            .withColumn(mark, F.coalesce(mark, F.lit(False))).drop("_rank", "_size"))


def _share(size: str, ratio: float) -> Column:
    return F.floor(F.col(size) * F.lit(float(ratio)))


def parts(df: DataFrame, mark: str = "is_train") -> tuple[DataFrame, DataFrame]:
    """(marked, unmarked) rows without the mark."""
    return df.where(F.col(mark)).drop(mark), df.where(~F.col(mark)).drop(mark)


def active_only(ratings: DataFrame, least: int) -> DataFrame:
    """Ratings whose user and whose item both have ``least`` ratings in the table as given (not iterated)."""
    def busy(key: str) -> DataFrame:
        return ratings.groupBy(key).count().where(F.col("count") >= least).select(key)

    return ratings.join(busy("user"), "user", "left_semi").join(busy("item"), "item", "left_semi") \
        .select(*ratings.columns)


def activity(ratings: DataFrame, key: str) -> DataFrame:
    """Ratings per user or item with their place in descending order, most active first."""
    counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sorted_rank(counts, [F.col("n").desc(), F.col(key)], "place")


def index_groups(ratings: DataFrame, key: str, value: str, width: int = 4096) -> DataFrame:
    """``key, part, members``: the sorted ids rated by each user (or of each item).

    A group wider than ``width`` comes as several parts, each a hash share of the members, so no row
    and no task ever holds more than a part.
    """
    sizes = ratings.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / width).alias("_parts"))
    part = F.pmod(F.xxhash64(value), F.col("_parts")).cast("int")
    return (ratings.join(sizes, key).groupBy(key, part.alias("part"))
            .agg(F.sort_array(F.collect_list(value)).alias("members")))
