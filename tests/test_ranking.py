import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import ranking as rk
from tessella.operators import splits


def _order(n, seed):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())


def test_thresholds_refine_when_a_prefix_is_large(spark, monkeypatch):
    monkeypatch.setattr(rk, "SMALL", 1)
    monkeypatch.setattr(rk, "HEX", 1)
    hashes = sorted(hashlib.md5(f"5:{i}".encode()).hexdigest() for i in range(500))
    got = rk.hash_thresholds(spark.range(500), "id", 5, [0, 1, 250, 499, 500])
    assert got[:4] == [hashes[i] for i in (0, 1, 250, 499)]
    assert got[4] > hashes[-1]


def test_hash_rank_is_a_permutation_and_keeps_only_what_is_asked(spark):
    order = _order(300, 1)
    full = {r["id"]: r["rank"] for r in rk.hash_rank(spark.range(300), "id", 1).collect()}
    assert [i for i, _ in sorted(full.items(), key=lambda t: t[1])] == order
    some = {r["rank"]: r["id"] for r in rk.hash_rank(spark.range(300), "id", 1, only=[0, 7, 299, 7]).collect()}
    assert some == {k: order[k] for k in (0, 7, 299)}
    assert sorted(r["rank"] for r in rk.hash_rank(spark.range(300), "id", 1, below=17).collect()) == list(range(17))
    assert rk.hash_rank(spark.range(300), "id", 1, below=0).count() == 0


@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
def test_grouped_rank_of_a_hot_group(spark, monkeypatch, hot_rows):
    # one user holds most of the rows
    monkeypatch.setattr(rk, "HOT_ROWS", hot_rows)
    rows = spark.range(2000).select(F.when(F.col("id") < 1900, 0).otherwise(F.col("id") % 5).alias("user"), F.col("id").alias("item"))
    got = rk.grouped_hash_rank(rows, "user", "item", 3).toPandas()
    assert len(got) == 2000
    for _, g in got.groupby("user"):
        assert sorted(g["rank"]) == list(range(len(g)))
        assert (g["size"] == len(g)).all()
        by_hash = sorted(zip(g["item"], g["user"]), key=lambda t: hashlib.md5(f"3:{t[1]}:{t[0]}".encode()).hexdigest())
        assert [i for i, _ in by_hash] == list(g.sort_values("rank")["item"])


def test_sorted_rank(spark):
    df = spark.range(1000).repartition(7)
    got = {r["id"]: r["rank"] for r in rk.sorted_rank(df, [F.col("id").desc()]).collect()}
    assert got == {i: 999 - i for i in range(1000)}


@pytest.mark.parametrize("small", [0, 7, 20_000])
@pytest.mark.parametrize("n", [1, 2, 9, 500, 501])
def test_medians_equal_numpy(spark, monkeypatch, small, n):
    monkeypatch.setattr(rk, "SMALL", small)
    rng = np.random.default_rng(n)
    cols = {"even": rng.normal(size=n), "tied": np.where(rng.random(n) < 0.7, 3.0, rng.integers(0, 9, n)).astype(float),
            "wide": rng.choice([-1.0, 1.0], n) * 10.0 ** rng.integers(-300, 300, n), "gaps": rng.normal(size=n)}
    cols["gaps"][rng.random(n) < 0.4] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*cols.values())]
    df = spark.createDataFrame([(*r, None) for r in rows], ", ".join(f"{c} DOUBLE" for c in [*cols, "none"]))
    got = rk.exact_medians(df, [*cols, "none"], cells=4)
    for c, v in cols.items():
        v = v[~np.isnan(v)]
        assert got[c] == (pytest.approx(np.median(v), rel=1e-15) if len(v) else None)
    assert got["none"] is None


def test_exact_split_and_folds(spark):
    df = spark.range(103)
    got = splits.split_exact(df, 0.8).toPandas()
    assert got["is_train"].sum() == 82
    folds = splits.fold_exact(df, 4).toPandas()
    assert sorted(folds["fold"].value_counts().tolist()) == [25, 25, 25, 28]
    assert (folds["fold"] == 3).sum() == 28
    assert splits.fold_exact(df, 4, seed=2).toPandas()["fold"].tolist() != folds["fold"].tolist()


def test_minibatches(spark):
    got = splits.minibatches(spark.range(50), 8, 3).toPandas()
    assert got["batch"].value_counts().to_dict() == {0: 8, 1: 8, 2: 8}
    assert sorted(got[got["batch"] == 0]["id"]) == sorted(_order(50, 1)[:8])
    plain = splits.minibatches(spark.range(50), 20, 3, shuffle=False).toPandas()
    assert plain.groupby("batch")["id"].agg(["min", "max"]).values.tolist() == [[0, 19], [20, 39], [40, 49]]


def test_per_user_split_sizes(spark):
    rows = [(u, i, 1.0) for u, n in ((0, 40), (1, 9), (2, 1), (3, 20)) for i in range(n)]
    got = splits.split_per_user(spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")).toPandas()
    assert got.groupby("user")["is_train"].sum().to_dict() == {0: 36, 1: 8, 2: 0, 3: 18}


def test_holdout_with_replacement(spark):
    rows = [(u, i, 1.0) for u, n in ((0, 400), (1, 9), (2, 30)) for i in range(n)]
    got = splits.holdout_with_replacement(spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")).toPandas()
    assert len(got) == len(rows)
    drawn = got.groupby("user")["is_test"].sum().to_dict()
    assert drawn[1] == 0  # fewer than ten ratings: no draw
    assert 1 <= drawn[2] <= 3 and 25 <= drawn[0] <= 40


def test_index_groups_are_bounded_and_whole(spark):
    rows = spark.range(1000).select(F.lit(1).alias("user"), F.col("id").alias("item"))
    got = splits.index_groups(rows, "user", "item", width=100).collect()
    assert len(got) == 10
    assert all(list(r["members"]) == sorted(r["members"]) for r in got)
    assert sorted(i for r in got for i in r["members"]) == list(range(1000))


def test_activity_filter_is_one_pass(spark):
    # item 9 has 2 raters only until user 5 (one rating) is dropped, and it is kept all the same
    rows = [(1, 9, 1.0), (1, 8, 1.0), (2, 8, 1.0), (2, 7, 1.0), (5, 9, 1.0)]
    got = splits.active_only(spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE"), 2).collect()
    assert sorted((r["user"], r["item"]) for r in got) == [(1, 8), (1, 9), (2, 8)]


def test_splits_and_folds_are_exact_on_a_repeated_key(spark):
    df = spark.range(400).select((F.col("id") % 100).alias("id"), F.col("id").alias("row"))
    assert splits.split_exact(df, 0.8075).where("is_train").count() == 323
    assert sorted(r["count"] for r in splits.fold_exact(df, 7).groupBy("fold").count().collect()) == [57] * 6 + [58]
    hot = spark.range(300).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("id"), F.lit(1).alias("same"))
    marked = splits.split_exact(hot, 0.5)
    assert marked.where("is_train").count() == 150 and marked.count() == 300 and marked.columns == ["id", "same", "is_train"]


def test_a_hot_group_is_ordered_in_pieces_of_the_target_size(spark, monkeypatch):
    monkeypatch.setattr(rk, "HOT_ROWS", 100)
    rows = spark.range(3000).select(F.when(F.col("id") < 2900, 0).otherwise(F.col("id") % 5 + 1).alias("user"), F.col("id").alias("item"))
    assert [tuple(r) for r in rk.hot_groups(rows, "user").collect()] == [(0, 29)]
