import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessella.operators import blending, factors, lookup, neighbours, tiles
from tessella.operators.cocluster import CoClustering
from tessella.operators.factors import GradientFactors, LibraryAls, WeightedAls
from tessella.operators.means import EntityMean, GlobalMean, holdout_rmse
from tessella.operators.neighbours import Baselines, Neighbours, SlopeOne
from tessella.operators.tiles import Grid
from tessella.operators.tuning import cross_tune, tune
from tessella.plans import recommend as plan

TRIPLET = "user INT, item INT, rating DOUBLE"


def _predict(model, train, pairs):
    got = model.fit(train).transform(pairs).toPandas()
    return got.set_index(["user", "item"])["prediction"].sort_index()


@pytest.fixture(scope="module")
def skewed(spark):
    """A busy user and a popular item, users with one rating, and items nobody shares."""
    rng = np.random.default_rng(3)
    cells = {(0, i) for i in range(30)} | {(u, 0) for u in range(40)}
    cells |= {(int(u), int(i)) for u, i in zip(rng.integers(1, 40, 300), rng.integers(0, 25, 300))}
    cells |= {(50, 40), (51, 41)}
    rows = [(u, i, float(rng.integers(1, 6))) for u, i in sorted(cells)]
    return spark.createDataFrame(rows, TRIPLET).cache(), pd.DataFrame(rows, columns=["user", "item", "rating"])


def _pearson(a, b):
    both = a.index.intersection(b.index)
    if len(both) < 2:
        return 0.0
    x, y = a[both], b[both]
    if x.std() == 0 or y.std() == 0:
        return 0.0
    return float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("grid", [None, Grid(4, 3)])
@pytest.mark.parametrize("entity,k,style", [("user", 5, "means"), ("item", 4, "zscore"), ("item", 99, "means")])
def test_neighbours_equal_brute_force(spark, skewed, grid, entity, k, style):
    train, pdf = skewed
    other = "item" if entity == "user" else "user"
    pairs = spark.createDataFrame([(u, i) for u in (0, 3, 7, 50, 60) for i in (0, 5, 24, 41, 99)], "user INT, item INT")
    got = _predict(Neighbours(k, entity, style, grid=grid), train, pairs)
    by = {e: g.set_index(other)["rating"] for e, g in pdf.groupby(entity)}
    mean, sd = {e: g.mean() for e, g in by.items()}, {e: g.std(ddof=0) or pdf["rating"].std(ddof=0) for e, g in by.items()}
    for (u, i), p in got.items():
        e, o = (u, i) if entity == "user" else (i, u)
        if e not in by or o not in set(pdf[other]):
            want = pdf["rating"].mean()
        else:
            near = [(round(_pearson(by[e], by[n]), 12), -n) for n in by if n != e and o in by[n].index]
            near = sorted([x for x in near if x[0] > 1e-9], reverse=True)[:k]
            scale = (lambda n: sd[n]) if style == "zscore" else (lambda n: 1.0)
            want = mean[e]
            if near:
                want += scale(e) * sum(s * (by[-n][o] - mean[-n]) / scale(-n) for s, n in near) / sum(s for s, _ in near)
        assert p == pytest.approx(min(max(want, 1.0), 5.0), abs=1e-8), (u, i)


@pytest.mark.parametrize("grid", [None, Grid(3, 5)])
def test_slope_one_equals_brute_force(spark, skewed, grid):
    train, pdf = skewed
    pairs = spark.createDataFrame([(u, i) for u in (0, 3, 7, 50, 60) for i in (0, 5, 24, 41, 99)], "user INT, item INT")
    got = _predict(SlopeOne(grid), train, pairs)
    by_item = {i: g.set_index("user")["rating"] for i, g in pdf.groupby("item")}
    by_user = {u: g.set_index("item")["rating"] for u, g in pdf.groupby("user")}
    for (u, i), p in got.items():
        if u not in by_user or i not in by_item:
            want = pdf["rating"].mean()
        else:
            devs = [(by_item[i] - by_item[j]).dropna() for j in by_user[u].index if j != i]
            devs = [d.mean() for d in devs if len(d)]
            want = by_user[u].mean() + (np.mean(devs) if devs else 0.0)
        assert p == pytest.approx(min(max(want, 1.0), 5.0), abs=1e-9), (u, i)


def test_pair_moments_do_not_depend_on_the_grid(skewed):
    train, _ = skewed
    frames = [tiles.pair_moments(train, "item", "user", "rating", grid=g).toPandas().sort_values(["i", "j"]).reset_index(drop=True)
              for g in (Grid(1, 1), Grid(5, 4))]
    pd.testing.assert_frame_equal(*frames)
    assert (frames[0]["i"] < frames[0]["j"]).all() and not frames[0].duplicated(["i", "j"]).any()


def test_baselines_with_one_epoch_are_decoupled(skewed):
    train, pdf = skewed
    got = Baselines(1, reg_user=10.0, reg_item=25.0).fit(train).attach(train).toPandas()
    mu = pdf["rating"].mean()
    bi = pdf.groupby("item")["rating"].apply(lambda r: (r - mu).sum() / (25 + len(r)))
    res = pdf["rating"] - mu - pdf["item"].map(bi)
    bu = res.groupby(pdf["user"]).apply(lambda r: r.sum() / (10 + len(r)))
    assert np.allclose(got["base"], mu + got["user"].map(bu) + got["item"].map(bi))


def test_mean_models_on_unseen_ids(spark, skewed):
    train, pdf = skewed
    pairs = spark.createDataFrame([(0, 0, 3.0), (77, 0, 4.0)], TRIPLET)
    got = EntityMean("user").fit(train).transform(pairs)
    assert got.where("user = 77").first()["prediction"] is None
    e = 3.0 - pdf[pdf.user == 0]["rating"].mean()
    errors = holdout_rmse(got).first()
    assert errors["rmse_all"] == pytest.approx(np.sqrt(e * e / 2)) and errors["rmse_seen"] == pytest.approx(abs(e))
    assert EntityMean("user", fallback=True).fit(train).transform(pairs).where("user = 77").first()["prediction"] == \
        pytest.approx(pdf["rating"].mean())
    assert GlobalMean().fit(train).transform(pairs).count() == 2


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_lookup_splits_hot_keys_and_loses_nothing(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "TASK_ROWS", 100)
    long = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 50).cast("int").alias("k"), "id")
    table = long.groupBy("k").count().withColumnRenamed("count", "n").withColumn("v", F.col("k") * 10)
    for how in ("left", "inner"):
        got = lookup.lookup(long, table.where("k != 7"), "k", rows=50, how=how, limit=limit).toPandas()
        assert len(got) == (3000 if how == "left" else 3000 - (long.where("k = 7").count()))
        assert not got.duplicated("id").any()
        seen = got[got["k"] != 7]
        assert (seen["v"] == seen["k"] * 10).all()


def _uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 4294967296.0


def _als_reference(pdf, rank, sweeps, lu, li, seed=988):
    q = {i: np.array([g["rating"].mean(), *[_uniform(seed, "item", i, k) for k in range(1, rank)]]) for i, g in pdf.groupby("item")}
    p, errors = {}, []

    def solve(groups, fixed, key, lam):
        out = {}
        for e, g in groups:
            m = np.array([fixed[o] for o in g[key]])
            out[e] = np.linalg.solve(m.T @ m + len(g) * lam * np.eye(rank), m.T @ g["rating"].to_numpy())
        return out

    for _ in range(sweeps):
        p = solve(pdf.groupby("user"), q, "item", lu)
        q = solve(pdf.groupby("item"), p, "user", li)
        errors.append(np.sqrt(np.mean([(r - p[u] @ q[i]) ** 2 for u, i, r in pdf.itertuples(index=False)])))
    return p, q, errors


@pytest.mark.parametrize("hot,small", [(False, True), (True, True), (True, False)])
def test_weighted_als_at_full_rank(spark, skewed, monkeypatch, hot, small):
    train, pdf = skewed
    monkeypatch.setattr(factors, "_is_small", lambda *_: small)  # too large to broadcast: lay out after the join
    if hot:  # deal the busy user and the popular item to several tasks
        monkeypatch.setattr(factors, "TASK_ROWS", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # rows of a key run across batches
    try:
        model = WeightedAls(rank=5, stop=0.0, max_sweeps=3)
        got = _predict(model, train, train.select("user", "item"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    p, q, errors = _als_reference(pdf, 5, 3, 0.1, 0.7)
    assert np.allclose(model.errors, errors)
    assert np.allclose(got.to_numpy(), [p[u] @ q[i] for u, i in got.index])


def test_lookup_deals_what_the_joined_table_holds(spark, monkeypatch):
    monkeypatch.setattr(lookup, "TASK_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:  # a cold key of the table that the pairs ask for most of the time, and rows without a key
        long = spark.range(4000).select(F.when(F.col("id") < 3000, 1).when(F.col("id") < 3500, None)
                                        .otherwise(F.col("id")).alias("k"), "id")
        table = spark.createDataFrame([(1, 10.0), (3600, 5.0)], "k BIGINT, v DOUBLE")
        got = lookup.lookup(long, table, "k", rows=2, limit=64 * 32)  # the hot keys fit, the table is said not to
        plain = lookup.lookup(long, table, "k", rows=1 << 30)
        sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
        assert got.count() == plain.count() == 4000 and plain.where("v is null").count() == 999
        assert max(sizes) <= 600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_als_stops_on_small_change(skewed):
    train, _ = skewed
    model = WeightedAls(rank=3, stop=0.05).fit(train)
    assert 2 <= len(model.errors) < 20 and abs(model.errors[-1] - model.errors[-2]) <= 0.05


@pytest.mark.parametrize("implicit", [False, True])
def test_gradient_models_lower_the_training_error(skewed, implicit):
    train, _ = skewed
    errors = []
    for epochs in (0, 2, 5):
        model = GradientFactors(3, epochs, 0.02, 0.001, implicit=implicit).fit(train)
        errors.append(model.transform(train).agg(F.avg((F.col("rating") - F.col("prediction")) ** 2)).first()[0])
    assert errors[0] > errors[1] > errors[2]


def test_gradient_step_is_first_order_equal_to_the_sequential_rule(spark):
    rows = [(0, 0, 5.0), (0, 1, 3.0), (1, 0, 2.0)]
    train = spark.createDataFrame(rows, TRIPLET)
    model = GradientFactors(2, 1, 1e-6, 0.5).fit(train)
    start = GradientFactors(2, 0, 1e-6, 0.5).fit(train)
    mu = np.mean([r for *_, r in rows])
    u0 = {r["user"]: r for r in start.users.collect()}
    q0 = {r["item"]: np.array([r["f0"], r["f1"]]) for r in start.items.collect()}
    for row in model.users.collect():
        u = row["user"]
        p0 = np.array([u0[u]["f0"], u0[u]["f1"]])
        grad = sum((r - mu - p0 @ q0[i]) * q0[i] - 0.5 * p0 for v, i, r in rows if v == u)
        assert np.allclose((np.array([row["f0"], row["f1"]]) - p0) / 1e-6, grad, atol=1e-4)


def test_plain_factors_do_not_overshoot(skewed):
    train, _ = skewed
    model = GradientFactors.plain(rank=10, epochs=6).fit(train)
    rmse = factors.observed_rmse(train, model.users, model.items, 10).first()["rmse"]
    assert rmse < 1.5


def test_coclustering_falls_back_to_known_means(spark, skewed):
    train, pdf = skewed
    pairs = spark.createDataFrame([(0, 999), (999, 0), (999, 999)], "user INT, item INT")
    got = _predict(CoClustering(2, 3, 2), train, pairs)
    assert got[0, 999] == pytest.approx(pdf[pdf.user == 0]["rating"].mean())
    assert got[999, 0] == pytest.approx(pdf[pdf.item == 0]["rating"].mean())
    assert got[999, 999] == pytest.approx(pdf["rating"].mean())


def test_library_als_scores_the_wanted_pairs_only(skewed):
    train, _ = skewed
    model = LibraryAls(rank=3, epochs=3).fit(train)
    pairs = train.select("user", "item").limit(20)
    direct = model.transform(pairs)
    joined = model.recommend(1000).join(pairs, ["user", "item"])
    a = {(r["user"], r["item"]): r["prediction"] for r in direct.collect()}
    b = {(r["user"], r["item"]): r["rating"] for r in joined.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-5) for k in a)
    assert model.transform(pairs.withColumn("item", F.lit(999))).count() == 0


def test_tuners(skewed):
    train, _ = skewed
    best, table = tune(train, lambda **p: EntityMean(fallback=True, **p), {"key": ["user", "item"]})
    rows = {r["key"]: r["rmse"] for r in table.collect()}
    assert best["key"] == min(rows, key=rows.get)
    best, table = cross_tune(train, lambda **p: EntityMean(fallback=True, **p), {"key": ["user", "item"]}, folds=2)
    assert table.count() == 2 and best["key"] in ("user", "item")


def test_blend_equals_numpy_and_reports_incomplete_rows(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(1, 6, 60).astype(float)
    x = np.column_stack([y + rng.normal(size=60), rng.uniform(1, 5, 60), np.full(60, 3.0)])
    names = ["good", "noise", "flat"]
    test = spark.createDataFrame([(i, 0, float(v)) for i, v in enumerate(y)], TRIPLET)
    long = [(n, i, 0, float(x[i, c])) for c, n in enumerate(names) for i in range(60) if not (n == "noise" and i == 5)]
    preds = spark.createDataFrame(long, "model STRING, user INT, item INT, prediction DOUBLE")
    wanted = test.select("user", "item").union(spark.createDataFrame([(77, 0), (77, 0)], "user BIGINT, item BIGINT"))
    got = plan.blend(test, preds, wanted, preds, names, 2.2)
    assert (got.scored, got.incomplete, got.unanswered) == (59, 1, 1)
    assert got.fallen_back == 1 + ("noise" in got.members)
    answers = {r["user"]: r["prediction"] for r in got.submission.collect()}
    assert len(answers) == got.submission.count() == 61 and None not in answers.values() and answers[77] == 2
    keep = np.arange(60) != 5
    want = {}
    for mask in blending.subsets(3):
        idx = [c for c in range(3) if mask >> c & 1]
        t = x[keep][:, idx]
        w = np.linalg.solve(t.T @ t + 2 * 59 * 0.001 * np.eye(len(idx)), t.T @ y[keep])
        want[mask] = np.sqrt(np.mean((y[keep] - np.clip(np.round(t @ w), 1, 5)) ** 2))
    rows = {r["mask"]: r for r in got.subsets.collect()}
    assert {m: r["rmse"] for m, r in rows.items()} == pytest.approx(want)
    assert got.rmse == pytest.approx(min(want.values())) and "good" in got.members
    sizes = {r["size"]: r["rmse"] for r in blending.best_by_size(got.subsets).collect()}
    assert sizes == pytest.approx({s: min(v for m, v in want.items() if m.bit_count() == s) for s in (1, 2, 3)})


def test_subsets_are_scored_in_slices(spark, monkeypatch):
    assert blending.subsets(3, least=3) == [7] and len(blending.subsets(17)) == (1 << 17) - 1
    rng = np.random.default_rng(1)
    wide = spark.createDataFrame([tuple(map(float, r)) for r in rng.uniform(1, 5, (40, 5))], "rating DOUBLE, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    whole = {r["mask"]: r for r in blending.evaluate_subsets(wide, list("abcd")).collect()}
    monkeypatch.setattr(blending, "SLICE", 4)
    assert {r["mask"]: r for r in blending.evaluate_subsets(wide, list("abcd")).collect()} == whole and len(whole) == 15


def test_every_wanted_pair_is_answered(spark, skewed):
    train, pdf = skewed
    seen = train.select("user", "item").limit(1)
    wanted = seen.union(spark.createDataFrame([(9999, 1), (9999, 9999)], "user BIGINT, item BIGINT"))
    chosen, final = plan.recommend(train, wanted, {"ALS": lambda: LibraryAls(rank=2, epochs=2)}, ratio=0.8)
    assert final.count() == 3 and final.where("Prediction is null").count() == 0
    assert (chosen.fallen_back, chosen.unanswered) == (2, 2)


def test_large_ids(spark, skewed):
    train, _ = skewed
    far = train.select((F.col("user") + 3_000_000_000).alias("user"), (F.col("item") + 3_000_000_000).alias("item"), "rating")
    model = LibraryAls(rank=2, epochs=2).fit(far)
    pairs = far.select("user", "item")
    assert model.transform(pairs).count() == pairs.count() and model.recommend(2).agg(F.min("user")).first()[0] >= 3_000_000_000
    assert model.transform(pairs.withColumn("item", F.lit(5))).count() == 0


def test_all_twelve_models_run_and_blend(spark, split, monkeypatch):
    train, test = split
    quick = {"epochs": 1}
    made = {
        **plan.MODELS,
        "ALS": lambda: LibraryAls(rank=2, **quick), "Co-Clustering": lambda: CoClustering(2, 3, **quick),
        "SVD": lambda: GradientFactors(2, **quick), "SVD++": lambda: GradientFactors(2, implicit=True, **quick),
        "Item-based-KNN-baseline": lambda: Neighbours(90, "item", "baseline", baselines=Baselines(1)),
        "User-based-KNN-baseline": lambda: Neighbours(400, "user", "baseline", baselines=Baselines(1)),
    }
    blend, final = plan.recommend(train.unionByName(test), test.select("user", "item"), made)
    assert blend.subsets.count() == 4095
    assert final.count() == test.count()
    assert {r[0] for r in final.select("Prediction").distinct().collect()} <= {1, 2, 3, 4, 5}


def test_a_split_reads_the_events_once(spark, sf, monkeypatch):
    """Each pass of the split used to read the events and make the ratings anew."""
    from tessella.queries import means

    kept, split = [], means.split_per_user
    monkeypatch.setattr(means, "split_per_user", lambda ratings: kept.append((ratings, ratings.storageLevel.useMemory)) or split(ratings))
    train, test = means.train_test(spark, sf)
    assert kept[0][1] and not kept[0][0].storageLevel.useMemory
    assert train.count() + test.count() == kept[0][0].count()
