import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import gram
from tessella.operators import linear as lm
from tessella.plans.tabular import Experiment, Preparation, SegmentedRidge, SegmentPlan
from tessella.queries.scan import nulled
from tessella.sources import views

COLS = ["bias", "a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 3))])
    z = x @ np.array([0.3, 1.0, -2.0, 0.5]) + rng.normal(size=400)
    y = np.where(z > 0, 1.0, -1.0)
    df = spark.createDataFrame([(i, *map(float, r), float(t), float(t > 0)) for i, (r, t) in enumerate(zip(x, y))],
                               "id BIGINT, bias DOUBLE, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE, y01 DOUBLE").repartition(4).cache()
    return df, x, y


def test_closed_forms(data):
    df, x, y = data
    m = lm.moments_of(df, COLS)
    w = np.linalg.solve(x.T @ x, x.T @ y)
    ls = lm.least_squares(m, COLS)
    assert np.allclose(ls.w, w) and ls.loss == pytest.approx(np.mean((y - x @ w) ** 2) / 2)
    w = np.linalg.solve(x.T @ x + 2 * 400 * 0.1 * np.eye(4), x.T @ y)
    rd = lm.ridge(m, COLS, 0.1)
    assert np.allclose(rd.w, w) and rd.loss == pytest.approx(np.sqrt(np.mean((y - x @ w) ** 2)))


def test_descent_equals_the_row_by_row_form(data):
    df, x, y = data
    w, losses = np.zeros(4), []
    for _ in range(40):
        e = y - x @ w
        losses.append(np.mean(e ** 2) / 2)
        w = w + 0.1 * x.T @ e / 400
    got = lm.descend(lm.moments_of(df, COLS), COLS, np.zeros(4), 40, 0.1)
    assert np.allclose(got.w, w) and got.loss == pytest.approx(losses[-1])
    assert all(b <= a for a, b in zip(losses, losses[1:]))


@pytest.mark.parametrize("wide", [2, 99])
@pytest.mark.parametrize("newton", [False, True])
def test_logistic_on_both_paths(data, monkeypatch, wide, newton):
    monkeypatch.setattr(lm, "WIDE", wide)
    df, x, y = data
    y = (y > 0).astype(float)
    lam, gamma = 2.0, 0.5 if newton else 0.002
    w = np.zeros(4)
    for _ in range(4):
        s = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (s - y) + lam * w
        w = w - gamma * (np.linalg.solve((x.T * (s * (1 - s))) @ x + lam * np.eye(4), g) if newton else g)
    got = lm.logistic(df, COLS, "y01", np.zeros(4), 4, gamma, lam=lam, newton=newton)
    z = x @ w
    assert np.allclose(got.w, w)
    assert got.loss == pytest.approx(np.sum(np.log1p(np.exp(z))) - y @ z + lam / 2 * w @ w)


def test_logistic_stops(data):
    df, _, _ = data
    got = lm.logistic(df, COLS, "y01", np.zeros(4), 50, 1.0, newton=True, stop=lm.STOP_BELOW)
    assert got.steps < 15


def test_singular_system_gets_the_minimum_norm_answer():
    a = np.array([[1.0, 1.0], [1.0, 1.0]])
    assert np.allclose(gram.solve(a, np.array([2.0, 2.0])), [1.0, 1.0])


@pytest.mark.parametrize("family,params", [("least", {}), ("ridge", {"lam": 0.1}), ("gd", {"gamma": 0.1}), ("sgd", {"gamma": 0.01}),
                                           ("logistic", {"gamma": 1e-4}), ("logistic_l2", {"gamma": 1e-4, "lam": 1.0})])
def test_every_family_runs(spark, sf, family, params):
    table = nulled(spark, sf)
    exp = Experiment(family, ["f0", "f1", "f3"], ratio=0.8, params=params, steps=8)
    out = exp.run(table)
    assert 0.5 < out.accuracy <= 1.0 and np.isfinite(out.error)
    got = exp.predict(out, table)
    assert got.columns == ["Id", "Prediction"] and got.count() == table.count()
    assert {r[0] for r in got.select("Prediction").distinct().collect()} <= {-1, 1}


def test_tuning_picks_the_least_error_and_ignores_divergence(spark, sf):
    table = nulled(spark, sf)
    out = Experiment("gd", ["f0", "f1"], folds=3, ranges={"gamma": [0.01, 0.5, 1e200]}, steps=20).run(table)
    errors = [t["error"] for t in out.trials]
    assert out.error == np.nanmin([e for e in errors if np.isfinite(e)])
    assert not np.isfinite(errors[2])


def test_validation_arguments():
    for bad in ({"ratio": 1.0}, {"folds": 1}, {}, {"ratio": 0.5, "folds": 2}):
        with pytest.raises(ValueError):
            Experiment("least", ["f0"], **bad)


def test_preparation_uses_train_statistics_unless_refit(spark):
    train = spark.createDataFrame([(1, 0.0), (2, 2.0)], "id INT, f0 DOUBLE")
    test = spark.createDataFrame([(1, 4.0), (2, None)], "id INT, f0 DOUBLE")
    prep = Preparation(["f0"], missing="median").fit(train)
    assert [r["f0_p1"] for r in prep.transform(test).orderBy("id").collect()] == [3.0, 0.0]
    assert [r["f0_p1"] for r in prep.transform(test, refit=True).orderBy("id").collect()] == [0.0, 0.0]


def test_segments_equal_separate_fits(spark, sf):
    plans = {0: SegmentPlan(["f0"], 2, 0.2), 1: SegmentPlan(["f0", "f3"], 1, 0.1), 2: SegmentPlan(["f0", "f3", "f5"], 1, 0.2)}
    table = nulled(spark, sf).fillna(0.0, views.FEATURES)
    model = SegmentedRidge(F.least(F.col("f2").cast("int"), F.lit(2)), plans).fit(table)
    rows = model.rows.where("is_train").toPandas()
    for s, p in plans.items():
        mine = rows[rows["_seg"] == s]
        own = ["bias", *[f"{c}_p{d}" for c in p.cols for d in range(1, p.degree + 1)]]
        x, y = mine[own].to_numpy(), mine["y"].to_numpy()
        assert np.allclose(model.models[s].w, np.linalg.solve(x.T @ x + 2 * len(x) * p.lam * np.eye(len(own)), x.T @ y))
    assert model.predict(table).count() == table.count()
    overall = {r["is_train"]: r["accuracy"] for r in model.overall().collect()}
    assert 0.5 < overall[True] <= 1.01 and 0.5 < overall[False] <= 1.05


@pytest.mark.parametrize("switch", [0, 1000])
def test_rows_with_gaps_take_no_part_on_either_path(spark, monkeypatch, switch):
    monkeypatch.setattr(gram, "NARROW", switch)
    monkeypatch.setattr(lm, "WIDE", switch)
    rng = np.random.default_rng(3)
    x, gone = rng.normal(size=(300, 3)), rng.random((300, 3)) < 0.3
    y = np.where(x[:, 0] + rng.normal(size=300) > 0, 1.0, 0.0)
    rows = [(i, *[None if g else float(v) for v, g in zip(r, m)], float(t)) for i, (r, m, t) in enumerate(zip(x, gone, y))]
    df = spark.createDataFrame(rows, "id BIGINT, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE").repartition(3)
    own = ~gone.any(axis=1)
    cx, cy = x[own], y[own]
    m = lm.moments_of(df, list("abc"))
    assert m.n == own.sum() and np.allclose(m.xx, cx.T @ cx) and np.allclose(m.xy, cx.T @ cy)
    w = np.zeros(3)
    for _ in range(3):
        s = 1 / (1 + np.exp(-cx @ w))
        w = w - np.linalg.solve((cx.T * (s * (1 - s))) @ cx, cx.T @ (s - cy))
    assert np.allclose(lm.logistic(df, list("abc"), "y", np.zeros(3), 3, 1.0, newton=True).w, w)
    table = df.select("id", F.when(F.col("y") > 0, "s").otherwise("b").alias("label"), "a", "b", "c")
    out = Experiment("ridge", list("abc"), missing="keep", scale=False, ratio=0.8, params={"lam": 0.01}).run(table)
    assert out.left_out == 300 - own.sum() and out.accuracy > 0.5


def test_the_marker_can_stay_a_value(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0)], "id INT, f0 DOUBLE")
    prep = Preparation(["f0"], missing="marker", scale=False, degree=2).fit(df)
    assert [tuple(r) for r in prep.transform(df).orderBy("id").select("f0_p1", "f0_p2").collect()] == [(-999.0, 998001.0), (2.0, 4.0)]


def test_a_segment_without_a_plan_gets_the_frequent_class(spark):
    rows = [(i, "b" if i % 4 else "s", float(i % 2), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id BIGINT, label STRING, f2 DOUBLE, f0 DOUBLE")
    model = SegmentedRidge(F.col("f2").cast("int"), {0: SegmentPlan(["f0"], 1, 0.1), 1: SegmentPlan(["f0"], 1, 0.1)}).fit(df)
    other = spark.createDataFrame([(99, 7.0, 1.0), (98, None, 1.0)], "id BIGINT, f2 DOUBLE, f0 DOUBLE")
    assert {r["Prediction"] for r in model.predict(other).collect()} == {-1}


@pytest.mark.parametrize("newton", [False, True])
def test_a_grid_moves_as_its_settings_do_alone(spark, data, newton):
    df, _, _ = data
    rows = df.withColumn("_held", (F.col("id") % 3).cast("int"))
    settings = [(g, lam, h) for g in (0.002, 0.01) for lam in (0.0, 2.0) for h in (0, 1, -1)]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = lm.logistic_grid(rows, COLS, "y01", np.zeros(4), 3, settings, "_held", newton=newton, stop=1e-8)
    jobs = len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before))
    assert jobs <= 2 * 4 + 2  # passes, not settings
    for (g, lam, h), (m, inside) in list(zip(settings, got))[::2]:
        alone = lm.logistic(rows.where(F.col("_held") != h), COLS, "y01", np.zeros(4), 3, g, lam=lam, newton=newton, stop=1e-8)
        assert np.allclose(m.w, alone.w) and m.loss == pytest.approx(alone.loss) and m.steps == alone.steps
        assert (inside > 0) == (h >= 0)


@pytest.mark.parametrize("batch,steps", [(1, 10_000), (16, 40)])
def test_step_maps_are_the_steps_one_after_another(data, batch, steps):
    df, x, y = data
    drawn = lm.draw_rows(df, COLS, "y", steps, batch=batch).toPandas().sort_values("_step", kind="stable")
    assert (drawn.groupby("_step").size() == batch).all() and drawn["_step"].nunique() == steps
    got = lm.descend_stochastic(df, COLS, "y", np.ones(4), steps, [0.003, 0.02], batch=batch)
    for gamma, model in zip((0.003, 0.02), got, strict=True):
        w = np.ones(4)
        for _, rows in drawn.groupby("_step"):
            a, t = rows[COLS].to_numpy(), rows["y"].to_numpy()
            loss = np.mean((t - a @ w) ** 2) / 2
            w = w - gamma * a.T @ (a @ w - t) / batch
        assert np.allclose(model.w, w, rtol=1e-9, atol=1e-12) and model.loss == pytest.approx(loss)
    assert np.mean((y - x @ got[1].w) ** 2) < np.mean((y - x @ np.ones(4)) ** 2)


def test_step_maps_compose_in_order(data, monkeypatch):
    df, _, _ = data
    whole = lm.descend_stochastic(df, COLS, "y", np.zeros(4), 300, [0.01])[0].w
    monkeypatch.setattr(lm, "STEP_FAN_IN", 2)  # a tree of several floors
    assert np.allclose(lm.descend_stochastic(df, COLS, "y", np.zeros(4), 300, [0.01])[0].w, whole)
    one = lm.descend_stochastic(df, COLS, "y", np.zeros(4), 1, [0.01])[0]
    assert one.steps == 1 and np.isfinite(one.loss)


def test_thresholds_of_many_groups_in_as_many_jobs_as_of_few(spark, monkeypatch):
    from tessella.functions.scalars import digest
    from tessella.operators import ranking

    monkeypatch.setattr(ranking, "SMALL", 40)
    jobs = []
    for groups in (3, 10_000):
        # one large group, the others of one to three rows, and rows without a group
        rows = spark.range(30_000).select("id", F.when(F.col("id") < 8000, 0).when(F.col("id") < 8100, None)
                                          .otherwise(1 + F.col("id") % (groups - 1)).alias("g")).persist()
        rows.count()
        before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
        limits = ranking.grouped_thresholds(rows, "g", "id", 7, 0.8)
        seen = limits.toPandas()
        jobs.append(len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)))
        placed = rows.withColumn("h", digest(7, "id")).join(limits.withColumnRenamed("g", "of"), F.col("g").eqNullSafe(F.col("of")))
        got = placed.groupBy("of").agg(F.count("*").alias("n"), F.count_if(F.col("h") < F.col("limit")).alias("below")).toPandas()
        assert len(seen) == len(got) and (got["below"] == np.floor(0.8 * got["n"])).all() and got["n"].sum() == 30_000
        rows.unpersist()
    assert jobs[1] <= jobs[0] + 2


def test_a_model_for_each_of_a_thousand_segments(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 1000).cast("int").alias("s"), (F.col("id") / 7 % 1).alias("f0")) \
        .withColumn("label", F.when((F.col("f0") > 0.5) == (F.col("s") % 2 == 0), "s").otherwise("b"))
    plans = {s: SegmentPlan(["f0"], 1, 1e-6) for s in range(1000)}
    model = SegmentedRidge(F.col("s"), plans).fit(df)
    assert model.accuracies().count() == 2000
    hits = model.accuracies().agg(F.sum(F.col("n") * F.col("accuracy")) / F.sum("n")).first()[0]
    assert hits > 0.85
