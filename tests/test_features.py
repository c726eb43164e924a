import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions import scalars as fn
from tessella.operators import features as ft
from tessella.operators import gram, metrics
from tessella.operators.tuning import grid, steps
from tessella.operators import tuning
from tessella.sources import features as fs
from tessella.sources import ratings as rs
from tessella.session import scratch_path


def _one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_scalar_edges(spark):
    assert _one(spark, fn.sigmoid(F.lit(2000.0))) == 1.0
    assert _one(spark, fn.sigmoid(F.lit(-2000.0))) == 0.0
    assert _one(spark, fn.softplus(F.lit(2000.0))) == 2000.0
    assert _one(spark, fn.class_label(F.lit(0.0))) == -1.0
    assert _one(spark, fn.class_label(F.lit(0.5), logistic=True)) == 0.0
    assert math.isnan(_one(spark, fn.class_label(F.lit(float("nan")))))
    assert [_one(spark, fn.star(F.lit(v))) for v in (2.5, 3.5, 0.2, 6.7)] == [2.0, 4.0, 1.0, 5.0]
    assert _one(spark, fn.star(F.lit(None).cast("double"))) is None


def test_log_loss_is_finite_and_matches_the_plain_form(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, -1.5), (1.0, -0.3)], "y DOUBLE, z DOUBLE")
    got = df.agg(metrics.log_loss(F.col("y"), F.col("z"))).first()[0]
    y, z = np.array([1, 0, 1.0]), np.array([2, -1.5, -0.3])
    assert got == pytest.approx(np.sum(np.log(1 + np.exp(z))) - y @ z)
    far = spark.createDataFrame([(1.0, 2000.0), (0.0, 2000.0)], "y DOUBLE, z DOUBLE")
    assert far.agg(metrics.log_loss(F.col("y"), F.col("z"))).first()[0] == 2000.0


@pytest.fixture()
def gaps(spark):
    rows = [(1, 1.0, None, 5.0, None), (2, 2.0, None, 5.0, 1.0), (3, 4.0, None, 5.0, None), (4, 9.0, None, 5.0, 3.0)]
    return spark.createDataFrame(rows, "id INT, a DOUBLE, none DOUBLE, same DOUBLE, b DOUBLE")


def test_repair_edges(gaps):
    cols = ["a", "none", "same", "b"]
    got = ft.impute_median(gaps, cols).orderBy("id").toPandas()
    assert got["b"].tolist() == [2.0, 1.0, 2.0, 3.0]
    assert got["none"].isna().all()
    scaled = ft.standardise(gaps, cols).orderBy("id").toPandas()
    assert scaled["same"].tolist() == [0.0] * 4 and scaled["none"].tolist() == [0.0] * 4
    assert scaled["b"].tolist() == [0.0, -1.0, 0.0, 1.0]
    assert scaled["a"].tolist() == pytest.approx(((np.array([1, 2, 4, 9]) - 4) / np.std([1, 2, 4, 9])).tolist())
    _, kept = ft.drop_incomplete(gaps, cols)
    assert kept == ["a", "same"]


def test_indicators_by_count_and_by_mask(spark):
    df = spark.createDataFrame([(1, None, 1.0, None), (2, 1.0, None, None), (3, 1.0, 1.0, 1.0)], "id INT, a DOUBLE, b DOUBLE, c DOUBLE")
    rows, names = ft.missing_indicators(df, ["a", "b", "c"])
    assert names == ["has_a", "has_c"]
    assert [tuple(r) for r in rows.orderBy("id").select(*names).collect()] == [(0, 0), (1, 0), (1, 1)]
    assert ft.missing_indicators(df, ["a", "b", "c"], by_mask=True)[1] == ["has_a", "has_b", "has_c"]


def test_expansion_order(gaps):
    _, names = ft.expand_powers(gaps, ["a", "b"], 3)
    assert names == ["bias", "a_p1", "a_p2", "a_p3", "b_p1", "b_p2", "b_p3"]
    _, odd = ft.expand_powers(gaps, ["a"], 4, bias=False, odd_only=True)
    assert odd == ["a_p1", "a_p3"]
    _, one = ft.expand_one(gaps, ["a", "b"], "a", 2)
    assert one == ["a_p1", "a_p2", "b"]


@pytest.mark.parametrize("narrow", [0, 1000])
def test_moments_on_both_paths(spark, monkeypatch, narrow):
    monkeypatch.setattr(gram, "NARROW", narrow)
    rng = np.random.default_rng(1)
    x, y, g = rng.normal(size=(200, 4)), rng.normal(size=200), rng.integers(0, 3, 200)
    df = spark.createDataFrame([(*map(float, r), float(t), int(k)) for r, t, k in zip(x, y, g)],
                               "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, y DOUBLE, g INT").repartition(5)
    by = gram.moments(df, list("abcd"), "y", by="g")
    for k, m in by.items():
        assert np.allclose(m.xx, x[g == k].T @ x[g == k]) and np.allclose(m.xy, x[g == k].T @ y[g == k])
        assert m.n == (g == k).sum()
    whole = gram.moments(df, list("abcd"), "y")[None]
    assert np.allclose(sum((by[k] for k in (1, 2)), by[0]).xx, whole.xx)
    w = rng.normal(size=4)
    assert whole.sse(w) == pytest.approx(np.sum((y - x @ w) ** 2))
    weighted = {(r["i"], r["j"]): r["v"] for r in gram.moment_cells(df, list("abcd"), weight="y").collect()}
    assert weighted[1, 2] == pytest.approx(np.sum(x[:, 1] * x[:, 2] * y))


def test_ranges(spark):
    assert steps("1:3:1", int) == [1, 2, 3]
    assert steps("0.1:0.5:0.1") == pytest.approx([0.1, 0.2, 0.3, 0.4, 0.5])
    assert grid({"a": [1, 2], "b": None, "c": [3]}) == [{"a": 1, "c": 3}, {"a": 2, "c": 3}]
    assert np.allclose(tuning.RIDGE_LAMBDAS, np.logspace(-12, -1, 20))


def test_rating_text_round_trip(spark):
    up = spark.createDataFrame([("r007_c1", 4.0), ("r44_c10", 2.0)], "Id STRING, Prediction DOUBLE")
    rows = rs.normalise(up)
    assert sorted(map(tuple, rows.collect())) == [(6, 0, 4.0), (43, 9, 2.0)]
    assert sorted(map(tuple, rs.denormalise(rows).collect())) == [("r44_c10", 2), ("r7_c1", 4)]
    swapped = rs.normalise(up, row="item", col="user")
    assert sorted(map(tuple, swapped.collect())) == [(0, 6, 4.0), (9, 43, 2.0)]
    assert rs.denormalise(spark.createDataFrame([(0, 0, 3.9)], "user INT, item INT, rating DOUBLE")).first()["Prediction"] == 3


def test_files_round_trip(spark):
    rows = rs.from_tuples(spark, [(1, 2, 3.5), (4, 5, 1.0)])
    path = scratch_path(spark, "t")
    rs.write_triplets(rows, path)
    assert sorted(map(tuple, rs.read_triplets(spark, path).collect())) == [(1, 2, 3.5), (4, 5, 1.0)]
    for name in ("SVD++", "Z-Score"):
        rs.write_triplets(rows, f"{path}-p/{name}.csv")
    got = rs.read_prediction_files(spark, f"{path}-p").collect()
    assert {r["model"] for r in got} == {"SVD++", "Z-Score"} and len(got) == 4
    labelled = spark.createDataFrame([(1, "s", 0.5, -999.0), (2, "b", -999.0, 1.0)], "id BIGINT, label STRING, f0 DOUBLE, f1 DOUBLE")
    labelled.write.csv(f"{path}-f", header=True)
    back = fs.missing_to_null(fs.read_labelled_csv(spark, f"{path}-f", 2), ["f0", "f1"]).orderBy("id")
    assert [tuple(r) for r in back.collect()] == [(1, "s", 0.5, None), (2, "b", None, 1.0)]
    fs.write_submission(fs.submission(back.withColumn("prediction", F.lit(0.0))), f"{path}-s")
    assert sorted(map(tuple, spark.read.csv(f"{path}-s", header=True, schema="Id INT, Prediction INT").collect())) == [(1, -1), (2, -1)]


def test_last_write_wins_and_zero_is_missing(spark):
    log = spark.createDataFrame([(1, 1, 5.0, 1), (1, 1, 2.0, 2), (1, 2, 4.0, 1), (1, 2, 0.0, 3)], "user INT, item INT, rating DOUBLE, seq INT")
    assert [tuple(r) for r in rs.last_write(log, "seq").collect()] == [(1, 1, 2.0)]
