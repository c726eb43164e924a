"""A workflow that breaks and is started again."""

import pytest
from pyspark.sql import functions as F

from tessella.operators.means import EntityMean, GlobalMean
from tessella.operators.neighbours import Neighbours
from tessella.plans.recommend import predict_all, recommend
from tessella.plans.stages import Manifest, digest, settings
from tessella.session import scratch_path

FITTED = []


class Counted(EntityMean):
    """A model that notes its training, and may not survive it."""

    def __init__(self, name, key, breaks=False):
        super().__init__(key, fallback=True)
        self.name, self._breaks = name, breaks

    def fit(self, ratings):
        if self._breaks and len(FITTED) >= 5:
            raise RuntimeError("the driver is lost")
        FITTED.append(self.name)
        return super().fit(ratings)


def twelve(breaks):
    made = {f"m{k}": (lambda k=k: Counted(f"m{k}", "user" if k % 2 else "item", breaks)) for k in range(12)}
    return made


@pytest.fixture()
def folder(spark):
    return scratch_path(spark, "test-stages")


def test_a_broken_run_goes_on_with_what_is_missing(spark, split, folder, monkeypatch):
    monkeypatch.setattr("tessella.plans.recommend.settings", lambda m: f"{m.name} {m.key}")  # whether it breaks is no setting
    train, test = split
    FITTED.clear()
    with pytest.raises(RuntimeError):
        predict_all(train, test, twelve(True), Manifest(spark, folder))
    assert FITTED == [f"m{k}" for k in range(5)]
    FITTED.clear()
    again = Manifest(spark, folder)
    got = predict_all(train, test, twelve(False), again)
    assert FITTED == [f"m{k}" for k in range(5, 12)] and len(again.made) == 7
    want = predict_all(train, test, twelve(False))
    both = [{(r.model, r.user, r.item): r.prediction for r in t.collect()} for t in (got, want)]
    assert both[0] == both[1] and len(both[0]) == 12 * test.count()
    # other ratings or pairs are other stages
    FITTED.clear()
    predict_all(train.where("item > 3"), test, {"m1": twelve(False)["m1"]}, again)
    predict_all(train, test.where("item > 3"), {"m1": twelve(False)["m1"]}, again)
    predict_all(train, test, {"m1": twelve(False)["m1"]}, again)
    assert FITTED == ["m1", "m1"]
    again.remove()
    assert not Manifest(spark, folder).done


def test_settings_and_digests_tell_inputs_apart(spark):
    assert settings(Neighbours(5, "item")) != settings(Neighbours(6, "item")) != settings(Neighbours(6, "user"))
    assert settings(Neighbours(5, "item")) == settings(Neighbours(5, "item"))
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert digest(rows) == digest(rows.orderBy(F.col("k").desc())) != digest(rows.where("k = 1"))
    assert digest(rows.limit(0)) == "0:None"


def test_the_whole_workflow_resumes(spark, split, folder):
    train, test = split
    models = {"User-Mean": lambda: EntityMean("user", fallback=True), "Global": lambda: GlobalMean()}
    first = recommend(train, test, models, folder=folder)[1].collect()
    before = Manifest(spark, folder)
    assert len(before.done) == 4
    assert sorted(recommend(train, test, models, folder=folder)[1].collect()) == sorted(first)
    assert len(Manifest(spark, folder).done) == 4
