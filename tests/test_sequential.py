"""Sequential factor models, routed ALS and the search over unrated items against plain NumPy programs."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import factors, strata, topn
from tessella.operators.factors import WeightedAls
from tessella.operators.strata import SequentialFactors
from tessella.operators.topn import search_blocks, top_unrated


def rmse(model, test):
    return model.transform(test).agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]


def start_of(model, train):
    """The first factors, as the model draws them."""
    model.mu = train.agg(F.avg("rating")).first()[0] if model.biased else 0.0
    names = [f"f{k}" for k in range(model.rank)]
    return [{r[0]: (np.array(r[1:-1]), r[-1]) for r in model._start(train, key).select(key, *names, "b").collect()}
            for key in ("user", "item")]


def run_in_order(model, train):
    """One rating after another, by the hash of (user, item), in plain Python."""
    p, q = start_of(model, train)
    line = sorted(((int(hashlib.md5(f"{model.seed}:{r.user}:{r.item}".encode()).hexdigest()[:15], 16), r.user, r.item, r.rating)
                   for r in train.collect()))
    gamma = model.gamma
    for _ in range(model.epochs):
        gamma /= model.decay
        for _, u, i, r in line:
            (pu, bu), (qi, bi) = p[u], q[i]
            e = r - (model.mu + bu + bi + pu @ qi)
            new = qi + gamma * (e * pu - model.reg[strata.ITEM] * qi)
            pu = pu + gamma * (e * (qi if model.biased else new) - model.reg[strata.USER] * pu)
            if model.biased:
                bu, bi = bu + gamma * (e - model.reg[strata.USER] * bu), bi + gamma * (e - model.reg[strata.ITEM] * bi)
            p[u], q[i] = (pu, bu), (new, bi)
    return p, q


def test_one_block_is_the_sequential_program(split):
    train, test = split
    for model in (SequentialFactors(4, 7, 0.01, 0.05), SequentialFactors.plain(rank=5, epochs=3)):
        p, q = run_in_order(model, train)
        model.fit(train)
        for r in model.transform(test).collect():
            if r.user in p and r.item in q:
                want = model.mu + p[r.user][1] + q[r.item][1] + p[r.user][0] @ q[r.item][0]
                assert abs((min(max(want, 1), 5) if model.biased else want) - r.prediction) < 1e-9


def test_real_settings_within_a_hundredth_of_the_sequential_program(split):
    """400 epochs of rank 10, in one block and in three: the order of the ratings differs, the model doesn't."""
    train, test = split
    plain = SequentialFactors(10, 400, 0.0002, 0.009)
    p, q = run_in_order(plain, train)
    rows = [r for r in test.collect() if r.user in p and r.item in q]
    want = np.sqrt(np.mean([(min(max(plain.mu + p[r.user][1] + q[r.item][1] + p[r.user][0] @ q[r.item][0], 1), 5) - r.rating) ** 2
                            for r in rows]))
    both = test.join(train.select("user").distinct(), "user").join(train.select("item").distinct(), "item")
    assert abs(rmse(SequentialFactors(10, 400, 0.0002, 0.009).fit(train), both) - want) < 1e-6
    blocked = SequentialFactors(10, 12, 0.006, 0.009, blocks=3).fit(train)
    assert abs(rmse(blocked, both) - rmse(SequentialFactors(10, 12, 0.006, 0.009).fit(train), both)) < 0.01


def test_levels_keep_the_order_and_share_no_row():
    rng = np.random.default_rng(1)
    users, items = rng.integers(0, 20, 500), rng.zipf(1.4, 500) % 30
    order, cuts = strata.levels(users, items)
    place = np.empty(500, int)
    place[order] = np.arange(500)
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        part = order[lo:hi]
        assert len(set(users[part])) == len(part) == len(set(items[part]))
    for same in (users, items):
        for key in set(same):
            assert (np.diff(place[np.flatnonzero(same == key)]) > 0).all()


def test_strata_cover_every_block_once_and_leave_ratings_in_place(spark, split):
    train, _ = split
    model = SequentialFactors(3, 1, 0.01, 0.01, blocks=5)
    model.fit(train)
    layout = strata.lay_out(train, 5, 988)
    met = [(r.slot, r.block) for r in layout.select("slot", "block").collect()]
    assert len(met) == len(set(met)) <= 25
    assert {(b, (b + s) % 5) for b in range(5) for s in range(5)} >= set(met)
    columns = ["f0", "f1", "f2", "b"]
    state = strata._packed(model.users, "user", 0, 5, columns).unionByName(strata._packed(model.items, "item", 1, 5, columns))
    plan = model._stratum(layout, state, 5, 2, [0.01])._jdf.queryExecution().executedPlan().toString()
    left = plan.split("InMemoryTableScan")[0]
    assert "Exchange" not in left.split("FlatMapCoGroups")[1]
    layout.unpersist()


def test_sequential_edges(spark):
    one = spark.createDataFrame([(1 << 40, 2, 3.0)], "user long, item long, rating double")
    model = SequentialFactors(2, 2, 0.01, 0.01, blocks=2).fit(one)
    assert model.transform(one).count() == 1 and model.users.first()[0] == 1 << 40
    same = spark.createDataFrame([(k, 0, float(1 + k % 5)) for k in range(50)], "user int, item int, rating double")
    hot = SequentialFactors(2, 2, 0.01, 0.01, blocks=3, implicit=True).fit(same)
    assert hot.transform(same).where("prediction is null").count() == 0 and hot.items.count() == 1


def test_implicit_vectors_learn(split):
    train, test = split
    known = test.join(train.select("user").distinct(), "user").join(train.select("item").distinct(), "item")
    model = SequentialFactors(3, 5, 0.01, 0.02, implicit=True, blocks=2).fit(train)
    assert rmse(model, train) < rmse(SequentialFactors(3, 0, 0.01, 0.02, implicit=True).fit(train), train)
    assert known.count() and model.transform(known).where("prediction is null").count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_routed_half_steps_equal_broadcast_ones(spark, split, monkeypatch, hot):
    train, test = split
    want = {(r.user, r.item): r.prediction for r in WeightedAls(3, stop=0.0, max_sweeps=2).fit(train).transform(test).collect()}
    monkeypatch.setattr(factors, "_is_small", lambda rows, width: False)
    if hot:
        monkeypatch.setattr(factors, "TASK_ROWS", 20)
    model = WeightedAls(3, stop=0.0, max_sweeps=2).fit(train)
    got = {(r.user, r.item): r.prediction for r in model.transform(test).collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and abs((got[k] or 0) - (want[k] or 0)) < 1e-8 for k in want)


def test_half_step_moves_no_rating(spark, split, monkeypatch):
    train, _ = split
    monkeypatch.setattr(factors, "_is_small", lambda rows, width: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        model = WeightedAls(2, stop=0.0, max_sweeps=1).fit(train)
        layout = model._routed(train, model.users, "user")
        plan = model._solved(layout, "user", "item", model.items, model.n_items, 0.1)._jdf.queryExecution().executedPlan().toString()
        ratings = plan.split("FlatMapCoGroups")[1].split("InMemoryTableScan")[0]
        assert "_ratings" in plan and "Exchange" not in ratings
        sent = layout[1].count()  # a factor for each block that needs it, not for each rating
        assert sent <= train.count() and sent == layout[1].distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


class Known:
    """A model of given factors."""

    def __init__(self, spark, p, q, first_user=0):
        self.rank = p.shape[1]
        names = ", ".join(f"f{k} double" for k in range(self.rank))
        self.users = spark.createDataFrame([(first_user + u, *map(float, v)) for u, v in enumerate(p)], f"user long, {names}")
        self.items = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(q)], f"item int, {names}")


def plain_top(p, q, rated, n, first_user=0):
    out = set()
    for u, v in enumerate(p):
        s = q @ v
        order = sorted((i for i in range(len(q)) if (first_user + u, i) not in rated), key=lambda i: (-round(s[i], 9), i))
        out |= {(first_user + u, i, k + 1) for k, i in enumerate(order[:n])}
    return out


@pytest.mark.parametrize("wave_bytes", [1 << 26, 8 * 8 * 50])
def test_top_items_equal_all_scores_and_skip_tiles(spark, monkeypatch, wave_bytes):
    monkeypatch.setattr(topn, "TILE", 16)
    rng = np.random.default_rng(2)
    p = rng.normal(0, 1, (70, 4))
    q = rng.normal(0, 1, (300, 4)) * (rng.pareto(1.5, (300, 1)) + 0.05)  # few long vectors
    rated = {(int(u), int(i)) for u, i in zip(rng.integers(0, 70, 2000), rng.integers(0, 300, 2000), strict=True)}
    rated |= {(5, i) for i in range(297)} | {(6, i) for i in range(300)} | {(999, 1), (1, 9999)}
    model = Known(spark, p, q)
    table = spark.createDataFrame(sorted(rated), "user long, item int")
    got = {(r.user, r.item, r.place) for r in top_unrated(model, table, 5, wave_bytes).collect()}
    assert got == plain_top(p, q, rated, 5)
    assert len([g for g in got if g[0] == 5]) == 3 and not [g for g in got if g[0] == 6]
    easy = table.where("user not in (5, 6)")  # a user with fewer open items than n needs them all
    read = search_blocks(Known(spark, p[7:], q, 7), easy, 5, wave_bytes).agg(F.sum("tiles"), F.count("*")).first()
    assert read[0] < 19 * read[1]


def test_top_items_of_equal_scores(spark):
    p, q = np.ones((3, 2)), np.ones((40, 2))
    got = {(r.user, r.item, r.place) for r in top_unrated(Known(spark, p, q), spark.createDataFrame([(0, 0)], "user long, item int"), 4).collect()}
    assert got == plain_top(p, q, {(0, 0)}, 4)
    none = spark.createDataFrame([], "user long, item int")
    assert top_unrated(Known(spark, p, q), none, 4).count() == 12


def test_top_items_of_a_model_with_offsets(split):
    train, _ = split
    model = SequentialFactors(3, 5, 0.01, 0.02).fit(train)
    best = top_unrated(model, train, 3)
    pairs = best.select("user", "item")
    again = {(r.user, r.item): r.prediction for r in model.raw(pairs).collect()}
    assert all(abs(again[r.user, r.item] - r.prediction) < 1e-9 for r in best.collect())
    assert best.join(train, ["user", "item"]).count() == 0
