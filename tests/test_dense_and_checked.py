"""Fused neighbourhoods against the kept table of similarities, and scans of damaged files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import dense
from tessella.operators.neighbours import Baselines, Neighbours
from tessella.operators.tiles import Grid
from tessella.session import scratch_path
from tessella.sources.checked import read_checked, read_labelled_checked, read_ratings_checked


@pytest.mark.parametrize("style", ["means", "zscore", "baseline"])
@pytest.mark.parametrize("entity,k,blocks", [("user", 4, 3), ("item", 50, 2), ("item", 3, 1)])
def test_fused_scores_equal_those_of_the_kept_table(split, monkeypatch, style, entity, k, blocks):
    train, test = split
    monkeypatch.setattr(dense, "SLICE", 7)
    answers = []
    for cells in (2_000_000, -1):
        monkeypatch.setattr(dense, "BLOCK_CELLS", cells)
        model = Neighbours(k, entity, style, baselines=Baselines(1), grid=Grid(blocks, 2)).fit(train)
        assert model.fused == (cells > 0) and hasattr(model, "links") != model.fused
        answers.append({(r.user, r.item): r.prediction for r in model.transform(test).collect()})
    assert answers[0].keys() == answers[1].keys()
    assert all(abs(answers[0][p] - answers[1][p]) < 1e-9 for p in answers[0])


def test_fused_plan_writes_no_table_of_pairs(split):
    train, test = split
    model = Neighbours(5, "item", grid=Grid(1, 1)).fit(train)
    plan = model.transform(test)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1 and "Window" not in plan


def written(spark, lines):
    path = scratch_path(spark, "test-damaged")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_damaged_rows_are_kept_apart(spark):
    lines = ["id,label,f0,f1", "1,b,0.5,1", "2,s,,2", "x,b,1,1", "3,b,one,1", "4,s,1", "5,s,1,2,3", ",b,1,1", "6,,1,1", '7,"a,b",1,NaN', ""]
    found = read_labelled_checked(spark, written(spark, lines), 2)
    assert sorted((r.id, r.label, r.f0) for r in found.good.collect()) == [(1, "b", 0.5), (2, "s", None), (7, "a,b", 1.0)]
    bad = sorted(r["_raw"] for r in found.bad.collect())
    assert bad == sorted(["x,b,1,1", "3,b,one,1", "4,s,1", "5,s,1,2,3", ",b,1.0,1.0", "6,,1.0,1.0"])
    assert (found.n_good, found.n_bad) == (3, 6)


def test_damaged_ratings(spark):
    lines = ["Id,Prediction", "r1_c1,5", "r0007_c2,3", "r0_c1,3", "r1-c1,3", "r1_c2,6", "r1_c3,", "r1_c4,four", "r1_c5,4,4", "R1_c1,1"]
    found = read_ratings_checked(spark, written(spark, lines))
    assert sorted((r.user, r.item, r.rating) for r in found.good.collect()) == [(0, 0, 5.0), (6, 1, 3.0)]
    assert (found.n_good, found.n_bad) == (2, 7) and found.bad.count() == 7


def test_an_empty_file_and_a_rule(spark):
    empty = read_checked(spark, written(spark, []), "a INT", header=False)
    assert (empty.n_good, empty.n_bad, empty.good.count()) == (0, 0, 0)
    even = read_checked(spark, written(spark, ["1", "2", "3"]), "a INT", header=False, valid=F.col("a") % 2 == 0)
    assert [r.a for r in even.good.collect()] == [2] and even.n_bad == 2
    assert np.isclose(even.n_good, 1)


@pytest.mark.parametrize("style,entity,k", [("means", "user", 4), ("baseline", "user", 9), ("zscore", "item", 3)])
def test_several_blocks_of_neighbours_give_the_scores_of_one(split, monkeypatch, style, entity, k):
    train, test = split
    monkeypatch.setattr(dense, "SLICE", 7)
    monkeypatch.setattr(dense, "CHUNK", 5)
    monkeypatch.setattr(dense, "STRIP_CELLS", 60)
    answers = []
    for cells in (6_000_000, 200):
        monkeypatch.setattr(dense, "NEAR_CELLS", cells)
        model = Neighbours(k, entity, style, baselines=Baselines(1), grid=Grid(3, 1)).fit(train)
        answers.append({(r.user, r.item): r.prediction for r in model.transform(test).collect()})
    assert answers[0].keys() == answers[1].keys()
    assert all(abs(answers[0][p] - answers[1][p]) < 1e-9 for p in answers[0])


def test_sides_are_sent_by_cores_and_not_by_entities(spark):
    """Each side used to travel once for every 512 entities of the other."""
    cells = spark.range(6000).selectExpr("id % 600 as user", "id div 600 as item", "cast(pmod(hash(id), 5) as double) as r", "cast(id % 3 as double) as x")
    pairs = spark.range(600).selectExpr("id as user", "id % 10 as item")
    got = dense.neighbour_scores(pairs, cells, "user", "item", 3, lambda s: dense.pearson(s, 2), Grid(300, 1))
    plan = got._jdf.queryExecution().executedPlan().toString()
    n = dense.ROUNDS * spark.sparkContext.defaultParallelism
    assert plan.count("repartition_by_num".upper()) == 1 and f", {n})" in plan and "FlatMapGroupsInArrow" in plan
    assert got.count() == 600


def test_equal_weights_count_by_place():
    assert list(dense._best(np.array([0.5, 0.0, 0.7, 0.5, -1.0, 0.5]), 3)) == [0, 2, 3]
    assert list(dense._best(np.array([0.5, 0.0, 0.5]), 3)) == [0, 2]


def test_rows_with_a_null_side_meet_nothing(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(5)]
    schema = "user bigint, item bigint, r double, x double"
    answers = []
    for more in ([], [(None, 1, 3.0, 1.0), (2, None, 4.0, 1.0)]):
        cells = spark.createDataFrame([(u, i, r, r - 3) for u, i, r in rows if (u + i) % 4] + more, schema)
        pairs = spark.createDataFrame([(u, i) for u, i, _ in rows if (u + i) % 4 == 0] + [m[:2] for m in more], "user bigint, item bigint")
        got = dense.neighbour_scores(pairs, cells, "user", "item", 2, lambda s: dense.pearson(s, 2), Grid(2, 1))
        answers.append({(r.user, r.item): (r.num, r.den) for r in got.collect()})
    assert answers[0] and answers[0] == answers[1]


def test_more_neighbours_than_raters_are_final_where_they_are_made(spark):
    """Several blocks used to add up and then rank in a window over the best k of each block for each pair."""
    rows = [(u, i, float((u * i + u) % 5 + 1)) for u in range(12) for i in range(6) if (u + i) % 3]
    cells = spark.createDataFrame([(u, i, r, r - 3) for u, i, r in rows], "user bigint, item bigint, r double, x double")
    pairs = spark.createDataFrame([(u, i) for u in range(12) for i in range(7) if not (u + i) % 3], "user bigint, item bigint")
    got = dense.neighbour_scores(pairs, cells, "user", "item", 900, lambda s: dense.pearson(s, 2), Grid(4, 1))
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    held = {u: {i: r for v, i, r in rows if v == u} for u in range(12)}
    want = {}
    for u, i in pairs.collect():
        num = den = 0.0
        for v in range(12):
            both = [i_ for i_ in held[u] if i_ in held[v]]
            if v != u and i in held[v] and len(both) > 1:
                a, b = (np.array([held[e][i_] for i_ in both]) for e in (u, v))
                if a.std() > 0 and b.std() > 0 and np.corrcoef(a, b)[0, 1] > 1e-9:
                    w = np.corrcoef(a, b)[0, 1]
                    num, den = num + w * (held[v][i] - 3), den + w
        if den:
            want[u, i] = (num, den)
    found = {(r.user, r.item): (r.num, r.den) for r in got.collect()}
    assert want and found.keys() == want.keys() and all(np.allclose(found[p], want[p]) for p in want)


def side(rng, n, top, width=60):
    m = (rng.random((n, width)) < 0.6).astype(float)
    r = m * rng.integers(-top, top + 1, m.shape)
    return dense.Cells(np.arange(n), np.concatenate([[0], np.cumsum(m.sum(1))]).astype(int), np.nonzero(m)[1], r[m > 0], r[m > 0])


@pytest.mark.parametrize("top,dtype", [(2, np.float32), (9, np.float64), (2000, np.float64), (40_000, np.float64)])
def test_whole_ratings_are_added_up_as_digits(monkeypatch, top, dtype):
    """Six sums used to be six products; they are exact whatever fits into a number."""
    rng = np.random.default_rng(3)
    a, b = side(rng, 20, top), side(rng, 30, top)
    digits = dense.Digits.of(a, b)
    made, product = [], dense.Products._product
    monkeypatch.setattr(dense.Products, "_product", lambda self, *pq: made.append(pq) or product(self, *pq))
    column = np.arange(60)
    left, right = a.dense(0, 20, column, 60, digits.dtype), b.dense(0, 30, column, 60, digits.dtype)
    want = {k: left[p].astype(float) @ right[q].astype(float).T for k, (p, q) in dense.Products.SIDES.items()}
    got = dense.Products([digits.left(left)], [digits.right(right)], digits)
    assert all(np.array_equal(got[k], want[k]) for k in ("sij", "si", "n", "sjj", "sii", "sj"))
    assert digits.dtype is dtype and len(made) == (3 if digits.squares else 6) and bool(digits.squares) == (top < 10_000)


def test_pairs_look_for_their_raters_among_the_strongest(spark, monkeypatch):
    """Every pair used to pick its k neighbours from all raters of its item."""
    cells = spark.range(30_000).selectExpr("id div 10 as user", "id % 10 as item", "cast(pmod(hash(id), 5) as double) as r", "cast(pmod(hash(id, 1), 7) as double) as x").where("pmod(hash(id, 2), 3) > 0")
    pairs = spark.range(60).selectExpr("id * 50 as user", "id % 10 as item")
    tile = dense._array_tiles(pairs, cells, "user", "item", 1, 1).drop("t").toArrow().to_batches()
    answers, seen, best = [], [], dense._best
    monkeypatch.setattr(dense, "_best", lambda v, k: seen.append(len(v)) or best(v, k))
    for worth in (dense.WORTH, 1 << 40):
        monkeypatch.setattr(dense, "WORTH", worth)
        got = dense._tile_scores(iter(tile), lambda s: dense.pearson(s, 2), 3, False, (dense.pa.int64(), dense.pa.int64()))
        answers.append(sorted(tuple(r.values()) for b in got for r in b.to_pylist()))
        seen.append(None)
    assert answers[0] == answers[1] and len(answers[0]) == 60
    with_list, without = seen[:seen.index(None)], seen[seen.index(None) + 1:-1]
    assert min(without) > 1500 and sum(with_list) < sum(without) / 4


def test_too_few_raters_among_the_strongest():
    row, raters, place = np.array([0.9, 0.8, 0.7, 0.3, 0.2, 0.1]), np.array([1, 3, 4, 5]), np.array([9, 0, 9, 1, 2, 3])
    for strong in ([0, 1, 2], [0, 1, 2, 3], [0, 1, 2, 3, 4, 5], []):
        assert list(dense._among(row, np.array(strong, int), raters, place, 2)) == [0, 1]
    assert list(dense._strongest(np.array([0.0, 0.5, 0.0, 0.2]), 3)) == [1, 3]


@pytest.mark.parametrize("style,rating", [("means", "tinyint"), ("zscore", "tinyint"), ("baseline", "double")])
def test_neighbours_travel_in_narrow_arrays_without_their_values(split, style, rating):
    """Others, ratings and averaged values used to travel as eight bytes each."""
    train, test = split
    model = Neighbours(900, "user", style, baselines=Baselines(1), grid=Grid(3, 1)).fit(train)
    assert model.cells.columns == ["user", "item", "r"]
    tile = dense._array_tiles(test.select("user", "item"), model.cells, "user", "item", 2, 1, units=model.units)
    assert {c: t for c, t in tile.dtypes if c in "orx"} == {"o": "array<tinyint>", "r": f"array<{rating}>", "x": "array<double>"}
    assert {r.n for r in tile.where("kind = 1").selectExpr("size(x) as n").distinct().collect()} == {0 if style == "baseline" else 2}


@pytest.mark.parametrize("item,unit,kinds", [(1, 1.0, ("tinyint", "tinyint")), (-5_000, 0.5, ("smallint", "float")),
                                             (1 << 20, 0.1, ("int", "double")), (1 << 40, 200.0, ("bigint", "float"))])
def test_narrow_types_hold_what_there_is(spark, item, unit, kinds):
    """Scores by shift and unit are those of given values, and wanted others beyond the cells' range meet nothing."""
    rows = [(u, i * item, unit * ((u * i + u) % 5 + 1)) for u in range(12) for i in range(1, 7) if (u + i) % 3]
    plain = spark.createDataFrame(rows, "user bigint, item bigint, r double")
    own = spark.createDataFrame([(u, 0.3 * u, u + 1.0) for u in range(12)], "user bigint, shift double, unit double")
    own = dense.Held.of(own)
    pairs = spark.createDataFrame([(u, i * item) for u in range(12) for i in (1, 2, 3, 9, 200, 1 << 18)] + [(None, item), (3, None)], "user bigint, item bigint")
    narrow = dense.Narrow.of(plain, "item")
    assert (narrow.rows, narrow.other, narrow.rating) == (len(rows), *kinds)
    answers = []
    for cells, units in ((plain, own), (dense.with_values(plain, "user", own), None)):
        got = dense.neighbour_scores(pairs, cells, "user", "item", 3, lambda s: dense.pearson(s, 2), Grid(4, 1), units)
        answers.append({(r.user, r.item): (r.num, r.den) for r in got.collect()})
    assert answers[0] and answers[0] == answers[1]


def test_ratings_that_are_no_numbers_keep_their_type(spark):
    rows = [(u, 1, v) for u, v in enumerate((1.0, None, float("nan"), 2.0))]
    assert dense.Narrow.of(spark.createDataFrame(rows, "user bigint, item bigint, r double"), "item").rating == "float"
    none = spark.createDataFrame([], "user bigint, item bigint, r double")
    assert dense.Narrow.of(none, "item") == dense.Narrow(0, None, None, "bigint", "float")
    pairs = spark.createDataFrame([(1, 1)], "user bigint, item bigint")
    assert dense.neighbour_scores(pairs, none.withColumn("x", F.col("r")), "user", "item", 3, lambda s: dense.pearson(s, 2), Grid(2, 1)).count() == 0
