"""Many neighbours, streamed by thresholds from a sample, against strips of all similarities."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.operators import dense
from tessella.operators.tiles import Grid

SIMILARITIES = {"pearson": partial(dense.pearson, least=2), "shrunk": partial(dense.shrunk, least=2, shrinkage=5.0),
                "own": lambda s: dense.pearson(s, 3),
                # two common raters always have 1 or -1, which rounding orders for other than whole ratings
                "three": partial(dense.pearson, least=3)}


def tile(seed, n=300, width=30, ratings="whole", value="units"):
    """Targets, neighbours and wanted pairs; the last items have few raters, and some targets are no neighbours."""
    rng = np.random.default_rng(seed)
    m = rng.random((n, width)) < np.where(np.arange(width) < width - 6, 0.5, 0.02)
    m[:, 0] = True
    r = rng.integers(-2, 3, m.shape) if ratings == "whole" else rng.normal(0, 1.3, m.shape) + (ratings == "far") * 4
    first = np.concatenate([[0], np.cumsum(m.sum(1))])
    kept = r[m].astype(np.int8 if ratings == "whole" else np.float64)
    x = {"units": rng.random(2 * n) + 0.5, "x": rng.random(m.sum()), "r": np.zeros(0)}[value]
    near = dense.Cells(np.arange(n) * 3, first, np.nonzero(m)[1].astype(np.int8), kept, x, value)
    at = np.sort(rng.choice(n, 30, replace=False))
    target = near.some(at)
    target.ids[5] += 1
    wanted = [np.flatnonzero(~m[i])[rng.random((~m[i]).sum()) < 0.6] for i in at]
    asked = [*wanted, np.array([1, 2])]
    o = np.concatenate(asked).astype(np.int8)
    o[::17] = -1
    ids = np.concatenate([target.ids, [10 * n]])  # the last has no ratings
    return target, near, dense.Cells(ids, np.concatenate([[0], np.cumsum([len(v) for v in asked])]), o, o, x[:0]), width


def answers(kernel, args, similarity, k):
    found = {}
    for got in kernel(*args, similarity, k):
        for e, o, nb, w, x in got:
            assert (e, o) not in found
            found[e, o] = nb, w, x
    return found


def same(a, b):
    assert a and a.keys() == b.keys()
    for p in a:
        assert np.array_equal(a[p][0], b[p][0]) and np.allclose(a[p][1], b[p][1], rtol=1e-7, atol=0) and np.allclose(a[p][2], b[p][2])


@pytest.fixture
def small(monkeypatch):
    for name, value in (("CHUNK", 37), ("GROUP", 24), ("ROWS", 8), ("SLICE", 11), ("DRAWN", (60, 100)), ("STRIP", 40), ("SAMPLE", 2), ("PIECE", 400)):
        monkeypatch.setattr(dense, name, value)
    return monkeypatch


@pytest.mark.parametrize("kind,ratings,value", [("pearson", "whole", "units"), ("three", "parts", "x"), ("three", "far", "r"),
                                                ("shrunk", "parts", "r"), ("shrunk", "whole", "x"), ("own", "whole", "units")])
@pytest.mark.parametrize("k,worth,cells", [(3, 4, 3_000_000), (40, 0, 3_000_000), (3, 0, 300), (40, 1 << 30, 3_000_000), (3, 1 << 30, 300)])
def test_streamed_neighbours_are_those_of_whole_rows(small, kind, ratings, value, k, worth, cells):
    """With thresholds for many pairs, all or none, and with candidates thinned out on the way."""
    small.setattr(dense, "WORTH", worth)
    small.setattr(dense, "STRIP_CELLS", cells)
    args = tile(3, ratings=ratings, value=value)
    few = answers(dense._few_scores, args, SIMILARITIES[kind], k)
    same(few, answers(dense._many_scores, args, SIMILARITIES[kind], k))


@pytest.mark.parametrize("cells", [3_000_000, 300])
def test_equal_weights_go_to_the_smaller_ids(small, cells):
    """Ratings of two levels have many equal similarities; candidates beyond the limit are thinned out."""
    small.setattr(dense, "STRIP_CELLS", cells)
    target, near, asked, n = tile(5, width=9)
    for side in (target, near):
        side.r[:] = np.sign(side.r)
    args = target, near, asked, n
    same(answers(dense._few_scores, args, SIMILARITIES["pearson"], 4), answers(dense._many_scores, args, SIMILARITIES["pearson"], 4))


def test_a_threshold_that_is_too_high_is_given_up(small):
    """Pairs with fewer than k neighbours of their threshold are done again over all raters."""
    args, runs = tile(7), []
    want = answers(dense._few_scores, args, SIMILARITIES["pearson"], 3)
    floors, run = dense.Search._floors, dense.Search.run
    small.setattr(dense, "WORTH", 0)
    small.setattr(dense.Search, "_floors", lambda *a: np.where(floors(*a) > 0, 0.97, 0.0))
    small.setattr(dense.Search, "run", lambda self, pairs: runs.append(pairs.listed.any()) or run(self, pairs))
    same(want, answers(dense._many_scores, args, SIMILARITIES["pearson"], 3))
    assert True in runs and False in runs


def test_no_row_of_similarities_to_many_neighbours_is_kept(small):
    """A strip used to hold its targets' similarities to all neighbours, and as many candidates as there are raters."""
    seen, best = [], dense._best
    small.setattr(dense, "_best", lambda v, k: seen.append(len(v)) or best(v, k))
    small.setattr(dense, "DRAWN", (800, 800))
    small.setattr(dense, "_weights", None)
    args = tile(11, n=6000)
    assert answers(dense._many_scores, args, SIMILARITIES["pearson"], 3)
    raters = np.bincount(args[1].o)[args[2].o[args[2].o >= 0]]
    assert sum(seen) < raters.sum() / 8


@pytest.mark.parametrize("style", ["r", "x"])
def test_blocks_of_many_neighbours_are_ranked_in_one_pass(spark, monkeypatch, style):
    cells = spark.range(9000).selectExpr("id div 10 as user", "id % 10 as item", "cast(pmod(hash(id), 5) as double) as r").where("pmod(hash(id, 2), 3) > 0")
    cells = cells.withColumn("x", F.col("r") - 2) if style == "x" else cells
    pairs = spark.range(900).selectExpr("id as user", "id % 10 as item")
    found, passes = [], []
    tiles = dense._array_tiles
    monkeypatch.setattr(dense, "_array_tiles", lambda *a: passes.append(a[5]) or tiles(*a))
    for near, many in ((123_000_000, 1 << 30), (123_000_000, 0), (2000, 0)):
        monkeypatch.setattr(dense, "NEAR_CELLS", near)
        monkeypatch.setattr(dense, "MANY", many)
        got = dense.neighbour_scores(pairs, cells, "user", "item", 6, partial(dense.pearson, least=2), Grid(5, 1))
        found.append({(r.user, r.item): (r.num, r.den) for r in got.collect()})
    assert found[0] and all(v.keys() == found[0].keys() for v in found)
    assert all(np.allclose(v[p], found[0][p]) for v in found for p in v)
    assert passes[:2] == [1, 1] and len(passes) == 3 and passes[2] > 1
