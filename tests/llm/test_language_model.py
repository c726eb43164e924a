"""The language model: counts and base scores against plain sums, probabilities that sum to one, exact gradients, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tessella.llm import maxent, queries  # noqa: E402
from tessella.session import scratch_path  # noqa: E402
from llm import brute  # noqa: E402



def learnt():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) != 2


def chained(seed, n):
    """Words of which each follows from the last in three of four cases."""
    rng = np.random.default_rng(seed)
    w, out = 0, []
    for _ in range(n):
        w = (5 * w + 3) % 40 if rng.random() < 0.75 else int(rng.integers(0, 40))
        out.append(f"w{w}")
    return " ".join(out)


ROWS = [(k, chained(k, 60 + k % 50)) for k in range(300)] + [
    (500, None), (501, ""), (502, " \t\n"), (503, "Unseen-" + "x" * 300 + " Alone"), (504, "W1 w1 É é W1"), (505, chained(9, 30_000)),
    (7, chained(7, 67)), (7, chained(7, 67)), (None, "w1 onlynull w2"), (None, None)]


def plain(rows):
    """(key, n_tokens, n_known, N, base) of each row."""
    tokens = [(i, [*brute.words(brute.lower(t)), ""]) for i, t in rows]
    learn = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 != 2
    c = Counter(w for i, t in tokens if learn(i) for w in t)
    total, kinds = sum(c.values()), len(c)
    return [(i, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in t))
            for i, t in tokens]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1.0, 2, "w") for i, t in ROWS],
                                 "doc_id long, text string, score double, n_tokens int, word string").repartition(4)


def checked(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], round(r[4], 6))
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(plain(rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(math.isclose(g[4], w[4], rel_tol=1e-9) for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("frequent", [1 << 20, 20, 0])
def test_counts_and_base_scores(docs, monkeypatch, frequent):
    """However many counts are broadcast, the rest comes from the join."""
    monkeypatch.setattr(maxent, "FREQUENT", frequent)
    got = maxent.score_texts(docs, learnt()).collect()
    checked(got, ROWS)
    apart = [r for r in got if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    gain = sum(r.score - r.base_score for r in apart) / sum(r.n_tokens for r in apart)
    assert len(apart) > 20 and gain > 0.5  # log10 a token
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_no_training_text_and_no_text_at_all(docs):
    none = maxent.score_texts(docs, F.lit(False)).collect()
    assert len(none) == len(ROWS) and all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and abs(r.score) < 1e-4 for r in none)
    assert maxent.score_texts(docs.limit(0), F.lit(True)).count() == 0
    ends = maxent.score_texts(docs.where("text is null"), F.lit(True)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in ends] == [(1, 1, 2)] * 2


def small_model(words=200, seed=0):
    rng = np.random.default_rng(seed)
    signs = np.sort(rng.integers(1, 1 << 63, words).astype(np.uint64))
    model = maxent.Model(signs, rng.integers(1, 50, words), 9000, words + 40)
    model.classes[:] = rng.normal(0, 1, model.classes.shape)
    model.words[:] = rng.normal(0, 1, model.words.shape)
    return model


def test_probabilities_sum_to_one():
    model = small_model()
    lookup = maxent.Lookup(model.signs)
    for seed in range(3):
        past = [np.full(len(model.signs) + 1, h, np.uint64) for h in np.random.default_rng(seed).integers(1, 1 << 60, 3)]
        places = model.places(lookup, np.append(model.signs, np.uint64(5)))
        p = np.exp(model.logs(places, past))
        assert abs(p.sum() - 1) < 1e-4  # the last one is the class of all other words, whose base shares sum to one
    assert abs(np.exp(model.of_class.astype(float)).sum() - 1) < 1e-5


def test_gradients_are_derivatives():
    model = small_model()
    rng = np.random.default_rng(1)
    n = 300
    places = rng.choice([*range(len(model.signs)), (maxent.CLASSES - 1) * maxent.MEMBERS], n)
    past = [rng.integers(1, 40, n).astype(np.uint64) for _ in range(3)]  # few rows, met often
    total = maxent.Gradient()
    model.logs(places, past, total)
    for weights, (slope, met) in ((model.classes, total.classes), (model.words, total.words)):
        rows = np.argsort(-met)[:4]
        for row in rows:
            column = int(np.argmax(np.abs(slope[row])))
            old = weights[row, column]
            weights[row, column] = old + 1e-2
            up = model.logs(places, past).sum()
            weights[row, column] = old - 1e-2
            down = model.logs(places, past).sum()
            weights[row, column] = old
            assert math.isclose((up - down) / 2e-2, slope[row, column], rel_tol=2e-2, abs_tol=5e-2)


def test_gradients_of_many_tasks_add_up(spark, monkeypatch):
    monkeypatch.setattr(maxent, "FAN_IN", 3)
    rng = np.random.default_rng(2)
    rows, want = [], maxent.Gradient()
    for task in range(11):
        one = maxent.Gradient()
        for slope, met in (one.classes, one.words):
            at = rng.integers(0, maxent.ROWS, 20)
            slope[at] = rng.integers(-100, 100, (20, slope.shape[1]))
            met[at] = 1
        rows += [(shard, task, data) for shard, data in one.parts()]
        for a, b in zip((*want.classes, *want.words), (*one.classes, *one.words), strict=True):
            a += b
    got = maxent.add_up(spark.createDataFrame(rows, "__shard int, __task int, __data binary"), 11)
    for a, b in zip((*want.classes, *want.words), (*got.classes, *got.words), strict=True):
        assert np.abs(a - b).max() <= 1


def test_rows_add_up_whatever_repeats():
    rng = np.random.default_rng(3)
    values = rng.integers(-9, 9, (500, 8)).astype(np.float32)
    for high in (1, 3, 400, maxent.ROWS):
        rows = rng.integers(0, high, 1000)  # two rows for each value
        got, want = np.zeros((maxent.ROWS, 8), np.float32), np.zeros((maxent.ROWS, 8), np.float32)
        maxent.add_rows(got, rows, values)
        np.add.at(want, rows, np.concatenate([values, values]))
        assert (got == want).all()


def test_lookup_finds_what_is_there():
    rng = np.random.default_rng(4)
    signs = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(1))
    close = np.arange(1000, dtype=np.uint64) << np.uint64(40)  # all want one slot
    for have in (signs, close, signs[:0]):
        lookup = maxent.Lookup(have)
        assert lookup(have).tolist() == list(range(len(have)))
        assert (lookup(np.array([1, 3, (1 << 64) - 1], np.uint64)) == -1).all()


def test_features_see_no_other_text():
    alone = maxent.Tokens.of(pa.array(["a B c"])).histories()
    among = maxent.Tokens.of(pa.array(["x y z", None, "A b C", "q"])).histories()
    assert all((a == b[5:9]).all() for a, b in zip(alone, among, strict=True))


def test_query_rows(spark):
    rows = [(i, t) for i, t in ROWS if i is not None][:310]
    folder = scratch_path(spark, "test-lm")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = queries.QUERIES["op13_language_model"](spark, folder).collect()
    checked(got, rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
