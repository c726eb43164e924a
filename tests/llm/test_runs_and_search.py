"""Periodic runs and ranked search against plain versions, on edge rows and on repeated ids."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from tessella.llm import lexical, queries, runs  # noqa: E402
from tessella.session import scratch_path  # noqa: E402
from llm import brute  # noqa: E402


def plain_runs(words):
    """(start, length, period) by comparing every word with the word q further on, for every q."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i:i + length]
                if not any(all(part[x] == part[x + p] for x in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(key, text, edit=True):
    words = brute.words(text)
    n, h = len(words), zlib.crc32(str(key).encode())
    if edit and key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return found, " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts():
    rng = np.random.default_rng(5)
    out = [None, "", " \t\n ", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "x " * 300, "é é é\x1fé", "A a A a A a A a"]
    for k in range(60):  # few words, so that runs of many periods overlap and touch
        out.append(" ".join(str(w) for w in rng.integers(0, 2 + k % 3, 20 + 3 * k)))
    for q in (1, 2, 3, 5, 8, 9, 17, 40):
        part = [f"w{i}" for i in rng.integers(0, 1 + q, q)]
        for more in (-1, 0, 1):
            out.append(" ".join(["start", *(part * 5)[:4 * q + more], "end"]))
        out.append(" ".join(["one", *part * 4, *part * 4, "more", *part * 4]))
    # a period that itself holds repeats
    out.append(" ".join((["a", "b"] * 6 + ["c"]) * 5))
    return out


def test_runs_against_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(some_texts())] + [(7, "b b b b b b b"), (7, "b b b b b b b"), (None, "z z z z z z z z"), (None, None)]
    docs = spark.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], "doc_id long, text string, n_words int, runs string, start int") \
        .repartition(3)
    for edit in (runs.repeated_tail, None):
        got = Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed, r.start)
                      for r in runs.periodic_runs(docs, edit=edit).collect())
        want = []
        for i, t in rows:
            found, kept = plain_row(i, t, edit is not None)
            want.append((i, len(brute.words(t)), tuple(found), kept, 2))
        assert got == Counter(want)
    assert sum(len(plain_runs(brute.words(t))) for _, t in rows) > 60  # the cases are not empty ones
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_runs_of_a_very_long_text(spark):
    rng = np.random.default_rng(6)
    part = [f"v{i}" for i in rng.integers(0, 500, 20_000)]
    text = " ".join(["q", *part * 5, "r", *["same"] * 100_000])
    row = runs.periodic_runs(spark.createDataFrame([(3, text)], "doc_id long, text string")).first()
    big = [(r.start, r.length, r.period) for r in row.runs if r.length > 1000]
    assert big == [(1, 100_000, 20_000), (100_002, 100_000, 1)]
    assert row.n_words == 200_002 and row.collapsed.split()[-2:] == ["r", "same"]


def test_seeds_grow_with_the_words_only(monkeypatch):
    """A word that fills a document has as many seeds as words, not as many as pairs of its places."""
    seeds = []
    real = runs._neighbours

    def counted(key, at):
        left, right = real(key, at)
        seeds.append(len(left))
        return left, right

    monkeypatch.setattr(runs, "_neighbours", counted)
    found = runs.find_runs(np.full(50_000, 9, np.uint64), np.array([0, 50_000]))
    assert found.tolist() == [[0, 50_000, 1]]
    assert sum(seeds) < 50_000 * 20


def test_run_query_rows(spark):
    rows = [(k, t) for k, t in enumerate(some_texts())]
    folder = scratch_path(spark, "test-runs")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op11_periodic_runs"](spark, folder).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in rows:
        found, kept = plain_row(i, t)
        top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * top[1] // top[2] if found else None
        assert tuple(got[i]) == (i, len(found), *top, milli, digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(kept))


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text))


def plain_search(docs, items, limit=10):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for name, text in items:
        scored = []
        for i, c in counts:
            n, s = sum(c.values()), 0
            m = 25 + (75 * n * n_docs) // total
            for t in plain_terms(text):
                if c[t]:
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i, s))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(name, k + 1, i, s) for k, (_, _, i, s) in enumerate(scored[:limit])]
    return out


def search_rows():
    rng = np.random.default_rng(7)
    vocabulary = [f"Wörd{i}" if i % 3 else f"w{i}" for i in range(60)]
    docs = [(k, " ".join(vocabulary[i] for i in rng.zipf(1.5, 5 + k % 40) % 60)) for k in range(200)]
    docs += [(500 + k, "same text, SAME rank-ties w3") for k in range(30)]
    docs += [(None, "same text, SAME rank-ties w3"), (None, None), (901, ""), (902, " .,;"), (903, "w1w3 Éclair\x00w9\x7fw12"), (903, "w6 w6")]
    docs.append((904, "w9 " * 100_000 + "unique"))
    items = [(1, "w3 w9, w3"), (2, None), (3, ""), (4, "no such TERMS"), (5, "SAME ties"), (6, "Éclair éclair W12"), (7, "unique"),
             (7, "unique"), (None, "w6"), (8, "w"), (9, "wörd1 WÖRD1")]
    return docs, items


def test_search_against_brute_force(spark):
    docs, items = search_rows()
    table = spark.createDataFrame([(i, t, 0, 5) for i, t in docs], "doc_id long, text string, rank int, score int").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = [(r.item_id, r.rank, r.doc_id, r.score) for r in lexical.search(table, asked).collect()]
    assert Counter(got) == Counter(plain_search(docs, items))
    assert len([g for g in got if g[0] == 5]) == 10 and [g[2] for g in got if g[0] == 5] == list(range(500, 510))
    assert lexical.search(table.limit(0), asked).count() == 0
    assert lexical.search(table, asked.limit(0)).count() == 0
    none = lexical.search(table.where("doc_id >= 901 and doc_id <= 902"), asked)
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = search_rows()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 40)
    got = lexical.search(table, spark.createDataFrame(items, "item_id long, text string"), limit=3).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_search(docs, items, 3))


def test_search_shuffles_no_text(spark):
    docs, items = search_rows()
    plan = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "__text" not in plan.split("MapInArrow")[0]


def test_tasks_keep_ties_for_the_smallest_ids():
    best = lexical.Best(3, 1)
    one = np.ones(1, np.int64)
    for k in (9, 4, 7, 2, 8, 1):
        best.offer(0, 5 * one, k * one, 0 * one)
    best.offer(0, 5 * one, 0 * one, one)  # no id
    best.offer(0, 6 * one, 99 * one, 0 * one)
    assert best.doc[0].tolist() == [99, 1, 2] and best.score[0].tolist() == [6, 5, 5]
    best.offer(0, np.zeros(4, np.int64), np.arange(4), np.zeros(4, np.int64))
    assert best.doc[0].tolist() == [99, 1, 2]
