"""The corpus operators on edge rows, against brute force, by round trips and on held-out rows."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

import corpus_pipeline  # noqa: E402
from tessella.llm import (bpe, curves, licences, pages, queries, rans, simhash, substrings, suffixes, templates,  # noqa: E402
                          toxicity)
from tessella.session import scratch_path  # noqa: E402
from llm import brute  # noqa: E402

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


LONG = prose(1, 60_000)
SHARED = prose(2, 60)
ROWS = [
    (1, "first " + SHARED + " end", "a"), (2, None, "b"), (3, "", None), (4, " \t\n ", "a"), (5, LONG, "a"),
    (6, "other start " + SHARED, "a"), (7, "first " + SHARED + " end", "c"), (7, "first " + SHARED + " end", "c"),
    (None, prose(3, 30), "d"), (None, None, None), (9, "Héllo Wörld's ΣΑΣ <|endoftext|> 123!!", "é"), (10, prose(4, 19), "a"),
    (11, "x " * 50, "a"), (12, "line one is here\n" + "All rights reserved.\n" + prose(5, 12), "a"),
    (13, "another line\nAll rights reserved.", "a"), (14, "third\nAll rights reserved.\n\n", "b"), (15, "All rights reserved.", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Edge rows, with extra columns that clash with the operators' own names."""
    rows = [(i, t, s, 7, "x", 1.5, 3, "r") for i, t, s in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int, hits string, score double, "
                                       "n_lines int, __batch string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, " ".join(SHARED.split()[5:30])), (2, None), (3, ""), (None, SHARED), (4, "Wörld"),
                                  (4, "Wörld"), (5, "never seen words here")], "item_id long, text string")


def kept_words(texts, width=20):
    """Brute force for (id, text) in document order."""
    seen, out = set(), []
    for _, text in texts:
        words = brute.words(text)
        gone = set()
        for k in range(len(words) - width + 1):
            window = tuple(words[k:k + width])
            if window in seen:
                gone.update(range(k, k + width))
            seen.add(window)
        out.append((len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def test_substrings_remove_what_occurs_earlier(docs):
    got = substrings.dedup_substrings(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [(i, *k) for (i, _, _), k in zip(order, kept_words([(i, t) for i, t, _ in order]), strict=True)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got), key=key) == sorted(want, key=key)
    assert all(sum(s["to"] - s["from"] for s in r.removed) == r.n_removed for r in got)
    assert all(a["to"] < b["from"] for r in got for a, b in zip(r.removed, r.removed[1:], strict=False))


def test_line_templates_against_brute_force(docs, spark):
    got = templates.drop_recurring_lines(docs).collect()
    want = brute.recurring_lines([(r[0], r[1]) for r in ROWS])
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == Counter(want)
    assert "__batch" not in got[0].asDict() and {"n_words", "hits", "score"} <= set(got[0].asDict())
    fields = [(k, f"User u{k}9 posted item {k}42 at the market today") for k in range(5)]
    kept = templates.drop_recurring_lines(spark.createDataFrame(fields, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in kept) == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 1)]


def test_simhash_against_brute_force(docs, spark):
    rows = [(r[0], r[1]) for r in ROWS if r[0] is not None]
    base = prose(8, 300).split()
    for k in range(40):  # near copies, in chains
        base = [*base]
        base[k * 7] = f"new{k}"
        rows.append((100 + k, " ".join(base)))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute.simhash(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    loners = simhash.keep_one(docs).collect()
    ids = Counter(r.doc_id for r in loners)
    assert ids[7] == 0 and ids[1] == 1  # copies go
    assert ids[None] == 1  # a row without id stays only if no row with one is like it
    assert sorted(i for i in (2, 3, 4) if ids[i]) == [2]


def test_one_row_of_each_group_stays(spark):
    """Ids that are shared, null or both, against brute force."""
    x, y, z = prose(21, 80), prose(22, 80), prose(23, 80)
    three = simhash.keep_one(spark.createDataFrame([(1, x), (1, y), (2, x)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in three) == sorted([(1, x), (1, y)])
    near = " ".join(["changed", *x.split()[1:]])
    rows = [(1, x), (1, y), (2, x), (3, near), (None, x), (None, z), (None, z), (4, None), (None, ""), (5, prose(24, 40)),
            (6, prose(25, 40)), (6, prose(25, 40)), (6, prose(26, 40)), (7, prose(26, 40)), (0, prose(26, 40)), (None, None)]
    rows += [(None, prose(27, 50))] * 40
    prints = [(i, t, brute.simhash([(0, t)])[0][0]) for i, t in rows]
    linked = [(a, b) for k, (_, _, a) in enumerate(prints) for _, _, b in prints[k + 1:]
              if (int(a, 16) ^ int(b, 16)).bit_count() <= 2]
    order = lambda r: (r[0] is None, r[0] or 0, int(r[2], 16) - (1 << 64 if int(r[2], 16) >> 63 else 0), r[1] is not None, r[1] or "")
    want = []
    for members in brute.groups({p[2] for p in prints}, linked).values():
        want.append(min((p for p in prints if p[2] in members), key=order)[:2])
    for parts in (1, 5):
        got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter(want)


def test_bit_sliced_distances_are_exact():
    rng = np.random.default_rng(0)
    block = rng.integers(0, 1 << 63, 300, np.uint64)
    asked = np.concatenate([block[:50] ^ np.uint64(1 << 40), block[50:100] ^ np.uint64(7), rng.integers(0, 1 << 63, 30, np.uint64)])
    for radius in (0, 1, 2, 3, 4, 7):
        hit = np.zeros((len(asked), len(block)), bool)
        for start, rows in simhash.near(asked, block, radius):
            hit[start:start + len(rows)] = rows
        want = np.bitwise_count(asked[:, None] ^ block[None]) <= radius
        assert (hit == want).all()


def test_tiles_of_a_hot_key_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(3)
    values = {int(rng.integers(0, 1 << 62))}
    for _ in range(150):  # many prints that share most fields
        values.add(sorted(values)[int(rng.integers(0, len(values)))] ^ (1 << int(rng.integers(0, 20))))
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(prints, 2).collect()]
    assert len(brute.groups(values, edges)) == len(brute.groups(values, [
        (a, b) for a in values for b in values if (a ^ b).bit_count() <= 2]))
    assert len(edges) < 3000


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(chain).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 0), 0: 0, 100: 100, 101: 100} or \
        got == {**dict.fromkeys(range(1, 41), 0), 101: 100}


def test_decontamination_marks_windows(docs, items, monkeypatch):
    def run():
        got = suffixes.match_documents(docs, items).collect()
        return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated, r.longest) for r in got)

    one = run()
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 40)  # several blocks of items give the same
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 1000)
    assert run() == one
    by_id = {k[0]: k for k in one if k[0] is not None}
    assert by_id[1][2:] == (25, ("1",), True, 25) and by_id[6][2:] == (25, ("1",), True, 25)
    assert by_id[9][2:5] == (1, ("4",), True)
    assert by_id[2][1:5] == (0, 0, (), False) and by_id[5][4] is False
    assert sum(one.values()) == len(ROWS)


def test_suffix_arrays_are_sorted():
    rng = np.random.default_rng(1)
    for n, letters in ((0, 1), (1, 1), (50, 1), (400, 2), (3000, 50)):
        text = rng.integers(0, letters, n)
        order = suffixes.suffix_array(text)
        assert sorted(order) == list(range(n))
        assert all(tuple(text[a:]) < tuple(text[b:]) for a, b in zip(order, order[1:], strict=False))


def test_bpe_equals_the_library_and_decodes(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode_decode(docs, PATH).collect())
    want = Counter()
    for i, t, _ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)] += 1
    assert got == want


def test_backtracking_equals_the_library_on_hard_words():
    from tokenizers import Tokenizer

    library, mine = Tokenizer.from_file(PATH), bpe.Encoder(PATH)
    rng = np.random.default_rng(5)
    signs = list("aeiosthTHS''<|>.,!&12éßñ한Σς̈  ")
    for _ in range(3000):
        text = "".join(rng.choice(signs, int(rng.integers(1, 30))))
        assert mine.word(text) == library.encode(text, add_special_tokens=False).ids, text
    for text in ("a" * 3000, "th" * 2000, "abcabc" * 500):
        assert mine.word(text) == library.encode(text, add_special_tokens=False).ids


def test_id_files_round_trip(docs, spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    folder = scratch_path(spark, "test-ids")
    rans.write_ids(docs, folder, PATH)
    got = sorted(rans.read_ids(spark, folder).collect(), key=lambda r: r.start)
    coded = [(i, np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t, _ in ROWS]
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter(coded)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    named = [r.doc_id for r in got if r.doc_id is not None]
    assert named == sorted(named) and [r.doc_id for r in got[:2]] == [None, None]


def test_rans_blocks():
    rng = np.random.default_rng(2)
    for n in (1, 7, 5000):
        ids = (rng.pareto(1, n) * 3).astype(np.int64) % 900
        coder = rans.Coder(rans.shares(np.bincount(ids, minlength=900)), lanes=16)
        states, words = coder.encode(ids)
        assert (coder.decode(states, words, n) == ids).all()
    share = rans.shares(np.array([0, 1, 10**12, 5] + [1] * 1000))
    assert share.sum() == 1 << rans.SCALE and share[0] == 0 and (share[1:] > 0).all()


def test_damaged_blocks_are_refused(docs, spark):
    folder = scratch_path(spark, "test-damage")
    rans.write_ids(docs, folder, PATH)
    broken = scratch_path(spark, "test-damage")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{broken}/table")
    spark.read.parquet(f"{folder}/blocks").withColumn("checksum", F.col("checksum") + 1).write.parquet(f"{broken}/blocks")
    with pytest.raises(Exception, match="damaged"):
        rans.read_ids(spark, broken).collect()


def test_toxicity_on_held_out_rows(spark):
    insults = ["blockhead", "numbskullish", "dimwitted"]
    rows, labels = [], []
    for k in range(600):
        words = prose(k, 40).split()
        toxic = k % 5 == 0
        if toxic:
            words.insert(k % 40, insults[k % 3] + ("ly" if k % 2 else ""))
        if k % 10 < 3:
            words.insert(3, "women" if toxic else "men")
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame([*rows, (9000, None), (9001, "")], "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (9000, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known.where(~toxicity.held_out()))
    got = {r.doc_id: r for r in toxicity.score(docs, model).withColumn("held", toxicity.held_out()).collect()}
    held = [(got[k].predicted, y) for k, y in labels if got[k].held]
    assert len(held) > 80 and np.mean([p == y for p, y in held]) > 0.97
    assert 0 <= got[9000].score == got[9001].score <= 1 and got[9000].predicted == 0
    neutral = spark.createDataFrame([(1, prose(7, 30) + " women"), (2, prose(7, 30) + " men")], "doc_id long, text string")
    a, b = (r.score for r in toxicity.score(neutral, model).orderBy("doc_id").collect())
    assert abs(a - b) < 0.1  # a neutral mention of a group changes little


def test_swapped_identity_terms_are_penalised():
    rows = [np.array([0, 1])] * 30 + [np.array([2])] * 30
    y = np.array([1] * 30 + [0] * 30)
    twins = [np.array([0])] * 30 + [None] * 30
    free, _ = toxicity.fit_weights(rows, [None] * 60, y, 3, 1e-4, 0.0)
    tied, _ = toxicity.fit_weights(rows, twins, y, 3, 1e-4, 10.0)
    assert abs(tied[1]) < 0.1 * abs(free[1]) and tied[0] > 1


def test_toxicity_without_labels(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == len(ROWS) and len({r.score for r in got}) == 1


PAGE = """<html><head><title>No</title><script>if (a < b) "</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav>
<header class="site-header">Site name</header><div class="cookie">We use cookies on this site.</div>
<article><h1>Big &amp; small</h1><p>First   para &lt;here&gt; with <b>bold</b> text and some more words to read.<br>Next line<p>Second&nbsp;para of the
story goes on for a while and tells the reader more.</p><!-- <p>hidden</p> --><div class="ad">Buy now!</div><p>Last words of it.</p></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=y>Other story</a></li></ul></aside>
<section id="comments"><h3>Comments</h3><p>I liked it.</p></section><form><label>Mail</label><button>Go</button></form><footer>&copy; us</footer>"""


def test_page_text(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", PAGE), (5, "u", "<p"), (6, "u", "<div>" * 2000 + "deep")]
    got = {r.page_id: r for r in pages.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = ("Big & small First para <here> with bold text and some more words to read. Next line Second para of the story goes "
            "on for a while and tells the reader more. Last words of it.")
    assert got[1].text == want == got[4].text
    assert got[2].text == "" == got[3].text and got[2].n_blocks == 0 and len(got) == 6


def test_labeller_on_unseen_layouts():
    import random

    model, rng = pages.fit_labeller([PAGE]), random.Random(77)
    right = total = 0
    for _ in range(150):
        page, labels = pages.made_page(rng, WORDS)
        found = pages.blocks(page)
        if len(found) == len(labels):
            right += int(((model.probabilities([found], {})[0] >= 0.5) == np.array(labels, bool)).sum())
            total += len(labels)
    assert total > 2000 and right / total > 0.97


def test_labeller_gradients():
    model = pages.Labeller(3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(4, 3, pages.INPUT)), np.ones((4, 3), bool)
    mask[2:, 1] = False
    y = rng.integers(0, 2, (4, 3)).astype(float)

    def loss():
        p, _ = model.forward(x, mask)
        return -(np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0)).sum() / mask.sum()

    grads = model.gradients(x, mask, y)
    for name, g in grads.items():
        flat = model.w[name].reshape(-1)
        for k in rng.integers(0, flat.size, 4):
            old = flat[k]
            flat[k] = old + 1e-5
            up = loss()
            flat[k] = old - 1e-5
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-5 - g.reshape(-1)[k]) < 1e-4, name


def test_licences(docs, spark):
    notices, per_doc = licences.scan_licences(docs)
    assert sorted((r.doc_id, r.paragraph, r.family) for r in notices.collect()) == [
        (12, 1, "proprietary"), (13, 1, "proprietary"), (14, 1, "proprietary"), (15, 0, "proprietary")]
    rows = {r.doc_id: r for r in per_doc.collect()}
    assert rows[12].licences == "proprietary" and rows[14].n_paragraphs == 4 and rows[1].licences == ""
    assert rows[2].n_paragraphs == 0 and len(rows) == len({r[0] for r in ROWS})
    more = [(1, "Released under the MIT License."), (2, "Licensed under CC BY 4.0"), (3, "Licensed under CC BY-NC 4.0."),
            (4, "This project mentions a license and the copyright of nobody in a long sentence on other things entirely"),
            (5, "SPDX note: Licensed under the Apache License, Version 2.0 (the License)"), (6, "der Hund geht mit dem Mann")]
    got = {r.doc_id: r.licences for r in licences.scan_licences(spark.createDataFrame(more, "doc_id long, text string"))[1].collect()}
    assert got == {1: "mit", 2: "cc-by-4.0", 3: "cc-by-nc-4.0", 4: "", 5: "apache-2.0", 6: ""}


def test_licence_scan_runs_without_python(docs):
    plan = licences.scan_licences(docs)[1]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")


def brute_nearest(rows, asked, k=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, v in good:
        if i in asked:
            far = sorted((float(np.sqrt(((v - w)**2).sum())), j) for j, w in good if j != i)
            out[i] = [j for _, j in far[:k]]
    return out


def test_nearest_vectors(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(1000 + i, [1.0] * 8) for i in range(60)]
    bad = [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [1.0, None] * 4), (None, [1.0] * 8), (2004, [1.0])]
    table = vectors(spark, rows + bad)
    monkeypatch.setattr(curves, "BLOCK_ROWS", 64)
    monkeypatch.setattr(curves, "QUERY_ROWS", 8)
    got = {}
    for r in curves.search(table, table.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute_nearest(rows, {i for i, _ in rows if i % 20 == 0})
    assert set(got) == set(want)
    assert np.mean([len(set(got[i]) & set(want[i])) / 10 for i in want]) >= 0.9
    assert got[1000] == [1001 + k for k in range(10)] and got[1040] == [1000 + k for k in range(10)]
    few = vectors(spark, rows[:3])
    assert curves.search(few, few.where("vec_id = 0")).count() == 2
    assert curves.search(table.limit(0), table.limit(0)).count() == 0


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    key = curves.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_empty_tables(empty, items, spark):
    assert substrings.dedup_substrings(empty).count() == 0
    assert templates.drop_recurring_lines(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert suffixes.match_documents(empty, items).count() == 0
    assert bpe.encode_decode(empty, PATH).count() == 0 and rans.round_trip(empty, PATH).count() == 0
    assert licences.scan_licences(empty)[1].count() == 0
    blank = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.extract_text(blank).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0


def test_no_benchmark_leaves_all_clean(docs, items):
    assert suffixes.match_documents(docs, items.limit(0)).where("contaminated").count() == 0


def test_pipeline_stages_on_edge_rows(docs, items, spark):
    folder = scratch_path(spark, "test-tables")
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    for start in (docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars")),
                  docs.limit(0).select("doc_id", "text", "source")):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, "test-stage")
            stage(spark, now, folder).write.parquet(path)
            after = spark.read.parquet(path)
            assert name == corpus_pipeline.STAGES[-1][0] or after.columns == start.columns
            now = after
        assert "ids_sha256" in now.columns


def test_pipeline_decisions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf).collect()
    assert 0.5 * docs.count() < len(got) <= docs.count() and len({r.doc_id for r in got}) == len(got)
    kept = docs.join(spark.createDataFrame([(r.doc_id,) for r in got], "doc_id long"), "doc_id")
    again = suffixes.match_documents(kept, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert again.where("n_hit > 30").count() == 0


def test_queries_against_duckdb(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        got = queries.QUERIES[name](spark, sf).select(*columns).collect()
        assert Counter(map(tuple, got)) == Counter(want.fetchall()), name


def test_id_queries_against_the_library(spark, sf):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    coded = {r.doc_id: r for r in queries.QUERIES["op6_bpe_encode_decode"](spark, sf).collect()}
    filed = {r.doc_id: r for r in queries.QUERIES["op9_token_id_files"](spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert coded[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert coded[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        row = filed[r.doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids) + 1)
        assert row.ids_crc32 == zlib.crc32(np.array([*ids, 2], "<u4").tobytes())
        start += len(ids) + 1


def test_simhash_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op4_simhash_near_dedup"](spark, sf).collect()}
    assert got == brute.simhash(rows)


def test_vector_query_recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(rows, {i for i, _ in rows if i % 100 == 0})
    got = {}
    for r in queries.QUERIES["op7_nearest_vectors"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[i] & set(want[i])) / 10 for i in want]) >= 0.9
