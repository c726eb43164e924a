"""Cases in which an operator once did less than its whole job."""

import random
import re

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tessella.llm import pages, queries, templates  # noqa: E402
from tessella.session import scratch_path  # noqa: E402
from llm import brute  # noqa: E402

TWICE = "this line of plain words stands in exactly two of the documents here"


def test_lines_of_two_documents_are_dropped_by_query_and_stage(spark):
    rows = [(1, f"first alone\n{TWICE}"), (2, f"{TWICE}\nsecond alone"), (3, "third alone"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch_path(spark, "test-twice")
    docs.write.parquet(f"{folder}/documents.parquet")
    want = brute.recurring_lines(rows, least=2)
    assert [w[3] for w in want] == [0, 1, 0, 0]
    got = queries.QUERIES["op8_line_dedup"](spark, folder).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped) for r in got) == [(i, n, k) for i, _, n, k in want]
    staged = corpus_pipeline.lines(spark, docs, folder).collect()
    assert sorted((r.doc_id, r.text) for r in staged) == [(i, t) for i, t, _, _ in want]


def constant_templates(line, depth=3, fixed=6):
    """Brute force: templates with six different constants, else the exact tokens."""
    t = brute.words(line)
    if not t:
        return []
    shape = ["<*>" if re.search(r"[0-9@]", w) else w for w in t]
    enough = lambda part: len({w for w in part if w != "<*>" and re.search(r"[^\W\d_]|[^\x00-\x7f]", w)}) >= fixed
    out = [("all", *(shape if enough(shape) else t))]
    middle = depth + (len(t) - depth) // 2
    if len(t) > depth:
        if enough(shape[:middle]):
            out.append(("left", len(t), *shape[:middle]))
        if enough(shape[:depth] + shape[middle:]):
            out.append(("right", len(t), *shape[:depth], *shape[middle:]))
    return out


def test_lines_of_fields_are_compared_exactly(spark, monkeypatch):
    lines = [lambda k: f"{k} {k + 7} 2020-01-0{k}", lambda k: f"| {k} | {k}1 | {k}2 | {k}3 | {k}4 |", lambda k: f"price {k}.99 EUR",
             lambda k: f"{k} 1{k} 2{k} 3{k} 4{k} 5{k} only document number{k} {'abcdef'[k]}lpha {'abcdef'[k]}eta says this",
             lambda k: f"{k} km 1{k} km 2{k} km 3{k} km 4{k} km 5{k} km 6{k} km",
             lambda k: "2019 2020 2021", lambda k: f"User u{k}9 posted item {k}42 at the market today"]
    rows = [(k, "\n".join(line(k) for line in lines)) for k in range(5)]
    got = templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), least_docs=2).collect()
    dropped = {r.doc_id: set(dict(rows)[r.doc_id].split("\n")) - set(r.text.split("\n")) for r in got}
    assert dropped == {0: set()} | {k: {"2019 2020 2021", lines[-1](k)} for k in range(1, 5)}
    rng = random.Random(4)
    few = [*"abcdefg", "é", "7", "x9", "|", "–"]
    rows = [(k, "\n".join(" ".join(rng.choice(few) for _ in range(rng.randint(0, 14))) for _ in range(60))) for k in range(40)]
    heads = ["a b c d e f", "a 1 b c d", "a a b c d e f g"]
    rows += [(100 + k, "\n".join(f"{h} {' '.join(rng.choice(few) for _ in range(4))}" for h in heads for _ in range(9))) for k in range(20)]
    monkeypatch.setattr(brute, "line_templates", constant_templates)
    got = templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"), least_docs=2).collect()
    want = brute.recurring_lines(rows, least=2)
    assert sum(w[3] for w in want) > 100
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == sorted(want)


@pytest.mark.parametrize("page", [
    "<html><head><title>No</title><meta charset=x><body><p>All the text", "<head><title>No<body><p>All the text</p>",
    "<head><style>p > a {}</style><link href='a>b'><p>All the text</p>", "<head><title>No</title>\n All the text",
    "<head><div>All</div></head><p>the text", "<head><script>if (a<b) '<p>'</script></head><p>All the text",
    "<p>All <svg class=a /> the text</p>", "<p>All</p><svg/><p>the</p><svg><text>no</text></svg><p>text</p>",
    "<p>All</p><svg><path d=x><p>the text</p>", "<p>All <svg> the text", "<svg><svg><text>no</text></svg><text>no</text></svg><p>All the text",
    "<p>All</p><svg><foreignObject><div>no</div></foreignObject></svg><p>the text", "<p>All the text<script>no <p>no",
    "<p>All</p><template><p>the text", "<p>All</p><template><p>no</p></template><noscript>no</noscript>the text<noscript>",
    "<p>All</p><svg-icon></svg-icon><p>the text", "<header>All</header><p>the text</p><iframe>no"])
def test_pages_lose_no_text_to_open_elements(page):
    assert " ".join(b.text for b in pages.blocks(page)) == "All the text"
