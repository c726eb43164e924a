"""Ranked lexical search: one automaton of all query terms reads the texts themselves; there is no document index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.text import LOWER, slices, words_of
from tessella.session import cut_lineage

BLOCK_BYTES = 32 << 20  # item text whose terms one automaton holds
SLICE_BYTES = 2 << 20
SPREAD = 64             # groups of tasks whose best documents are ranked before all tasks'
LENGTH_SHARE = 75       # percent of a document's length that counts in its scores
BREAKS = np.zeros(256, bool)
BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
TO_TERMS = {b: " " if BREAKS[b] else chr(LOWER[b]) for b in range(128)}


def terms(text: str | None) -> list[str]:
    return (text or "").translate(TO_TERMS).split(" ")


@dataclass
class Asked:
    """A block of items: their distinct terms, and each item's terms with repeats."""

    words: list[str]
    item_terms: list[np.ndarray]
    item_times: list[np.ndarray]

    @staticmethod
    def of(texts: list[str | None]) -> Asked:
        number: dict[str, int] = {}
        each = []
        for text in texts:
            counts = Counter(t for t in terms(text) if t)
            each.append(([number.setdefault(t, len(number)) for t in counts], list(counts.values())))
        return Asked(list(number), [np.array(t, np.int64) for t, _ in each], [np.array(c, np.int64) for _, c in each])

    def automaton(self) -> ahocorasick.Automaton:
        """Finds each term only between two guards, which stand for the ends of a text and all signs between terms."""
        out = ahocorasick.Automaton()
        for k, word in enumerate(self.words):
            out.add_word(f" {word} ", k)
        if self.words:
            out.make_automaton()
        return out


def occurrences(texts: pa.Array, automaton: ahocorasick.Automaton, size: int) -> tuple[np.ndarray, ...]:
    """(document, term, times) of the terms in these texts, by document; and the number of all terms of each text."""
    found, many = [], []
    for text in texts.to_pylist():
        guarded = f" {(text or '').translate(TO_TERMS)} "
        hits = np.fromiter(map(itemgetter(1), automaton.iter(guarded)), np.int64) if size else np.zeros(0, np.int64)
        found.append(hits)
        many.append(len(hits))
    both = np.repeat(np.arange(len(many)), many) * max(size, 1) + np.concatenate(found) if found else np.zeros(0, np.int64)
    pairs, times = np.unique(both, return_counts=True)
    return pairs // max(size, 1), pairs % max(size, 1), times, words_of(texts, BREAKS).counts


@dataclass
class Best:
    """The best documents of each item so far: highest scores first, then smallest ids; a null id comes last."""

    limit: int
    items: int

    def __post_init__(self) -> None:
        none = np.zeros(0, np.int64)
        self.score, self.doc, self.null = ([none] * self.items for _ in range(3))

    def offer(self, item: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        have = self.score[item]
        least = have[-1] if len(have) == self.limit else 1
        good = np.flatnonzero(score >= least)
        if not len(good):
            return
        if len(good) > self.limit:  # all ties of the last place stay until ids decide
            place = len(good) - self.limit
            good = good[score[good] >= np.partition(score[good], place)[place]]
        both = [np.concatenate(p) for p in ((have, score[good]), (self.doc[item], doc[good]), (self.null[item], null[good]))]
        order = np.lexsort((both[1], both[2], -both[0]))[:self.limit]
        self.score[item], self.doc[item], self.null[item] = (b[order] for b in both)


def weights(df: np.ndarray, with_terms: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * with_terms + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def term_scores(times: np.ndarray, length: np.ndarray, with_terms: int, all_terms: int) -> np.ndarray:
    """What one occurrence pattern adds to a score for each unit of its term's weight."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * length.astype(np.int64) * with_terms) // max(all_terms, 1)
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", limit: int = 10) -> DataFrame:
    """(item, rank, key, score): each item's ``limit`` documents of the highest scores above 0, ties by smaller key.

    Terms are runs of ASCII letters and digits and of non-ASCII characters; A-Z are lower-cased. Term frequency, document
    length and document frequency give integer scores (see ``weights`` and ``term_scores``). Two passes read the texts:
    the first counts documents, lengths and document frequencies, the second scores all documents and keeps each task's
    best for each item, which are then ranked in two steps. No row holds a document's terms, and no shuffle its text.

    The items' terms are broadcast: ``BLOCK_BYTES`` of item text at once at most, and a larger table of items takes the
    two passes for each such block. A null or empty text has no terms: such a document is no one's answer and
    counts nowhere, such an item has no answers. Equal items are answered once each, and equal documents each have a
    rank; ids that are null come after all others of their score. Further columns are not read. ``key`` is an integer.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__text"))
    asked = items.select(F.col(item).alias("__item"), F.col(item_text).alias("__words")) \
        .where(F.octet_length("__words") > 0)
    size = asked.agg(F.sum(F.octet_length("__words"))).first()[0] or 0
    out = None
    for k in range(-(-size // BLOCK_BYTES) or 1):
        of_block = F.pmod(F.xxhash64("__item", "__words"), F.lit(-(-size // BLOCK_BYTES) or 1)) == k
        rows = asked.where(of_block).collect()
        best = _answers(texts, Asked.of([r["__words"] for r in rows]), limit)
        names = spark.createDataFrame([(n, r["__item"]) for n, r in enumerate(rows)],
                                      f"__n long, `{item}` {asked.schema['__item'].dataType.simpleString()}")
        one = best.join(names, "__n").select(item, "rank", F.col("__id").alias(key), "score")
        out = one if out is None else out.unionByName(one)
    return out


def _answers(texts: DataFrame, asked: Asked, limit: int) -> DataFrame:
    """(__n, rank, __id, score) of a block of items."""
    spark, size = texts.sparkSession, len(asked.words)
    shared = spark.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        df, documents, length = np.zeros(size, np.int64), 0, 0
        for rows in slices(batches, "__text", SLICE_BYTES):
            _, term, _, lengths = occurrences(rows.column(1), automaton, size)
            df += np.bincount(term, minlength=size)
            documents += int((lengths > 0).sum())
            length += int(lengths.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some.tolist()], pa.int64()),
                                          pa.array([documents, length, *df[some].tolist()], pa.int64())], ["term", "n"])

    # one row for each term and two sums: as bounded as the block
    sums = dict(texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    with_terms, all_terms = sums.pop(-2, 0), sums.pop(-1, 0)
    df = np.zeros(size, np.int64)
    df[list(sums)] = list(sums.values())
    weight = spark.sparkContext.broadcast(weights(df, with_terms))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        best = Best(limit, len(shared.value.item_terms))
        for rows in slices(batches, "__text", SLICE_BYTES):
            doc, term, times, lengths = occurrences(rows.column(1), automaton, size)
            by_term = np.argsort(term, kind="stable")
            doc, term, times = doc[by_term], term[by_term], times[by_term]
            worth = weight.value[term] * term_scores(times, lengths[doc], with_terms, all_terms)
            cut = np.searchsorted(term, np.arange(size + 1))
            ids = rows.column(0)
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for n, (own, repeats) in enumerate(zip(shared.value.item_terms, shared.value.item_times, strict=True)):
                sums = np.zeros(rows.num_rows, np.int64)
                for t, c in zip(own.tolist(), repeats.tolist(), strict=True):
                    lo, hi = cut[t], cut[t + 1]
                    sums[doc[lo:hi]] += c * worth[lo:hi]  # a term has one entry for each document
                best.offer(n, sums, ids, null)
        many = [len(s) for s in best.score]
        if sum(many):
            doc = pa.array(np.concatenate(best.doc), mask=np.concatenate(best.null).astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(many)), many)), doc,
                                              pa.array(np.concatenate(best.score))], ["__n", "__id", "score"])

    order = [F.col("score").desc(), F.col("__id").asc_nulls_last()]
    found = cut_lineage(texts.mapInArrow(score, "__n long, __id long, score long")
                        .withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(SPREAD))))
    for by in (["__n", "__part"], ["__n"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))) \
            .where(F.col("rank") <= limit)
    return found.select("__n", "rank", "__id", "score")
