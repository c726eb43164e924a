"""Toxicity scores by a counterfactual-regularised logistic classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.frames import bounded_sample, carried, fields
from tessella.llm.suffixes import BREAKS
from tessella.llm.text import BYTE_BASE, inverse, mix, powers, slices, words_of

PREFIXES = (3, 4, 5, 6, 8)  # bytes of a word's beginning that are features beside the whole word
SLICE_BYTES = 1 << 20
LEAST_Z = 3.5  # a feature's rates in the classes must differ by so many standard errors
# fixed values: terms for groups of people; the terms of one line are swapped for each other
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"],
    ["muslims", "christians", "jews", "hindus", "atheists"], ["muslim", "christian", "jewish", "hindu", "atheist"],
    ["gay", "lesbian", "straight", "bisexual", "transgender"], ["black", "white", "asian", "latino"],
    ["immigrants", "foreigners", "refugees", "locals"], ["old", "young"], ["disabled", "deaf", "blind"],
]


def features(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word and word beginning, repeats included; case is folded."""
    words = words_of(pc.utf8_lower(texts), BREAKS)
    owner = words.owners()
    n = len(words.data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words.data * powers(BYTE_BASE, n), out=total[1:])
    back = powers(inverse(BYTE_BASE), n + 1)[words.starts]
    hashes, owners = [], []
    for k, size in enumerate((0, *PREFIXES)):
        keep = slice(None) if size == 0 else words.ends - words.starts > size
        start = words.starts[keep]
        end = words.ends if size == 0 else start + size
        hashes.append(mix((total[end] - total[start]) * back[keep] + np.uint64(k)))
        owners.append(owner[keep])
    return np.concatenate(hashes), np.concatenate(owners)


def swapped(text: str, terms: regex.Pattern, to: dict[str, str]) -> str:
    """The text with each identity term exchanged for the next of its line."""
    return terms.sub(lambda m: to[m[0].lower()], text)


@dataclass
class Model:
    """Weights of chosen feature hashes, in order of the hashes."""

    chosen: np.ndarray
    weight: np.ndarray
    bias: float
    marks: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.marks = np.zeros(1 << 20, bool)  # a first sieve: most features are not chosen ones
        self.marks[(self.chosen & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def present(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, chosen feature) pairs without repeats."""
        value, owner = features(texts)
        maybe = np.flatnonzero(self.marks[(value & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.searchsorted(self.chosen, value[maybe])
        hit = at < len(self.chosen)
        hit[hit] = self.chosen[at[hit]] == value[maybe][hit]
        size = max(len(self.chosen), 1)
        both = np.unique(owner[maybe[hit]] * size + at[hit])
        return both // size, both % size

    def scores(self, texts: pa.Array) -> np.ndarray:
        text, feature = self.present(texts)
        z = self.bias + np.bincount(text, weights=self.weight[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_weights(rows: list[np.ndarray], twins: list[np.ndarray | None], y: np.ndarray, width: int, l2: float,
                fairness: float, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features by Adam.

    The loss is the mean log loss (both classes weigh the same), ``l2`` times the squared weights and ``fairness`` times
    the mean squared change of the linear score from a text to its twin with swapped identity terms.
    """
    size = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(len(rows)), size)
    col = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    pairs = [(i, t) for i, t in enumerate(twins) if t is not None]
    change_row = np.concatenate([np.full(len(rows[i]) + len(t), k) for k, (i, t) in enumerate(pairs)]) if pairs else col[:0]
    change_col = np.concatenate([np.concatenate([rows[i], t]) for i, t in pairs]) if pairs else col[:0]
    sign = np.concatenate([np.repeat([1.0, -1.0], [len(rows[i]), len(t)]) for i, t in pairs]) if pairs else np.zeros(0)
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = w[-1] + np.bincount(row, weights=w[col], minlength=len(rows))
        slope = each * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        grad = np.append(np.bincount(col, weights=slope[row], minlength=width) + 2 * l2 * w[:-1], slope.sum())
        if pairs:
            delta = np.bincount(change_row, weights=sign * w[change_col], minlength=len(pairs))
            grad[:-1] += 2 * fairness / len(pairs) * np.bincount(change_col, weights=sign * delta[change_row], minlength=width)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 8000, width: int = 8192, least_docs: int = 4, l2: float = 1e-5, fairness: float = 1.0,
        terms: list[list[str]] = IDENTITY_TERMS) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class, the first by a hash of their id.

    The ``width`` features that tell the classes apart best and occur in ``least_docs`` sampled documents take part.
    The share of each class among all labelled rows sets the final bias. Rows without id, text or a 0/1 label are left
    out, a repeated label row counts once; with one class only, or none, the score is the same for all texts.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).cast("long").alias("__id"), F.col(label).cast("int").alias("__y")) \
        .where("__id is not null and __y in (0, 1)").distinct()
    count = {r["__y"]: r.n for r in known.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    prior = np.log((count.get(1, 0) + 0.5) / (count.get(0, 0) + 0.5))
    if not count.get(0) or not count.get(1):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(prior))
    picked = bounded_sample(known.where("__y = 1"), per_class, F.col("__id")).unionAll(
        bounded_sample(known.where("__y = 0"), per_class, F.col("__id")))
    # at most 2 * per_class ids
    sample = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__t")) \
        .join(F.broadcast(picked), "__id").select("__y", "__t")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "__t", SLICE_BYTES):
            value, owner = features(rows.column(1))
            order = np.lexsort((owner, value))
            value, owner = value[order], owner[order]
            fresh = np.ones(len(value), bool)
            fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
            value, toxic = value[fresh], rows.column(0).to_numpy()[owner[fresh]]
            found, at = np.unique(value, return_inverse=True)
            ones = np.bincount(at, weights=toxic, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(ones),
                                              pa.array(np.bincount(at, minlength=len(found)) - ones)], ["f", "pos", "neg"])

    seen = sample.agg(F.sum("__y").alias("pos"), F.sum(1 - F.col("__y")).alias("neg")).first()
    p, n = max(1, seen.pos or 0), max(1, seen.neg or 0)
    rate = (F.col("pos") + F.col("neg")) / (p + n)
    gap = F.abs(F.col("pos") / p - F.col("neg") / n) / F.sqrt(rate * (1 - rate) + 1e-9)
    best = sample.mapInArrow(tally, "f long, pos long, neg long").groupBy("f") \
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= least_docs) \
        .select("f", gap.alias("gap")).where(F.col("gap") * float(np.sqrt(p * n / (p + n))) > LEAST_Z).orderBy(F.desc("gap"), "f").limit(width).collect()
    model = Model(np.sort(np.array([r.f for r in best], np.int64).view(np.uint64)), np.zeros(len(best)), 0.0)
    to = {a: b for line in terms for a, b in zip(line, line[1:] + line[:1], strict=True)}
    any_term = regex.compile(r"\b(" + "|".join(map(regex.escape, sorted(to, key=len, reverse=True))) + r")\b", regex.I)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "__t", SLICE_BYTES):
            def lists(texts: pa.Array) -> list[list[int]]:
                owner, feature = model.present(texts)
                return [a.tolist() for a in np.split(feature, np.searchsorted(owner, np.arange(1, len(texts))))]

            texts = rows.column(1).to_pylist()
            named = [k for k, t in enumerate(texts) if any_term.search(t)]
            twins: list[list[int] | None] = [None] * len(texts)
            if named:
                for k, twin in zip(named, lists(pa.array([swapped(texts[k], any_term, to) for k in named])), strict=True):
                    twins[k] = twin
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(lists(rows.column(1)), kind), pa.array(twins, kind)],
                                             ["y", "own", "twin"])

    fitted = sample.mapInArrow(rows_of, "y int, own array<int>, twin array<int>").collect()  # 2 * per_class rows at most
    y = np.array([r.y for r in fitted])
    weight, bias = fit_weights([np.array(r.own, np.int64) for r in fitted],
                               [None if r.twin is None else np.array(r.twin, np.int64) for r in fitted],
                               y, len(best), l2, fairness)
    return Model(model.chosen, weight, bias + float(prior))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The input's columns with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    A null or empty text has no features and gets the score of the bias alone. Whole texts are read, rows are
    independent, and input columns named ``score`` or ``predicted`` are replaced.
    """
    docs = docs.select(*(f"`{c}`" for c in carried(docs, "score", "predicted")))
    shared = docs.sparkSession.sparkContext.broadcast((model.chosen, model.weight, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for rows in slices(batches, text, SLICE_BYTES):
            s = own.scores(rows.column(rows.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             [*rows.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, f"{fields(docs)}, score double, predicted int")


def held_out(key: str = "doc_id"):
    """Whether a row's label must not be learnt from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2
