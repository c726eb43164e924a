"""Periodic runs of words: stretches that repeat a short sequence at least four times over.

Seeds and extensions on the diagonals of a document against itself. A run of smallest period q has at least
max(6, 4q) words, so max(6 - q, 3q) of its words equal the word q further on. For the lags of one octave (q in
2**(j-1)+1 .. 2**j) the least of these numbers is a k-gram that every run of the octave holds twice, q words apart; and
as k >= q, no nearer copy of that k-gram lies between the two (else the run would have a smaller period, by Fine and
Wilf's theorem). So pairs of neighbouring occurrences of a document's k-grams are all the seeds there are: one for each
position at most, however often a k-gram occurs.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm.frames import carried, fields
from tessella.llm.text import WORD_BASE, Words, inverse, mix, powers, slices, words_of
from tessella.llm.wordids import join

SLICE_BYTES = 2 << 20
LEAST, TIMES = 6, 4    # words of a run, and repeats of its period, at least
JOIN_WORDS = 1 << 16
Edit = Callable[[object, int], tuple[int, int] | None]


def overlap(octave: int) -> int:
    """Words of the longest k-gram that each run of the octave's lags holds twice."""
    least = (1 << octave - 1) + 1 if octave else 1
    return max(LEAST - least, (TIMES - 1) * least)


def matched(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values of two arrays of one length are equal; looks at twice as many each time."""
    at, step = 0, 64
    while at < len(a):
        apart = a[at:at + step] != b[at:at + step]
        if apart.any():
            return at + int(apart.argmax())
        at, step = at + step, step * 2
    return len(a)


def _neighbours(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, next position) of neighbouring occurrences of equal keys; ``at`` ascends."""
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    return at[order[same]], at[order[same + 1]]


def find_runs(signs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(start, length, period) of each run in signs[first[d]:first[d + 1]] of every document d, by start and period.

    ``signs`` are 64-bit hashes of words; ``start`` counts from the beginning of ``signs``.
    """
    n, counts = len(signs), np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    end = np.repeat(first[1:], counts)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(signs * powers(WORD_BASE, n), out=total[1:])
    back = powers(inverse(WORD_BASE), n + 1)

    def grams(at: np.ndarray, k: int) -> np.ndarray:
        return mix((total[at + k] - total[at]) * back[at]) ^ mix(owner[at].astype(np.uint64))

    at, k = np.arange(n), overlap(0)
    at = at[at + k <= end]
    left, right = _neighbours(grams(at, k), at)
    gap = np.full(n, n)  # words to the nearest copy of the shortest k-gram; both places of a seed have one within its lag
    gap[left] = right - left
    gap[right] = np.minimum(gap[right], right - left)
    live, covered, out, octave = np.flatnonzero(gap < n), {}, [], 0
    while len(live) and ((1 << octave - 1) + 1 if octave else 1) * TIMES <= counts.max():
        k, least, most = overlap(octave), (1 << octave - 1) + 1 if octave else 1, 1 << octave
        at = live[(live + k <= end[live]) & (gap[live] <= most)]
        left, right = _neighbours(grams(at, k), at)
        lag = right - left
        fit = (lag >= least) & (lag <= most)
        left, lag = left[fit], lag[fit]
        order = np.lexsort((left, lag))
        left, lag = left[order], lag[order]
        lead = np.ones(len(left), bool)  # a seed right behind one of its diagonal lies in the same extension
        lead[1:] = (lag[1:] != lag[:-1]) | (left[1:] != left[:-1] + 1)
        for i, q in zip(left[lead].tolist(), lag[lead].tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            low, high = int(first[owner[i]]), int(end[i])
            stop = i + matched(signs[i:high - q], signs[i + q:high])
            begin = i - matched(signs[low:i][::-1], signs[low + q:i + q][::-1])
            covered[q] = stop
            if stop - i >= k and stop + q - begin >= max(LEAST, TIMES * q):
                out.append((begin, stop + q - begin, q))
        octave += 1
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated_tail(key: object, n: int) -> tuple[int, int] | None:
    """(a, p): from word a on, a document repeats its p words from a on. A tenth of all ids, by a hash; no null id."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def sources(keys: list, words: Words, edit: Edit | None) -> np.ndarray:
    """The word that stands at each place: itself, but for documents that ``edit`` repeats."""
    out = np.arange(len(words.starts))
    for d, key in enumerate(keys if edit else ()):
        low, high = int(words.first[d]), int(words.first[d + 1])
        if found := edit(key, high - low):
            a, p = found
            out[low + a:high] = low + a + np.arange(high - low - a) % p
    return out


def _texts(words: Words, source: np.ndarray, keep: np.ndarray, first: np.ndarray) -> pa.Array:
    """Each document's kept words with a space between them."""
    kept = source[keep]
    size = words.ends[kept] - words.starts[kept] + 1
    data = b"".join(join(words, kept[i:i + JOIN_WORDS], b" ") for i in range(0, len(kept), JOIN_WORDS))
    at = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(keep)])[first]].tolist()
    return pa.array([data[a:max(a, b - 1)].decode() for a, b in zip(at, at[1:], strict=False)], pa.string())


def _report(rows: pa.RecordBatch, key: str, text: str, edit: Edit | None) -> pa.RecordBatch:
    words = words_of(rows.column(rows.schema.get_field_index(text)))
    source = sources(rows.column(rows.schema.get_field_index(key)).to_pylist() if edit else [], words, edit)
    found = find_runs(words.hashes()[source], words.first)
    # hashes stood for words: hold the words of each run against each other
    true = [all(a == b or words.word(a) == words.word(b) for a, b in zip(source[s:s + n - q], source[s + q:s + n], strict=True))
            for s, n, q in found.tolist()]
    found = found[np.array(true, bool)]
    step = np.zeros(len(source) + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(step[:-1]) == 0
    cut = np.searchsorted(found[:, 0], words.first)
    low = np.repeat(words.first[:-1], np.diff(cut))
    spans = pa.StructArray.from_arrays([pa.array(found[:, 0] - low), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                       ["start", "length", "period"])
    new = [pa.array(words.counts), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), spans),
           _texts(words, source, keep, words.first)]
    return pa.RecordBatch.from_arrays([*rows.columns, *new], [*rows.schema.names, "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Edit | None = None) -> DataFrame:
    """The input's columns, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are split at ASCII white space. A run is a stretch of words with smallest period q, of max(6, 4q) words at
    least, that no neighbouring word extends with that period. ``collapsed`` has the words that are in no run after that
    run's first q words, with a space between them. With ``edit``, the search is run on documents of which some parts
    repeat: ``edit(key, n_words)`` gives the word from which on a document repeats, and after how many words.

    Each row stands alone: rows may share an id, be equal or have none, and no row leaves its task. Null, empty and blank
    texts have no words, no runs and an empty ``collapsed``. Result columns replace input columns of the same name.
    """
    docs = docs.select(*(f"`{c}`" for c in carried(docs, "n_words", "runs", "collapsed")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, text, SLICE_BYTES):
            yield _report(rows, key, text, edit)

    return docs.mapInArrow(run, f"{fields(docs)}, n_words long, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")
