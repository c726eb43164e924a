"""Exact substring deduplication over windows of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm.exchange import Keys, exchange
from tessella.llm.text import SECOND_BASE, WORD_BASE, Words, spans_hash, words_of


def window_keys(words: Words, width: int) -> tuple[np.ndarray, Keys]:
    """Windows of ``width`` words and their Rabin-Karp hashes: 56 bits to compare and 32 more of a second hash."""
    at = words.windows(width)
    value = words.hashes()
    one = spans_hash(value, at, at + width, WORD_BASE)
    two = spans_hash(value ^ (value >> np.uint64(32)), at, at + width, SECOND_BASE)
    return at, Keys(one & np.uint64((1 << 56) - 1), (two >> np.uint64(32)).astype(np.uint32), words.owners()[at])


def intervals(covered: np.ndarray, words: Words) -> pa.Array:
    """Per text, the maximal runs of covered words as [from, to) pairs."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[1:] = covered
    edge[words.first] = False
    starts = np.flatnonzero(covered & ~edge[:-1])
    after = np.zeros(len(covered) + 1, bool)
    after[:-1] = covered
    after[words.first] = False
    ends = np.flatnonzero(covered & ~after[1:]) + 1
    owner = words.owners()[starts]
    flat = pa.StructArray.from_arrays([pa.array(starts - words.first[owner], pa.int32()),
                                       pa.array(ends - words.first[owner], pa.int32())], ["from", "to"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(words.first))), pa.int32()), flat)


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 20) -> DataFrame:
    """Remove each word that lies in a window of ``width`` words which also starts earlier in the corpus.

    Earlier means a smaller id, or an earlier start in the same document; windows are judged on the input. Words are
    runs of bytes other than ASCII white space. Result per row: ``key``, ``text`` (kept words joined by one space),
    ``n_words``, ``n_removed`` and ``removed`` (maximal word intervals).

    A null text has no words, and a text of fewer words than a window keeps all of them. A null id comes before all
    others. Rows that share an id count as documents in order of their texts, so a repeated row loses its windows.
    An empty table gives an empty result; other columns are not read. Windows are equal if 56 bits and the bucket's
    bits of two Rabin-Karp hashes are.
    """
    def find(rows: pa.Table) -> Keys:
        return window_keys(words_of(rows.column(1)), width)[1]

    def apply(rows: pa.Table, keys: Keys, shared: np.ndarray, later: np.ndarray) -> pa.Table:
        words = words_of(rows.column(1))
        at = words.windows(width)[later]
        step = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + width, -1)
        covered = np.cumsum(step[:-1]) > 0
        removed = np.add.reduceat(np.append(covered, False), words.first[:-1]) if rows.num_rows else np.zeros(0)
        removed = np.where(words.counts > 0, removed, 0)
        kept = []
        for k, t in enumerate(rows.column(1).to_pylist()):
            parts = (t or "").encode().split()
            if removed[k]:
                parts = [parts[i] for i in np.flatnonzero(~covered[words.first[k]:words.first[k + 1]])]
            kept.append(b" ".join(parts).decode())
        return pa.table({key: rows.column(0), "text": pa.array(kept, pa.string()),
                         "n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                         "removed": intervals(covered, words)})

    schema = f"`{key}` long, text string, n_words long, n_removed long, removed array<struct<`from`: int, `to`: int>>"
    return exchange(docs.selectExpr(f"cast(`{key}` as long) as `{key}`", f"`{text}`"), key, text, find, apply, schema, 2)
