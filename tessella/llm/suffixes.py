"""Benchmark decontamination with suffix arrays over the training documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.frames import carried, fields
from tessella.llm.text import Words, slices, words_of

BREAKS = np.ones(256, bool)  # words are digits, letters a-z and everything beyond ASCII
BREAKS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
SHARD_BYTES = 4 << 20  # text under one suffix array
BLOCK_BYTES = 4 << 20  # benchmark text that is broadcast at once


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Positions by the order of the suffixes that begin there.

    Prefix doubling: once suffixes are in order by their first h symbols, only ties are sorted again, by the place of
    the suffix h symbols further on.
    """
    n = len(ranks)
    order = np.argsort(ranks)
    place = np.empty(n, np.int64)
    step, todo = 1, np.arange(n)
    key = ranks
    while True:
        # todo: places in the order whose group isn't settled; order[todo] is sorted by (group, key)
        at = order[todo]
        first = np.ones(len(todo), bool)
        if step == 1:
            first[1:] = key[at[1:]] != key[at[:-1]]
        else:
            first[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        start = np.maximum.accumulate(np.where(first, todo, 0))
        place[at] = start
        tied = ~first
        tied[:-1] |= ~first[1:]
        todo, start = todo[tied], start[tied]
        if not len(todo):
            return order
        at = order[todo]
        further = at + step
        key = np.where(further < n, place[np.minimum(further, n - 1)], -1)
        by = np.argsort(start * (n + 1) + key + 1)
        order[todo], key, group = at[by], key[by], start[by]
        step *= 2


@dataclass
class Queries:
    """A block of benchmark items: word hashes, and each suffix's item and remaining length."""

    word: np.ndarray
    left: np.ndarray    # words from here to the item's end
    item: np.ndarray    # item of each word
    need: np.ndarray    # words of a window of this item
    names: list[str]

    @staticmethod
    def of(items: list[tuple[str, str]], width: int) -> Queries:
        words = words_of(pa.array([t for _, t in items], pa.string()), BREAKS, lower=True)
        owner = words.owners()
        left = words.first[1:][owner] - np.arange(len(owner))
        return Queries(words.hashes(), left, owner, np.minimum(width, words.counts)[owner], [n for n, _ in items])


def search(order: np.ndarray, ranks: np.ndarray, query: np.ndarray, at: np.ndarray, length: np.ndarray,
           after: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of the suffix array for query[at:at + length]: its first place, or the first ``after`` its matches.

    Also returns the longest prefix that a suffix compared on the way shares with it.
    """
    n = len(ranks)
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), n, np.int64)
    best = np.zeros(len(at), np.int64)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo, best
        middle = (lo[open_] + hi[open_]) >> 1
        q, s, k = at[open_], order[middle], np.zeros(len(open_), np.int64)
        below = np.full(len(open_), after)  # of a suffix that has the whole query as a prefix
        live = np.arange(len(open_))
        while len(live):
            live = live[k[live] < length[open_[live]]]
            theirs = ranks[np.minimum(s[live] + k[live], n - 1)]
            theirs = np.where(s[live] + k[live] < n, theirs, -1)
            ours = query[q[live] + k[live]]
            same = theirs == ours
            below[live[~same]] = theirs[~same] < ours[~same]
            live = live[same]
            k[live] += 1
        np.maximum.at(best, open_, k)
        lo[open_[below]] = middle[below] + 1
        hi[open_[~below]] = middle[~below]


def occurrences(words: Words, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where windows of the items occur in these documents: (word, width, item); and each suffix's longest match."""
    value, ranks = np.unique(words.hashes(), return_inverse=True)
    docs = len(words.counts)
    # a different sign ends each document, so that no match crosses into the next
    spaced = np.arange(len(ranks)) + words.owners()
    signs = np.empty(len(ranks) + docs, np.int64)
    signs[spaced] = ranks + docs
    signs[words.first[1:] + np.arange(docs)] = np.arange(docs)
    word_at = np.full(len(signs), -1)
    word_at[spaced] = np.arange(len(ranks))
    order = suffix_array(signs)
    found = np.searchsorted(value, queries.word)
    known = np.minimum(found, len(value) - 1) if len(value) else found
    ours = np.where((found < len(value)) & (value[known] == queries.word), found + docs, -2) if len(value) else \
        np.full(len(found), -2)
    suffixes = np.flatnonzero(ours >= 0)
    _, best = search(order, signs, ours, suffixes, queries.left[suffixes])
    longest = np.zeros(len(ours), np.int64)
    longest[suffixes] = best
    # windows that occur: their matches are one run of the suffix array
    hits = suffixes[(best >= queries.need[suffixes]) & (queries.left[suffixes] >= queries.need[suffixes])]
    lo, _ = search(order, signs, ours, hits, queries.need[hits])
    hi, _ = search(order, signs, ours, hits, queries.need[hits], after=True)
    each = hi - lo
    run = np.repeat(lo - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())
    return word_at[order[run]], np.repeat(queries.need[hits], each), np.repeat(queries.item[hits], each), longest, each


def match_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                    item_text: str = "text", width: int = 10) -> DataFrame:
    """Mark the words of each document that lie in a benchmark window.

    Words are runs of a-z, digits and non-ASCII characters after lower-casing A-Z. A window is ``width`` consecutive
    words of an item, or a shorter item's whole text. Result: the input's columns, then ``n_words``, ``n_hit``,
    ``hits`` (maximal word intervals), ``longest`` (words of the longest verbatim match of any item suffix that begins
    with a window), ``items`` (ids of the items with a window here, as strings in order) and ``contaminated``.

    The benchmark is searched in blocks of ``BLOCK_BYTES`` of text; documents pass all blocks in one stage without a
    shuffle. Null and empty texts have no words and no hits; items without words or without an id match nothing;
    rows of one item id count as one item. Result columns replace input columns of the same name.
    """
    spark = docs.sparkSession
    asked = benchmark.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item).cast("string").alias("name"), F.col(item_text).alias("body"))
    size = asked.agg(F.sum(F.octet_length("body") + F.octet_length("name"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    made = ("n_words", "n_hit", "hits", "longest", "items", "contaminated")
    docs = docs.select(*(f"`{c}`" for c in carried(docs, *made)))
    state = docs.withColumns({"__cover": F.lit(None).cast("binary"), "__longest": F.lit(0).cast("long"),
                              "__items": F.array().cast("array<string>")})
    for k in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == k).orderBy("name", "body").collect()
        shared = spark.sparkContext.broadcast([(r.name, r.body) for r in rows])

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries = Queries.of(shared.value, width)
            for rows in slices(batches, text, SHARD_BYTES):
                yield _mark(rows, text, queries)

        state = state.mapInArrow(scan, f"{fields(docs)}, __cover binary, __longest long, __items array<string>")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield _report(rows)

    result = "n_words long, n_hit long, hits array<struct<`from`: int, `to`: int>>, longest long, items array<string>, contaminated boolean"
    return state.mapInArrow(finish, f"{fields(docs)}, {result}")


def _put(rows: pa.RecordBatch, drop: tuple[str, ...], new: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [n for n in rows.schema.names if n not in drop]
    return pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index(n)) for n in names] + list(new.values()),
                                      names + list(new))


def _mark(rows: pa.RecordBatch, text: str, queries: Queries) -> pa.RecordBatch:
    """Adds a block's matches to a shard's rows. The cover is a bit for each word, after their number."""
    words = words_of(rows.column(rows.schema.get_field_index(text)), BREAKS, lower=True)
    at, width, item, longest, each = occurrences(words, queries) if len(queries.word) else [np.zeros(0, np.int64)] * 5
    step = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    covered = np.cumsum(step[:-1]) > 0
    owner = words.owners()[at]
    pairs = np.unique(np.stack([owner, item], 1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
    most = np.zeros(len(words.counts), np.int64)
    if len(at):
        starts = np.flatnonzero((longest >= queries.need) & (queries.left >= queries.need))
        np.maximum.at(most, owner, _reach(words, queries, at, np.repeat(starts, each)))
    old_cover, old_items, old_most = (rows.column(rows.schema.get_field_index(c)).to_pylist()
                                      for c in ("__cover", "__items", "__longest"))
    cover, names = [], []
    cut = np.searchsorted(pairs[:, 0], np.arange(len(most) + 1))
    for k in range(len(most)):
        bits = np.packbits(covered[words.first[k]:words.first[k + 1]])
        if old_cover[k] is not None:
            bits |= np.frombuffer(old_cover[k], np.uint8)[8:]
        cover.append(int(words.counts[k]).to_bytes(8, "little") + bits.tobytes())
        names.append([*old_items[k], *(queries.names[i] for i in pairs[cut[k]:cut[k + 1], 1])])
    most = np.maximum(most, np.array(old_most, np.int64))
    return _put(rows, ("__cover", "__longest", "__items"),
                {"__cover": pa.array(cover, pa.binary()), "__longest": pa.array(most, pa.int64()),
                 "__items": pa.array(names, pa.list_(pa.string()))})


def _reach(words: Words, queries: Queries, at: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Words from ``at`` on that equal the item's words from ``query`` on."""
    value, end = words.hashes(), words.first[1:][words.owners()[at]]
    k, live = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(live):
        live = live[(at[live] + k[live] < end[live]) & (k[live] < queries.left[query[live]])]
        live = live[value[at[live] + k[live]] == queries.word[query[live] + k[live]]]
        k[live] += 1
    return k


def _report(rows: pa.RecordBatch) -> pa.RecordBatch:
    get = lambda c: rows.column(rows.schema.get_field_index(c)).to_pylist()
    count, hit, spans, names = [], [], [], []
    for cover, items in zip(get("__cover"), get("__items"), strict=True):
        n = int.from_bytes(cover[:8], "little")
        bits = np.unpackbits(np.frombuffer(cover, np.uint8)[8:], count=n)
        edge = np.flatnonzero(np.diff(bits, prepend=0, append=0)) if bits.any() else []
        count.append(n)
        hit.append(int(bits.sum()))
        spans.append([{"from": int(a), "to": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
        names.append(sorted(set(items)))
    pair = pa.struct([("from", pa.int32()), ("to", pa.int32())])
    return _put(rows, ("__cover", "__longest", "__items"), {
        "n_words": pa.array(count, pa.int64()), "n_hit": pa.array(hit, pa.int64()), "hits": pa.array(spans, pa.list_(pair)),
        "longest": rows.column(rows.schema.get_field_index("__longest")), "items": pa.array(names, pa.list_(pa.string())),
        "contaminated": pa.array([h > 0 for h in hit], pa.bool_()),
    })
