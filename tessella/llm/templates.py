"""Line deduplication by a log-template tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessella.llm.frames import carried, fields
from tessella.llm.exchange import Keys, exchange
from tessella.llm.text import SECOND_BASE, WORD_BASE, buffers, mix, spans_hash, split_words

LEADING = 3      # leading tokens on a line's way through the tree
FIXED = 6        # different constant words that must be equal for a template with fields or an open half
RECURS = 2       # documents in which a template recurs; the query and the pipeline's stage name it
FIELD = np.uint64(0x5851F42D4C957F2D)  # stands for any variable field
VARIABLE = np.zeros(256, bool)
VARIABLE[[*b"0123456789@"]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def lines_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all lines, and the first line of each text; every text has one line at least."""
    breaks = np.flatnonzero(data == 10) + 1
    cuts = np.sort(np.concatenate([bounds[:-1], breaks, bounds[-1:]]), kind="stable")
    return cuts, np.arange(len(bounds)) + np.searchsorted(breaks, bounds, side="right")


def repeats(value: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last place before each word where its line has the same word; -1 if there is none."""
    order = np.lexsort((value, line))  # stable: equal words of a line stand in order
    new = np.ones(len(order), bool)
    new[1:] = (value[order][1:] != value[order][:-1]) | (line[order][1:] != line[order][:-1])
    first, last = np.full(len(order), -1), np.full(len(order), -1)
    again = np.flatnonzero(~new)
    first[order[again]] = order[new][np.cumsum(new)[again] - 1]
    last[order[again]] = order[again - 1]
    return first, last


def line_keys(data: np.ndarray, cuts: np.ndarray, depth: int, fixed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, value, place) for each template that a line belongs to.

    Every line has the template of all its tokens, in which tokens with a digit or an @ are fields. A line's way is its
    token count and its leading tokens; in its leaf, the remaining tokens have two halves, either of which may be open.
    A template needs ``fixed`` different constants: words with a letter that are no fields. Without these, fields would
    join lines of other content, so such a line is compared by its exact tokens and has no template with an open half.
    """
    words = split_words(data, cuts)
    exact = words.hashes()
    marks, letters = (np.concatenate([[0], np.cumsum(kind[data])]) for kind in (VARIABLE, LETTER))
    field = marks[words.ends] > marks[words.starts]
    value = np.where(field, FIELD, exact)
    n, lo, hi = words.counts, words.first[:-1], words.first[1:]
    keep = n > 0
    line, n, lo, hi = np.flatnonzero(keep), n[keep], lo[keep], hi[keep]
    middle = lo + depth + (n - depth) // 2
    constant = ~field & (letters[words.ends] > letters[words.starts])
    first, last = repeats(exact, words.owners())
    count = lambda which, a, b: (c := np.concatenate([[0], np.cumsum(which)]))[b] - c[a]
    fresh = constant & (last < 0)
    late = constant & (last < np.repeat(middle, n)) & ((first < 0) | (first >= np.repeat(lo + depth, n)))
    tight = count(fresh, lo, hi) < fixed
    long = (n > depth) & (count(fresh, lo, np.minimum(middle, hi)) >= fixed)
    far = (n > depth) & (count(fresh, lo, np.minimum(lo + depth, hi)) + count(late, np.minimum(middle, hi), hi) >= fixed)
    value = np.where(np.repeat(tight, n), exact, value)
    found = []
    for base in (WORD_BASE, SECOND_BASE):
        whole = spans_hash(value, lo, hi, base)
        size = n.astype(np.uint64)
        left = spans_hash(value, lo[long], middle[long], base)
        right = spans_hash(value, middle[far], hi[far], base) * np.uint64(3) + spans_hash(value, lo[far], lo[far] + depth, base)
        found.append(np.concatenate([mix(whole + size), mix(left + (size[long] << np.uint64(20)) + np.uint64(1)),
                                     mix(right + (size[far] << np.uint64(20)) + np.uint64(2))]))
    which = np.concatenate([line, line[long], line[far]])
    return which, found[0] & np.uint64((1 << 56) - 1), (found[1] >> np.uint64(32)).astype(np.uint32)


def drop_recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_docs: int = 3,
                         depth: int = LEADING, fixed: int = FIXED) -> DataFrame:
    """Drop lines whose template occurs in ``least_docs`` documents or more, except in the first of them.

    With ``RECURS`` no template is kept in a second document; a larger ``least_docs`` leaves those of fewer documents.
    Result: the input's columns with the shortened ``text``, and ``n_lines`` and ``n_dropped``; no row is dropped. The
    first document is the one of the smallest id, and it keeps all its lines of that template, so that no content is
    lost altogether. Blank lines are no templates and stay. A null text stays null with no lines, and an empty text has
    one blank line. A null id comes before all others, and rows that share an id count as one document. Columns named
    ``n_lines`` or ``n_dropped`` in the input are replaced.
    """
    rest = carried(docs, "n_lines", "n_dropped", key, text)
    docs = docs.selectExpr(f"cast(`{key}` as long) as `{key}`", f"`{text}`", *(f"`{c}`" for c in rest))

    def find(rows: pa.Table) -> Keys:
        data, bounds = buffers(rows.column(1))
        cuts, first = lines_of(data, bounds)
        which, value, place = line_keys(data, cuts, depth, fixed)
        owner = np.searchsorted(first, which, side="right") - 1
        # rows that share an id are one document; a document counts once for each of its templates
        ids = rows.column(0).cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()
        same = np.concatenate([[0], np.cumsum(ids[1:] != ids[:-1])]) if len(ids) else ids
        lead = np.searchsorted(same, same)
        order = np.argsort(owner, kind="stable")
        return Keys(value[order], place[order], lead[owner[order]], distinct_docs=True, line=which[order])

    def apply(rows: pa.Table, keys: Keys, shared: np.ndarray, later: np.ndarray) -> pa.Table:
        data, bounds = buffers(rows.column(1))
        cuts, first = lines_of(data, bounds)
        # an occurrence in the key's first document stays, as does that document's next one
        both = keys.value ^ (keys.place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        head = ~later
        kept = set(zip(both[head].tolist(), keys.doc[head].tolist(), strict=True))
        drop = shared & later
        if drop.any() and kept:
            at = np.flatnonzero(drop)
            own = [(k, d) in kept for k, d in zip(both[at].tolist(), keys.doc[at].tolist(), strict=True)]
            drop[at[np.array(own, bool)]] = False
        gone = np.zeros(first[-1], bool)
        gone[keys.line[drop]] = True
        lost = np.add.reduceat(np.append(gone, False).astype(np.int64), first[:-1]) if rows.num_rows else np.zeros(0)
        out = []
        for k, t in enumerate(rows.column(1).to_pylist()):
            if t is not None and lost[k]:
                parts = t.split("\n")
                t = "\n".join(parts[i] for i in np.flatnonzero(~gone[first[k]:first[k + 1]]))
            out.append(t)
        null = rows.column(1).is_null().combine_chunks().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, bool)
        done = rows.set_column(1, rows.schema.field(1), pa.array(out, rows.schema.field(1).type))
        done = done.append_column("n_lines", pa.array(np.where(null, 0, np.diff(first)), pa.int64()))
        return done.append_column("n_dropped", pa.array(np.where(null, 0, lost), pa.int64()))

    return exchange(docs, key, text, find, apply, f"{fields(docs)}, n_lines long, n_dropped long", least_docs)
