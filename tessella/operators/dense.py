"""Neighbourhoods scored where their similarities are made.

One task has a block of target entities, a block of possible neighbours and the target's wanted pairs. It adds up the
similarity sums of the two blocks over slices of the other axis, and scores the wanted pairs with them at once: no
similarity leaves the task and no table of pairs is written. Only targets of wanted pairs take part as targets.

One block is scored as it is. Otherwise ratings travel as a row of arrays for each entity, and the two sides are cut apart:
neighbours into as few blocks as fit a task (``NEAR_CELLS``, counted), targets into as many as keep the cores at work. Each
side is sent once for each block of the other, so its copies follow the cores and not the number of entities.

Whole ratings are added up exactly: three matrix products of packed numbers stand for six sums (``Digits``). A target's
strongest neighbours are picked once, and its wanted pairs look for their ``k`` raters among them; a pair that finds fewer
goes through all its raters.

With one block of neighbours a pair is final where it is made, its best ``k`` neighbours included. With several, a first
pass adds up each pair's neighbours over the blocks, and a second one ranks only for pairs that have more than ``k``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import iadd

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lookup import Held
from .tiles import Grid, _dense

SLICE = 4096          # ids of the other axis whose cells are dense at once
BLOCK_CELLS = 2_000_000  # cells of a block; beyond that the chunked tiles do the work
NEAR_CELLS = 128_000_000  # cells of NARROW bytes of the possible neighbours that one task holds as arrays
NARROW = 2            # bytes of a cell whose other and rating are bytes; wider ones count for more cells
STRIP_CELLS = 3_000_000  # candidates that a strip of targets is to have
THIN = 3              # times as many candidates are thinned out
FEW_CELLS = 24_000_000  # similarities of a strip of targets to few neighbours
MANY = 32_768         # neighbours from which on no row of similarities is kept
MANY_CELLS = 6_000_000  # and their cells
STRIP = 2048          # targets of a strip
STRIP_PAIRS = 16_384  # wanted pairs of a strip
LEFT_CELLS = 1 << 24  # dense cells of a strip, or of a block of neighbours
LEAST = 16            # but so many targets or neighbours
CHUNK = 512           # neighbours whose sums are made at once
GROUP = 512           # targets whose products are made at once
ROWS = 128            # and whose similarities are, so that they stay in a core's cache
ROUNDS = 2            # blocks of targets for each core
EXACT = 1 << 24       # whole numbers below this are exact in single precision
EXACT_DOUBLE = 1 << 53  # and in double precision
SAMPLE = 8            # places of a sample that a threshold is read from
MARGIN = 2            # times the neighbours wanted that the strongest should hold
WORTH = 4             # raters for each of the strongest, from which on looking those up is less work
DRAWN = 4096, 16_384  # least and most neighbours of the sample that a pair's threshold is read off
CLOSE = 4.0           # standard deviations by which a threshold is set lower than the sample says
DOTS = 1 << 15         # cells of rows that are multiplied at once, so that they stay in a core's cache
ROUGH_TOP = 1e18      # largest sum of squares of which rough products are made in single precision
ROUGH = 2.0 ** -22    # error of a rough similarity for each rating that its sums add up, far beyond single precision's
SMALL = 127           # whole ratings up to this travel as a byte
PIECE = 1 << 20       # cells or candidates that are worked on at once where that takes room
FLAT = 1e-12
Sums = dict[str, np.ndarray]
Similarity = Callable[[Sums], tuple[np.ndarray, np.ndarray]]


def pearson(s: Sums, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pearson correlation over common raters, where it is positive; 0 with fewer than ``least`` or without spread."""
    if "over" in s:
        over, vi, vj = s["over"], s["vi"], s["vj"]
    else:
        vi, vj = s["n"] * s["sii"] - s["si"] * s["si"], s["n"] * s["sjj"] - s["sj"] * s["sj"]
        over = s["n"] * s["sij"] - s["si"] * s["sj"]
    if getattr(s, "rough", False):
        return _rough(over, vi, vj)
    bad = (s["n"] < least) | (vi < FLAT) | (vj < FLAT)
    return _positive(over, vi, vj, bad)


def shrunk(s: Sums, least: int, shrinkage: float) -> tuple[np.ndarray, np.ndarray]:
    """Correlation of residuals about zero, times (n - 1) / (n - 1 + shrinkage), where it is positive."""
    if getattr(s, "rough", False):
        more = s["n"] - 1
        w, linked = _rough(s["sij"], s["sii"], s["sjj"])
        more /= np.maximum(more, 1) + more.dtype.type(shrinkage)
        w *= more
        return w, linked
    bad = (s["n"] < max(least, 2)) | (s["sii"] < FLAT) | (s["sjj"] < FLAT)
    w, linked = _positive(s["sij"], s["sii"], s["sjj"], bad)
    more = np.maximum(s["n"].astype(np.float64) - 1, 1)
    return more / (more + shrinkage) * w, linked


def _positive(over: np.ndarray, vi: np.ndarray, vj: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """over / sqrt(vi * vj) in double precision where it is positive and not ``bad``, else 0."""
    w = np.multiply(vi, vj, dtype=np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        np.sqrt(w, out=w)
        np.divide(over, w, out=w)
    w[bad] = 0.0
    np.maximum(w, 0.0, out=w)
    return w, w > 0


def _rough(over: np.ndarray, vi: np.ndarray, vj: np.ndarray) -> tuple[np.ndarray, None]:
    """over / sqrt(vi * vj) in the sums' own precision, anything where that has no meaning: to be held against a threshold."""
    with np.errstate(divide="ignore", invalid="ignore"):
        w = vi * vj
        np.sqrt(w, out=w)
        np.divide(over, w, out=w)
    return w, None


def fits(ratings: DataFrame, entity: str, grid: Grid) -> bool:
    """Whether every block's cells are few enough for one task."""
    most = ratings.groupBy(grid.block(entity)).count().agg(F.max("count")).first()[0] or 0
    return most <= BLOCK_CELLS


def _sums(left: pd.DataFrame, right: pd.DataFrame, ia: np.ndarray, ib: np.ndarray) -> Sums:
    out = {k: np.zeros((len(ia), len(ib))) for k in ("n", "si", "sj", "sii", "sjj", "sij")}
    common = np.intersect1d(left["o"].to_numpy(), right["o"].to_numpy())
    for lo in range(0, len(common), SLICE):
        os = common[lo:lo + SLICE]
        a, b = (t[(t["o"].to_numpy() >= os[0]) & (t["o"].to_numpy() <= os[-1])] for t in (left, right))
        a, b = (t[np.isin(t["o"].to_numpy(), os)] for t in (a, b))
        ra, ma = (_dense(a["e"].to_numpy(), a["o"].to_numpy(), v, ia, os) for v in (a["r"].to_numpy(), np.ones(len(a))))
        rb, mb = (_dense(b["e"].to_numpy(), b["o"].to_numpy(), v, ib, os) for v in (b["r"].to_numpy(), np.ones(len(b))))
        for k, p, q in (("n", ma, mb), ("si", ra, mb), ("sj", ma, rb), ("sii", ra * ra, mb), ("sjj", ma, rb * rb), ("sij", ra, rb)):
            out[k] += p @ q.T
    return out


def _scored(pdf: pd.DataFrame, similarity: Similarity, k: int) -> pd.DataFrame:
    kind = pdf["kind"].to_numpy()
    left, right, pair = pdf[kind == 0], pdf[kind == 1], pdf[kind == 2]
    columns = ["e", "o", "num", "den"]
    if not len(left) or not len(right) or not len(pair):
        return pd.DataFrame({c: [] for c in columns})
    right = right[np.isin(right["o"].to_numpy(), pair["o"].to_numpy()) | np.isin(right["o"].to_numpy(), left["o"].to_numpy())]
    ia, ib = np.unique(left["e"].to_numpy()), np.unique(right["e"].to_numpy())
    w, linked = similarity(_sums(left, right, ia, ib))
    same = ia[:, None] == ib[None, :]
    w[same], linked[same] = 0.0, False
    pair = pair[np.isin(pair["e"].to_numpy(), ia)]
    order = np.argsort(pair["o"].to_numpy(), kind="stable")
    pair = pair.iloc[order]
    wanted = np.unique(pair["o"].to_numpy())
    out = []
    for lo in range(0, len(wanted), SLICE):
        os = wanted[lo:lo + SLICE]
        asked = pair[(pair["o"].to_numpy() >= os[0]) & (pair["o"].to_numpy() <= os[-1])]
        cell = right[np.isin(right["o"].to_numpy(), os)]
        at = cell["e"].to_numpy(), cell["o"].to_numpy()
        x, m = _dense(*at, cell["x"].to_numpy(), ib, os), _dense(*at, np.ones(len(cell)), ib, os)
        r, c = np.searchsorted(ia, asked["e"].to_numpy()), np.searchsorted(os, asked["o"].to_numpy())
        num, den, cnt = (v[r, c] for v in (w @ x, w @ m, linked.astype(float) @ m))
        over = np.flatnonzero(cnt > k)
        for t in np.unique(r[over]):
            row = np.flatnonzero(linked[t])
            row = row[np.lexsort((ib[row], -w[t, row]))]
            mine = over[r[over] == t]
            rated = m[np.ix_(row, c[mine])] > 0
            near = w[t, row][:, None] * (rated & (np.cumsum(rated, axis=0) <= k))
            num[mine], den[mine] = (near * x[np.ix_(row, c[mine])]).sum(0), near.sum(0)
        some = cnt > 0
        out.append(pd.DataFrame({"e": asked["e"].to_numpy(), "o": asked["o"].to_numpy(), "num": num, "den": den})[some])
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in columns})


def _taken(rows: pa.Table, column: str, order: np.ndarray) -> pa.ListArray:
    v = rows.column(column).combine_chunks()
    return (v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v).take(pa.array(order))


def _places(others: np.ndarray, o: np.ndarray) -> np.ndarray:
    """The place of each of ``o`` among ``others``, -1 for none, in pieces and in the smallest type."""
    out = np.empty(len(o), next(t for t in (np.int8, np.int16, np.int32) if len(others) <= np.iinfo(t).max))
    for lo in range(0, len(o) if len(others) else 0, PIECE):
        part = o[lo:lo + PIECE]
        place = np.searchsorted(others, part)
        place[place == len(others)] = 0
        place[others[place] != part] = -1
        out[lo:lo + PIECE] = place
    if not len(others):
        out[:] = -1
    return out


@dataclass
class Cells:
    """Ratings by entity: those of ``ids[i]`` are at ``first[i]`` to ``first[i + 1]``, ``o`` counts in the block's others."""

    ids: np.ndarray
    first: np.ndarray
    o: np.ndarray
    r: np.ndarray
    x: np.ndarray
    value: str = "x"

    @staticmethod
    def read(batches: Iterable[pa.RecordBatch], value: str = "x") -> tuple[Cells, Cells, Cells, np.ndarray]:
        """Targets, neighbours and wanted pairs, and the others that neighbours have.

        ``value`` names what a neighbour's averaged values come from: ``x`` its own array of them, ``r`` the ratings, or
        ``units`` the ratings by the entity's shift and unit, two numbers in place of the array. Columns keep the types they
        came in, and a place among the others has the smallest.
        """
        parts: list[list[pa.RecordBatch]] = [[], [], []]
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            for n, part in enumerate(parts):
                rows = batch.filter(pa.array(kind == n))
                if rows.num_rows:
                    part.append(rows.select(["e", "o", "r", "x"]))
        found = [np.unique(rows.column("o").flatten().to_numpy()) for rows in parts[1]]
        others = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        made = []
        while parts:
            part = parts.pop(0)
            if not part:
                made.append(Cells(*(np.zeros(0, np.int64),) * 2, np.zeros(0, np.int32), *(np.zeros(0),) * 2))
                continue
            rows = pa.Table.from_batches(part)
            del part
            e = rows.column("e").to_numpy()
            order = np.argsort(e)
            o, r, x = (_taken(rows, c, order) for c in "orx")
            del rows
            size = pc.list_value_length(o).to_numpy()
            o, r, x = (v.flatten().to_numpy(zero_copy_only=False) for v in (o, r, x))
            made.append(Cells(e[order], np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), _places(others, o),
                              r if len(r) else o, x, value))
        return *made, others

    @property
    def top(self) -> float:
        """The largest rating without its sign, 1 at least."""
        return float(max(self.r.max(initial=1), -self.r.min(initial=-1).astype(float)))

    def values(self, at: np.ndarray, entity: np.ndarray) -> np.ndarray:
        """The averaged values of the cells at these places, which are those of the entities beside them."""
        if self.value == "x":
            return self.x[at]
        if self.value == "r":
            return self.r[at].astype(np.float64)
        shift, unit = self.x[2 * entity], self.x[2 * entity + 1]
        return (self.r[at] - shift) / unit

    def some(self, at: np.ndarray) -> Cells:
        """The entities at these places, without what is averaged."""
        size = np.diff(self.first)[at]
        first = np.concatenate([[0], np.cumsum(size)])
        cells = np.repeat(self.first[at] - first[:-1], size) + np.arange(first[-1])
        return Cells(self.ids[at], first, self.o[cells], self.r[cells], self.x[:0])

    def dense(self, lo: int, hi: int, column: np.ndarray, width: int, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marks, values and squares of entities lo to hi in the chosen columns; ``column`` is -1 for others left out."""
        a, b = self.first[lo], self.first[hi]
        c, r = column[self.o[a:b]], self.r[a:b]
        at = np.repeat(np.arange(hi - lo) * width, np.diff(self.first[lo:hi + 1])) + c
        marks, values = np.zeros((hi - lo) * width, dtype), np.zeros((hi - lo) * width, dtype)
        if c.min(initial=0) < 0:
            at, r = at[c >= 0], r[c >= 0]
        marks[at], values[at] = 1, r
        marks, values = marks.reshape(-1, width), values.reshape(-1, width)
        return marks, values, values * values


@dataclass(frozen=True)
class Digits:
    """How exact whole sums are added up: several as digits of one number, where their bounds let all fit.

    A number is squares + ``squares`` * (marks + ``marks`` * values): two powers of two over the largest sums of squares
    and of marks; values may be negative and come last. Without digits (``squares`` 0) each sum is a product of its own.
    """

    dtype: type
    squares: int = 0
    marks: int = 0
    exact: bool = False

    @staticmethod
    def of(target: Cells, near: Cells) -> Digits:
        """Single precision where every sum and every product of two sums is a whole number that it holds exactly."""
        most = min(int(np.diff(c.first).max(initial=0)) for c in (target, near))
        for c in (target, near):
            parts = (c.r[lo:lo + PIECE] for lo in range(0, len(c.r), PIECE))
            if c.r.dtype.kind == "f" and not all(np.array_equal(v, np.rint(v)) for v in parts):
                return Digits(np.float64)
        top = max(c.top for c in (target, near))
        if not most * top * top < EXACT_DOUBLE:
            return Digits(np.float64)
        short = (most * top * top) ** 2 < EXACT
        squares, marks = (1 << int(v).bit_length() for v in (most * top * top, most))
        for dtype, exact in ((np.float32, EXACT), (np.float64, EXACT_DOUBLE)):
            if (short or dtype is np.float64) and (most * top + 1) * squares * marks < exact:
                return Digits(dtype, squares, marks, True)
        return Digits(np.float32 if short else np.float64, exact=True)

    def left(self, side: tuple) -> tuple:
        marks, values, squares = side
        if self.squares:
            squares += self.dtype(self.squares) * values
        return marks, values, squares

    def right(self, side: tuple) -> tuple:
        marks, values, squares = side
        if self.squares:
            squares += self.dtype(self.squares) * marks
            squares += self.dtype(self.squares * self.marks) * values
        return marks, values, squares

    def split(self, number: np.ndarray, digit: int, above: np.ndarray | None = None, room: np.ndarray | None = None) -> np.ndarray:
        """What stands above ``digit``, a power of two; ``number`` keeps what is below."""
        above = np.multiply(number, self.dtype(1 / digit), out=above)
        np.floor(above, out=above)
        np.subtract(number, np.multiply(above, self.dtype(digit), out=room), out=number)
        return above


class Products(dict):
    """Similarity sums of two sides, each made when it is asked for; a side is marks, values and squares by slice.

    With digits the left side's squares hold its values too, the right side's its marks and values.
    """

    SIDES = {"n": (0, 0), "si": (1, 0), "sj": (0, 1), "sii": (2, 0), "sjj": (0, 2), "sij": (1, 1)}

    def __init__(self, left: list[tuple], right: list[tuple], digits: Digits, rough: bool = False):
        super().__init__()
        self.left, self.right, self.digits, self.rough = left, right, digits, rough

    def _product(self, p: int, q: int) -> np.ndarray:
        return reduce(iadd, (a[p] @ b[q].T for a, b in zip(self.left, self.right, strict=True)))

    def __missing__(self, key: str) -> np.ndarray:
        d = self.digits
        if d.squares and key in ("n", "sj", "sjj"):
            self["sjj"] = self._product(0, 2)
            self["sj"] = d.split(self["sjj"], d.squares * d.marks)
            self["n"] = d.split(self["sjj"], d.squares)
        elif d.squares and key in ("si", "sii"):
            self["sii"] = self._product(2, 0)
            self["si"] = d.split(self["sii"], d.squares)
        else:
            self[key] = self._product(*self.SIDES[key])
        return self[key]


def _weights(target: Cells, near: Cells, lo: int, hi: int, n_others: int, similarity: Similarity, digits: Digits,
             room: np.ndarray) -> np.ndarray:
    """Similarities of targets lo to hi to every neighbour, in ``room``; 0 for none and for the target itself."""
    w = room[:hi - lo]
    mine = np.unique(target.o[target.first[lo]:target.first[hi]])
    mine = mine[mine >= 0]
    columns, left = [], []
    for at in range(0, len(mine), SLICE):
        column = np.full(n_others + 1, -1, np.int64)  # the last is for others that no neighbour has
        os = mine[at:at + SLICE]
        column[os] = np.arange(len(os))
        columns.append((column, len(os)))
        left.append(digits.left(target.dense(lo, hi, column, len(os), digits.dtype)))
    if not columns:
        w[:] = 0.0
    for at in range(0, len(near.ids) if columns else 0, CHUNK):
        to = min(at + CHUNK, len(near.ids))
        right = [digits.right(near.dense(at, to, column, width, digits.dtype)) for column, width in columns]
        w[:, at:to] = similarity(Products(left, right, digits))[0]
    place = np.searchsorted(near.ids, target.ids[lo:hi])
    own = np.flatnonzero(near.ids[np.minimum(place, len(near.ids) - 1)] == target.ids[lo:hi])
    w[own, place[own]] = 0.0
    return w


def _best(v: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest weights that are positive, in order of place; among equal ones the first count."""
    at = np.flatnonzero(v > 0)
    if len(at) <= k:
        return at
    v = v[at]
    least = np.partition(v, len(v) - k)[len(v) - k]
    at, v = at[v >= least], v[v >= least]
    if len(at) > k:
        ties = np.flatnonzero(v == least)
        at = np.delete(at, ties[len(ties) - (len(at) - k):])
    return at


def _strongest(row: np.ndarray, many: float) -> np.ndarray:
    """Places of all weights from a threshold on that about ``many`` reach, read off an even sample; all are positive."""
    step = max(1, int(many) // SAMPLE)
    some = row[::step]
    at = min(len(some), max(1, int(many) // step))
    least = np.partition(some, len(some) - at)[len(some) - at]
    return np.flatnonzero(row >= least if least > 0 else row > 0)


def _among(row: np.ndarray, strong: np.ndarray, raters: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """``_best`` of ``row[raters]`` from the strongest entities alone; where fewer than k of them are raters, from all raters.

    ``place`` has the place of each rater, and anything for other entities.
    """
    at = np.minimum(place[strong], len(raters) - 1)
    at = at[raters[at] == strong]
    if len(at) < k:
        return _best(row[raters], k)
    return at[_best(row[raters[at]], k)]


def _tile_scores(batches: Iterable[pa.RecordBatch], similarity: Similarity, k: int, ranked: bool,
                 ids: tuple[pa.DataType, pa.DataType], value: str = "x") -> Iterator[pa.RecordBatch]:
    """``_scored`` for rows of arrays: ``e, o, num, den, cnt`` of each wanted pair, or its ``nb, w, x`` if ``ranked``."""
    target, near, asked, others = Cells.read(batches, value)
    if not len(others) or not len(target.ids):
        return
    few = len(near.ids) < MANY and len(near.o) < MANY_CELLS
    for got in (_few_scores if few else _many_scores)(target, near, asked, len(others), similarity, k):
        if not got:
            continue
        e, o, nb, w, x = zip(*got, strict=True)
        if ranked:
            size = [len(v) for v in w]
            columns = np.repeat(e, size), np.repeat(o, size), *(np.concatenate(v) for v in (nb, w, x))
        else:
            columns = e, o, [v @ z for v, z in zip(w, x, strict=True)], [v.sum() for v in w], [len(v) for v in w]
        names, types = (["nb", "w", "x"], [ids[0], pa.float64(), pa.float64()]) if ranked else (
            ["num", "den", "cnt"], [pa.float64(), pa.float64(), pa.int64()])
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(v)).cast(t) for v, t in zip(columns, [*ids, *types], strict=True)],
                                         ["e", "o", *names])


def _few_scores(target: Cells, near: Cells, asked: Cells, n_others: int, similarity: Similarity, k: int) -> Iterator[list[tuple]]:
    """Target, other and the k best neighbours of each wanted pair, their weights and values: strips of targets against all
    neighbours, then each wanted pair over its raters."""
    order = np.argsort(near.o, kind="stable")
    rater = np.repeat(np.arange(len(near.ids), dtype=np.int32), np.diff(near.first))[order]
    x = near.values(order, rater)
    begin = np.concatenate([[0], np.cumsum(np.bincount(near.o, minlength=n_others))])
    del order
    digits = Digits.of(target, near)
    place = np.zeros(len(near.ids), np.int32)
    at = np.searchsorted(asked.ids, target.ids)
    strip = max(1, FEW_CELLS // len(near.ids))
    room = np.empty((min(strip, len(target.ids)), len(near.ids)))
    for lo in range(0, len(target.ids), strip):
        hi = min(lo + strip, len(target.ids))
        w = _weights(target, near, lo, hi, n_others, similarity, digits, room)
        many = [slice(asked.first[n], asked.first[n + 1]) for n in at[lo:hi]]
        row = np.repeat(np.arange(hi - lo), [m.stop - m.start for m in many])
        wanted, names = (np.concatenate([v[m] for m in many]) for v in (asked.o, asked.r))
        size = begin[wanted + 1] - begin[wanted]
        many = _enough(k, size, len(near.ids))
        listed = (wanted >= 0) & (many * WORTH < size)
        strong = {t: _strongest(w[t], many[listed & (row == t)].max()) for t in np.unique(row[listed])}
        got = []
        for c in np.unique(wanted[wanted >= 0]):
            raters, value = rater[begin[c]:begin[c + 1]], x[begin[c]:begin[c + 1]]
            mine = np.flatnonzero(wanted == c)
            if listed[mine].any():
                place[raters] = np.arange(len(raters))
            for n in mine:
                v = w[row[n]]
                best = _among(v, strong[row[n]], raters, place, k) if listed[n] else _best(v[raters], k)
                if len(best):
                    got.append((target.ids[lo + row[n]], names[n], near.ids[raters[best]], v[raters[best]], value[best]))
        yield got


def _enough(k: int, size: np.ndarray, n: int) -> np.ndarray:
    """How many of the strongest of n neighbours should hold k raters of an item that ``size`` have rated."""
    return MARGIN * (k + SAMPLE) * n / np.maximum(size, 1)


def _many_scores(target: Cells, near: Cells, asked: Cells, n_others: int, similarity: Similarity, k: int) -> Iterator[list[tuple]]:
    """``_few_scores`` for many neighbours, of which no row of similarities is kept.

    A pair whose item has many raters gets a threshold from a sample of the neighbours. Similarities are made roughly, block
    by block, and only those that may reach a target's lowest threshold are made exactly and held against the pair's own.
    At the end a pair either has k neighbours of its threshold or more, so that its k best are among them, or it is done
    again over all raters of its item, as pairs of items with few raters are from the start.
    """
    sizes = reduce(iadd, (np.bincount(near.o[lo:lo + PIECE], minlength=n_others) for lo in range(0, len(near.o), PIECE)))
    place = np.searchsorted(target.ids, asked.ids)
    known = target.ids[np.minimum(place, len(target.ids) - 1)] == asked.ids
    row = np.repeat(np.where(known, place, -1), np.diff(asked.first))
    at = np.flatnonzero((row >= 0) & (asked.o >= 0))
    pairs = Pairs(row[at], asked.o[at].astype(np.int64), sizes[asked.o[at]], len(near.ids), k)
    search = Search.of(target, near, n_others, similarity, k)
    for lo, hi in pairs.strips(max(LEAST, LEFT_CELLS // n_others)):
        strip = pairs.part(np.arange(lo, hi))
        names = asked.r[at[lo:hi]]
        got, again = search.run(strip)
        if len(again):
            whole, _ = search.run(strip.part(again, listed=False))
            given_up = set(again)
            got = [v for v in got if v[0] not in given_up] + [(again[n], *rest) for n, *rest in whole]
        yield [(target.ids[strip.row[n]], names[n], near.ids[nb], w, x) for n, nb, w, x in got]


@dataclass
class Pairs:
    """Wanted pairs by target: the target's row, the item's place, how many raters it has, and whether a threshold is worth it."""

    row: np.ndarray
    col: np.ndarray
    size: np.ndarray
    n: int
    k: int
    listed: np.ndarray | None = None

    def __post_init__(self) -> None:
        if self.listed is None:
            self.listed = _enough(self.k, self.size, self.n) * WORTH < self.size

    def part(self, at: np.ndarray, listed: bool = True) -> Pairs:
        return Pairs(self.row[at], self.col[at], self.size[at], self.n, self.k, self.listed[at] & listed)

    def strips(self, most: int) -> Iterator[tuple[int, int]]:
        """Runs of pairs that have few enough targets and candidates."""
        few = np.minimum(self.size, MARGIN * (self.k + SAMPLE))
        total, target = np.cumsum(few), np.cumsum(np.diff(self.row, prepend=-1) > 0)
        lo = 0
        while lo < len(self.row):
            hi = min(np.searchsorted(total, (total[lo - 1] if lo else 0) + STRIP_CELLS, "right"),
                     np.searchsorted(target, target[lo] + min(most, STRIP)), lo + STRIP_PAIRS)
            yield lo, int(max(hi, lo + 1))
            lo = int(max(hi, lo + 1))


@dataclass
class Search:
    """The k best neighbours of wanted pairs, strip by strip, over blocks of all neighbours in order of id."""

    target: Cells
    near: Cells
    n_others: int
    similarity: Similarity
    k: int
    drawn: np.ndarray
    digits: Digits
    rough: Digits
    close: float

    @staticmethod
    def of(target: Cells, near: Cells, n_others: int, similarity: Similarity, k: int) -> Search:
        n = len(near.ids)
        # a larger sample sets closer thresholds and is more work itself
        some = min(max(DRAWN[0], int(np.sqrt(k * n))), DRAWN[1], -(-n // 4))
        drawn = np.sort(np.random.default_rng(n).choice(n, some, replace=False))
        digits = rough = Digits.of(target, near)
        most = min(int(np.diff(c.first).max(initial=0)) for c in (target, near))
        top = max(c.top for c in (target, near))
        # Pearson correlations of other than whole ratings would lose too much in differences of sums
        if not digits.exact and getattr(similarity, "func", None) is shrunk and most * top * top < ROUGH_TOP:
            rough = Digits(np.float32)
        # the error of a sum is that of its terms' absolute sum, which is at most the root of both sums of squares
        close = ROUGH * (most + SAMPLE) if not digits.exact else ROUGH * SAMPLE
        return Search(target, near, n_others, similarity, k, drawn, digits, rough, close)

    def run(self, pairs: Pairs) -> tuple[list[tuple], np.ndarray]:
        """Pair, neighbours, weights and values of the pairs that have neighbours; and the pairs whose threshold was too high."""
        rows, row = np.unique(pairs.row, return_inverse=True)
        # most pairs over all raters: similarities are needed as they are
        whole = pairs.size[~pairs.listed].sum() > len(rows) * self.near_count / 32
        digits = self.digits if whole else self.rough
        columns, left = self._left(rows, digits)
        if not columns:
            return [], np.zeros(0, np.int64)
        exact = None if digits.exact or digits is self.digits else self._left(rows, self.digits)[1]
        floor = self._floors(pairs, row, columns, left, digits)
        sampled = pairs.listed
        own = self._own(rows)
        wanted, col = np.unique(pairs.col, return_inverse=True)
        held = Candidates(self.near, row, col, floor, self.close, self.k)
        look = np.full(self.n_others, -1, np.int64)
        look[wanted] = np.arange(len(wanted))
        chunk = self._chunk(columns, len(wanted))
        block = Block(self.similarity, digits, min(GROUP, len(rows)), chunk)
        kind = np.int32 if len(self.near.o) < 1 << 31 else np.int64
        for lo in range(0, self.near_count, chunk):
            hi = min(lo + chunk, self.near_count)
            a, b = self.near.first[lo], self.near.first[hi]
            nb = np.repeat(np.arange(hi - lo), np.diff(self.near.first[lo:hi + 1]))
            c = look[self.near.o[a:b]]
            mine = np.flatnonzero(c >= 0)
            cells = np.full((hi - lo, len(wanted)), -1, kind)
            cells[nb[mine], c[mine]] = a + mine
            right = [digits.right(self.near.dense(lo, hi, column, width, digits.dtype)) for column, width in columns]
            right_exact = exact and [self.near.dense(lo, hi, column, width, np.float64) for column, width in columns]
            found = []
            for group in range(0, len(rows), GROUP):
                block.make([tuple(v[group:group + GROUP] for v in side) for side in left], right)
                for at in range(group, min(group + GROUP, len(rows)), ROWS):
                    above, some = held.above[at:at + ROWS, None], held.unlisted(at)
                    reach = above.min() < np.inf
                    if not reach and some is None:
                        continue
                    block.prepare(at - group, len(above), hi - lo)
                    if reach:
                        t, j = _places_of(block.reach(above))
                        found.append((at + t, j, block.sums_at(t, j, exact is not None)))
                    if some is not None:
                        p, t, j, cell = some.meet(cells)
                        w = self._exactly(at + t, j, block.sums_at(t, j, exact is not None), exact, right_exact)
                        w[own[at + t] == lo + j] = 0.0
                        held.add(p, lo + j, w, self.near.values(cell, lo + j))
            if found:
                t, j = (np.concatenate([v[n] for v in found]) for n in (0, 1))
                sums = {key: np.concatenate([v[2][key] for v in found]) for key in found[0][2]}
                w = self._exactly(t, j, sums, exact, right_exact)
                w[own[t] == lo + j] = 0.0
                held.reached(t, lo, j, w, cells)
            held.thin()
        got = held.best()
        count = np.zeros(len(pairs.row), np.int64)
        for n, nb, *_ in got:
            count[n] = len(nb)
        return got, np.flatnonzero(sampled & (floor > 0) & (count < self.k))

    @property
    def near_count(self) -> int:
        return len(self.near.ids)

    @staticmethod
    def _chunk(columns: list, wanted: int = 0) -> int:
        return max(1, min(CHUNK, max(LEAST, LEFT_CELLS // max(wanted, sum(width for _, width in columns)))))

    def _left(self, rows: np.ndarray, digits: Digits) -> tuple[list, list]:
        """The columns of the others that the targets have, in slices, and the targets' side of the products."""
        mine = self.target.some(rows)
        os = np.unique(mine.o)
        os = os[os >= 0].astype(np.int64)
        columns, left = [], []
        for at in range(0, len(os), SLICE):
            column = np.full(self.n_others + 1, -1, np.int64)  # the last is for others that no neighbour has
            some = os[at:at + SLICE]
            column[some] = np.arange(len(some))
            columns.append((column, len(some)))
            left.append(digits.left(mine.dense(0, len(rows), column, len(some), digits.dtype)))
        return columns, left

    def _own(self, rows: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.near.ids, self.target.ids[rows])
        return np.where(self.near.ids[np.minimum(place, self.near_count - 1)] == self.target.ids[rows], place, -1)

    def _floors(self, pairs: Pairs, row: np.ndarray, columns: list, left: list, digits: Digits) -> np.ndarray:
        """For each pair a weight that its k best neighbours should all reach, read off the sample; 0 for none."""
        floor = np.zeros(len(pairs.row))
        some = np.flatnonzero(pairs.listed)
        if not len(some):
            return floor
        drawn = self.near.some(self.drawn)
        share = self.k * len(self.drawn) / self.near_count
        count = int(np.ceil(share + CLOSE * (np.sqrt(share) + 1)))
        order = np.argsort(drawn.o, kind="stable")
        rater = np.repeat(np.arange(len(self.drawn)), np.diff(drawn.first))[order]
        begin = np.concatenate([[0], np.cumsum(np.bincount(drawn.o, minlength=self.n_others))])
        w = np.empty((row.max() + 1, len(self.drawn)), digits.dtype)
        chunk = self._chunk(columns)
        for lo in range(0, len(self.drawn), chunk):
            hi = min(lo + chunk, len(self.drawn))
            right = [digits.right(drawn.dense(lo, hi, column, width, digits.dtype)) for column, width in columns]
            for at in range(0, len(w), ROWS):
                side = [tuple(v[at:at + ROWS] for v in slices) for slices in left]
                w[at:at + ROWS, lo:hi] = self.similarity(Products(side, right, digits, True))[0]
        w[~(w > 0)] = 0.0
        for c in np.unique(pairs.col[some]):
            raters, p = rater[begin[c]:begin[c + 1]], some[pairs.col[some] == c]
            for at in range(0, len(p) if len(raters) >= count else 0, ROWS):
                mine = p[at:at + ROWS]
                v = np.partition(w[np.ix_(row[mine], raters)], len(raters) - count, axis=1)[:, len(raters) - count]
                floor[mine] = v.astype(np.float64) - self.close
        floor[floor <= self.close] = 0.0
        return floor

    def _exactly(self, t: np.ndarray, j: np.ndarray, sums: Sums, exact: list | None, right: list | None) -> np.ndarray:
        """Similarities of targets t and neighbours j of a block in double precision, from their sums or from their rows."""
        if exact is None:
            return self.similarity({key: v.astype(np.float64) for key, v in sums.items()})[0]
        out = np.empty(len(t))
        step = max(1, DOTS // max(v[0].shape[1] for v in exact))
        for lo in range(0, len(t), step):
            p, q = t[lo:lo + step], j[lo:lo + step]
            sides = [(tuple(v[p] for v in a), tuple(v[q] for v in b)) for a, b in zip(exact, right, strict=True)]
            out[lo:lo + step] = self.similarity(Dots(sides, sums["n"][lo:lo + step].astype(np.float64)))[0]
        return out


class Block:
    """Sums of a block of targets and neighbours, in room that the next block uses again.

    For the similarities known here the sums are worked on in place; another one is asked with its sums as they are.
    """

    def __init__(self, similarity: Similarity, digits: Digits, rows: int, columns: int):
        self.similarity, self.digits, self.kind = similarity, digits, getattr(similarity, "func", None)
        keys = ["n", "sii", "sjj", "sij"] if self.kind is shrunk else list(Products.SIDES)
        self.made = {key: np.empty((rows, columns), digits.dtype) for key in (["sii", "sjj", "sij"] if digits.squares else keys)}
        self.room = {key: np.empty((ROWS, columns), digits.dtype) for key in ("n", "si", "sj", "u", "v", "z")}
        self.marks = np.empty((ROWS, columns), bool)
        self.sums: Sums = {}

    def make(self, left: list[tuple], right: list[tuple]) -> None:
        for key, room in self.made.items():
            p, q = Products.SIDES[key]
            out = room[:len(left[0][p]), :len(right[0][q])]
            np.matmul(left[0][p], right[0][q].T, out=out)
            for a, b in zip(left[1:], right[1:], strict=True):
                out += a[p] @ b[q].T

    def prepare(self, at: int, rows: int, columns: int) -> None:
        """The sums of some rows, once after ``make``."""
        s = {key: v[at:at + rows, :columns] for key, v in self.made.items()}
        room = {key: v[:rows, :columns] for key, v in self.room.items()}
        d, u = self.digits, room["u"]
        if d.squares:
            for key, of, digit in (("sj", "sjj", d.squares * d.marks), ("n", "sjj", d.squares), ("si", "sii", d.squares)):
                s[key] = d.split(s[of], digit, room[key], u)
        if self.kind is pearson:
            for out, a, b in (("sii", "si", "si"), ("sjj", "sj", "sj"), ("sij", "si", "sj")):
                np.multiply(s[out], s["n"], out=s[out])
                np.multiply(s[a], s[b], out=u)
                np.subtract(s[out], u, out=s[out])
            s = {"n": s["n"], "vi": s["sii"], "vj": s["sjj"], "over": s["sij"]}
        self.sums, self.now = s, room

    def reach(self, above: np.ndarray) -> np.ndarray:
        """Whether similarities may be ``above``, a number for each row that is lower than meant by their error."""
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            return self._reach(above.astype(self.digits.dtype))

    def _reach(self, above: np.ndarray) -> np.ndarray:
        s, u, v, z = self.sums, *(self.now[key] for key in "uvz")
        out = self.marks[:u.shape[0], :u.shape[1]]
        if self.kind is pearson:
            np.multiply(s["vi"], s["vj"], out=u)
            np.sqrt(u, out=u)
            np.multiply(u, above, out=u)
            return np.greater(s["over"], u, out=out)
        if self.kind is shrunk:
            np.multiply(s["sii"], s["sjj"], out=u)
            np.sqrt(u, out=u)
            np.subtract(s["n"], 1, out=v)
            np.multiply(s["sij"], v, out=z)
            np.add(v, u.dtype.type(self.similarity.keywords["shrinkage"]), out=v)
            np.multiply(u, v, out=u)
            np.multiply(u, above, out=u)
            return np.greater(z, u, out=out)
        return np.greater(self.similarity(Rough(s))[0], above, out=out)

    def sums_at(self, t: np.ndarray, j: np.ndarray, rough: bool) -> Sums:
        """The sums of some places; of rough ones only the number of ratings, which is exact."""
        return {key: v[t, j] for key, v in self.sums.items() if not rough or key == "n"}


class Rough(dict):
    """Sums whose similarities are only held against a threshold."""

    rough = True


class Dots(dict):
    """Similarity sums of two rows each, in the order of the rows."""

    def __init__(self, sides: list[tuple], n: np.ndarray):
        super().__init__(n=n)
        self.sides = sides

    def __missing__(self, key: str) -> np.ndarray:
        p, q = Products.SIDES[key]
        self[key] = reduce(iadd, (np.einsum("ij,ij->i", a[p], b[q]) for a, b in self.sides))
        return self[key]


def _places_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the places that are marked, in order; most often they are few."""
    flat = marks.ravel()
    if len(flat) % 8 or np.count_nonzero(flat) * 32 > len(flat):
        at = np.flatnonzero(flat)
    else:  # eight at once
        eight = np.flatnonzero(flat.view(np.uint64))
        n, within = np.nonzero(flat.reshape(-1, 8)[eight])
        at = eight[n] * 8 + within
    return np.divmod(at, marks.shape[1])


@dataclass
class Meeting:
    """The pairs without a threshold of a block of targets: their rows, and their items' columns among the wanted."""

    pair: np.ndarray
    row: np.ndarray
    col: np.ndarray

    def meet(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pair, row, neighbour and cell wherever a neighbour has a pair's item; a pair's neighbours in order."""
        only, n = np.unique(self.col, return_inverse=True)
        c, j = np.nonzero(cells.T[only] >= 0)
        size = np.bincount(c, minlength=len(only))
        begin = np.cumsum(size) - size
        each = size[n]
        at = np.repeat(begin[n] - np.cumsum(each) + each, each) + np.arange(each.sum())
        j = j[at]
        return np.repeat(self.pair, each), np.repeat(self.row, each), j, cells[j, np.repeat(self.col, each)]


class Candidates:
    """Candidates for the k best neighbours of the pairs of a strip, by ascending neighbour for each pair."""

    def __init__(self, near: Cells, row: np.ndarray, col: np.ndarray, floor: np.ndarray, close: float, k: int):
        self.near, self.col, self.row, self.floor, self.close, self.k = near, col, row, floor, close, k
        self.first = np.concatenate([[0], np.cumsum(np.bincount(row))])
        self.parts: list[tuple] = []
        self.count = 0
        self._limits()

    def _limits(self) -> None:
        """A target's lowest threshold, infinite if no pair of it has one; and the pairs without, by block of targets."""
        listed = self.floor > 0
        self.above = np.full(len(self.first) - 1, np.inf)
        np.minimum.at(self.above, self.row[listed], self.floor[listed] - self.close)
        self.needed = np.where(listed, self.floor, np.inf)
        self.meeting: dict[int, Meeting] = {}
        rest = np.flatnonzero(~listed)
        block = self.row[rest] // ROWS
        for n in np.unique(block):
            p = rest[block == n]
            self.meeting[n * ROWS] = Meeting(p, self.row[p] - n * ROWS, self.col[p])

    def unlisted(self, at: int) -> Meeting | None:
        return self.meeting.get(at)

    def reached(self, row: np.ndarray, lo: int, j: np.ndarray, w: np.ndarray, cells: np.ndarray) -> None:
        """Takes neighbours lo + j that may be of use to a target into those of its pairs whose threshold they reach."""
        each = self.first[row + 1] - self.first[row]
        n = np.repeat(np.arange(len(row)), each)
        p = np.repeat(self.first[row] - np.cumsum(each) + each, each) + np.arange(len(n))
        ok = np.flatnonzero(np.repeat(w, each) >= self.needed[p])
        n, p = n[ok], p[ok]
        cell = cells[j[n], self.col[p]]
        ok = np.flatnonzero(cell >= 0)
        n, nb = n[ok], lo + j[n[ok]]
        self.add(p[ok], nb, w[n], self.near.values(cell[ok], nb))

    def add(self, pair: np.ndarray, nb: np.ndarray, w: np.ndarray, x: np.ndarray) -> None:
        if len(pair):
            self.parts.append((pair.astype(np.uint16), nb.astype(np.int32), w, x))
            self.count += len(pair)

    def _sorted(self) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        if not self.parts:
            return np.zeros(len(self.row) + 1, np.int64), tuple(np.zeros(0, t) for t in (np.int32, np.float64, np.float64))
        pair, *rest = (np.concatenate(v) for v in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(pair, kind="stable")
        begin = np.concatenate([[0], np.cumsum(np.bincount(pair, minlength=len(self.row)))])
        return begin, tuple(v[order] for v in rest)

    def best(self) -> list[tuple]:
        """Pair, neighbours, weights and values of the k best of each pair that has any."""
        begin, (nb, w, x) = self._sorted()
        got = []
        for p in np.flatnonzero(np.diff(begin)):
            at = begin[p] + _best(w[begin[p]:begin[p + 1]], self.k)
            if len(at):
                got.append((p, nb[at], w[at], x[at]))
        return got

    def thin(self) -> None:
        """With too many candidates, keeps the k best of each pair, which later ones have to exceed: they lose ties."""
        if self.count <= THIN * STRIP_CELLS:
            return
        got = self.best()
        self.count = 0
        for p, nb, w, x in got:
            self.add(np.full(len(nb), p), nb, w, x)
            if len(nb) == self.k:
                least = np.nextafter(w.min(), 2.0)
                self.floor[p] = least if least > 2 * self.close else 0.0
        self._limits()


@dataclass(frozen=True)
class Narrow:
    """How many cells there are, and the smallest types that hold their others and ratings exactly."""

    rows: int
    low: int | None
    high: int | None
    other: str
    rating: str

    @staticmethod
    def of(cells: DataFrame, other: str) -> Narrow:
        r = F.col("r")
        found = cells.agg(F.count(F.lit(1)).alias("n"), F.min(other).alias("low"), F.max(other).alias("high"), F.min("r").alias("least"),
                          F.max("r").alias("most"), F.count_if(r != F.rint(r)).alias("parts"),
                          F.count_if(r != r.cast("float").cast("double")).alias("long")).first()
        kind = dict(cells.dtypes)[other]
        if found["low"] is not None:
            kind = next((t for t, bits in (("tinyint", 7), ("smallint", 15), ("int", 31))
                         if -(1 << bits) <= found["low"] and found["high"] < 1 << bits), kind)
        small = found["least"] is not None and -SMALL <= found["least"] and found["most"] <= SMALL and not found["parts"]
        rating = "tinyint" if small else "double" if found["long"] else "float"
        return Narrow(found["n"], found["low"], found["high"], kind, rating)


def _array_tiles(pairs: DataFrame, cells: DataFrame, entity: str, other: str, a: int, b: int, narrow: Narrow | None = None,
                 units: Held | None = None) -> DataFrame:
    """Targets, possible neighbours and wanted pairs as a row of arrays each; ``t`` numbers the tile of blocks a and b.

    Arrays are of the types in ``narrow``. A neighbour's ``x`` are those of its cells, or its shift and unit in ``units``
    (once for an entity), or none if the cells have none.
    """
    narrow = narrow or Narrow.of(cells, other)
    e, own = F.col(entity).alias("e"), "x" in cells.columns
    cell = F.struct(F.col(other).cast(narrow.other).alias("o"), F.col("r").cast(narrow.rating).alias("r"), *["x"] * own)
    both = F.col(entity).isNotNull() & F.col(other).isNotNull()  # a null meets nothing
    rows = cells.where(both).groupBy(e).agg(F.collect_list(cell).alias("c"))
    none = F.array().cast("array<double>")
    rows = rows.select("e", F.col("c.o").alias("o"), F.col("c.r").alias("r"), *[F.col("c.x").alias("x")] * own)
    valued = rows if own else rows.withColumn("x", none)
    if units is not None:
        valued = rows.join(units.df.select(e, F.array("shift", "unit").alias("x")), "e")
    # others that no cell has meet nothing, and may not fit the type
    wanted = pairs.where(both & F.col(other).between(narrow.low, narrow.high)).groupBy(e).agg(
        F.collect_list(F.col(other).cast(narrow.other)).alias("o"))
    target, near, p = Grid(a, 1).block("e"), Grid(b, 1).block("e"), F.col("_p")

    def shape(df, kind, r, x, tile):
        return df.select(F.lit(kind).alias("kind"), "e", "o", r.alias("r"), x.alias("x"), tile.cast("int").alias("t"))

    def to_each(df, n):
        return df.withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    asking = rows.join(wanted.select("e"), "e", "left_semi")
    return (shape(to_each(asking, b), 0, F.col("r"), none, target * b + p)
            .unionByName(shape(to_each(valued, a), 1, F.col("r"), F.col("x"), p * b + near))
            .unionByName(shape(to_each(wanted, b), 2, F.array().cast(f"array<{narrow.rating}>"), none, target * b + p)))


def _one_tile(pairs: DataFrame, cells: DataFrame, entity: str, other: str) -> DataFrame:
    """Targets, possible neighbours and wanted pairs of the only tile as one tagged table."""
    none = F.lit(0.0)
    targets = cells.join(pairs.select(entity).distinct(), entity, "left_semi")

    def shape(df, kind, r, x):
        return df.select(F.lit(kind).alias("kind"), F.col(entity).alias("e"), F.col(other).alias("o"), r.alias("r"), x.alias("x"))

    return (shape(targets, 0, F.col("r"), none).unionByName(shape(cells, 1, F.col("r"), F.col("x")))
            .unionByName(shape(pairs, 2, none, none))).withColumn("t", F.lit(0))


def with_values(cells: DataFrame, entity: str, units: Held | None) -> DataFrame:
    """Cells with ``x``, see ``neighbour_scores``."""
    if "x" in cells.columns:
        return cells
    if units is None:
        return cells.withColumn("x", F.col("r"))
    x = (F.col("r") - F.col("shift")) / F.col("unit")
    return units.join_to(cells, entity).select(*cells.columns, x.alias("x"))


def neighbour_scores(pairs: DataFrame, cells: DataFrame, entity: str, other: str, k: int, similarity: Similarity,
                     grid: Grid, units: Held | None = None) -> DataFrame:
    """``entity, other, num, den``: sums of w * x and of w over the k nearest neighbours that rated a pair's other side.

    ``cells`` has ``r``, from which similarities are made, and ``x``, which is averaged. Without ``x`` it is
    (r - shift) / unit by ``units``, a row for each entity with a value, or ``r`` itself. Ties go to the smaller id. Pairs
    without a neighbour are absent.
    """
    types = dict(pairs.dtypes)
    ids = f"e {types[entity]}, o {types[other]}"
    wanted = pairs.select(entity, other)
    value = "x" if "x" in cells.columns else "r" if units is None else "units"
    if grid.blocks == 1:
        cells = with_values(cells, entity, units)
        got = _one_tile(wanted, cells, entity, other).groupBy("t").applyInPandas(
            lambda pdf: _scored(pdf, similarity, k), f"{ids}, num DOUBLE, den DOUBLE")
        return got.withColumnsRenamed({"e": entity, "o": other})
    arrow = tuple(pa.int32() if types[c] == "int" else pa.int64() for c in (entity, other))
    narrow = Narrow.of(cells, other)
    width = {"tinyint": 1, "smallint": 2, "int": 4, "float": 4}
    wide = sum(width.get(t, 8) for t in (narrow.other, narrow.rating)) + 8 * (value == "x")
    near = max(1, -(-narrow.rows * wide // (NARROW * NEAR_CELLS)))
    targets = min(grid.blocks, ROUNDS * pairs.sparkSession.sparkContext.defaultParallelism)

    def run(asked: DataFrame, ranked: bool, schema: str) -> DataFrame:
        # a partition is a tile: hashed, some would hold several and others none
        tiled = _array_tiles(asked, cells, entity, other, targets, near, narrow, units).repartitionById(targets * near, "t")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _tile_scores(batches, similarity, k, ranked, arrow, value)

        return tiled.groupBy("t").applyInArrow(score, schema)

    if near == 1:
        got = run(wanted, False, f"{ids}, num DOUBLE, den DOUBLE, cnt BIGINT")
        return got.drop("cnt").withColumnsRenamed({"e": entity, "o": other})
    best = run(wanted, True, f"{ids}, nb {types[entity]}, w DOUBLE, x DOUBLE")
    place = F.row_number().over(Window.partitionBy("e", "o").orderBy(F.col("w").desc(), "nb"))
    best = best.withColumn("place", place).where(F.col("place") <= k)
    return best.groupBy("e", "o").agg(F.sum(F.col("w") * F.col("x")).alias("num"), F.sum("w").alias("den")).withColumnsRenamed(
        {"e": entity, "o": other})
