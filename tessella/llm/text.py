"""Whole Arrow string columns as numpy arrays of words and their hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# odd multipliers of the polynomial hashes (any odd number with mixed bits will do)
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
SECOND_BASE = np.uint64(0xD6E8FEB86659FD93)
RUN_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown, as every batch asks for about as many."""
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        got = np.full(max(n, 1 << 16), base, np.uint64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        _powers[int(base)] = got
    return got[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """The polynomial hash of values[start:end] for each span, from one running sum (Rabin and Karp's rolling hash)."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(inverse(base), len(values) + 1)[starts])


@dataclass
class Words:
    """Words of several texts: bytes data[starts[i]:ends[i]]; words first[k] to first[k + 1] belong to text k."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """Of each word, wherever it stands; in runs, as a byte takes several numbers of eight bytes."""
        out, lo = np.empty(len(self.starts), np.uint64), 0
        while lo < len(out):
            begin = self.starts[lo]
            hi = max(lo + 1, int(np.searchsorted(self.ends, begin + RUN_BYTES)))
            starts, ends = self.starts[lo:hi] - begin, self.ends[lo:hi] - begin
            out[lo:hi] = spans_hash(self.data[begin:self.ends[hi - 1]], starts, ends, BYTE_BASE)
            lo = hi
        return mix(out + (self.ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, width: int) -> np.ndarray:
        """Words at which ``width`` words of one text begin."""
        at = np.arange(len(self.starts))
        return at[at + width <= np.repeat(self.first[1:], self.counts)]


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its texts; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(texts.buffers()[1] or b"\0" * 8, np.int64 if wide else np.int32)
    bounds = bounds[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def split_words(data: np.ndarray, bounds: np.ndarray, breaks: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes not in ``breaks`` inside each text."""
    inside = ~breaks[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[bounds] = False  # no word runs on into the next text
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[bounds] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def words_of(texts: pa.Array | pa.ChunkedArray, breaks: np.ndarray = SPACE, lower: bool = False) -> Words:
    data, bounds = buffers(texts)
    return split_words(LOWER[data] if lower else data, bounds, breaks)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column`` at most, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, bounds = buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
