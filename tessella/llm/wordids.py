"""Token ids of whole texts from the ids of their distinct words."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from tessella.llm.text import LOWER, SPACE, Words, buffers, split_words

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
STOP = np.zeros(256, bool)
STOP[[*b'.,;:!?()-"%$#&*']] = True


def pieces(texts: pa.Array) -> Words:
    """Words, cut further between a letter (ASCII or U+00C0 to U+00FF) and a stop.

    For tokenizers that split letters from signs, drop white space and fold ASCII case, a text's ids are those of its
    pieces in order. Apostrophes and the signs of special tokens are no stops. Case is folded unless a special token
    may occur, whose case counts.
    """
    data, bounds = buffers(texts)
    if b"<|" not in data.tobytes():
        data = LOWER[data]
    words = split_words(data, bounds, SPACE)
    letter = LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # the signs for times and divided
    letter[lead] = letter[lead + 1] = True
    stop = STOP[data]
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        cut[1:-1] = (letter[:-1] & stop[1:]) | (stop[:-1] & letter[1:])
    cut[bounds] = False
    at = np.flatnonzero(cut)
    starts, ends = np.sort(np.append(words.starts, at)), np.sort(np.append(words.ends, at))
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


def join(words: Words, which: np.ndarray, between: bytes) -> bytes:
    """The bytes of some words with ``between`` after each."""
    size = words.ends[which] - words.starts[which]
    ends = np.cumsum(size + len(between))
    begin = ends - size - len(between)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    out[at] = words.data[np.repeat(words.starts[which] - np.cumsum(size) + size, size) + np.arange(size.sum())]
    for k, b in enumerate(between):
        out[ends - len(between) + k] = b
    return out.tobytes()


@dataclass
class WordEncoder:
    """Encodes each distinct piece of a batch once, and remembers it by its 64-bit hash.

    ``encode`` gets pieces as one text with a line break after each, and gives their ids and each piece's number of ids.
    Beyond ``remembered`` pieces, all are forgotten and encoded again; nothing is lost.
    """

    encode: Callable[[str], tuple[np.ndarray, np.ndarray]]
    remembered: int
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    size: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    flat: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, and the bounds of the texts."""
        words = pieces(texts)
        value, at, of = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.known) > self.remembered:
            self.known, self.start, self.size, self.flat = (a[:0] for a in (self.known, self.start, self.size, self.flat))
        place = np.searchsorted(self.known, value)
        old = place < len(self.known)
        old[old] = self.known[place[old]] == value[old]
        new = np.flatnonzero(~old)
        if len(new):
            ids, size = self.encode(join(words, at[new], b"\n").decode())
            begin = len(self.flat) + np.cumsum(size) - size
            self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
            both = np.concatenate([self.known, value[new]])
            order = np.argsort(both, kind="stable")  # two sorted runs
            self.known = both[order]
            self.start = np.concatenate([self.start, begin])[order]
            self.size = np.concatenate([self.size, size])[order]
            place = np.searchsorted(self.known, value)
        start, each = self.start[place][of], self.size[place][of]
        ends = np.cumsum(each)
        ids = self.flat[np.repeat(start - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[words.first]
