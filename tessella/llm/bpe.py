"""Byte-pair encoding by backtracking over longest token matches, and decoding by an offset table."""

from __future__ import annotations

import gc
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessella.llm.text import slices
from tessella.llm.wordids import WordEncoder

SLICE_BYTES = 1 << 20
REMEMBERED = 400_000  # distinct words that a task keeps
RUN = 1 << 17  # ids that are decoded at once
END = 0x10000  # added to the last letter's code: a letter at a word's end is a symbol of its own


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes are their own."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens of a word-end BPE file: a token is a string of letters, the last of which may end a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        if not self.suffix or model["continuing_subword_prefix"] or model["unk_token"] or model["ignore_merges"]:
            raise ValueError("a BPE file with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        symbols = {t: self.symbols(t) for t in self.ids}
        self.length = {i: len(symbols[t]) for t, i in self.ids.items()}
        self.matcher = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.matcher.add_word(symbols[t], i)
        self.matcher.make_automaton()
        by_symbols = {s: self.ids[t] for t, s in symbols.items()}
        #: the longest token that is a proper prefix, -1 for none
        self.shorter = {}
        for t, i in self.ids.items():
            s = symbols[t]
            self.shorter[i] = next((by_symbols[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in by_symbols), -1)
        self.rank: dict[tuple[int, int], int] = {}
        self.made = dict.fromkeys(self.ids.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for k, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair = (self.ids[a], self.ids[b])
            whole = self.ids[a + b]
            self.rank[pair] = k
            if whole in self.parts:
                raise ValueError(f"two merges make {a + b!r}")
            self.made[whole], self.parts[whole] = k, pair
        self.fits = lru_cache(maxsize=1 << 16)(self._fits)

    def symbols(self, token: str) -> str:
        if token.endswith(self.suffix) and token != self.suffix:
            token = token[:-len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + END)
        return token

    def _fits(self, a: int, b: int) -> bool:
        """Whether tokens a and b stay side by side: no merge across their border would have come first.

        Undoes the merges inside both, latest first. A pair at the border merges if its rank is below that of the merge
        that ends the pair; at equal rank the left one goes first, which a merge on the right loses.
        """
        before = len(self.rank)
        while True:
            if self.rank.get((a, b), before) < before:
                return False
            if self.made[a] > self.made[b]:
                before = self.made[a]
                a = self.parts[a][1]
            elif self.made[b] >= 0:
                before = self.made[b] + 1
                b = self.parts[b][0]
            else:
                return True

    def encode(self, symbols: str) -> list[int]:
        """The ids of one word in linear time: the only sequence of tokens that covers it and fits side by side."""
        n = len(symbols)
        longest = [-1] * n
        for end, token in self.matcher.iter(symbols):
            start = end + 1 - self.length[token]
            if longest[start] < 0 or self.length[token] > self.length[longest[start]]:
                longest[start] = token
        open_ = [True] * (n + 1)  # ends that haven't failed yet
        done: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + self.length[token]
                if open_[end] and (not done or self.fits(done[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                done.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                if not done:
                    raise ValueError("the vocabulary can't spell this word")
                open_[at] = False
                token = done.pop()
                at -= self.length[token]
                token = self.shorter[token]
        return done


class Encoder:
    """A text's ids as the vocabulary's file defines them: specials, NFC, lower case, pieces, bytes, merges."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.letters = byte_letters()
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocabulary.special)) + ")")
        # fixed value: the file's splitting pattern
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        self.kept: dict[str, list[int]] = {}

    def piece(self, piece: str) -> list[int]:
        got = self.kept.get(piece)
        if got is None:
            s = "".join(self.letters[b] for b in piece.encode())
            got = self.vocabulary.encode(s[:-1] + chr(ord(s[-1]) + END))
            if len(self.kept) > 60_000:
                self.kept.clear()
            self.kept[piece] = got
        return got

    def word(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.special.split(text) if "<|" in text else (text,):
            if part in self.vocabulary.special:
                ids.append(self.vocabulary.special[part])
                continue
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()  # no final sigma
            for piece in self.pieces.findall(part):
                ids += self.piece(piece)
        return ids

    def lines(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that each end in a line break, and how many each has."""
        ids: list[int] = []
        ends = []
        for word in text.split("\n")[:-1]:
            ids += self.word(word)
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(np.array(ends, np.int64), prepend=0)


class Decoder:
    """Token bytes one after another with their offsets; a text is its tokens joined by one space."""

    def __init__(self, vocabulary: Vocabulary):
        top = max(vocabulary.names) + 1
        names = [(vocabulary.names.get(i, "") + " ").encode() for i in range(top)]
        self.start = np.concatenate([[0], np.cumsum([len(b) for b in names])])
        self.data = np.frombuffer(b"".join(names), np.uint8)

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        size = self.start[ids + 1] - self.start[ids]
        ends = np.cumsum(size)
        runs = []
        for k in range(0, len(ids), RUN):  # the gather's index is eight times its bytes
            part, wide = ids[k:k + RUN], size[k:k + RUN]
            runs.append(self.data[np.repeat(self.start[part] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())])
        data = np.concatenate(runs) if runs else self.data[:0]
        at = np.concatenate([[0], ends])[bounds]
        keep = np.ones(len(data), bool)
        keep[at[1:][np.diff(at) > 0] - 1] = False  # the space after a text's last token
        full = (np.diff(at) > 0).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(np.diff(at) - full)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(at.tobytes()),
                                                pa.py_buffer(data[keep].tobytes()))


def _coder(path: str) -> tuple[Encoder, Decoder, WordEncoder]:
    """Built in each task and dropped with it: a worker that goes on to other stages keeps no vocabulary."""
    encoder = Encoder(path)
    return encoder, Decoder(encoder.vocabulary), WordEncoder(encoder.lines, REMEMBERED)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids, decoded) for each row; ``ids`` are little-endian unsigned 32-bit integers.

    ``path`` names the vocabulary file, which every executor must have. Null and empty texts have no ids and decode to
    an empty text. Rows are independent: repeated ids and rows are encoded each. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder, coder = _coder(path)
        for rows in slices(batches, text, SLICE_BYTES):
            ids, bounds = coder.ids(rows.column(1))
            raw = ids.astype("<u4").tobytes()
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), rows.num_rows, [None, pa.py_buffer((bounds * 4).astype(np.int64).tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(bounds), pa.int64()), packed.cast(pa.binary()),
                 decoder.texts(ids, bounds).cast(pa.string())], [key, "n_tokens", "ids", "decoded"])
        encoder.vocabulary.fits.cache_clear()  # the cache and the vocabulary hold each other
        del encoder, decoder, coder
        gc.collect()
        pa.default_memory_pool().release_unused()

    return docs.selectExpr(f"cast(`{key}` as long) as `{key}`", f"`{text}`").mapInArrow(
        run, f"`{key}` long, n_tokens long, ids binary, decoded string")
