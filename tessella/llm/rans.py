"""Token-id files compressed by a static range asymmetric numeral system.

A file set is a folder of two Parquet tables. ``table`` holds the shared frequencies (id, n, share): the shares of all
ids sum to 2**SCALE. ``blocks`` holds independent blocks of whole documents in ascending document order: where the
block begins, its documents' ids and lengths, the coder's states at its start (the checkpoint from which any task can
decode it), its 32-bit words and a CRC-32 of what it decodes to.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.text import slices
from tessella.llm.wordids import WordEncoder
from tessella.session import scratch_path

SCALE = 20          # frequencies are multiples of 2**-SCALE
SLICE_BYTES = 8 << 20
REMEMBERED = 2_000_000  # distinct words that a task keeps
LANES = 1024        # interleaved coders of a block
BLOCK_IDS = 1 << 18  # a block ends with the document that reaches so many ids
PART_BYTES = 32 << 20  # text of one sorted part
RUN = 2000          # words that the library encodes in one call
LOW = np.uint64(1 << 31)
BLOCKS = ("part int, block int, first long, n long, docs binary, lengths binary, states binary, words binary, "
          "checksum long")


def shares(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Integer shares of 2**scale in proportion to counts; every id that occurs gets one at least."""
    total, used = 1 << scale, np.flatnonzero(counts)
    if len(used) > total:
        raise ValueError("more ids than shares")
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    exact = counts[used] / counts[used].sum() * total
    out[used] = np.maximum(1, np.floor(exact).astype(np.int64))
    rest = total - out.sum()
    by_size = used[np.argsort(-counts[used], kind="stable")]
    while rest:  # spread what rounding left over or took too much, largest first
        change = np.sign(rest)
        able = by_size[out[by_size] > 1] if change < 0 else by_size
        take = able[:abs(rest)]
        out[take] += change
        rest -= change * len(take)
    return out


class Coder:
    """Encodes and decodes blocks under one share table."""

    def __init__(self, share: np.ndarray, scale: int = SCALE, lanes: int = LANES):
        self.share = share.astype(np.uint64)
        self.base = (np.cumsum(share) - share).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(share), dtype=np.uint32), share)
        self.scale, self.mask, self.lanes = np.uint64(scale), np.uint64((1 << scale) - 1), lanes
        self.filler = int(np.argmax(share)) if len(share) else 0

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(states, words) of a block: id k belongs to lane k mod lanes, and ids are coded from the last to the first."""
        steps = -(-len(ids) // self.lanes)
        grid = np.full(steps * self.lanes, self.filler, np.int64)
        grid[:len(ids)] = ids
        grid = grid.reshape(steps, self.lanes)
        x = np.full(self.lanes, LOW, np.uint64)
        most = np.uint64(31 - int(self.scale) + 32)
        words: list[np.ndarray] = []
        for row in grid[::-1]:
            f, c = self.share[row], self.base[row]
            full = x >= f << most
            words.append(x[full].astype(np.uint32))
            x[full] >>= np.uint64(32)
            q = x // f
            x = (q << self.scale) + (x - q * f) + c
        return x, np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)

    def decode(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        steps = -(-n // self.lanes)
        out = np.empty((steps, self.lanes), np.uint32)
        x, at = states.astype(np.uint64), 0
        for k in range(steps):
            low = x & self.mask
            row = self.slot[low]
            out[k] = row
            x = self.share[row] * (x >> self.scale) + low - self.base[row]
            short = np.flatnonzero(x < LOW)
            if len(short):
                x[short] = (x[short] << np.uint64(32)) | words[at:at + len(short)]
                at += len(short)
        return out.ravel()[:n]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> WordEncoder:
    """Ids by the tokenizers library, for vocabularies that drop white space and split letters from signs."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    mark = encode("!")

    def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
        # words in runs, told apart by a lone mark; words that hold the mark go one by one
        words = text.split("\n")[:-1]
        plain = [k for k, w in enumerate(words) if "!" not in w]
        size = np.zeros(len(words), np.int64)
        parts: list[np.ndarray | None] = [None] * len(words) if len(plain) < len(words) else []
        runs = []
        for k in range(0, len(plain), RUN):
            ids = encode("".join(f"{words[i]} ! " for i in plain[k:k + RUN]))
            ends = np.flatnonzero(ids == mark[0])
            size[plain[k:k + RUN]] = np.diff(ends, prepend=-1) - 1
            runs.append(np.delete(ids, ends))
        flat = np.concatenate(runs) if runs else np.zeros(0, np.uint32)
        if not parts:
            return flat, size
        cuts = np.cumsum(size[plain])
        for i, piece in zip(plain, np.split(flat, cuts[:-1]) if len(plain) else [], strict=True):
            parts[i] = piece
        for k, w in enumerate(words):
            if parts[k] is None:
                parts[k] = encode(w)
                size[k] = len(parts[k])
        return np.concatenate(parts), size

    return WordEncoder(lines, REMEMBERED)


def with_ends(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with ``end`` after each."""
    return np.insert(ids, bounds[1:], end), bounds + np.arange(len(bounds))


def tokenize(docs: DataFrame, folder: str, path: str, key: str, text: str, end: int) -> np.ndarray:
    """Write (key, ids) to ``folder`` and give each id's count over all documents.

    Texts are encoded once: a task adds its counts as a row of their own, and sums meet by id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for rows in slices(batches, text, SLICE_BYTES):
            ids, bounds = with_ends(*library_encoder(path).ids(rows.column(1)), end)
            got = np.bincount(ids, minlength=len(total))
            got[:len(total)] += total
            total = got
            raw = ids.astype("<u2" if len(got) <= 1 << 16 else "<u4")
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows.num_rows, [
                None, pa.py_buffer((bounds * raw.itemsize).astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), packed.cast(pa.binary()), pa.array([raw.itemsize] * rows.num_rows, pa.int32())],
                ["doc", "ids", "width"])
        used = np.flatnonzero(total)
        counts = np.stack([used, total[used]], 1).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([counts], pa.binary()),
                                          pa.array([0], pa.int32())], ["doc", "ids", "width"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            pairs = np.concatenate([np.frombuffer(v, "<i8").reshape(-1, 2) for v in rows.column(0).to_pylist()] or
                                   [np.zeros((0, 2), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int32()), pa.array(pairs[:, 1])], ["id", "n"])

    docs.mapInArrow(run, "doc long, ids binary, width int").write.option("compression", "zstd").parquet(folder)
    counts = docs.sparkSession.read.schema("doc long, ids binary, width int").parquet(folder).where("width = 0").select("ids")
    sums = counts.mapInArrow(unpack, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(max((r.id for r in sums), default=-1) + 1, np.int64)  # at most one row for each vocabulary entry
    for r in sums:
        total[r.id] = r.n
    return total


def write_ids(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end: int = 2) -> None:
    """Write each text's ids and ``end`` as a file set in ascending order of ``key``.

    Ids are those of the tokenizers library for the file ``path``. A null text counts as empty and has the end id only;
    a null key comes first; rows that share a key stand in order of their ids. An empty table gives no blocks.
    """
    spark = docs.sparkSession
    docs = docs.selectExpr(f"cast(`{key}` as long) as `{key}`", f"`{text}`")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    plain = scratch_path(spark, "plain-ids")
    count = tokenize(docs, plain, path, key, text, end)
    share = shares(count)
    used = np.flatnonzero(count).tolist()
    spark.createDataFrame([(i, int(count[i]), int(share[i])) for i in used], "id int, n long, share long") \
        .coalesce(1).write.parquet(f"{folder}/table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(share), TaskContext.get().partitionId()
        first = block = 0
        docs_, sizes, held, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal first, block, docs_, sizes, held, n
            ids = np.concatenate(held).astype(np.uint32)
            states, words = coder.encode(ids)
            row = {"part": part, "block": block, "first": first, "n": len(ids),
                   "docs": np.concatenate(docs_).astype("<i8").tobytes(),
                   "lengths": np.concatenate(sizes).astype("<u4").tobytes(), "states": states.astype("<u8").tobytes(),
                   "words": words.astype("<u4").tobytes(), "checksum": zlib.crc32(ids.astype("<u4").tobytes())}
            first, block, docs_, sizes, held, n = first + len(ids), block + 1, [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=layout)

        for rows in batches:
            parts = [np.frombuffer(v.as_buffer(), f"<u{w}") for v, w in
                     zip(rows.column(1), rows.column(2).to_pylist(), strict=True)]
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            names = rows.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
            at = 0
            while at < rows.num_rows:
                to = min(rows.num_rows, int(np.searchsorted(bounds, bounds[at] + BLOCK_IDS - n)))
                docs_.append(names[at:to])
                sizes.append(np.diff(bounds[at:to + 1]))
                held += parts[at:to]
                n += int(bounds[to] - bounds[at])
                at = to
                if n >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    layout = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int64()),
                        ("docs", pa.binary()), ("lengths", pa.binary()), ("states", pa.binary()), ("words", pa.binary()),
                        ("checksum", pa.int64())])
    spark.read.schema("doc long, ids binary, width int").parquet(plain).where("width > 0") \
        .repartitionByRange(-(-size // PART_BYTES) or 1, "doc").sortWithinPartitions("doc", "ids") \
        .mapInArrow(run, BLOCKS).write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of each document of a file set; ids as little-endian unsigned 32-bit integers.

    Blocks are decoded in parallel, each from its own states; a block that doesn't decode to its checksum is an error.
    """
    table = spark.read.parquet(f"{folder}/table").select("id", "share").collect()  # bounded by the vocabulary
    share = np.zeros(max((r.id for r in table), default=-1) + 1, np.int64)
    for r in table:
        share[r.id] = r.share
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    begin, starts = 0, []
    for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one row for each file
        starts.append((r.part, begin))
        begin += r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, offset = Coder(share), dict(starts)
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
                raw = {c: np.frombuffer(r[c].as_buffer(), t) for c, t in
                       (("docs", "<i8"), ("lengths", "<u4"), ("states", "<u8"), ("words", "<u4"))}
                ids = coder.decode(raw["states"], raw["words"], r["n"].as_py()).astype("<u4")
                if zlib.crc32(ids.tobytes()) != r["checksum"].as_py():
                    raise ValueError(f"block {r['block']} of part {r['part']} is damaged")
                bounds = np.concatenate([[0], np.cumsum(raw["lengths"].astype(np.int64))])
                names = raw["docs"]
                start = bounds[:-1] + r["first"].as_py() + offset[r["part"].as_py()]
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(names), [
                    None, pa.py_buffer((bounds * 4).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64(), mask=names == np.iinfo(np.int64).min), pa.array(start, pa.int64()),
                     pa.array(np.diff(bounds), pa.int64()), packed.cast(pa.binary())], [key, "start", "n_tokens", "ids"])

    return blocks.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = 2) -> DataFrame:
    """Write a file set to a fresh folder in the shared scratch space and read it back."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, folder, path, key, text, end)
    return read_ids(docs.sparkSession, folder, key)
