"""SimHash near-duplicates: fingerprints, bit-sliced comparison of candidates and linked components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.frames import carried, fields
from tessella.llm.text import LOWER, buffers, slices
from tessella.session import cut_lineage

SLICE_BYTES = 1 << 20
TILE = 1 << 15       # fingerprints of one candidate key that are compared as one block of bit planes
QUERIES_AT_ONCE = 256


def fingerprint(shingle_hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each run of hashes: a bit is 1 if it is set in over half of them; none: zero."""
    size = np.diff(bounds)
    ones = np.zeros((len(size), 64), np.int64)
    full = np.flatnonzero(size)
    if len(full):
        bits = np.unpackbits(shingle_hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones[full] = np.add.reduceat(bits, bounds[:-1][full], axis=0, dtype=np.int64)
    return np.packbits(2 * ones > size[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def text_fingerprints(texts: pa.Array, width: int, seed: int) -> np.ndarray:
    """Fingerprints of texts by XXH64 of their word shingles, A-Z lower-cased, repeats included."""
    data, bounds = buffers(texts)
    data = LOWER[data].tobytes()
    hashes, counts, one = [], [], xxhash.xxh64_intdigest
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        words = data[lo:hi].split()
        n = max(len(words) - width + 1, 1) if words else 0
        if n == 1:
            hashes.append(one(b" ".join(words), seed))
        elif n:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate([[0], ends[:n - 1]])
            hashes += [one(line[a:b], seed) for a, b in zip(starts.tolist(), (ends[width - 1:] - 1).tolist(), strict=True)]
        counts.append(n)
    return fingerprint(np.array(hashes, np.uint64), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]))


def fingerprints(docs: DataFrame, key: str, text: str, width: int, seed: int) -> DataFrame:
    """(key, fp): a signed 64-bit fingerprint for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, text, SLICE_BYTES):
            fp = text_fingerprints(rows.column(1), width, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp)], [key, "fp"])

    return docs.selectExpr(f"cast(`{key}` as long) as `{key}`", f"`{text}`").mapInArrow(run, f"`{key}` long, fp long")


def planes(values: np.ndarray) -> np.ndarray:
    """Vertical layout: row b holds bit b of all values, packed in 64-bit words."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).T
    pad = -len(values) % 64
    return np.ascontiguousarray(np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1)).view(np.uint64)


def near(queries: np.ndarray, block: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """For runs of queries, a boolean matrix of the block's values at ``radius`` differing bits or fewer.

    Distances of all pairs grow plane by plane in bit-sliced counters: a carry-save addition of one difference bit for
    each lane, a sticky lane for those beyond the radius, and an end as soon as every lane is beyond.
    """
    vertical, digits = planes(block), max(radius, 1).bit_length()
    limit = np.uint64(0xFFFFFFFFFFFFFFFF)
    lanes = np.zeros(vertical.shape[1], np.uint64)
    lanes[:] = limit
    if len(block) % 64:
        lanes[-1] = np.packbits(np.arange(64) < len(block) % 64).view(np.uint64)[0]
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        asked = queries[start:start + QUERIES_AT_ONCE]
        count = [np.zeros((len(asked), vertical.shape[1]), np.uint64) for _ in range(digits)]
        live = np.broadcast_to(lanes, count[0].shape).copy()
        for b in range(64):
            flip = np.where((asked >> np.uint64(63 - b)) & np.uint64(1), limit, np.uint64(0))[:, None]
            carry = vertical[b] ^ flip
            for c in count:
                c ^= carry
                carry &= ~c  # a digit that went from 1 to 0 carries on
            live &= ~carry
            if radius + 1 < 1 << digits:
                over = ~np.zeros_like(live)
                for d, c in enumerate(count):
                    over &= c if (radius + 1) >> d & 1 else ~c
                live &= ~over
            if not live.any():
                break
        else:
            hit = np.unpackbits(live.view(np.uint8), axis=1)[:, :len(block)].astype(bool)
            yield start, hit


def spanning(values: np.ndarray, other: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of all pairs within ``radius``; with ``other``, of pairs between the two."""
    both = values if other is None else np.concatenate([values, other])
    block = values if other is None else other
    offset = 0 if other is None else len(values)
    root = np.arange(len(both))
    left, right = [], []
    for start, hit in near(values, block, radius):
        for q, row in enumerate(hit):
            me = start + q
            met = np.flatnonzero(row) + offset
            apart = met[root[met] != root[me]]
            if not len(apart):
                continue
            found, at = np.unique(root[apart], return_index=True)
            left += [me] * len(found)
            right += apart[at].tolist()
            groups = np.append(found, root[me])
            root[np.isin(root, groups)] = groups.min()
    return both[left], both[right]


def links(prints: DataFrame, radius: int) -> DataFrame:
    """(a, b) between distinct fingerprints: they join exactly those within ``radius`` bits, directly or in steps.

    Two prints within ``radius`` bits agree on at least two of radius + 2 bit fields, so the pairs of fields are the
    candidate keys. A key of many prints is dealt in tiles, and each pair of tiles is one comparison.
    """
    fields = radius + 2
    cuts = [64 * i // fields for i in range(fields + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]
    pairs = list(combinations(range(fields), 2))
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keyed = prints.select("fp", F.explode(F.array(*(
        F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(masks[i] | masks[j]))).alias("v"))
        for k, (i, j) in enumerate(pairs)))).alias("key")).select("fp", "key.t", "key.v")
    sized = keyed.groupBy("t", "v").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("long")
    met = keyed.join(sized, ["t", "v"]).withColumn("k", tiles) \
        .withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("k")))
    # tile pairs (i <= j): a print of tile m is the left side of (m, j) and the right side of (i, m)
    dealt = met.select("fp", "t", "v", "mine", F.explode(F.expr("sequence(0L, k - 1)")).alias("o")) \
        .select("fp", "t", "v", F.least("mine", "o").alias("i"), F.greatest("mine", "o").alias("j"), "mine")

    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        mine, i, j = (table.column(c).to_numpy() for c in ("mine", "i", "j"))
        fp_order = np.argsort(fp)
        fp, mine = fp[fp_order], mine[fp_order]
        other = None if i[0] == j[0] else fp[mine == j[0]]
        a, b = spanning(fp if other is None else fp[mine == i[0]], other, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("t", "v", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach.

    Alternating star contraction: every round links a node's larger neighbours, then its smaller ones, to the smallest;
    it ends when a round changes nothing. A star is replaced by its edges one by one, so no node's list is gathered.
    """
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        # large star: for each node, neighbours above it go to its smallest neighbour
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: for each node, its smaller neighbours and itself go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        new = cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        sums = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = new
        if sums == before:
            return now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        before = sums


def grouped(docs: DataFrame, key: str, text: str, width: int, radius: int, seed: int) -> DataFrame:
    """(key, fp, root) of each row; rows of one group have the same root, a fingerprint of the group."""
    prints = cut_lineage(fingerprints(docs, key, text, width, seed))
    roots = components(links(cut_lineage(prints.select("fp").distinct()), radius)) \
        .select(F.col("node").alias("__node"), "root")
    return prints.join(roots, F.col("fp") == F.col("__node"), "left").select(key, "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2,
                    seed: int = 42) -> DataFrame:
    """(key, fingerprint, component_id) for each row: the smallest id that can be reached over linked fingerprints.

    Words are split at ASCII white space after lower-casing A-Z; shingles have ``width`` words, a shorter text is one
    shingle, and a text without words (null, empty) has fingerprint zero and links like any other. Two fingerprints link
    at ``radius`` differing bits or fewer. A null id takes no part in choosing the smallest one but gets its component;
    rows that share an id each have their row. Other columns are not read. An empty table gives an empty result.
    """
    prints = cut_lineage(fingerprints(docs, key, text, width, seed))
    by_print = cut_lineage(prints.groupBy("fp").agg(F.min(key).alias("low")))
    roots = components(links(by_print.select("fp"), radius))
    linked = by_print.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    group = linked.join(smallest, "root").select(F.col("fp").alias("f"), "component_id")
    return prints.join(group, F.col("fp") == F.col("f"), "left").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2,
             seed: int = 42) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the one of the smallest id.

    Groups are those of the rows' own fingerprints, so rows that share an id but no group are judged apart. Of several
    rows with a group's smallest id, the one of the smallest fingerprint, then text, stays. Ids come before no id: a row
    without an id stays only in a group of such rows, of which again one stays. An empty table gives an empty result.
    """
    docs = docs.select(*(f"`{c}`" for c in carried(docs)))
    rows = cut_lineage(grouped(docs, key, text, width, radius, seed))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col(key).isNull(), F.col(key), F.col("fp"))).alias("w"))
    # rows that alone have their id are known by it, others by their fingerprint too
    shared = rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).select(F.col(key).alias("__id"))
    shared = cut_lineage(shared)
    kept = cut_lineage(first.select(F.col(f"w.{key}").alias("__kept"), F.col("w.fp").alias("__print")))
    own_id = F.col(key).cast("long")
    if shared.isEmpty():
        return docs.join(kept.select("__kept"), own_id == F.col("__kept"), "left_semi")
    alone = kept.where("__kept is not null").join(shared, F.col("__kept") == F.col("__id"), "left_anti")
    several = docs.join(shared.where("__id is not null"), own_id == F.col("__id"), "left_semi").unionByName(docs.where(own_id.isNull()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE_BYTES):
            fp = text_fingerprints(batch.column(batch.schema.get_field_index(text)), width, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], [*batch.schema.names, "__fp"])

    # equal ids and fingerprints are one row each task before they meet, however many they are
    one = several.mapInArrow(mark, f"{fields(docs)}, __fp long").withColumn(
        "__rank", F.row_number().over(Window.partitionBy(key, "__fp").orderBy(text))).where("__rank = 1").drop("__rank")
    met = own_id.eqNullSafe(F.col("__kept")) & (F.col("__fp") == F.col("__print"))
    return docs.join(alone.select("__kept"), own_id == F.col("__kept"), "left_semi").unionByName(
        one.join(kept, met, "left_semi").drop("__fp"))
