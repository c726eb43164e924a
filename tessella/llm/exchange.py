"""A shared-key exchange: which keys of a batch of documents occur in other batches too, and where first.

Rows of one key never travel one by one. Documents are dealt to batches by a hash of their id. A batch sends each of
its distinct keys once, packed by key range ("bucket"); a bucket compares the packs and replies two bits for each key.
A key that every document holds costs one entry for each batch, so no hot key can fill a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 2 << 20   # text that one batch holds on average
BUCKET_BYTES = 16 << 20  # text whose keys one bucket holds on average
NO_ID = np.iinfo(np.int64).min  # stands for a null id: it comes before all others
PACK = "__batch long, __bucket long, __keys binary, __docs binary, __runs binary, __many binary"
REPLY = "__batch long, __bucket long, __shared binary, __first binary"
KEY_BYTES = 7


@dataclass
class Keys:
    """Key occurrences of a batch in document order.

    value: 56 bits that are compared; place: 32 further bits that choose the bucket; doc: index of the document's row;
    distinct_docs: totals count a document once, else every occurrence; line: the line of each, for line keys.
    """

    value: np.ndarray
    place: np.ndarray
    doc: np.ndarray
    distinct_docs: bool = False
    line: np.ndarray | None = None


@dataclass
class Distinct:
    """The distinct keys of a batch in order of their bucket, then of first occurrence."""

    of: np.ndarray       # occurrence -> distinct key
    leads: np.ndarray    # occurrence is the first of its key here
    value: np.ndarray
    doc: np.ndarray
    total: np.ndarray
    bucket: np.ndarray


def distinct(keys: Keys, buckets: int) -> Distinct:
    bucket = (keys.place.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
    both = keys.value ^ (keys.place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both, kind="stable")
    ranked = both[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(new) - 1
    first = order[new]  # stable: the earliest occurrence of each
    if keys.distinct_docs:
        docs = keys.doc[order]
        fresh = new.copy()
        fresh[1:] |= docs[1:] != docs[:-1]
        total = np.bincount(group[fresh], minlength=len(first))
    else:
        total = np.bincount(group, minlength=len(first))
    place = np.lexsort((first, bucket[first]))
    where = np.empty(len(first), np.int64)
    where[place] = np.arange(len(first))
    of = np.empty(len(order), np.int64)
    of[order] = where[group]
    leads = np.zeros(len(order), bool)
    leads[first] = True
    first = first[place]
    return Distinct(of, leads, keys.value[first], keys.doc[first], total[place], bucket[first])


def ordered(table: pa.Table, key: str, text: str) -> tuple[pa.Table, np.ndarray]:
    """The rows of a batch by id, then text: the same order in every pass; and the ids."""
    table = table.combine_chunks()
    ids = table.column(key).cast(pa.int64()).fill_null(int(NO_ID)).to_numpy()
    if len(np.unique(ids)) < len(ids):  # repeated ids: equal rows may stand in any order
        rank = {t: i for i, t in enumerate(sorted({t or "" for t in table.column(text).to_pylist()}))}
        order = np.lexsort((np.array([rank[t or ""] for t in table.column(text).to_pylist()]), ids))
    else:
        order = np.argsort(ids, kind="stable")
    return table.take(pa.array(order)), ids[order]


def _packs(batch: int, ids: np.ndarray, found: Distinct) -> Iterator[dict]:
    cuts = np.flatnonzero(np.diff(found.bucket)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(found.bucket)], strict=True):
        if hi == lo:
            continue
        change = np.flatnonzero(np.diff(found.doc[lo:hi])) + 1
        heads = np.concatenate([[0], change])
        many = np.flatnonzero(found.total[lo:hi] > 1)
        raw = found.value[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        yield {
            "__batch": batch, "__bucket": int(found.bucket[lo]), "__keys": np.ascontiguousarray(raw).tobytes(),
            "__docs": ids[found.doc[lo:hi][heads]].astype("<i8").tobytes(),
            "__runs": np.diff(np.append(heads, hi - lo)).astype("<u4").tobytes(),
            "__many": np.stack([many, found.total[lo:hi][many]], 1).astype("<u4").tobytes(),
        }


def _settle(table: pa.Table, least: int) -> pa.Table:
    """The replies of one bucket to each of its packs."""
    packs = table.combine_chunks()
    col = {c: [v.as_buffer() for v in packs.column(c)] for c in ("__keys", "__docs", "__runs", "__many")}
    sizes = np.array([b.size // KEY_BYTES for b in col["__keys"]])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.zeros((starts[-1], 8), np.uint8)
    total = np.ones(starts[-1], np.int64)
    for i, b in enumerate(col["__keys"]):
        raw[starts[i]:starts[i + 1], :KEY_BYTES] = np.frombuffer(b, np.uint8).reshape(-1, KEY_BYTES)
        many = np.frombuffer(col["__many"][i], "<u4").reshape(-1, 2).astype(np.int64)
        total[starts[i] + many[:, 0]] = many[:, 1]
    value = raw.view("<u8").ravel()
    order = np.argsort(value)
    ranked = value[order]
    same = np.zeros(len(order), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    joined = same.copy()
    joined[:-1] |= same[1:]
    met = order[joined]  # keys of several packs; all others are first where they are
    first = np.ones(starts[-1], bool)
    sums = total
    if len(met):
        runs = np.concatenate([np.frombuffer(b, "<u4") for b in col["__runs"]]).astype(np.int64)
        docs = np.concatenate([np.frombuffer(b, "<i8") for b in col["__docs"]])
        doc = docs[np.searchsorted(np.cumsum(runs), met, side="right")]
        by = np.lexsort((met, doc, value[met]))
        met = met[by]
        head = np.ones(len(met), bool)
        head[1:] = value[met][1:] != value[met][:-1]
        first[met] = head
        group = np.cumsum(head) - 1
        sums = total.copy()
        sums[met] = np.bincount(group, weights=total[met])[group].astype(np.int64)
    shared = sums >= least
    rows = [i for i in range(len(sizes)) if shared[starts[i]:starts[i + 1]].any()]
    bits = [[np.packbits(a[starts[i]:starts[i + 1]]).tobytes() for i in rows] for a in (shared, first)]
    return pa.table({
        "__batch": packs.column("__batch").take(pa.array(rows, pa.int64())),
        "__bucket": packs.column("__bucket").take(pa.array(rows, pa.int64())),
        "__shared": pa.array(bits[0], pa.binary()), "__first": pa.array(bits[1], pa.binary()),
    })


def volume(docs: DataFrame, text: str) -> int:
    """Bytes of all texts, by which batches and buckets are counted."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def exchange(docs: DataFrame, key: str, text: str, find: Callable[[pa.Table], Keys],
             apply: Callable[[pa.Table, Keys, np.ndarray, np.ndarray], pa.Table], schema: str, least: int) -> DataFrame:
    """Apply ``apply(rows, keys, shared, later)`` to each batch of documents.

    ``find`` gives the keys of a batch. For each occurrence, ``shared`` says that its key's total over all documents is
    at least ``least``, and ``later`` that an earlier occurrence exists (smaller id, or earlier in the same document).
    """
    size = volume(docs, text)
    batches, buckets = -(-size // BATCH_BYTES) or 1, -(-size // BUCKET_BYTES) or 1
    dealt = docs.withColumn("__batch", F.pmod(F.xxhash64(F.col(key)), F.lit(batches)).cast("long"))
    columns = docs.columns

    def pack(table: pa.Table) -> pa.Table:
        batch = table.column("__batch")[0].as_py()
        rows, ids = ordered(table.select(columns), key, text)
        keys = find(rows)
        return pa.Table.from_pylist(list(_packs(batch, ids, distinct(keys, buckets))), schema=packed)

    def reply(table: pa.Table) -> pa.Table:
        return _settle(table, least)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, _ = ordered(left.select(columns), key, text)
        keys = find(rows)
        found = distinct(keys, buckets)
        shared, first = np.zeros(len(found.value), bool), np.ones(len(found.value), bool)
        bounds = np.searchsorted(found.bucket, np.arange(buckets + 1))
        for r in right.select(["__bucket", "__shared", "__first"]).to_pylist():
            lo, hi = bounds[r["__bucket"]], bounds[r["__bucket"] + 1]
            for out, bits in ((shared, r["__shared"]), (first, r["__first"])):
                out[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        pa.default_memory_pool().release_unused()
        return apply(rows, keys, shared[found.of], ~(found.leads & first[found.of]))

    packed = pa.schema([("__batch", pa.int64()), ("__bucket", pa.int64())]
                       + [(c, pa.binary()) for c in ("__keys", "__docs", "__runs", "__many")])
    replies = dealt.groupBy("__batch").applyInArrow(pack, PACK).groupBy("__bucket").applyInArrow(reply, REPLY)
    return dealt.groupBy("__batch").cogroup(replies.groupBy("__batch")).applyInArrow(finish, schema)
