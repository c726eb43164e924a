"""Approximate nearest neighbours along several Hilbert curves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.frames import bounded_sample
from tessella.session import cut_lineage

CURVES, DIMS, BITS = 4, 4, 14
BLOCK_ROWS = 4096    # neighbours on a curve that are searched as one matrix
QUERY_ROWS = 4096    # queries that meet a block in one task
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 128
SHARES = (0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of integer cells (row, dimension) on a Hilbert curve of ``bits`` bits for each dimension.

    Skilling's method on all rows at once: undo the turns and mirrors of each level, Gray-decode, interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(dims):
            high = (x[d] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
        level >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where(x[-1] & level, turn ^ (level - 1), turn)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> b & 1)
    return key


@dataclass
class Curves:
    """Shifted Hilbert curves over random projections, and the share of a curve that a query looks at on each side."""

    basis: np.ndarray  # (curve, vector dimension, DIMS)
    low: np.ndarray
    span: np.ndarray
    shift: np.ndarray
    share: float = 0.5

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        at = (vectors @ self.basis[curve] - self.low[curve]) / self.span[curve] * 0.5 + self.shift[curve]
        return hilbert_key(np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS)


def nearest(queries: np.ndarray, block: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, row, distance) of the k nearest rows of a block for each query, ties to the smaller id.

    A product of matrices finds the rows that may be among them, and these are measured by differences.
    """
    rough = (queries**2).sum(1)[:, None] + (block**2).sum(1)[None] - 2 * queries @ block.T
    k = min(k, len(block))
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1]
    q, r = np.nonzero(rough <= (limit + 1e-9 * (1 + np.abs(limit) + (queries**2).sum(1)))[:, None])
    exact = np.sqrt(((queries[q] - block[r])**2).sum(1))
    order = np.lexsort((ids[r], exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], r[keep], exact[keep]


def fit_curves(sample: np.ndarray, neighbours: int, goal: float, seed: int = 11) -> Curves:
    """Random curves for the sample's spread, and the smallest share at which the sample finds ``goal`` of its own
    nearest neighbours."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    dims = min(DIMS, width)
    basis = np.stack([np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dims] for _ in range(CURVES)])
    at = np.einsum("nd,cdp->cnp", sample, basis)
    low, high = np.quantile(at, [0.001, 0.999], axis=1)
    curves = Curves(basis, low, np.maximum(high - low, 1e-12), rng.random((CURVES, dims)) * 0.5)
    n = len(sample)
    if n <= neighbours + 1:
        return curves
    asked = np.arange(min(SAMPLE_QUERIES, n))
    place = np.empty((CURVES, n))
    for c in range(CURVES):
        place[c][np.lexsort((np.arange(n), curves.keys(sample, c)))] = np.arange(n) / n
    q, r, _ = nearest(sample[asked], sample, np.arange(n), neighbours + 1)
    q, r = q[r != asked[q]], r[r != asked[q]]
    apart = np.abs(place[:, asked[q]] - place[:, r]).min(0)
    curves.share = next((s for s in SHARES if (apart <= s).mean() >= goal), SHARES[-1])
    return curves


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): rows with an id and a finite vector other than zero, as doubles."""
    return rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        "id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
        " and exists(v, x -> x != 0)")


def search(rows: DataFrame, asked: DataFrame, key: str = "vec_id", vector: str = "embedding", neighbours: int = 10,
           goal: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``asked`` its nearest rows found, by Euclidean distance.

    Every row is on all curves. On each, rows are range-partitioned by their key into blocks, and a query is compared
    with all rows of the blocks in its window: whole blocks, so that no candidate is left out for being one of many.
    Windows are a share of the curve, the smallest that finds ``goal`` of the neighbours within a sample of
    ``SAMPLE_ROWS`` rows; at half a curve on each side a window is the whole table and the search is exact.

    ``asked`` is a part of ``rows``. Equal vectors are compared once: their ``neighbours`` + 1 smallest ids stand for
    all of them, which no answer can tell from all. Ties go to the smaller id. Null, zero and non-finite vectors, those
    of another length than most, and rows without an id take no part; a repeated id counts as one of its rows; fewer
    candidates than ``neighbours`` are all returned. Other columns are not read.
    """
    spark = rows.sparkSession
    keep = neighbours + 1
    good = usable(rows, key, vector)
    length = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if length is None:
        return empty
    good = good.where(F.size("v") == length.n)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = good.distinct().withColumn("k", place).where(F.col("k") <= keep)
    distinct = cut_lineage(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))  # keep ids at most
    queries = usable(asked, key, vector).where(F.size("v") == length.n).distinct()
    asked_vectors = queries.select("v").distinct().withColumn("query", F.lit(True))
    sample = bounded_sample(distinct.select("v"), SAMPLE_ROWS, F.col("v")).collect()
    curves = fit_curves(np.array([r.v for r in sample]), neighbours, goal)
    n, m = distinct.count(), asked_vectors.count()
    blocks = -(-n // BLOCK_ROWS)
    reach = min(blocks, int(np.ceil(curves.share * blocks)))
    shared = spark.sparkContext.broadcast(curves)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = matrix(b.column(0))
                for c in range(CURVES):
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, c, np.int32)),
                                                      pa.array(shared.value.keys(at, c))], ["v", "ids", "query", "curve", "at"])

    laid = distinct.join(asked_vectors, "v", "left").select("v", "ids", F.coalesce("query", F.lit(False)).alias("query")) \
        .mapInArrow(lay, "v array<double>, ids array<long>, query boolean, curve int, at long")
    # equal keys are told apart by the id, so that a crowded cell spreads over blocks
    dealt = cut_lineage(laid.repartitionByRange(blocks * CURVES, "curve", "at", F.col("ids")[0])
                        .withColumn("block", F.spark_partition_id()))
    tiles = -(-m * (2 * reach + 1) // (blocks * QUERY_ROWS)) or 1
    target = dealt.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    windows = dealt.where("query").select(
        "curve", "v", F.col("ids")[0].alias("id"), F.pmod(F.xxhash64("v"), F.lit(tiles)).cast("int").alias("tile"),
        F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("block"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for c in np.unique(left.column("curve").to_numpy()) if right.num_rows else []:
            l, r = (t.filter(pa.array(t.column("curve").to_numpy() == c)).combine_chunks() for t in (left, right))
            if not r.num_rows:
                continue
            ids = l.column("ids").combine_chunks()
            lead = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]]
            asked_ids = r.column("id").to_numpy()
            block, points = matrix(l.column("v")), matrix(r.column("v"))
            for s in range(0, len(points), 1024):
                q, row, far = nearest(points[s:s + 1024], block, lead, keep)
                out.append(pa.table({"q": asked_ids[s:s + 1024][q], "c": lead[row], "score": far,
                                     "ids": ids.take(pa.array(row))}))
        kind = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
        return pa.concat_tables([t.cast(kind) for t in out]) if out else kind.empty_table()

    found = target.groupBy("block", "tile").cogroup(windows.groupBy("block", "tile")) \
        .applyInArrow(meet, "q long, c long, score double, ids array<long>")
    best = found.groupBy("q", "c").agg(F.min("score").alias("score"), F.first("ids").alias("ids")) \
        .withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy("score", "c"))).where(F.col("k") <= keep)
    # each asked row by its vector's smallest id
    lead = distinct.select("v", F.col("ids")[0].alias("q"))
    each = queries.join(lead, "v").select(F.col("id").alias("query_id"), "q")
    answers = each.join(best, "q").select("query_id", F.explode("ids").alias("vec_id"), "score").where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
