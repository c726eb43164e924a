"""Exact ranks, thresholds and order statistics that never sort everything into one task.

Random orders are hash orders (``digest``): the leading hex digits of an md5 split the rows into
buckets of equal expected size whatever the data looks like, so a rank is the count of the earlier
buckets plus a position inside one bucket.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import digest
from ..session import BROADCAST_LIMIT_BYTES, cut_lineage

HEX = 3  # hex digits read per counting pass: at most 4,096 counts come back
HOT_ROWS = 1_000_000  # rows that one task still orders with ease: a larger group or bucket is taken apart
SMALL = 20_000  # values fetched to settle the last step of a selection; checked by count first


def _bucket_counts(df: DataFrame, key: Column, width: int) -> list[tuple[str, int]]:
    rows = df.groupBy(F.substring(key, 1, width).alias("b")).count().collect()
    return sorted((r["b"], r["count"]) for r in rows)


def hash_thresholds(df: DataFrame, key: str, seed: int, positions: Sequence[int]) -> list[str]:
    """For each position m the digest below which exactly m rows fall, for a ``key`` that is unique."""
    return [cut for cut, _ in hash_cuts(df, key, seed, positions)]


def hash_cuts(df: DataFrame, key: str, seed: int, positions: Sequence[int]) -> list[tuple[str, int]]:
    """For each position m a digest, and how many rows of that very digest are among the first m.

    All rows of smaller digests are; the number is 0 unless the key repeats. Each pass counts rows per digest prefix
    over the key column alone and looks further only into the prefixes that hold a wanted position, so no row is ever
    shuffled, and however often a key repeats its rows are only counted.
    """
    source = df.select(digest(seed, key).alias("h"))
    h = F.col("h")
    found: dict[int, tuple[str, int]] = {}
    open_at = {m: ("", m) for m in set(positions)}  # position -> (prefix, rank within the prefix)
    width = 0
    while open_at:
        width += HEX
        prefixes = sorted({p for p, _ in open_at.values() if p})
        part = source.where(F.substring(h, 1, width - HEX).isin(prefixes)) if prefixes else source
        counts = _bucket_counts(part, h, width)
        pending: dict[int, tuple[str, int]] = {}
        sizes: dict[str, int] = {}
        for m, (prefix, rank) in open_at.items():
            mine = [(b, n) for b, n in counts if b.startswith(prefix)]
            ends = list(accumulate(n for _, n in mine))
            i = bisect.bisect_right(ends, rank)
            if i == len(mine):  # past the last row: every digest is below
                found[m] = ("g", 0)
                continue
            pending[m] = (mine[i][0], rank - (ends[i - 1] if i else 0))
            sizes[mine[i][0]] = mine[i][1]
        if width >= 32:  # the whole digest
            found |= pending
            pending = {}
        elif sum(sizes.values()) <= SMALL:
            kept = source.where(F.substring(h, 1, width).isin(sorted(sizes))) if sizes else None
            values = sorted(r["h"] for r in kept.collect()) if kept is not None else []
            for m, (prefix, rank) in pending.items():
                at = bisect.bisect_left(values, prefix) + rank
                found[m] = (values[at], at - bisect.bisect_left(values, values[at]))
            pending = {}
        open_at = pending
    return [found[m] for m in positions]


def hash_rank(df: DataFrame, key: str, seed: int, rank: str = "rank", below: int | None = None,
              only: Sequence[int] | None = None) -> DataFrame:
    """0-based rank of each row in hash order; ``below`` or ``only`` keep the ranks asked for.

    Buckets with no wanted rank are filtered out before the shuffle. A bucket holds about ``HOT_ROWS`` rows at most,
    however many there are; rows of a repeated key share one.
    """
    width = HEX
    keys = df.select(digest(seed, key).alias("h"))
    counts = _bucket_counts(keys, F.col("h"), width)
    while sum(n for _, n in counts) > HOT_ROWS << 4 * width:
        width += 1
    if width > HEX:
        counts = _bucket_counts(keys, F.col("h"), width)
    starts = [0, *accumulate(n for _, n in counts)]
    chosen = range(len(counts))
    if only is not None:
        chosen = sorted({bisect.bisect_right(starts, r) - 1 for r in only if 0 <= r < starts[-1]})
    elif below is not None:
        chosen = range(bisect.bisect_left(starts, below)) if below > 0 else range(0)
    spark = df.sparkSession
    offsets = spark.createDataFrame([(counts[i][0], starts[i]) for i in chosen if i < len(counts)],
                                    "_b STRING, _start BIGINT")
    # at most 16 rows for each HOT_ROWS rows of data
    marked = (df.withColumn("_h", digest(seed, key)).withColumn("_b", F.substring("_h", 1, width))
              .join(F.broadcast(offsets), "_b"))
    within = F.row_number().over(W.partitionBy("_b").orderBy("_h", key))
    out = marked.withColumn(rank, F.col("_start") + within - 1).drop("_b", "_h", "_start")
    if only is not None:
        return out.where(F.col(rank).isin(sorted(set(only))))
    return out if below is None else out.where(F.col(rank) < below)


def grouped_thresholds(df: DataFrame, by: str, key: str, seed: int, ratio: float) -> DataFrame:
    """``by, limit``: for each group of n rows the digest below which exactly floor(ratio * n) of them fall.

    ``key`` is unique. A pass counts, for all groups at once, the rows by the next hex digits of their digest, inside the
    prefix that holds the group's position; a group's bucket of ``SMALL`` rows or fewer is ordered in one task. So the
    number of jobs follows the largest group and not the number of groups. A null group is one of its own.
    """
    rows = df.select(F.col(by).alias("_g"), digest(seed, key).alias("_h"))
    counts = rows.groupBy("_g").count().select("_g", F.floor(F.lit(ratio) * F.col("count")).cast("bigint").alias("_rank"),
                                               F.col("count").alias("_n"))
    sized = cut_lineage(counts)
    # all rows of the group are below a letter that no digest has
    ended = [sized.where(F.col("_rank") >= F.col("_n")).select("_g", F.lit("g").alias("limit"))]
    state = sized.where(F.col("_rank") < F.col("_n")).select("_g", F.lit("").alias("_prefix"), "_rank", "_n")
    width = 0
    while True:
        here = state.withColumnRenamed("_g", "_of")
        inside = rows.join(here, F.col("_g").eqNullSafe(F.col("_of")) & (F.substring("_h", 1, width) == F.col("_prefix"))).drop("_of")
        small = inside.where((F.col("_n") <= SMALL) | F.lit(width >= 30))
        place = F.row_number().over(W.partitionBy("_g").orderBy("_h"))
        ended.append(cut_lineage(small.withColumn("_place", place).where(F.col("_place") == F.col("_rank") + 1).select("_g", F.col("_h").alias("limit"))))
        large = state.where((F.col("_n") > SMALL) & F.lit(width < 30))
        if large.isEmpty():
            break
        width += HEX
        cells = inside.where(F.col("_n") > SMALL).groupBy("_g", F.substring("_h", 1, width).alias("_prefix"), "_rank").count()
        before = F.sum("count").over(W.partitionBy("_g").orderBy("_prefix")) - F.col("count")
        state = cut_lineage(cells.withColumn("_before", before).where(
            (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("count"))).select(
            "_g", "_prefix", (F.col("_rank") - F.col("_before")).alias("_rank"), F.col("count").alias("_n")))
    out = ended[0]
    for part in ended[1:]:
        out = out.unionByName(part)
    return out.withColumnRenamed("_g", by)


def hot_groups(df: DataFrame, by: str) -> DataFrame | None:
    """``by, _pieces``: the groups too large for one task to order, and the tasks each needs; None if there are none.

    A table of fewer rows than ``HOT_ROWS`` has none, and no group of it is counted.
    """
    if df.count() <= HOT_ROWS:
        return None
    hot = cut_lineage(df.groupBy(by).count().where(F.col("count") > HOT_ROWS)
                      .select(by, F.ceil(F.col("count") / HOT_ROWS).alias("_pieces")))
    n = hot.count()
    if n == 0:
        return None
    return F.broadcast(hot) if n * 64 <= BROADCAST_LIMIT_BYTES else hot


def grouped_hash_rank(df: DataFrame, by: str, key: str, seed: int, rank: str = "rank", size: str = "size") -> DataFrame:
    """0-based rank of each row within its group in hash order, and the group's size.

    Ordinary groups are one window. A hot group is ordered in hash ranges of about ``HOT_ROWS`` rows, each the
    work of a task of its own, and the pieces are stitched together by a running count of their sizes.
    """
    marked = df.withColumn("_h", digest(seed, by, key))
    hot = hot_groups(df, by)
    if hot is None:
        group = W.partitionBy(by)
        return marked.withColumns({rank: F.row_number().over(group.orderBy("_h", key)).cast("bigint") - 1,
                                   size: F.count(F.lit(1)).over(group)}).drop("_h")
    head = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    marked = marked.join(hot, by, "left").withColumn(
        "_piece", F.coalesce(F.floor(head * F.col("_pieces") / F.lit(float(1 << 32))), F.lit(0)).cast("bigint")).drop("_pieces")
    starts = (marked.groupBy(by, "_piece").agg(F.count(F.lit(1)).alias("_n"))
              .select(by, "_piece", (F.sum("_n").over(W.partitionBy(by).orderBy("_piece")) - F.col("_n")).alias("_start"),
                      F.sum("_n").over(W.partitionBy(by)).alias(size)))
    within = F.row_number().over(W.partitionBy(by, "_piece").orderBy("_h", key))
    return (marked.withColumn("_pos", within).join(starts, [by, "_piece"])
            .withColumn(rank, F.col("_start") + F.col("_pos") - 1).drop("_h", "_piece", "_pos", "_start"))


def sorted_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """0-based rank under any ordering: range-partitioned sort, then per-partition offsets.

    The sorted rows are cut off in the checkpoint folder because the two uses must see one sampling
    of the range bounds.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_m", 33)
    sizes = sorted((r["p"], r["count"]) for r in placed.groupBy(part.alias("p")).count().collect())
    starts = [0, *accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)],
                                              "_p BIGINT, _start BIGINT")
    # one row per partition
    return (placed.withColumn("_p", part).join(F.broadcast(offsets), "_p")
            .withColumn(rank, F.col("_start") + F.col("_m").bitwiseAND((1 << 33) - 1))
            .drop("_p", "_m", "_start"))


def exact_medians(df: DataFrame, cols: Sequence[str], cells: int = 1024) -> dict[str, float | None]:
    """Median of the non-null values of every column at once: the mean of the middle two.

    The built-in ``median`` gathers all distinct values of a column in one task. Here a sketch
    proposes an interval around the middle, counts prove which side of it each wanted rank is on, and
    passes that count values per cell narrow it; values are fetched only when few rows are left.
    """
    held = df.select(*cols) if df.is_cached else df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _medians(held, list(cols), cells)
    finally:
        if held is not df and not df.is_cached:
            held.unpersist()


def _medians(df: DataFrame, cols: list[str], cells: int) -> dict[str, float | None]:
    near = "percentile_approx(`{c}`, array(0.4998D, 0.5002D), 10000) AS `{c}_near`"
    first = df.agg(*[F.expr(e.format(c=c)) for c in cols for e in (
        "count(`{c}`) AS `{c}_n`", "min(`{c}`) AS `{c}_lo`", "max(`{c}`) AS `{c}_hi`", near)]).first()
    some = [c for c in cols if first[f"{c}_n"]]
    if not some:
        return dict.fromkeys(cols)
    sides = []
    for c in some:
        lo, hi = first[f"{c}_near"]
        sides += [F.count_if(F.col(c) < lo).alias(f"{c}_below"), F.count_if(F.col(c).between(lo, hi)).alias(f"{c}_in"),
                  F.max(F.when(F.col(c) < lo, F.col(c))).alias(f"{c}_last"),
                  F.min(F.when(F.col(c) > hi, F.col(c))).alias(f"{c}_next")]
    proof = df.agg(*sides).first()
    out: dict[str, list[float]] = {c: [] for c in cols}
    targets: list[dict] = []
    for c in some:
        n, (lo, hi) = first[f"{c}_n"], first[f"{c}_near"]
        below, inside = proof[f"{c}_below"], proof[f"{c}_in"]
        for r in ((n - 1) // 2, n // 2):
            if r < below:
                t = {"rank": r, "lo": first[f"{c}_lo"], "hi": proof[f"{c}_last"], "n": below}
            elif r < below + inside:
                t = {"rank": r - below, "lo": lo, "hi": hi, "n": inside}
            else:
                t = {"rank": r - below - inside, "lo": proof[f"{c}_next"], "hi": first[f"{c}_hi"], "n": n - below - inside}
            targets.append({"c": c, **t})
    while True:
        for t in targets:
            if t["lo"] == t["hi"]:
                out[t["c"]].append(t["lo"])
        targets = [t for t in targets if t["lo"] != t["hi"]]
        if not targets:
            break
        spans = list({(t["c"], t["lo"], t["hi"]): t["n"] for t in targets}.items())
        if sum(n for _, n in spans) <= SMALL:
            lists = _tagged(df, [s for s, _ in spans], 1).groupBy("t").agg(F.sort_array(F.collect_list("v")).alias("vs"))
            got = {spans[r["t"]][0]: r["vs"] for r in lists.collect()}
            for t in targets:
                out[t["c"]].append(got[t["c"], t["lo"], t["hi"]][t["rank"]])
            break
        seen: dict[tuple, list] = {}
        stats = _tagged(df, [s for s, _ in spans], cells).groupBy("t", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in stats.collect():  # at most spans x cells rows
            seen.setdefault(spans[r["t"]][0], []).append(r)
        for t in targets:
            for r in sorted(seen[t["c"], t["lo"], t["hi"]], key=lambda r: r["cell"]):
                if t["rank"] < r["n"]:
                    t.update(lo=r["lo"], hi=r["hi"], n=r["n"])
                    break
                t["rank"] -= r["n"]
    return {c: sum(v) / 2 if v else None for c, v in out.items()}


def _tagged(df: DataFrame, spans: list[tuple], cells: int) -> DataFrame:
    """One row per (span, value inside it), with the value's cell of the span."""
    fields = []
    for i, (c, lo, hi) in enumerate(spans):
        v = F.col(c)
        # halved before subtracting: a span wider than the largest double must not overflow
        place = (v / 2 - lo / 2) / F.lit(hi / 2 - lo / 2) * F.lit(float(cells))
        cell = F.least(F.floor(place), F.lit(cells - 1))
        fields.append(F.when(v.between(lo, hi), F.struct(F.lit(i).alias("t"), v.alias("v"), cell.alias("cell"))))
    return df.select(F.explode(F.array_compact(F.array(*fields))).alias("s")).select("s.*")
