"""Pairwise work on ratings as a blocked matrix product.

A similarity between two users needs every item they share, and a self-join on the item would emit
every pair of its raters. Instead both axes are hashed into blocks of bounded size and the unit of
work is a tile: one block of entities against another, over one chunk of the other axis. A cell
(entity, other) occurs once, so a tile holds at most ``block x chunk`` ratings per side however
popular an item or busy a user is. Within a tile the sums are matrix products; across chunks they are
added by a ``groupBy`` that combines before it shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 512  # entities per block
CHUNK = 4096  # ids of the other axis per chunk
MAX_TASKS = 20_000  # tiles are dealt to one task each up to this many
TILE = ("g", "chunk", "a", "b")


@dataclass(frozen=True)
class Grid:
    """How many blocks and chunks; ids are dealt to them by hash."""

    blocks: int
    chunks: int

    @staticmethod
    def of(ratings: DataFrame, entity: str, other: str, block: int = BLOCK, chunk: int = CHUNK) -> Grid:
        n = ratings.agg(F.approx_count_distinct(entity).alias("e"), F.approx_count_distinct(other).alias("o")).first()
        return Grid(max(1, -(-n["e"] // block)), max(1, -(-n["o"] // chunk)))

    def block(self, c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.blocks)).cast("int")

    def chunk(self, c: str) -> Column:
        return F.pmod(F.xxhash64(c, F.lit(1)), F.lit(self.chunks)).cast("int")

    def every_block(self) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1)))

    def every_chunk(self) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(self.chunks - 1)))


def _deal(tiled: DataFrame, tiles: int) -> GroupedData:
    """Groups of one tile each, spread by number: work in a tile is not in proportion to its bytes,
    so the runtime must not merge small ones into one task."""
    return tiled.repartition(min(tiles, MAX_TASKS), *TILE).groupBy(*TILE)


def _dense(e: np.ndarray, o: np.ndarray, v: np.ndarray, es: np.ndarray, os: np.ndarray) -> np.ndarray:
    m = np.zeros((len(es), len(os)))
    m[np.searchsorted(es, e), np.searchsorted(os, o)] = v
    return m


_MOMENTS = ("n", "si", "sj", "sii", "sjj", "sij")


def _tile_moments(pdf: pd.DataFrame, wanted: tuple[str, ...]) -> pd.DataFrame:
    """Sums over the common raters of each entity pair i < j of a tile."""
    a, b = int(pdf["a"].iat[0]), int(pdf["b"].iat[0])
    left = pdf[pdf["blk"] == a]
    right = left if a == b else pdf[pdf["blk"] == b]
    os = np.unique(pdf["o"].to_numpy())
    ia, ib = np.unique(left["e"].to_numpy()), np.unique(right["e"].to_numpy())
    ra = _dense(left["e"].to_numpy(), left["o"].to_numpy(), left["x"].to_numpy(), ia, os)
    ma = _dense(left["e"].to_numpy(), left["o"].to_numpy(), np.ones(len(left)), ia, os)
    rb, mb = (ra, ma) if a == b else (
        _dense(right["e"].to_numpy(), right["o"].to_numpy(), right["x"].to_numpy(), ib, os),
        _dense(right["e"].to_numpy(), right["o"].to_numpy(), np.ones(len(right)), ib, os))
    n = ma @ mb.T
    keep = n > 0
    if a == b:
        keep &= ia[:, None] < ib[None, :]
    r, c = np.nonzero(keep)
    i, j = ia[r], ib[c]
    swap = i > j
    side = {"n": n, "si": ra @ mb.T, "sj": ma @ rb.T}
    if "sij" in wanted:
        side |= {"sii": (ra * ra) @ mb.T, "sjj": ma @ (rb * rb).T, "sij": ra @ rb.T}
    got = {k: m[r, c] for k, m in side.items()}
    for x, y in (("si", "sj"), ("sii", "sjj")):
        if x in got:
            got[x], got[y] = np.where(swap, got[y], got[x]), np.where(swap, got[x], got[y])
    out = {"g": pdf["g"].iat[0], "i": np.where(swap, j, i), "j": np.where(swap, i, j)}
    return pd.DataFrame({**out, **{k: got[k] for k in wanted}})


def pair_moments(ratings: DataFrame, entity: str, other: str, value: str, *, by: str | None = None,
                 squares: bool = True, grid: Grid | None = None) -> DataFrame:
    """``[by,] i, j, n, si, sj[, sii, sjj, sij]`` for every pair i < j of entities with a common rater."""
    grid = grid or Grid.of(ratings, entity, other)
    wanted = _MOMENTS if squares else _MOMENTS[:3]
    g = F.col(by).cast("int") if by else F.lit(0)
    cells = ratings.select(g.alias("g"), F.col(entity).alias("e"), F.col(other).alias("o"),
                           F.col(value).cast("double").alias("x"), grid.block(entity).alias("blk"),
                           grid.chunk(other).alias("chunk"))
    p = F.col("p")
    tiled = (cells.withColumn("p", grid.every_block())
             .select("g", "e", "o", "x", "blk", "chunk", F.least("blk", p).alias("a"), F.greatest("blk", p).alias("b")))
    ids = "i INT, j INT" if dict(ratings.dtypes)[entity] == "int" else "i BIGINT, j BIGINT"
    schema = f"g INT, {ids}, " + ", ".join(f"{k} DOUBLE" for k in wanted)
    tiles = grid.blocks * (grid.blocks + 1) // 2 * grid.chunks
    part = _deal(tiled, tiles).applyInPandas(lambda pdf: _tile_moments(pdf, wanted), schema)
    if grid.chunks > 1:
        part = part.groupBy("g", "i", "j").agg(*[F.sum(k).alias(k) for k in wanted])
    return part.withColumnRenamed("g", by) if by else part.drop("g")


def _tile_parts(pdf: pd.DataFrame):
    kind = pdf["kind"].to_numpy()
    cell, pair, link = pdf[kind == 0], pdf[kind == 1], pdf[kind == 2]
    if not len(cell) or not len(pair) or not len(link):
        return None
    os = np.unique(pair["o"].to_numpy())
    cell = cell[np.isin(cell["o"].to_numpy(), os)]
    if not len(cell):
        return None
    ts = np.unique(pair["e"].to_numpy())
    link = link[np.isin(link["e"].to_numpy(), ts)]
    es = np.unique(np.concatenate([cell["e"].to_numpy(), link["o"].to_numpy()]))
    where = cell["e"].to_numpy(), cell["o"].to_numpy()
    x, m = _dense(*where, cell["x"].to_numpy(), es, os), _dense(*where, np.ones(len(cell)), es, os)
    at = link["e"].to_numpy(), link["o"].to_numpy()
    w, d = _dense(*at, link["x"].to_numpy(), ts, es), _dense(*at, link["d"].to_numpy(), ts, es)
    return pair, ts, es, os, x, m, w, d


def _tile_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Weighted sums over the neighbours of one block, for the wanted pairs of the tile."""
    parts = _tile_parts(pdf)
    if parts is None:
        return pd.DataFrame({"g": [], "e": [], "o": [], "num": [], "den": [], "cnt": []})
    pair, ts, es, os, x, m, w, d = parts
    r, c = np.searchsorted(ts, pair["e"].to_numpy()), np.searchsorted(os, pair["o"].to_numpy())
    num, den, cnt = w @ x + d @ m, w @ m, (w > 0).astype(float) @ m
    return pd.DataFrame({"g": pair["g"].to_numpy(), "e": pair["e"].to_numpy(), "o": pair["o"].to_numpy(),
                         "num": num[r, c], "den": den[r, c], "cnt": cnt[r, c].astype(np.int64)})


def _tile_top(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k strongest neighbours of one block for each wanted pair, ties to the lower id."""
    empty = {"g": [], "e": [], "o": [], "nb": [], "w": [], "x": []}
    parts = _tile_parts(pdf)
    if parts is None:
        return pd.DataFrame(empty)
    pair, ts, es, os, x, m, w, _ = parts
    out = []
    g = pair["g"].iat[0]
    pe, po = pair["e"].to_numpy(), pair["o"].to_numpy()
    for t in np.unique(pe):
        row = w[np.searchsorted(ts, t)]
        order = np.lexsort((es, -row))
        order = order[row[order] > 0]
        cols = np.searchsorted(os, po[pe == t])
        rated = m[np.ix_(order, cols)] > 0
        take = rated & (np.cumsum(rated, axis=0) <= k)
        r, c = np.nonzero(take)
        out.append(pd.DataFrame({"g": g, "e": t, "o": os[cols[c]], "nb": es[order[r]], "w": row[order[r]],
                                 "x": x[order[r], cols[c]]}))
    return pd.concat(out) if out else pd.DataFrame(empty)


def _scoring_tiles(pairs: DataFrame, cells: DataFrame, links: DataFrame, entity: str, other: str, value: str,
                   grid: Grid, by: str | None) -> DataFrame:
    """Ratings, wanted pairs and links of each tile as one tagged table."""
    g = F.col(by).cast("int") if by else F.lit(0)
    none = F.lit(0.0)

    def shape(df, kind, e, o, x, d, chunk, target, near):
        return df.select(g.alias("g"), F.lit(kind).alias("kind"), F.col(e).alias("e"), F.col(o).alias("o"),
                         x.alias("x"), d.alias("d"), chunk.alias("chunk"), target.alias("a"), near.alias("b"))

    rated = cells.withColumn("_p", grid.every_block())
    asked = pairs.withColumn("_p", grid.every_block())
    both = links.withColumn("_c", grid.every_chunk())
    p = F.col("_p")
    return (shape(rated, 0, entity, other, F.col(value), none, grid.chunk(other), p, grid.block(entity))
            .unionByName(shape(asked, 1, entity, other, none, none, grid.chunk(other), grid.block(entity), p))
            .unionByName(shape(both, 2, "i", "j", F.col("w"), F.col("d"), F.col("_c"), grid.block("i"), grid.block("j"))))


def both_ways(links: DataFrame, by: str | None = None) -> DataFrame:
    """Links i < j as directed ones; the weight is symmetric and the offset changes sign."""
    keys = [by] if by else []
    turn = F.explode(F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b"), F.col("d").alias("c")),
                             F.struct(F.col("j").alias("a"), F.col("i").alias("b"), (-F.col("d")).alias("c"))))
    return links.select(*keys, "w", turn.alias("s")).select(*keys, F.col("s.a").alias("i"), F.col("s.b").alias("j"),
                                                            "w", F.col("s.c").alias("d"))


def neighbour_sums(pairs: DataFrame, cells: DataFrame, links: DataFrame, entity: str, other: str, value: str, *,
                   grid: Grid, by: str | None = None) -> DataFrame:
    """``[by,] entity, other, num, den, cnt`` per wanted pair over ALL its linked neighbours.

    num sums w * value + d and den sums w over the entities linked to the pair's entity that rated
    its other side. ``links`` is directed (see ``both_ways``). Pairs without a tile are absent.
    """
    tiles = _scoring_tiles(pairs, cells, links, entity, other, value, grid, by)
    ids = _ids(pairs, entity, other)
    got = _deal(tiles, grid.blocks ** 2 * grid.chunks).applyInPandas(
        _tile_sums, f"g INT, {ids}, num DOUBLE, den DOUBLE, cnt BIGINT")
    if grid.blocks > 1:
        got = got.groupBy("g", "e", "o").agg(*[F.sum(c).alias(c) for c in ("num", "den", "cnt")])
    return _named(got, entity, other, by)


def neighbour_top(pairs: DataFrame, cells: DataFrame, links: DataFrame, entity: str, other: str, value: str,
                  k: int, *, grid: Grid, by: str | None = None) -> DataFrame:
    """``[by,] entity, other, nb, w, x, place``: the k strongest linked neighbours of each wanted pair.

    Every tile hands on its own best k, so the final ranking sees at most k rows per pair and block.
    """
    tiles = _scoring_tiles(pairs, cells, links, entity, other, value, grid, by)
    ids = _ids(pairs, entity, other)
    nb = "nb INT" if dict(pairs.dtypes)[entity] == "int" else "nb BIGINT"
    got = _deal(tiles, grid.blocks ** 2 * grid.chunks).applyInPandas(
        lambda pdf: _tile_top(pdf, k), f"g INT, {ids}, {nb}, w DOUBLE, x DOUBLE")
    place = F.row_number().over(W.partitionBy("g", "e", "o").orderBy(F.col("w").desc(), "nb"))
    return _named(got.withColumn("place", place).where(F.col("place") <= k), entity, other, by)


def _ids(pairs: DataFrame, entity: str, other: str) -> str:
    types = dict(pairs.dtypes)
    return f"e {types[entity]}, o {types[other]}"


def _named(df: DataFrame, entity: str, other: str, by: str | None) -> DataFrame:
    df = df.withColumnRenamed("e", entity).withColumnRenamed("o", other)
    return df.withColumnRenamed("g", by) if by else df.drop("g")
