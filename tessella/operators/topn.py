"""The best items for every user among those the user has not rated: an exact maximum-inner-product search in blocks.

Items stand in descending order of their vectors' lengths. A task holds a block of users and reads the items tile by tile;
no item of a later tile can score more than the user's length times the tile's greatest length, so a user is done when
that falls below the user's n-th best score, and a block is done with its last user. What a user has rated is a bit for
each item of a tile. Items beyond a broadcast go in waves of that size, and a wave gets only the blocks that aren't done.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import number
from ..session import BROADCAST_LIMIT_BYTES, cut_lineage
from .lookup import Held
from .ranking import sorted_rank

USER_BLOCK = 256
TILE = 2048
STATE = "block BIGINT, done BOOLEAN, tiles BIGINT, users BINARY, vectors BINARY, items BINARY, scores BINARY"


def _vectors(model) -> tuple[DataFrame, DataFrame]:
    """(user, v, shift) and (item, v), so that a prediction is shift plus the inner product."""
    rank, biased = model.rank, getattr(model, "biased", False)
    implicit = getattr(model, "implicit", False)
    p = [f"f{k} + z{k}" if implicit else f"f{k}" for k in range(rank)] + (["1.0D"] if biased else [])
    q = [f"f{k}" for k in range(rank)] + (["b"] if biased else [])
    shift = f"{number(model.mu)} + b" if biased else "0.0D"
    return (model.users.selectExpr("user", f"array({', '.join(p)}) AS v", f"{shift} AS shift"),
            model.items.selectExpr("item", f"array({', '.join(q)}) AS v"))


def _raw(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def _blocks(users: DataFrame, count: int, n: int) -> DataFrame:
    """Users in blocks of about ``USER_BLOCK``, one row each, with empty lists of their best items."""
    def pack(rows: pa.Table) -> pa.Table:
        ids = rows.column("user").to_numpy()
        by = np.argsort(ids)
        v = np.array(rows.column("v").to_pylist(), float)
        v = np.column_stack([v, rows.column("shift").to_numpy()])[by]
        return pa.table({
            "block": [rows.column("block")[0].as_py()], "done": [False], "tiles": [0], "users": [_raw(ids[by], "<i8")],
            "vectors": [_raw(v, "<f8")], "items": [_raw(np.zeros((len(ids), n)), "<i8")],
            "scores": [_raw(np.full((len(ids), n), -np.inf), "<f8")]})

    dealt = users.select(_block("user", count), F.col("user").cast("long").alias("user"), "v", "shift")
    return dealt.groupBy("block").applyInArrow(pack, STATE)


def _block(user: str, count: int):
    return F.pmod(F.xxhash64(F.col(user).cast("long")), F.lit(max(1, -(-count // USER_BLOCK)))).alias("block")


def _merge(items: np.ndarray, scores: np.ndarray, ids: np.ndarray, new: np.ndarray, n: int) -> None:
    """The n best of both, in place: highest scores first, ties by the smaller item."""
    better = np.flatnonzero((new >= scores[:, -1:]).any(1))
    for r in better.tolist():
        at = np.flatnonzero((new[r] >= scores[r, -1]) & (new[r] > -np.inf))
        if len(at) > n:  # all ties of the last place stay until ids decide
            place = len(at) - n
            at = at[new[r, at] >= np.partition(new[r, at], place)[place]]
        have = np.isfinite(scores[r])
        both, names = np.concatenate([scores[r, have], new[r, at]]), np.concatenate([items[r, have], ids[at]])
        order = np.lexsort((names, -both))[:n]
        scores[r, :len(order)], items[r, :len(order)] = both[order], names[order]


def _search(shared, n: int):
    def run(state: pa.Table, rated: pa.Table) -> pa.Table:
        if not state.num_rows:
            return state
        row = state.to_pylist()[0]
        ids, q, lengths = shared.value
        users = np.frombuffer(row["users"], "<i8")
        v = np.frombuffer(row["vectors"], "<f8").reshape(len(users), -1)
        items, scores = (np.frombuffer(row[c], k).reshape(len(users), n).copy() for c, k in (("items", "<i8"), ("scores", "<f8")))
        p, shift = v[:, :-1], v[:, -1]
        reach = np.sqrt(np.einsum("nk,nk->n", p, p)) * (1 + 1e-12)
        who, place = np.searchsorted(users, rated.column("user").to_numpy()), rated.column("place").to_numpy()
        by = np.argsort(place)
        who, place = who[by], place[by]
        done, tiles = False, 0
        for lo in range(0, len(ids), TILE):
            # what is still open: the bound of all later items doesn't fall below the last best score
            live = np.flatnonzero(reach * lengths[lo] + shift >= scores[:, -1])
            if not len(live):
                done = True
                break
            new = p[live] @ q[lo:lo + TILE].T + shift[live, None]
            known = np.zeros((len(users), new.shape[1]), bool)
            a, b = np.searchsorted(place, [lo, lo + TILE])
            known[who[a:b], place[a:b] - lo] = True
            new[known[live]] = -np.inf
            part_items, part_scores = items[live], scores[live]
            _merge(part_items, part_scores, ids[lo:lo + TILE], new, n)
            items[live], scores[live] = part_items, part_scores
            tiles += 1
        row |= {"done": done, "tiles": row["tiles"] + tiles, "items": _raw(items, "<i8"), "scores": _raw(scores, "<f8")}
        return pa.Table.from_pylist([row], schema=state.schema)

    return run


def top_unrated(model, rated: DataFrame, n: int, wave_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``user, item, prediction, place``: each user's n best items of those it has no row for in ``rated``.

    ``model`` has factor tables ``users`` and ``items``. Users who have rated all items but m get m rows. Items of equal
    scores are ordered by id. Users and items that the model doesn't know take no part.
    """
    return _listed(model, search_blocks(model, rated, n, wave_bytes), n)


def search_blocks(model, rated: DataFrame, n: int, wave_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """The blocks of users with their best items, and how many tiles each block has read."""
    users, items = _vectors(model)
    spark = users.sparkSession
    users = cut_lineage(users)
    n_users = users.count()
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    ranked = Held.of(sorted_rank(items.withColumn("length", length), [F.col("length").desc(), F.col("item")], "rank"))
    per_wave = max(1, wave_bytes // (8 * (model.rank + 4)))
    places = Held(ranked.df.select("item", "rank"), ranked.rows)
    known = cut_lineage(places.join_to(rated.select("user", "item"), "item", "inner").select(
        _block("user", n_users), F.col("user").cast("long").alias("user"), F.floor(F.col("rank") / per_wave).alias("wave"),
        (F.col("rank") % per_wave).alias("place")).join(users.select(F.col("user").cast("long").alias("user")), "user", "left_semi"))
    state = cut_lineage(_blocks(users, n_users, n))
    ended = []
    for wave in range(-(-ranked.rows // per_wave)):
        own = ranked.df.where(F.floor(F.col("rank") / per_wave) == wave).orderBy("rank") \
            .select(F.col("item").cast("long"), "v", "length").toArrow()  # at most ``wave_bytes``
        shared = spark.sparkContext.broadcast((own.column(0).to_numpy(), np.array(own.column(1).to_pylist(), float),
                                               own.column(2).to_numpy()))
        seen = known.where(F.col("wave") == wave).select("block", "user", "place")
        state = cut_lineage(state.groupBy("block").cogroup(seen.groupBy("block")).applyInArrow(_search(shared, n), STATE))
        ended.append(state.where("done"))
        state = state.where("not done")
        if state.isEmpty():
            break
    for part in ended:
        state = state.unionByName(part)
    return state


def _listed(model, state: DataFrame, n: int) -> DataFrame:
    kinds = {k: dict(t.dtypes)[k] for k, t in (("user", model.users), ("item", model.items))}

    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                users = np.frombuffer(r["users"], "<i8")
                items, scores = np.frombuffer(r["items"], "<i8"), np.frombuffer(r["scores"], "<f8")
                good = np.isfinite(scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(users, n)[good]), pa.array(items[good]), pa.array(scores[good]),
                     pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(users))[good])], ["user", "item", "prediction", "place"])

    out = state.select("users", "items", "scores").mapInArrow(rows, "user BIGINT, item BIGINT, prediction DOUBLE, place INT")
    return out.withColumns({k: F.col(k).cast(kind) for k, kind in kinds.items()})
