"""Sequential gradient descent over ratings, in parallel where it can't be told from a sequential run.

Users and items are dealt to K blocks each, so the ratings form K x K blocks. A stratum is K blocks of which no two share
a user block or an item block: block (b, b + s mod K) for every b. The blocks of a stratum touch different rows of the
factor tables, so to work on them at once gives what working on them one after another would give. K strata are an epoch.

Within a block the ratings have a fixed order, and a rating's level is one more than the last level of its user and its
item. The ratings of a level touch different rows too: a level is one step of array arithmetic, and the levels in turn
are the ratings in their order. So an epoch is one sequential pass over all ratings, whatever K is.

User factors, ratings and their levels stay in their slot; between strata only the item blocks move on to the next slot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .factors import ITEM, USER, GradientFactors
from .means import global_mean

BLOCK_RATINGS = 2_000_000  # of a block on average, and twice that of the largest
JOB_RATINGS = 50_000_000   # updates of a task between two checkpoints
MOST_BLOCKS = 1 << 14
STATE = "side INT, block BIGINT, ids BINARY, counts BINARY, vectors BINARY"
LAYOUT = "slot BIGINT, block BIGINT, users BINARY, items BINARY, ratings BINARY, cuts BINARY"


def levels(users: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, cuts): order[cuts[k]:cuts[k + 1]] are level k's rows, none of which share a user or an item."""
    last_user: dict[int, int] = {}
    last_item: dict[int, int] = {}
    level = np.empty(len(users), np.int64)
    for k, (u, i) in enumerate(zip(users.tolist(), items.tolist(), strict=True)):
        level[k] = last_user[u] = last_item[i] = max(last_user.get(u, -1), last_item.get(i, -1)) + 1
    order = np.argsort(level, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(level))])


def _deal(key: str, blocks: int):
    return F.pmod(F.xxhash64(key, F.lit(key)), F.lit(blocks))


def _bytes(a: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def lay_out(ratings: DataFrame, blocks: int, seed: int) -> DataFrame:
    """One row for each block of ratings that isn't empty, partitioned by its slot (the user block)."""
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "user", "item")), 1, 15), 16, 10).cast("long")
    cells = ratings.select(_deal("user", blocks).alias("slot"), _deal("item", blocks).alias("block"), order.alias("place"),
                           F.col("user").cast("long"), F.col("item").cast("long"), F.col("rating").cast("double"))

    def pack(table: pa.Table) -> pa.Table:
        slot, block = (table.column(c)[0].as_py() for c in ("slot", "block"))
        place, users, items, r = (table.column(c).to_numpy() for c in ("place", "user", "item", "rating"))
        by = np.lexsort((items, users, place))
        by = by[(again := levels(users[by], items[by]))[0]]
        return pa.table({"slot": [slot], "block": [block], "users": [_bytes(users[by], "<i8")], "items": [_bytes(items[by], "<i8")],
                         "ratings": [_bytes(r[by], "<f8")], "cuts": [_bytes(again[1], "<i8")]})

    packed = cut_lineage(cells.groupBy("slot", "block").applyInArrow(pack, LAYOUT))
    # kept as it is dealt, in no fewer parts than a shuffle has: a stratum reads its slots where they are
    parts = max(2 * blocks, int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = packed.repartition(parts, "slot").persist(StorageLevel.MEMORY_AND_DISK)
    dealt.count()
    return dealt


def _packed(table: DataFrame, key: str, side: int, blocks: int, columns: list[str]) -> DataFrame:
    """The factor rows of each block in one row."""
    def pack(rows: pa.Table) -> pa.Table:
        ids = rows.column(key).to_numpy()
        by = np.argsort(ids)
        vectors = np.column_stack([rows.column(c).to_numpy() for c in columns])
        return pa.table({"side": pa.array([side], pa.int32()), "block": [rows.column("_block")[0].as_py()],
                         "ids": [_bytes(ids[by], "<i8")], "counts": [_bytes(rows.column("n").to_numpy()[by], "<i8")],
                         "vectors": [_bytes(vectors[by], "<f8")]})

    rows = table.select(_deal(key, blocks).alias("_block"), F.col(key).cast("long").alias(key), F.col("n").cast("long"), *columns)
    return rows.groupBy("_block").applyInArrow(pack, STATE)


def _unpacked(state: DataFrame, key: str, side: int, kind: str, columns: list[str]) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, n = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["counts"], "<i8")
                v = np.frombuffer(r["vectors"], "<f8").reshape(len(ids), len(columns))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), *[pa.array(v[:, c]) for c in range(len(columns))]],
                                                 [key, "n", *columns])

    out = state.where(F.col("side") == side).mapInArrow(rows, f"{key} BIGINT, n BIGINT, " + ", ".join(f"{c} DOUBLE" for c in columns))
    return out.withColumn(key, F.col(key).cast(kind))


class SequentialFactors(GradientFactors):
    """Matrix factorisation by sequential gradient descent: ratings in one fixed order, each with the factors as they are.

    The order is by block, then by level, then by a hash of (user, item); it is the same in each epoch. The biased rule
    moves both sides of a rating by what they were, the plain one the item first and the user by the moved item. With ``implicit``
    the vectors and offsets move row by row, with the sum over a user's rated items held for an epoch, and the items'
    implicit vectors move once an epoch by their summed gradients.

    ``blocks`` follows the number of ratings: one block up to ``BLOCK_RATINGS`` of them, then as many on each axis as keep
    a block at that size on average, and more until the largest has at most twice that. A user or an item of many ratings
    is spread over all blocks of the other axis. Ratings are laid out once; an epoch moves each item block K times.
    """

    def __init__(self, *args, blocks: int | None = None, **settings):
        super().__init__(*args, **settings)
        self.blocks = blocks

    def _blocks_for(self, ratings: DataFrame, total: int) -> int:
        blocks = self.blocks or max(1, int(np.ceil(np.sqrt(total / BLOCK_RATINGS))))
        while self.blocks is None and blocks > 1 and blocks < MOST_BLOCKS:
            largest = ratings.groupBy(_deal("user", blocks), _deal("item", blocks)).count().agg(F.max("count")).first()[0]
            if largest <= 2 * BLOCK_RATINGS:
                break
            blocks *= 2
        return blocks

    def fit(self, ratings: DataFrame) -> SequentialFactors:
        ratings = cut_lineage(ratings.select("user", "item", "rating"))
        kinds = dict(ratings.dtypes)
        total = ratings.count()
        self.mu = global_mean(ratings) if self.biased else 0.0
        users, items = cut_lineage(self._start(ratings, "user")), cut_lineage(self._start(ratings, "item"))
        self.n_users, self.n_items = users.count(), items.count()
        if self.implicit:
            reach = ratings.join(users.select("user", "n"), "user").groupBy("item").agg(F.sum("n").cast("double").alias("m"))
            items = cut_lineage(items.join(reach, "item"))
        if total and self.epochs:
            k = self._blocks_for(ratings, total)
            layout = lay_out(ratings, k, self.seed)
            gammas = [self.gamma / self.decay ** (e + 1) for e in range(self.epochs)]
            # one block needs no move between epochs: several of them are one job
            at_once = max(1, JOB_RATINGS // total) if k == 1 and not self.implicit else 1
            if self.implicit:
                users, items = self._implicit_epochs(ratings, layout, users, items, k, gammas, kinds)
            else:
                columns = [*[f"f{c}" for c in range(self.rank)], "b"]
                state = cut_lineage(_packed(users, "user", USER, k, columns).unionByName(_packed(items, "item", ITEM, k, columns)))
                for e in range(0, self.epochs, at_once):
                    state = cut_lineage(self._pass(layout, state, k, gammas[e:e + at_once]))
                users = cut_lineage(_unpacked(state, "user", USER, kinds["user"], columns))
                items = cut_lineage(_unpacked(state, "item", ITEM, kinds["item"], columns))
            layout.unpersist()
        elif self.implicit:
            users = cut_lineage(self._with_implicit(ratings, users, items))
        self.users, self.items = users, items
        return self

    def _implicit_epochs(self, ratings, layout, users, items, k, gammas, kinds):
        vectors = [f"f{c}" for c in range(self.rank)]
        held = [f"z{c}" for c in range(self.rank)]
        still = items.select("item", "m", *[f"y{c}" for c in range(self.rank)])
        for gamma in gammas:
            users = cut_lineage(self._with_implicit(ratings, users, items))
            state = _packed(users, "user", USER, k, [*vectors, "b", *held]).unionByName(_packed(items, "item", ITEM, k, [*vectors, "b"]))
            state = cut_lineage(self._pass(layout, cut_lineage(state), k, [gamma]))
            users = cut_lineage(_unpacked(state, "user", USER, kinds["user"], [*vectors, "b", *held]))
            items = cut_lineage(_unpacked(state, "item", ITEM, kinds["item"], [*vectors, "b"]).join(still, "item"))
            items = self._implicit_step(ratings, users, items, gamma)
            still = items.select("item", "m", *[f"y{c}" for c in range(self.rank)])
        return cut_lineage(self._with_implicit(ratings, users, items)), items

    def _pass(self, layout: DataFrame, state: DataFrame, k: int, gammas: list[float]) -> DataFrame:
        """The state after one epoch for each of ``gammas``; several only where there is one block."""
        for s in range(k):
            state = self._stratum(layout, state, k, s, gammas)
        return state

    def _stratum(self, layout: DataFrame, state: DataFrame, k: int, s: int, gammas: list[float]) -> DataFrame:
        slot = F.when(F.col("side") == USER, F.col("block")).otherwise(F.pmod(F.col("block") - s, F.lit(k)))
        mine = layout.where(F.col("block") == F.pmod(F.col("slot") + s, F.lit(k)))
        moved = state.withColumn("slot", slot)
        return mine.groupBy("slot").cogroup(moved.groupBy("slot")).applyInArrow(self._block_update(gammas), STATE)

    def _block_update(self, gammas: list[float]):
        rank, mu, biased = self.rank, self.mu, self.biased
        reg_user, reg_item = self.reg[USER], self.reg[ITEM]

        def run(ratings: pa.Table, state: pa.Table) -> pa.Table:
            state = state.drop_columns("slot")
            sides = {r["side"]: r for r in state.to_pylist()}
            if not ratings.num_rows or len(sides) < 2:
                return state
            block = ratings.to_pylist()[0]
            ids = {s: np.frombuffer(r["ids"], "<i8") for s, r in sides.items()}
            p, q = (np.frombuffer(sides[s]["vectors"], "<f8").reshape(len(ids[s]), -1).copy() for s in (USER, ITEM))
            us = np.searchsorted(ids[USER], np.frombuffer(block["users"], "<i8"))
            vs = np.searchsorted(ids[ITEM], np.frombuffer(block["items"], "<i8"))
            r, cuts = np.frombuffer(block["ratings"], "<f8"), np.frombuffer(block["cuts"], "<i8").tolist()
            width = rank + biased  # the offset is one more entry, which meets a one
            for gamma in gammas:
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    u, v = us[lo:hi], vs[lo:hi]
                    a, b = p[u], q[v]
                    met = a[:, :rank] + a[:, rank + 1:] if a.shape[1] > rank + 1 else a[:, :rank]
                    e = r[lo:hi] - mu - np.einsum("nk,nk->n", met, b[:, :rank])
                    if biased:
                        e -= a[:, rank] + b[:, rank]
                    e = e[:, None]
                    to_a, to_b = np.ones((hi - lo, width)), np.ones((hi - lo, width))
                    to_a[:, :rank], to_b[:, :rank] = b[:, :rank], met
                    q[v, :width] = b[:, :width] + gamma * (e * to_b - reg_item * b[:, :width])
                    if not biased:  # the plain rule moves the item first, and the user by the moved item
                        to_a = q[v, :rank]
                    p[u, :width] = a[:, :width] + gamma * (e * to_a - reg_user * a[:, :width])
            new = {USER: p, ITEM: q}
            rows = [{**r, "vectors": _bytes(new[s], "<f8")} for s, r in sides.items()]
            return pa.Table.from_pylist(rows, schema=state.schema)

        return run
