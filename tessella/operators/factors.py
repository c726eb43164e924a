"""Matrix factorisation: gradient epochs (plain, biased, with implicit feedback), ALS with two
penalties, and the library ALS.

Factor tables have one row per user or item; they are cut into the checkpoint folder after every
epoch, which costs little next to the pass over the ratings and keeps plans flat.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import number
from ..session import checkpoint_root, cut_lineage
from .lookup import TASK_ROWS, Held
from .means import Recommender, global_mean
from .ranking import sorted_rank

USER, ITEM = 0, 1
ROWS_PER_TASK = 1_000_000
SLICE_ROWS = 1 << 14


def _f(prefix: str, rank: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(rank)]


def _draw(seed: int, kind: str, key: str, k: int) -> str:
    """SQL text of a uniform draw per (kind, key, k), the same as ``uniform``."""
    head = f"substring(md5(concat_ws(':', '{seed}', '{kind}', cast({key} AS string), '{k}')), 1, 8)"
    return f"cast(conv({head}, 16, 10) AS bigint) / 4294967296.0D"


def _inner(a: str, b: str, rank: int) -> str:
    """SQL text of the inner product of a0.. and b0.."""
    return " + ".join(f"{a}{k} * {b}{k}" for k in range(rank))


def init_factors(ratings: DataFrame, rank: int, seed: int = 988) -> tuple[DataFrame, DataFrame]:
    """(users, items) with uniform factors ``f0..``; an item's factor 0 is its mean rating."""
    def table(key: str, first: str | None) -> DataFrame:
        stats = ratings.groupBy(key).agg(F.expr("count(1) AS n"), F.expr("avg(rating) AS _mean"))
        cols = [f"{_draw(seed, key, key, k)} AS f{k}" for k in range(rank)]
        if first is not None:
            cols[0] = f"{first} AS f0"
        return stats.selectExpr(key, "n", *cols)

    return table("user", None), table("item", "_mean")


def observed_rmse(ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """RMSE of user . item over the observed cells."""
    p = users.selectExpr("user", *[f"f{k} AS p{k}" for k in range(rank)])
    q = items.selectExpr("item", *[f"f{k} AS q{k}" for k in range(rank)])
    e = F.col("rating") - F.expr(_inner("p", "q", rank))
    return ratings.join(p, "user").join(q, "item").agg(F.sqrt(F.avg(e * e)).alias("rmse"))


def _rate(gamma: float, n: Column, c: Column) -> Column:
    """(1 - (1 - gamma * c / n)^n) / c for n updates that meet a summed squared length c."""
    per = F.least(F.lit(gamma) * c / n, F.lit(1.0))
    return F.when(c > 0, (1 - F.pow(1 - per, n)) / c).otherwise(F.lit(gamma))


class GradientFactors(Recommender):
    """Matrix factorisation by gradient epochs.

    A half-epoch moves all items (or all users) at once with the other side held fixed. The n updates
    a row gets in a sequential epoch shrink it by (1 - gamma * lambda)^n and pull it with a step that
    saturates, so its summed gradient is scaled by (1 - (1 - gamma * c)^n) / (n * c), c being the mean
    squared length of the vectors it meets: gamma for a rare row, 1 / (n * c) for a frequent one. That
    agrees with the sequential rule to first order in gamma and cannot overshoot, whatever n is.
    """

    def __init__(self, rank: int = 10, epochs: int = 400, gamma: float = 0.0002, reg: float = 0.009, *,
                 reg_item: float | None = None, decay: float = 1.0, biased: bool = True, implicit: bool = False,
                 spread: float = 0.1, seed: int = 988):
        self.rank, self.epochs, self.gamma, self.decay = rank, epochs, gamma, decay
        self.reg = {USER: reg, ITEM: reg if reg_item is None else reg_item}
        self.biased, self.implicit, self.spread, self.seed = biased, implicit, spread, seed
        self.clipped = biased

    @classmethod
    def plain(cls, rank: int = 20, epochs: int = 20, seed: int = 988) -> GradientFactors:
        """r = u . i with the lab's settings; the step is divided by 1.2 before every epoch."""
        return cls(rank, epochs, 0.01, 0.1, reg_item=0.7, decay=1.2, biased=False, seed=seed)

    def _start(self, ratings: DataFrame, key: str) -> DataFrame:
        if not self.biased:
            return init_factors(ratings, self.rank, self.seed)[0 if key == "user" else 1] \
                .withColumn("b", F.lit(0.0))

        def draw(kind: str, name: str) -> list[str]:
            # uniform with deviation ``spread``
            return [f"({_draw(self.seed, kind, key, k)} - 0.5D) * {number(self.spread * 12 ** 0.5)} AS {name}{k}"
                    for k in range(self.rank)]

        y = draw("implicit", "y") if self.implicit and key == "item" else []
        return ratings.groupBy(key).agg(F.expr("count(1) AS n")).selectExpr(key, "n", *draw(key, "f"), "0.0D AS b", *y)

    def fit(self, ratings: DataFrame) -> GradientFactors:
        ratings = ratings.select("user", "item", "rating").persist(StorageLevel.MEMORY_AND_DISK)
        self.mu = global_mean(ratings) if self.biased else 0.0
        users, items = cut_lineage(self._start(ratings, "user")), cut_lineage(self._start(ratings, "item"))
        self.n_users, self.n_items = users.count(), items.count()
        if self.implicit:
            sizes = Held(users.select("user", "n"), self.n_users).join_to(ratings, "user")
            reach = sizes.groupBy("item").agg(F.sum("n_user").cast("double").alias("m"))
            items = cut_lineage(items.join(reach, "item"))
        gamma = self.gamma
        for _ in range(self.epochs):
            gamma /= self.decay
            users, items = self._epoch(ratings, users, items, gamma)
        if self.implicit:
            users = cut_lineage(self._with_implicit(ratings, users, items))
        ratings.unpersist()
        self.users, self.items = users, items
        return self

    def _with_implicit(self, ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        """Users with z = |N(u)|^-1/2 * sum of y over the rated items: one join and one sum."""
        y = Held(items.select("item", "n", *_f("y", self.rank)), self.n_items)
        z = y.join_to(ratings, "item", row_bytes=24 + 8 * self.rank).groupBy("user").agg(
            *[F.expr(f"sum(y{k}) AS z{k}") for k in range(self.rank)])
        kept = [c for c in users.columns if not c.startswith("z")]
        return users.select(*kept).join(z, "user").selectExpr(
            *kept, *[f"z{k} / sqrt(n) AS z{k}" for k in range(self.rank)])

    def _sides(self, users: DataFrame, items: DataFrame) -> tuple[Held, Held]:
        def side(df, key, new):
            z = self.implicit and key == "user"
            vec = [f"f{k} + z{k} AS {new}{k}" if z else f"f{k} AS {new}{k}" for k in range(self.rank)]
            return df.selectExpr(key, "n", f"b AS b_{key}", *vec)

        return Held(side(users, "user", "p"), self.n_users), Held(side(items, "item", "q"), self.n_items)

    def _score(self, rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        left, right = self._sides(users, items)
        width = 32 + 8 * self.rank
        return right.join_to(left.join_to(rows, "user", row_bytes=width), "item", row_bytes=width)

    def _errors(self, ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        offsets = " + b_user + b_item" if self.biased else ""
        est = f"{number(self.mu)}{offsets} + {_inner('p', 'q', self.rank)}"
        return self._score(ratings, users, items).withColumn("_e", F.expr(f"rating - ({est})"))

    def _epoch(self, ratings: DataFrame, users: DataFrame, items: DataFrame, gamma: float):
        if self.implicit:
            users = cut_lineage(self._with_implicit(ratings, users, items))
        items = self._half(self._errors(ratings, users, items), items, "item", "p", gamma, self.reg[ITEM])
        users = self._half(self._errors(ratings, users, items), users, "user", "q", gamma, self.reg[USER])
        if self.implicit:
            items = self._implicit_step(ratings, users, items, gamma)
        return users, items

    def _half(self, errors: DataFrame, table: DataFrame, key: str, met: str, gamma: float, reg: float) -> DataFrame:
        rank = self.rank
        length = _inner(met, met, rank) + (" + 1.0D" if self.biased else "")
        # combined before the shuffle: one row per key and task
        sums = errors.groupBy(key).agg(F.expr("sum(_e) AS _gb"), F.expr(f"sum({length}) AS _c"),
                                       *[F.expr(f"sum(_e * {met}{k}) AS _g{k}") for k in range(rank)])
        steps = table.join(sums, key).withColumns({"_rate": _rate(gamma, F.col("n").cast("double"), F.col("_c")),
                                                   "_keep": F.pow(F.lit(1 - gamma * reg), F.col("n"))})
        moved = {f"f{k}": f"f{k} * _keep + _rate * _g{k} AS f{k}" for k in range(rank)}
        if self.biased:
            moved["b"] = "b * _keep + _rate * _gb AS b"
        return cut_lineage(steps.selectExpr(*[moved.get(c, c) for c in table.columns]))

    def _implicit_step(self, ratings: DataFrame, users: DataFrame, items: DataFrame, gamma: float) -> DataFrame:
        """Moves y: each user's summed e * q goes back once to every item the user rated."""
        rank = self.rank
        own = self._errors(ratings, users, items).groupBy("user").agg(
            F.expr("count(1) AS n"), F.expr(f"sum({_inner('q', 'q', rank)}) AS _c"),
            *[F.expr(f"sum(_e * q{k}) / sqrt(count(1)) AS s{k}") for k in range(rank)])
        back = Held(own, self.n_users).join_to(ratings, "user", row_bytes=32 + 8 * rank).groupBy("item").agg(
            F.expr("sum(_c) AS _c"), *[F.expr(f"sum(s{k}) AS _h{k}") for k in range(rank)])
        steps = items.join(back, "item").withColumns(
            {"_rate": _rate(gamma, F.col("m"), F.col("_c")), "_keep": F.pow(F.lit(1 - gamma * self.reg[ITEM]), F.col("m"))})
        moved = {f"y{k}": f"y{k} * _keep + _rate * _h{k} AS y{k}" for k in range(rank)}
        return cut_lineage(steps.selectExpr(*[moved.get(c, c) for c in items.columns]))

    def raw(self, pairs: DataFrame) -> DataFrame:
        rows = self._score(pairs, self.users, self.items)
        est = " + ".join(f"coalesce(p{k} * q{k}, 0.0D)" for k in range(self.rank))
        if self.biased:
            est = f"{number(self.mu)} + coalesce(b_user, 0.0D) + coalesce(b_item, 0.0D) + {est}"
        return rows.select(*pairs.columns, F.expr(est).alias("prediction"))


class WeightedAls(Recommender):
    """ALS where a row's penalty is lambda times its number of ratings, with one lambda per side.

    A half-step solves (M M' + n lambda I) x = M r for every row of one side. The ratings are laid out
    once per side, sorted by row within a partition, so a task adds up each row's K x K system as it
    streams by and hands on one sum per row. A row with a large share of all ratings is dealt to
    several tasks and its partial sums are added in a second step.

    Fixed factors that fit a broadcast are broadcast. Others go by a routing table, which has for each
    of them the blocks of ratings that need it: a half-step sends a factor once to each such block,
    and no rating moves.
    """

    clipped = False

    def __init__(self, rank: int = 20, reg_user: float = 0.1, reg_item: float = 0.7, stop: float = 1e-4,
                 max_sweeps: int = 100, seed: int = 988):
        self.rank, self.reg_user, self.reg_item = rank, reg_user, reg_item
        self.stop, self.max_sweeps, self.seed = stop, max_sweeps, seed

    def fit(self, ratings: DataFrame) -> WeightedAls:
        ratings = ratings.select("user", "item", "rating")
        self.kinds = dict(ratings.dtypes)
        total_n = ratings.count()
        # the layout's width follows the data, not the session's shuffle setting
        parallel = ratings.sparkSession.sparkContext.defaultParallelism
        self.tasks = max(parallel, total_n // ROWS_PER_TASK)
        users, items = init_factors(ratings, self.rank, self.seed)
        users, items = cut_lineage(users), cut_lineage(items)
        self.n_users, self.n_items = users.count(), items.count()
        width = 24 + 8 * self.rank
        layouts = {key: (self._layout if _is_small(fixed, width) else self._routed)(ratings, table, key)
                   for key, table, fixed in (("user", users, self.n_items), ("item", items, self.n_users))}
        self.errors: list[float] = []
        before = 0.0
        for _ in range(self.max_sweeps):
            users = self._half_step(layouts["user"], "user", "item", items, self.n_items, self.reg_user)
            items = self._half_step(layouts["item"], "item", "user", users, self.n_users, self.reg_item)
            # the solved systems already know the squared error, so no further pass is needed
            rmse = float(np.sqrt(items.agg(F.sum("sse")).first()[0] / total_n))
            self.errors.append(rmse)
            if abs(rmse - before) <= self.stop:
                break
            before = rmse
        for layout in layouts.values():
            for kept in layout[:-1]:
                kept.unpersist()
        self.users, self.items = users, items
        return self

    def _dealt(self, ratings: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, bool]:
        """``ratings`` with ``_deal``, the share of a hot key that a rating is in, if there is any hot key."""
        other = "item" if key == "user" else "user"
        hot = table.where(F.col("n") > TASK_ROWS).select(key, F.ceil(F.col("n") / TASK_ROWS).alias("_shares"))
        many = hot.count()
        split = many > 0
        if split:
            share = F.pmod(F.xxhash64(other), F.coalesce(F.col("_shares"), F.lit(1)))
            ratings = ratings.join(F.broadcast(hot) if _is_small(many, 32) else hot, key, "left").withColumn("_deal", share) \
                .drop("_shares")
        return ratings, split

    def _layout(self, ratings: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, bool]:
        ratings, split = self._dealt(ratings, table, key)
        dealt = ratings.repartition(self.tasks, *([key, "_deal"] if split else [key]))
        return dealt.sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK), split

    def _routed(self, ratings: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame, bool]:
        """(blocks of ratings, routes, split): one row for each block, with the sorted ids that it needs and, by ``key``,
        the places of its ratings among them; and (other id, block) for each id that a block needs. Both are kept as they
        are partitioned, in no fewer parts than a shuffle has, so that a half-step reads them where they are."""
        other = "item" if key == "user" else "user"
        ratings, split = self._dealt(ratings, table, key)
        kind = dict(ratings.dtypes)[other]
        block = F.pmod(F.xxhash64(*([key, "_deal"] if split else [key])), F.lit(self.tasks))
        parts = max(2 * self.tasks, int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")))

        def pack(rows: pa.Table) -> pa.Table:
            keys, others, r = (rows.column(c).to_numpy() for c in (key, other, "rating"))
            by = np.lexsort((others, keys))
            needed, place = np.unique(others[by], return_inverse=True)
            raw = {"_keys": keys[by].astype("<i8"), "_needed": needed.astype("<i8"), "_places": place.astype("<i4"),
                   "_ratings": r[by].astype("<f8")}
            return pa.table({"_block": [rows.column("_block")[0].as_py()], **{c: [a.tobytes()] for c, a in raw.items()}})

        def routes(batches):
            for batch in batches:
                for block, needed in zip(batch.column("_block").to_pylist(), batch.column("_needed").to_pylist(), strict=True):
                    ids = np.frombuffer(needed, "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), block))], [other, "_block"])

        rows = ratings.select(block.alias("_block"), F.col(key).cast("long").alias(key), F.col(other).cast("long").alias(other), "rating")
        packed = cut_lineage(rows.groupBy("_block").applyInArrow(
            pack, "_block BIGINT, _keys BINARY, _needed BINARY, _places BINARY, _ratings BINARY"))
        routed = packed.select("_block", "_needed").mapInArrow(routes, f"{other} BIGINT, _block BIGINT") \
            .withColumn(other, F.col(other).cast(kind))
        kept = [t.repartition(parts, by).persist(StorageLevel.MEMORY_AND_DISK) for t, by in ((packed, "_block"), (routed, other))]
        for t in kept:
            t.count()
        return *kept, split

    def _half_step(self, layout: tuple, key: str, other: str, factors: DataFrame, rows_n: int, reg: float) -> DataFrame:
        return cut_lineage(self._solved(layout, key, other, factors, rows_n, reg))

    def _solved(self, layout: tuple, key: str, other: str, factors: DataFrame, rows_n: int, reg: float) -> DataFrame:
        *tables, split = layout
        rank = self.rank
        names = _f("f", rank)
        wide = [f"s{c}" for c in range(rank * (rank + 1) // 2 + rank + 2)]
        kind = self.kinds[key]
        out_schema = f"{key} {kind}, n BIGINT, sse DOUBLE, " + ", ".join(f"{n} DOUBLE" for n in names)
        sum_schema = f"{key} {kind}, " + ", ".join(f"{w} DOUBLE" for w in wide)
        systems = _sum_systems(key, rank, names, wide, None if split else reg)
        schema = sum_schema if split else out_schema
        if len(tables) == 1:
            fixed = Held(factors.select(other, "n", *names), rows_n)
            joined = fixed.join_to(tables[0], other, "inner", row_bytes=24 + 8 * rank)
            made = joined.select(key, "rating", *names).mapInArrow(systems, schema)
        else:
            blocks, routes = tables
            sent = routes.join(factors.select(other, *names), other).select("_block", other, *names)
            made = blocks.groupBy("_block").cogroup(sent.groupBy("_block")).applyInArrow(
                _block_systems(key, other, names, systems, kind), schema)
        if not split:
            return made
        summed = made.groupBy(key).agg(*[F.expr(f"sum({w}) AS {w}") for w in wide])
        return summed.mapInArrow(_solve_sums(key, rank, names, wide, reg), out_schema)

    def raw(self, pairs: DataFrame) -> DataFrame:
        width = 24 + 8 * self.rank
        p = Held(self.users.selectExpr("user", "n", *[f"f{k} AS p{k}" for k in range(self.rank)]), self.n_users)
        q = Held(self.items.selectExpr("item", "n", *[f"f{k} AS q{k}" for k in range(self.rank)]), self.n_items)
        rows = q.join_to(p.join_to(pairs, "user", row_bytes=width), "item", row_bytes=width)
        return rows.select(*pairs.columns, F.expr(_inner("p", "q", self.rank)).alias("prediction"))


def _is_small(rows: int, row_bytes: int) -> bool:
    from ..session import BROADCAST_LIMIT_BYTES
    return rows * row_bytes <= BROADCAST_LIMIT_BYTES


def _solve_batch(ids, sums: np.ndarray, key: str, rank: int, names: list[str], reg: float) -> pa.RecordBatch:
    iu, ju = np.triu_indices(rank)
    cells = len(iu)
    a = np.zeros((len(sums), rank, rank))
    a[:, iu, ju] = a[:, ju, iu] = sums[:, :cells]
    v, rr, n = sums[:, cells:cells + rank], sums[:, -2], sums[:, -1]
    x = np.linalg.solve(a + (reg * n)[:, None, None] * np.eye(rank), v[:, :, None])[:, :, 0]
    sse = rr - 2 * np.einsum("nk,nk->n", x, v) + np.einsum("nk,nkl,nl->n", x, a, x)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(n.astype(np.int64)), pa.array(np.maximum(sse, 0.0)), *[pa.array(x[:, k]) for k in range(rank)]],
        names=[key, "n", "sse", *names])


def _sum_systems(key: str, rank: int, names: list[str], wide: list[str], reg: float | None) -> Callable:
    """Stream rows sorted by ``key`` into one system per key; solve them at once when ``reg`` is given."""
    iu, ju = np.triu_indices(rank)

    def emit(ids, sums):
        if reg is not None:
            return _solve_batch(ids, sums, key, rank, names, reg)
        return pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(sums[:, c]) for c in range(sums.shape[1])]],
                                          names=[key, *wide])

    def run(batches):
        held_id, held = None, None
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(key).to_numpy()
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in names])
            r = b.column("rating").to_numpy(zero_copy_only=False)
            terms = np.column_stack([x[:, iu] * x[:, ju], x * r[:, None], r * r, np.ones(len(r))])
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            sums, heads = np.add.reduceat(terms, starts, axis=0), ids[starts]
            if held is not None:
                if heads[0] == held_id:
                    sums[0] += held[0]
                else:
                    sums, heads = np.vstack([held, sums]), np.r_[held_id, heads]
            # the last key may go on in the next batch
            held_id, held = heads[-1], sums[-1:]
            if len(heads) > 1:
                yield emit(heads[:-1], sums[:-1])
        if held is not None:
            yield emit(np.array([held_id]), held)

    return run


def _block_systems(key: str, other: str, names: list[str], systems: Callable, kind: str) -> Callable:
    """A block's ratings with the factors that were sent to it, in slices, through ``systems``."""
    def run(ratings: pa.Table, sent: pa.Table) -> pa.Table:
        block = ratings.to_pylist()[0]  # factors are sent to blocks that have ratings only
        keys, needed = np.frombuffer(block["_keys"], "<i8"), np.frombuffer(block["_needed"], "<i8")
        place, r = np.frombuffer(block["_places"], "<i4"), np.frombuffer(block["_ratings"], "<f8")
        ids = sent.column(other).to_numpy()
        by = np.argsort(ids)
        if not np.array_equal(ids[by], needed):
            raise ValueError("a block of ratings lacks factors")
        x = np.column_stack([sent.column(n).to_numpy() for n in names])[by]
        keys = keys.astype(np.int32 if kind == "int" else np.int64)

        def slices():
            for lo in range(0, len(keys), SLICE_ROWS):
                at = slice(lo, lo + SLICE_ROWS)
                f = x[place[at]]
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(r[at]), *[pa.array(f[:, c]) for c in range(len(names))]],
                                                 [key, "rating", *names])

        return pa.Table.from_batches(list(systems(slices())))

    return run


def _solve_sums(key: str, rank: int, names: list[str], wide: list[str], reg: float) -> Callable:
    def run(batches):
        for b in batches:
            if b.num_rows:
                sums = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in wide])
                yield _solve_batch(b.column(key).to_numpy(), sums, key, rank, names, reg)

    return run


class LibraryAls(Recommender):
    """The library's ALS; cold pairs get no row, and the answer is not limited to [1, 5]."""

    clipped = False

    def __init__(self, rank: int = 10, epochs: int = 100, lam: float = 0.009, seed: int | None = 4):
        self.rank, self.epochs, self.lam, self.seed = rank, epochs, lam, seed

    def fit(self, ratings: DataFrame) -> LibraryAls:
        from pyspark.ml.recommendation import ALS
        checkpoint_root(ratings.sparkSession)  # the library cuts its lineage there
        # the library takes 32-bit ids only: others are numbered
        low, high = (ratings.agg(f(*[g(c) for c in ("user", "item")])).first()[0] for f, g in ((F.least, F.min), (F.greatest, F.max)))
        self.numbers = None
        if low is not None and (low < -(1 << 31) or high >= 1 << 31):
            self.numbers = {k: Held.of(sorted_rank(ratings.select(k).distinct(), [F.col(k)], f"_{k}")) for k in ("user", "item")}
        als = ALS(rank=self.rank, maxIter=self.epochs, regParam=self.lam, seed=self.seed, userCol="_user",
                  itemCol="_item", ratingCol="rating", coldStartStrategy="drop")
        self.model = als.fit(self._numbered(ratings).select("_user", "_item", "rating"))
        return self

    def _numbered(self, rows: DataFrame) -> DataFrame:
        """``rows`` with 32-bit ids; those of unseen users and items are no numbers of the model."""
        if self.numbers is None:
            fits = F.lit(True)
            for k in ("user", "item"):
                fits = fits & F.col(k).between(-(1 << 31), (1 << 31) - 1)
            return rows.where(fits).withColumns({f"_{k}": F.col(k).cast("int") for k in ("user", "item")})
        for k in ("user", "item"):
            rows = self.numbers[k].join_to(rows, k, "inner")
        return rows.withColumns({f"_{k}": F.col(f"_{k}").cast("int") for k in ("user", "item")})

    def raw(self, pairs: DataFrame) -> DataFrame:
        """Scores only the wanted pairs instead of every user times every item."""
        return self.model.transform(self._numbered(pairs)).select(*pairs.columns, F.col("prediction").cast("double"))

    def recommend(self, n: int) -> DataFrame:
        """The n best items of every user, one row each."""
        recs = self.model.recommendForAllUsers(n)
        out = recs.select("_user", F.explode("recommendations").alias("r")).select(
            "_user", "r._item", F.col("r.rating").cast("double").alias("rating"))
        if self.numbers is None:
            return out.select(F.col("_user").alias("user"), F.col("_item").alias("item"), "rating")
        for k in ("user", "item"):
            out = self.numbers[k].join_to(out, f"_{k}", "inner")
        return out.select("user", "item", "rating")


def top_n(scored: DataFrame, n: int, score: str = "prediction") -> DataFrame:
    """The n best items of each user; ranks beyond n are dropped before the shuffle."""
    from pyspark.sql import Window as W
    place = F.row_number().over(W.partitionBy("user").orderBy(F.col(score).desc(), "item"))
    return scored.withColumn("place", place).where(F.col("place") <= n)
