"""Linear models. Rows are reduced to moments or gradients on the executors; the driver sees D numbers.

Squared losses never iterate over the data: gradient descent, ridge paths and folds all run on one
second-moment matrix. The logistic loss makes one aggregation pass per step over a cached table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import dot, sigmoid
from ..session import cut_lineage
from .gram import Moments, complete_rows, moments, solve
from .ranking import hash_rank

STOP_BELOW = 1e-8  # change of the penalised logistic loss that ends the descent
WIDE = 12  # columns from which a logistic pass runs on Arrow batches
STEP_FAN_IN = 16  # step maps of neighbouring tasks that one task composes
GRID_CELLS = 1 << 19  # rows x settings of one product inside a task


@dataclass
class Linear:
    """Weights by column, and the loss of the fit in the loss of its own family."""

    cols: list[str]
    w: np.ndarray
    loss: float = float("nan")
    steps: int = 0

    def score(self):
        return dot(self.cols, self.w)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, c, float(v)) for i, (c, v) in enumerate(zip(self.cols, self.w))]
        return spark.createDataFrame(rows, "pos INT, feature STRING, weight DOUBLE")


def least_squares(m: Moments, cols: Sequence[str]) -> Linear:
    """Normal equations; loss is half the mean squared error."""
    w = solve(m.xx, m.xy)
    return Linear(list(cols), w, m.sse(w) / m.n / 2)


def ridge(m: Moments, cols: Sequence[str], lam: float) -> Linear:
    """(X'X + 2 n lam I) w = X'y, the bias penalised like the rest; loss is the RMSE."""
    w = solve(m.xx + 2 * m.n * lam * np.eye(len(m.xy)), m.xy)
    return Linear(list(cols), w, float(np.sqrt(m.sse(w) / m.n)))


def descend(m: Moments, cols: Sequence[str], w0: np.ndarray, steps: int, gamma: float) -> Linear:
    """Full gradient descent on half the mean squared error; the loss is that before the last step."""
    w, loss = np.array(w0, float), float("nan")
    for _ in range(steps):
        loss = m.sse(w) / m.n / 2
        with np.errstate(over="ignore", invalid="ignore"):
            w = w - gamma * (m.xx @ w - m.xy) / m.n
    return Linear(list(cols), w, loss, steps)


@dataclass
class StepMap:
    """What a run of descent steps does to any weights: w becomes a w + c. Runs in a row compose."""

    a: np.ndarray
    c: np.ndarray

    def then(self, later: StepMap) -> StepMap:
        return StepMap(later.a @ self.a, later.a @ self.c + later.c)


def draw_rows(df: DataFrame, cols: Sequence[str], y: str, steps: int, batch: int = 1, seed: int = 1,
              key: str = "id") -> DataFrame:
    """``_step`` from 1, ``y`` and ``cols`` of the rows drawn for each step, uniformly and with replacement.

    Draws are ranks in hash order, and Spark draws them. Only the hash buckets that hold a drawn rank are shuffled. Rows
    with a gap are never drawn.
    """
    df = complete_rows(df, [y, *cols])
    n = df.count()
    spark = df.sparkSession
    at = F.col("id")
    step, place = (at / batch).cast("bigint") + 1, at % batch
    # a step's first draw is named by the step alone
    name = F.concat_ws(":", F.lit(str(seed)), step, F.when(place > 0, place))
    share = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / 4294967296.0
    draws = cut_lineage(spark.range(steps * batch).select(step.alias("_step"), F.floor(share * n).alias("_rank")))
    asked = [r["_rank"] for r in draws.select("_rank").distinct().toLocalIterator()]
    ranked = hash_rank(df.select(key, y, *cols), key, seed, "_rank", only=asked)
    return ranked.join(draws, "_rank").select("_step", y, *cols)


def step_maps(drawn: DataFrame, cols: Sequence[str], y: str, gammas: Sequence[float]) -> list[StepMap]:
    """The map of all steps in order, for each step length: half the mean squared error of a step's rows goes down.

    A task folds the steps of its range, and neighbouring tasks' maps are composed in a tree, so the driver gets D x D
    numbers for each step length whatever the number of steps.
    """
    d, rates = len(cols), np.array(gammas)
    fan_in = STEP_FAN_IN
    schema = "_place INT, _maps BINARY"

    def fold(batches):
        maps = np.zeros((len(rates), d, d + 1))
        maps[:, :, :d] = np.eye(d)
        held, seen = None, False

        def apply(x, t):
            # a step: w - gamma / n * X'(X w - y), on the map's columns and on its constant
            inner = np.einsum("nd,gdk->gnk", x, maps)
            inner[:, :, d] -= t
            maps[:] -= np.einsum("nd,gnk->gdk", x, inner) * (rates / len(t))[:, None, None]

        with np.errstate(over="ignore", invalid="ignore"):
            for b in batches:
                if not b.num_rows:
                    continue
                seen = True
                step = b.column("_step").to_numpy()
                x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])
                t = b.column(y).to_numpy(zero_copy_only=False)
                if held is not None:
                    step, x, t = np.r_[held[0], step], np.vstack([held[1], x]), np.r_[held[2], t]
                cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
                for lo, hi in zip(cuts[:-2], cuts[1:-1], strict=True):
                    apply(x[lo:hi], t[lo:hi])
                held = step[cuts[-2]:], x[cuts[-2]:], t[cuts[-2]:]  # a step may go on in the next batch
            if held is not None:
                apply(held[1], held[2])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([maps.tobytes()], pa.binary())], ["_place", "_maps"])

    def opened(data: bytes) -> list[StepMap]:
        return [StepMap(m[:, :d], m[:, d]) for m in np.frombuffer(data).reshape(len(rates), d, d + 1)]

    def compose(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("_place").to_pylist(), table.column("_maps").to_pylist(), strict=True))
        total = opened(rows[0][1])
        with np.errstate(over="ignore", invalid="ignore"):
            for _, data in rows[1:]:
                total = [m.then(later) for m, later in zip(total, opened(data), strict=True)]
        packed = np.stack([np.column_stack([m.a, m.c]) for m in total]).tobytes()
        return pa.table({"_place": pa.array([rows[0][0] // fan_in], pa.int32()), "_maps": pa.array([packed], pa.binary())})

    parts = drawn.sparkSession.sparkContext.defaultParallelism
    read = drawn.select("_step", y, *cols).repartitionByRange(parts, "_step").sortWithinPartitions("_step")
    maps = read.mapInArrow(fold, schema)
    while parts > 1:
        maps = maps.groupBy(F.floor(F.col("_place") / fan_in).alias("_group")).applyInArrow(compose, schema)
        parts = -(-parts // fan_in)
    row = maps.first()
    return opened(row["_maps"]) if row else [StepMap(np.eye(d), np.zeros(d)) for _ in rates]


def descend_stochastic(df: DataFrame, cols: Sequence[str], y: str, w0: np.ndarray, steps: int, gammas: Sequence[float],
                       seed: int = 1, key: str = "id", batch: int = 1) -> list[Linear]:
    """Stochastic descent on half the mean squared error of ``batch`` drawn rows in each step, for each step length.

    The loss is that of the last step's rows before that step.
    """
    drawn = cut_lineage(draw_rows(df, cols, y, steps, batch, seed, key))
    before = step_maps(drawn.where(F.col("_step") < steps), cols, y, gammas)
    last = drawn.where(F.col("_step") == steps)
    end = step_maps(last, cols, y, gammas)
    m = moments(last, cols, y).get(None)
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        for first, then in zip(before, end, strict=True):
            w = first.a @ np.array(w0, float) + first.c
            out.append(Linear(list(cols), then.a @ w + then.c, m.sse(w) / m.n / 2 if m else float("nan"), steps))
    return out


def _logistic_pass(df: DataFrame, cols: list[str], y: str, w: np.ndarray,
                   curvature: bool) -> tuple[float, np.ndarray, np.ndarray | None]:
    """Loss, gradient and (when asked) Hessian at ``w`` in one aggregation over rows without gaps."""
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i, d)] if curvature else []
    z = dot(cols, w)
    if d < WIDE and len(pairs) <= 36:
        scored = df.select(*cols, F.col(y).alias("_y"), z.alias("_z")).withColumn("_s", sigmoid(F.col("_z")))
        loss = "sum(greatest(_z, 0.0D) + log1p(exp(-abs(_z))) - _y * _z) AS loss"
        row = scored.agg(F.expr(loss), *[F.expr(f"sum(`{c}` * (_s - _y)) AS g{i}") for i, c in enumerate(cols)],
                         *[F.expr(f"sum(`{cols[i]}` * `{cols[j]}` * _s * (1 - _s)) AS h{i}_{j}") for i, j in pairs]).first()
        hess = None
        if curvature:
            hess = np.zeros((d, d))
            for i, j in pairs:
                hess[i, j] = hess[j, i] = row[f"h{i}_{j}"]
        return row["loss"], np.array([row[f"g{i}"] for i in range(d)]), hess

    def partial(batches):
        out = np.zeros(1 + d + (d * d if curvature else 0))
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])
            t = b.column(y).to_numpy(zero_copy_only=False)
            u = x @ w
            with np.errstate(over="ignore"):  # as the column expression: limited at 1,000, where e^z is infinite
                s = 1.0 / (1.0 + np.exp(-np.clip(u, -1000.0, 1000.0)))
            out[0] += np.sum(np.maximum(u, 0) + np.log1p(np.exp(-np.abs(u))) - t * u)
            out[1:1 + d] += x.T @ (s - t)
            if curvature:
                out[1 + d:] += (x.T @ (x * (s * (1 - s))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out)],
                                         names=["i", "v"])

    rows = (df.select(y, *cols).mapInArrow(partial, "i INT, v DOUBLE")
            .groupBy("i").agg(F.sum("v").alias("v")).collect())
    v = np.zeros(len(rows))
    for r in rows:
        v[r["i"]] = r["v"]
    return v[0], v[1:1 + d], v[1 + d:].reshape(d, d) if curvature else None


def logistic(df: DataFrame, cols: Sequence[str], y: str, w0: np.ndarray, steps: int, gamma: float, *,
             lam: float = 0.0, newton: bool = False, stop: float | None = None) -> Linear:
    """Logistic regression on labels {0, 1}; the gradient is a sum, not a mean.

    ``lam`` adds the ridge term to gradient, Hessian and loss. ``stop`` ends the descent when the
    loss moves by less (``STOP_BELOW`` for the regularised model). The loss is that after the last
    step; step t's gradient and step t-1's loss come out of the same pass. Rows with a gap take no part.
    """
    cols = list(cols)
    held = complete_rows(df.select(y, *cols), [y, *cols]).persist(StorageLevel.MEMORY_AND_DISK)
    w, before, done = np.array(w0, float), 0.0, 0
    try:
        loss, grad, hess = _logistic_pass(held, cols, y, w, newton)
        for done in range(1, steps + 1):
            g = grad + lam * w
            w = w - gamma * (solve(hess + lam * np.eye(len(w)), g) if newton else g)
            loss, grad, hess = _logistic_pass(held, cols, y, w, newton)
            loss += lam / 2.0 * float(w @ w)
            if stop is not None and abs(loss - before) < stop:
                break
            before = loss
    finally:
        held.unpersist()
    return Linear(cols, w, float(loss), done)


def _grid_pass(df: DataFrame, cols: list[str], y: str, part: str, w: np.ndarray, held: np.ndarray,
               curvature: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """For each column of ``w``: loss, gradient and Hessian over the rows outside its held-out part, and the loss in it."""
    d, many = w.shape
    per = 2 + d + (d * d if curvature else 0)
    step = max(1, GRID_CELLS // many)

    def partial(batches):
        out = np.zeros((many, per))
        for b in batches:
            xs = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])
            ts, ps = (b.column(c).to_numpy(zero_copy_only=False) for c in (y, part))
            for at in range(0, len(xs), step):
                x, t = xs[at:at + step], ts[at:at + step, None]
                inside = ps[at:at + step, None] == held
                with np.errstate(all="ignore"):  # a diverged setting has no finite loss
                    u = x @ w
                    s = 1.0 / (1.0 + np.exp(-np.clip(u, -1000.0, 1000.0)))
                    loss = np.maximum(u, 0) + np.log1p(np.exp(-np.abs(u))) - t * u
                    out[:, 0] += np.where(inside, 0.0, loss).sum(axis=0)
                    out[:, 1] += np.where(inside, loss, 0.0).sum(axis=0)
                    out[:, 2:2 + d] += np.where(inside, 0.0, s - t).T @ x
                    for k in range(many if curvature else 0):
                        weight = np.where(inside[:, k], 0.0, s[:, k] * (1 - s[:, k]))
                        out[k, 2 + d:] += (x.T @ (x * weight[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size, dtype=np.int32)), pa.array(out.ravel())],
                                         names=["i", "v"])

    v = np.zeros(many * per)
    for r in df.mapInArrow(partial, "i INT, v DOUBLE").groupBy("i").agg(F.sum("v").alias("v")).collect():
        v[r["i"]] = r["v"]
    v = v.reshape(many, per)
    return v[:, 0], v[:, 2:2 + d].T, v[:, 1], v[:, 2 + d:].reshape(many, d, d) if curvature else None


def logistic_grid(df: DataFrame, cols: Sequence[str], y: str, w0: np.ndarray, steps: int,
                  settings: Sequence[tuple[float, float, int]], part: str, *, newton: bool = False,
                  stop: float | None = None) -> list[tuple[Linear, float]]:
    """What ``logistic`` gives for each (gamma, lambda, held-out part), and the loss in that part.

    All settings move together: a step is one pass over the rows for the D x settings weight matrix, so the number of
    jobs doesn't grow with the settings. A setting that has stopped leaves the matrix. Rows with a gap take no part.
    """
    cols = list(cols)
    rows = complete_rows(df.select(y, part, *cols), [y, *cols]).persist(StorageLevel.MEMORY_AND_DISK)
    gamma, lam = np.array([s[0] for s in settings]), np.array([s[1] for s in settings])
    held = np.array([s[2] for s in settings])
    w = np.repeat(np.array(w0, float)[:, None], len(settings), axis=1)
    before, loss, inside, done = (np.zeros(len(settings)) for _ in range(4))
    live = np.arange(len(settings))
    try:
        _, grad, _, hess = _grid_pass(rows, cols, y, part, w, held, newton)
        for t in range(1, steps + 1):
            with np.errstate(all="ignore"):
                g = grad + lam[live] * w[:, live]
                if newton:
                    g = np.column_stack([solve(h + lam[k] * np.eye(len(w)), g[:, at]) for at, (k, h) in enumerate(zip(live, hess))])
                w[:, live] -= gamma[live] * g
            fit, grad, inside[live], hess = _grid_pass(rows, cols, y, part, w[:, live], held[live], newton)
            loss[live] = fit + lam[live] / 2.0 * (w[:, live] ** 2).sum(axis=0)
            done[live] = t
            going = np.full(len(live), True) if stop is None else ~(np.abs(loss[live] - before[live]) < stop)
            before[live] = loss[live]
            live, grad, hess = live[going], grad[:, going], hess[going] if newton else None
            if not len(live):
                break
    finally:
        rows.unpersist()
    return [(Linear(cols, w[:, k], float(loss[k]), int(done[k])), float(inside[k])) for k in range(len(settings))]


def ridge_path(m: Moments, cols: Sequence[str], lams: Sequence[float]) -> list[Linear]:
    """One fit per penalty from one moment matrix: only its diagonal changes."""
    return [ridge(m, cols, lam) for lam in lams]


def rmse_of(m: Moments, w: np.ndarray) -> float:
    return float(np.sqrt(m.sse(w) / m.n))


def moments_of(df: DataFrame, cols: Sequence[str], y: str = "y") -> Moments:
    return moments(df, cols, y)[None]
