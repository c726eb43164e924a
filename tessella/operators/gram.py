"""Second-moment matrices: the one pass over the data that every quadratic model needs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

NARROW = 45  # up to this many cells plain sums stay in generated code; wider goes to Arrow batches


@dataclass
class Moments:
    """n, X'X, X'y and y'y of one group of rows."""

    n: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.xx + other.xx, self.xy + other.xy, self.yy + other.yy)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.xx - other.xx, self.xy - other.xy, self.yy - other.yy)

    def sse(self, w: np.ndarray) -> float:
        """Sum of squared residuals of weights ``w``, without touching the rows again."""
        with np.errstate(over="ignore", invalid="ignore"):  # a diverged model has no finite error
            return float(max(self.yy - 2 * w @ self.xy + w @ self.xx @ w, 0.0))

    def pick(self, idx: Sequence[int]) -> Moments:
        """Moments of a subset of the columns."""
        return Moments(self.n, self.xx[np.ix_(idx, idx)], self.xy[list(idx)], self.yy)


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows without a NULL or NaN in ``cols``: the only ones that sums over several columns are made of."""
    return df.dropna(subset=list(dict.fromkeys(cols)))


def moment_cells(df: DataFrame, cols: Sequence[str], by: str | None = None, weight: str | None = None) -> DataFrame:
    """``[by,] i, j, v``: the upper triangle of the sum of (weight *) x_i * x_j, over rows without gaps.

    A row with a NULL or NaN in any of the columns (or in the weight) adds to no cell, whatever the number of columns.
    Rows never leave their partition: each contributes to at most D(D+1)/2 partial sums per group.
    """
    cols = list(cols)
    df = complete_rows(df, [*cols, *([weight] if weight else [])])
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    keys = [by] if by else []
    if len(pairs) <= NARROW:
        by_weight = f" * `{weight}`" if weight else ""
        wide = df.groupBy(*keys).agg(*[F.expr(f"sum(`{cols[i]}` * `{cols[j]}`{by_weight}) AS `_{i}_{j}`") for i, j in pairs])
        cells = ", ".join(f"struct({i} AS i, {j} AS j, `_{i}_{j}` AS v)" for i, j in pairs)
        return wide.select(*keys, F.expr(f"inline(array({cells}))"))

    data = df.select(*keys, *([weight] if weight else []), *cols)
    key_fields = [f for f in data.schema.fields if f.name in keys]
    key_type = to_arrow_type(key_fields[0].dataType) if by else None
    iu, ju = np.triu_indices(d)

    def partial(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols]).astype(float)
            w = batch.column(weight).to_numpy(zero_copy_only=False) if weight else None
            if by:
                codes = batch.column(by).dictionary_encode()
                at = codes.indices.to_numpy(zero_copy_only=False)
                groups = [((g,), at == c) for c, g in enumerate(codes.dictionary.to_pylist())]
            else:
                groups = [((), slice(None))]
            for g, rows in groups:
                part = x[rows]
                scaled = part if w is None else part * w[rows][:, None]
                sums[g] = sums.get(g, 0.0) + scaled.T @ part
        for g, m in sums.items():
            columns = [pa.array([v] * len(iu), key_type) for v in g]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(iu.astype(np.int32)), pa.array(ju.astype(np.int32)), pa.array(m[iu, ju])],
                names=[*keys, "i", "j", "v"])

    schema = T.StructType([*key_fields, T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
                           T.StructField("v", T.DoubleType())])
    return data.mapInArrow(partial, schema).groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))


def moments(df: DataFrame, cols: Sequence[str], y: str, by: str | None = None) -> dict:
    """Moments per group (key ``None`` without ``by``); only D x D cells per group reach the driver.

    ``by`` is a key of few values, such as a fold, a split or a segment. ``n`` counts the rows without gaps, which are those that the sums are made of.
    """
    one = "_one"
    names = [*cols, y, one]
    rows = df.withColumn(one, F.lit(1.0))
    cells = moment_cells(rows, names, by)
    d = len(cols)
    out: dict = {}
    for r in cells.collect():
        key = r[by] if by else None
        m = out.setdefault(key, np.zeros((d + 2, d + 2)))
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"] or 0.0
    return {k: Moments(float(m[d + 1, d + 1]), m[:d, :d], m[:d, d], float(m[d, d])) for k, m in out.items()}


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solve a D x D system; a singular one gets the minimum-norm answer."""
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(a, b, rcond=None)[0]
