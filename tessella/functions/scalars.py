"""Column expressions shared by the operators; everything here stays inside code generation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = -999.0
RATING_LOW, RATING_HIGH = 1.0, 5.0


def digest(seed: int, *keys: str | Column) -> Column:
    """Hex digest of ``seed:key[:key...]``: one fixed random order, the same in any SQL engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_col(k).cast("string") for k in keys]))


def uniform(seed: int, *keys: str | Column) -> Column:
    """A reproducible draw from [0, 1) for each key."""
    return F.conv(F.substring(digest(seed, *keys), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def number(v: float) -> str:
    """A double as SQL text, digit for digit."""
    v = float(v)
    return f"{v!r}D" if math.isfinite(v) else f"double('{v}')"


def dot(cols: Sequence[str], weights: Sequence[float]) -> Column:
    """Linear score of a row: the sum of column times weight."""
    return F.expr(" + ".join(f"`{c}` * {number(w)}" for c, w in zip(cols, weights, strict=True)))


def sigmoid(z: Column) -> Column:
    """Logistic function on a score limited to [-1000, 1000]."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(z, -1000.0, 1000.0)))


def softplus(z: Column) -> Column:
    """log(1 + e^z) without overflow."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def clip(c: Column, low: float = RATING_LOW, high: float = RATING_HIGH) -> Column:
    """Limited to [low, high]; NULL stays NULL."""
    return F.when(c > high, F.lit(high)).when(c < low, F.lit(low)).otherwise(c)


def star(c: Column) -> Column:
    """A predicted rating as a valid star value: rounded half to even, then limited to [1, 5]."""
    return clip(F.rint(c))


def class_label(score: Column, logistic: bool = False) -> Column:
    """Class of a linear score; ``logistic`` takes a probability and answers 0 or 1."""
    cut, low, high = (0.5, 0.0, 1.0) if logistic else (0.0, -1.0, 1.0)
    return F.when(F.isnan(score), score).when(score > cut, high).when(score <= cut, low)


def powers(c: str | Column, degree: int, step: int = 1) -> list[Column]:
    """x, x^(1+step), ... up to ``degree``."""
    x = _col(c)
    return [x if p == 1 else F.pow(x, F.lit(float(p))) for p in range(1, degree + 1, step)]
