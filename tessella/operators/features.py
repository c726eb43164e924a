"""Feature repair and expansion. Missing values are NULL here (see ``sources.features.missing_to_null``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import powers
from .ranking import exact_medians

BIAS = "bias"


def expand_powers(df: DataFrame, cols: Sequence[str], degree: int | Mapping[str, int] | Sequence[int], *,
                  bias: bool = True, odd_only: bool = False) -> tuple[DataFrame, list[str]]:
    """Powers of every feature (no cross terms), feature by feature; ``degree`` may differ per feature.

    Gives the frame with the new columns in place of the old ones, and their names in order.
    """
    if isinstance(degree, int):
        degree = {c: degree for c in cols}
    elif not isinstance(degree, Mapping):
        degree = dict(zip(cols, degree, strict=True))
    step = 2 if odd_only else 1
    made = [(f"{c}_p{p}", x) for c in cols
            for p, x in zip(range(1, degree[c] + 1, step), powers(c, degree[c], step))]
    if bias:
        made.insert(0, (BIAS, F.lit(1.0)))
    kept = [F.col(c) for c in df.columns if c not in cols]
    return df.select(*kept, *[x.alias(n) for n, x in made]), [n for n, _ in made]


def expand_one(df: DataFrame, cols: Sequence[str], which: str, degree: int) -> tuple[DataFrame, list[str]]:
    """Replace one feature by its powers and leave the others as they are."""
    names = [n for c in cols for n in ([c] if c != which else [f"{c}_p{p}" for p in range(1, degree + 1)])]
    made = dict(zip((f"{which}_p{p}" for p in range(1, degree + 1)), powers(which, degree)))
    kept = [F.col(c) for c in df.columns if c not in cols]
    return df.select(*kept, *[made[n].alias(n) if n in made else F.col(n) for n in names]), names


def missing_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return row.asDict()


def missing_indicators(df: DataFrame, cols: Sequence[str], *, by_mask: bool = False) -> tuple[DataFrame, list[str]]:
    """One 0/1 column per group of features with missing values: 1 where the group's first is present.

    Features belong together when they miss equally often; ``by_mask`` asks for the same rows instead.
    """
    counts = missing_counts(df, cols)
    gaps = sorted((n, i, c) for i, c in enumerate(cols) if (n := counts[c]))
    heads: list[str] = []
    if by_mask and gaps:
        differ = [(a, b) for x, (_, _, a) in enumerate(gaps) for _, _, b in gaps[:x] if counts[a] == counts[b]]
        rows = df.agg(*[F.count_if(F.col(a).isNull() != F.col(b).isNull()).alias(f"{a}|{b}")
                        for a, b in differ]).first() if differ else {}
        same = {(a, b) for a, b in differ if rows[f"{a}|{b}"] == 0}
        for _, _, c in gaps:
            if not any((c, h) in same for h in heads):
                heads.append(c)
    else:
        seen: set[int] = set()
        for n, _, c in gaps:
            if n not in seen:
                seen.add(n)
                heads.append(c)
    names = [f"has_{h}" for h in heads]
    return df.withColumns({n: F.col(h).isNotNull().cast("int") for n, h in zip(names, heads)}), names


def complete_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The features without a single missing value."""
    counts = missing_counts(df, cols)
    return [c for c in cols if counts[c] == 0]


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    kept = complete_columns(df, cols)
    return df.drop(*[c for c in cols if c not in kept]), kept


def impute(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """Fill missing values per column; a column without any value stays missing."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return impute(df, exact_medians(df, cols))


def scales(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population deviation over the present values, all columns in one pass."""
    row = df.agg(*[f(c).alias(f"{c}|{n}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"{c}|m"], row[f"{c}|s"]) for c in cols}


def standardise(df: DataFrame, cols: Sequence[str], fitted: Mapping[str, tuple] | None = None) -> DataFrame:
    """Centre and scale; a missing value becomes 0, the mean. The bias column is left alone.

    A constant column has no scale and becomes 0 as well.
    """
    cols = [c for c in cols if c != BIAS]
    fitted = fitted or scales(df, cols)
    made = {}
    for c in cols:
        mean, std = fitted[c]
        made[c] = F.coalesce((F.col(c) - F.lit(mean)) / F.lit(std), F.lit(0.0)) if std else F.lit(0.0)
    return df.withColumns(made)


def segment(key: str, last: int = 2):
    """Segment 0, 1 or ``last`` and above."""
    return F.least(F.col(key).cast("int"), F.lit(last))
