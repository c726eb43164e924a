"""Small helpers on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def carried(df: DataFrame, *made: str) -> list[str]:
    """The columns that an operator hands on: all but reserved names and those that it makes itself."""
    return [c for c in df.columns if not c.startswith("__") and c.lower() not in {m.lower() for m in made}]


def fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def bounded_sample(df: DataFrame, rows: int, *by: Column) -> DataFrame:
    """The first ``rows`` rows by a hash of ``by``, a statistical sample of fixed size.

    Rows are thinned by their hash to a few times ``rows`` first, so that tasks don't each send as many to the driver.
    """
    n = df.count()
    hashed = F.xxhash64(*by)
    thin = df.where(F.pmod(hashed, F.lit(max(1, n // (4 * rows)))) == 0)
    return thin.orderBy(hashed, *by).limit(rows)
