"""The registered queries: a Spark function each, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def r6(c: Column) -> Column:
    return F.round(c, 6)


def r9(c: Column) -> Column:
    return F.round(c, 9)


def load() -> None:
    for area in ("scan", "scalar", "aggregate", "split", "linear", "means", "factor", "neighbour", "blend"):
        import_module(f"{__name__}.{area}")
