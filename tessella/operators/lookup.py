"""Joining a long table to one row per key, whatever the keys' frequencies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_LIMIT_BYTES, cut_lineage

TASK_ROWS = 1_000_000  # rows of a key that one task takes; a key of more is dealt to several


def lookup(long: DataFrame, table: DataFrame, on: str, *, rows: int, row_bytes: int = 32, how: str = "left",
           limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join ``table`` (``rows`` rows, one per ``on``) to ``long``.

    A table within ``limit`` bytes is broadcast. A larger one is shuffled: the keys of ``long`` are counted, one of more
    than ``TASK_ROWS`` rows is dealt to as many shares as it needs, and only the rows of those keys are repeated, so no
    task gets more than about ``TASK_ROWS`` rows of a key. Counted is the table that is joined, whatever the key's place
    elsewhere. Rows with a NULL key meet nothing and are dealt like a hot key of their own.
    """
    if rows * row_bytes <= limit:
        return long.join(F.broadcast(table), on, how)
    hot = cut_lineage(long.groupBy(on).count().where(F.col("count") > TASK_ROWS)
                      .select(on, F.ceil(F.col("count") / TASK_ROWS).cast("int").alias("_shares")))
    n = hot.count()
    if n == 0:
        return long.join(table, on, how)
    if n * 32 <= limit:
        hot = F.broadcast(hot)
    shares = F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)
    wide = table.join(hot, on, "left").withColumn("_share", F.explode(shares)).drop("_shares")
    met = hot.withColumnRenamed(on, "_met")
    deal = F.pmod(F.xxhash64(*long.columns), F.coalesce(F.col("_shares"), F.lit(1))).cast("int")
    dealt = long.join(met, F.col(on).eqNullSafe(F.col("_met")), "left").withColumn("_share", deal).drop("_shares", "_met")
    return dealt.join(wide, [on, "_share"], how).drop("_share")


@dataclass
class Held:
    """A kept table of one row per entity and its row count, which decides how it may be joined."""

    df: DataFrame
    rows: int

    @staticmethod
    def of(df: DataFrame) -> Held:
        df = cut_lineage(df)
        return Held(df, df.count())

    def join_to(self, long: DataFrame, on: str, how: str = "left", row_bytes: int = 64) -> DataFrame:
        return lookup(long, self.df.withColumnRenamed("n", f"n_{on}"), on, rows=self.rows, row_bytes=row_bytes, how=how)
