"""The two working tables, derived by Spark from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import MISSING

FEATURES = ["f0", "f1", "f2", "f3", "f4", "f5"]
SEGMENT = "f2"


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit ratings 1..5 from the event stream: the latest value of each (user, item)."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    item = F.get_json_object("props", "$.k").cast("bigint")
    cells = (ev.groupBy(F.col("user_id").cast("bigint").alias("user"), item.alias("item"))
             .agg(F.max_by("value", "event_id").alias("v")))
    v = F.col("v")
    level = F.when(v < 11, 1.0).when(v < 26, 2.0).when(v < 46, 3.0).when(v < 80, 4.0).otherwise(5.0)
    return cells.select("user", "item", level.alias("rating"))


def upstream(spark: SparkSession, sf: str) -> DataFrame:
    return ratings(spark, sf).select(
        F.concat(F.lit("r"), F.col("user") + 1, F.lit("_c"), F.col("item") + 1).alias("Id"),
        F.col("rating").cast("int").alias("Prediction"))


def features(spark: SparkSession, sf: str) -> DataFrame:
    """One labelled row per order; orders without returned lines lack the returned-line statistics."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice")
    returned = F.col("l_returnflag") == "R"

    def only(c: str):
        return F.when(returned, F.col(c))

    # aggregated before the join, so the join is one row per order on both sides
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"),
        F.count_if(returned).alias("nr"), F.sum(only("l_quantity")).alias("qr"),
        F.avg(only("l_discount")).alias("dr"),
        (F.max(only("l_quantity")) - F.min(only("l_quantity"))).alias("sp"))
    a = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    nr = F.coalesce("nr", F.lit(0))
    gone = F.lit(MISSING)
    return a.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.coalesce("q", F.lit(0.0)) > 100, "s").otherwise("b").alias("label"),
        (F.col("o_totalprice") / 100000).alias("f0"),
        F.coalesce(F.col("p") / 100000, gone).alias("f1"),
        F.least(nr, F.lit(2)).cast("double").alias("f2"),
        F.coalesce("qr", gone).alias("f3"),
        F.coalesce("dr", gone).alias("f4"),
        F.when(nr >= 2, F.col("sp")).otherwise(gone).alias("f5"))
