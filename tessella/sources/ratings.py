"""Rating tables: upstream ``r{user}_c{item},rating`` text and normalised ``user,item,rating`` triplets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRIPLET = "user BIGINT, item BIGINT, rating DOUBLE"
UPSTREAM = "Id STRING, Prediction DOUBLE"
_ID = r"^r(\d+)_c(\d+)$"


def read_upstream(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=UPSTREAM)


def normalise(upstream: DataFrame, row: str = "user", col: str = "item") -> DataFrame:
    """``r44_c1`` becomes (43, 0); give ``row='item', col='user'`` for item-major files."""
    def part(g: int) -> Column:
        return F.regexp_extract("Id", _ID, g).cast("bigint") - 1

    named = upstream.select(part(1).alias(row), part(2).alias(col),
                            F.col("Prediction").cast("double").alias("rating"))
    return named.select("user", "item", "rating")


def denormalise(triplets: DataFrame, rating: str = "rating") -> DataFrame:
    """Back to 1-based ids; the rating is truncated, so round before where that is wanted."""
    return triplets.select(
        F.format_string("r%d_c%d", F.col("user") + 1, F.col("item") + 1).alias("Id"),
        F.col(rating).cast("int").alias("Prediction"),
    )


def read_triplets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=TRIPLET)


def write_triplets(df: DataFrame, path: str) -> None:
    df.select("user", "item", "rating").write.csv(path, header=True)


def from_tuples(spark: SparkSession, rows: Iterable[tuple[int, int, float]]) -> DataFrame:
    return spark.createDataFrame(list(rows), TRIPLET)


def last_write(log: DataFrame, order: str) -> DataFrame:
    """One rating per (user, item), the latest by ``order``; a rating of 0 means no rating."""
    latest = log.groupBy("user", "item").agg(F.max_by("rating", order).alias("rating"))
    return latest.where(F.col("rating") != 0)


def id_ranges(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.min("user").alias("min_user"), F.max("user").alias("max_user"),
                       F.min("item").alias("min_item"), F.max("item").alias("max_item"))


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Long ``model, user, item, prediction`` table, one folder per model, so a blend reads only its members."""
    predictions.write.partitionBy("model").parquet(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("model", "user", "item", "prediction")


def read_prediction_files(spark: SparkSession, path: str) -> DataFrame:
    """A folder of triplet CSVs, one file (or one sub-folder of parts) per model, named after the model."""
    raw = spark.read.csv(path, header=True, schema="user BIGINT, item BIGINT, prediction DOUBLE",
                         recursiveFileLookup=True)
    # ``<model>.csv`` itself, or ``<model>.csv/part-...`` as Spark writes it
    name = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))),
                            r"([^/]+)\.csv(/part-[^/]*)?$", 1)
    return raw.select(name.alias("model"), "user", "item", "prediction")


def id_pairs(predictions: DataFrame) -> DataFrame:
    """The distinct (user, item) pairs that have a prediction."""
    return predictions.select("user", "item").distinct()
