"""Labelled feature tables: ``id, label, f0..fD`` in, ``Id, Prediction`` out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import MISSING


def feature_names(n: int) -> list[str]:
    return [f"f{i}" for i in range(n)]


def read_labelled_csv(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """Header CSV with id, label and ``n_features`` numbers; the schema is given, never inferred."""
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("label", T.StringType())]
        + [T.StructField(f, T.DoubleType()) for f in feature_names(n_features)]
    )
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=True)


def missing_to_null(df: DataFrame, cols: list[str], marker: float = MISSING) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(marker)) for c in cols})


def encode_label(label: str | Column = "label", logistic: bool = False) -> Column:
    """``b`` is the negative class (-1, or 0 for logistic models); anything else is +1."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c == "b", F.lit(0.0 if logistic else -1.0)).otherwise(F.lit(1.0))


def head_sample(df: DataFrame, n: int = 100, key: str = "id") -> DataFrame:
    """The first ``n`` rows by key (a distributed file has no row order of its own)."""
    return df.orderBy(key).limit(n)


def submission(df: DataFrame, key: str = "id", prediction: str = "prediction") -> DataFrame:
    """Integer classes in {-1, 1}; the logistic class 0 is written as -1."""
    p = F.col(prediction)
    return df.select(
        F.col(key).cast("bigint").alias("Id"),
        F.when(p == 0, F.lit(-1)).otherwise(p.cast("int")).alias("Prediction"),
    )


def write_submission(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)
