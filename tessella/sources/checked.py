"""Scans of files that may be damaged: rows that don't parse are kept apart and counted, none is guessed at or lost."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .features import feature_names
from .ratings import UPSTREAM, normalise

RAW = "_raw"


@dataclass
class Checked:
    """``good`` rows under the schema, the ``bad`` ones as text (``_raw``), and their numbers."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True,
                 valid: Column | None = None, required: tuple[str, ...] = ()) -> Checked:
    """A CSV scan under a fixed schema. A row is bad if a field has the wrong type, if fields lack or are too many, if a
    ``required`` field is empty, or if ``valid`` isn't true of it. An empty field is a missing value.

    The rows are parsed once and cut off in the checkpoint folder, so that both parts and the counts are of one scan.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    parsed = spark.read.csv(path, header=header, schema=wide, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, enforceSchema=True)
    rule = F.col(RAW).isNull()
    for c in required:
        rule = rule & F.col(c).isNotNull()
    if valid is not None:
        rule = rule & F.coalesce(valid, F.lit(False))
    again = F.coalesce(F.col(RAW), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schema.names]))
    rows = cut_lineage(parsed.select(*schema.names, rule.alias("_good"), again.alias(RAW)))
    counts = rows.agg(F.count_if("_good"), F.count_if(~F.col("_good"))).first()
    return Checked(rows.where("_good").select(*schema.names), rows.where("not _good").select(RAW), *counts)


def read_labelled_checked(spark: SparkSession, path: str, n_features: int, header: bool = True) -> Checked:
    """Labelled features; a row needs an id and a label."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.StringType()),
                           *[T.StructField(f, T.DoubleType()) for f in feature_names(n_features)]])
    return read_checked(spark, path, schema, header=header, required=("id", "label"))


def read_ratings_checked(spark: SparkSession, path: str, header: bool = True, low: float = 1, high: float = 5) -> Checked:
    """Upstream ratings as triplets; an id needs the form ``r1_c1`` with numbers from 1, a rating lies in [low, high]."""
    fits = F.col("Id").rlike(r"^r0*[1-9]\d{0,17}_c0*[1-9]\d{0,17}$") & F.col("Prediction").between(low, high)
    found = read_checked(spark, path, UPSTREAM, header=header, valid=fits, required=("Id", "Prediction"))
    found.good = normalise(found.good)
    return found
