"""The corpus pipeline: from ``documents`` to token ids, in stages that are each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of ``documents``.
Documents without an id or a text pass through: a null text is neither toxic nor contaminated, and has no ids. In an
empty table every stage gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bpe, simhash, suffixes, templates, toxicity
from tessella.session import scratch_path

ORACLE_SQL = None  # scores, fingerprints and merges have no SQL form; tests compare with brute force


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.where("predicted = 0").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of templates of an earlier document; ``n_chars`` counts what is left."""
    short = templates.drop_recurring_lines(docs, least_docs=templates.RECURS)
    if "n_chars" in docs.columns:
        short = short.withColumn("n_chars", F.char_length("text").cast("long"))
    return short.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest id."""
    return simhash.keep_one(docs, width=3, radius=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return suffixes.match_documents(docs, items).where("not contaminated").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids as a digest, with their number, and the digest of the text they decode to."""
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxic),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("bpe encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
