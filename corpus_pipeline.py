"""The corpus pipeline: documents through the stages below, one after another.

Each stage gets what the one before wrote and read again, and all but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covshare.llm.catalogue import word_tokenizer
from covshare.llm.exact_dedup import drop_exact_duplicates
from covshare.llm.minhash import drop_near_duplicates
from covshare.llm.packing import pack
from covshare.llm.repeats import drop_repeats
from covshare.llm.toxicity import drop_toxic
from covshare.llm.workers import importable
from covshare.sources.scratch import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers does not reject.

    The chain is fitted on the labelled ones among `docs`. A null or empty text
    is never rejected, nor is a row with a null id; rows that share an id are judged
    one by one.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, null as empty) the one with the largest id,
    as often as it occurs; rows with a null id all stay."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar sets of five-word shingles (0.8 or more) the
    one with the smallest id; documents without words, or with a null id, all stay."""
    return drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages of 50 bytes and more that a document
    with a smaller id has too; n_chars is counted anew."""
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

# Classifiers and tokens of a public tokenizer are beyond SQL; the tests compare
# the stages and run() with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`, each written and read again.

    An empty table gives no rows. Null and empty texts and null ids go through all
    stages as each one's docstring says; rows that repeat an id are judged by their
    texts. Further columns of `documents`, whatever their names, reach the last stage.
    """
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
