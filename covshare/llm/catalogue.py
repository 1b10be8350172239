"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from covshare.llm import (
    configurations,
    exact_dedup,
    lexical,
    licences,
    minhash,
    packing,
    pieces,
    ppm,
    quality,
    repeats,
    spelling,
    toxicity,
    urls,
)
from covshare.llm.workers import importable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge_quality(docs, quality.fit_quality(docs, _table(spark, sf_dir, "labels")))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def word_tokenizer() -> str:
    """Path of the tokenizer file that packing counts with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), word_tokenizer(), keep=True)


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(_table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def piece_model() -> str:
    """Path of the model file that op7 encodes with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(_table(spark, sf_dir, "documents"), piece_model())


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.judge_repeats(_table(spark, sf_dir, "documents"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(_table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configurations.pack_few(_table(spark, sf_dir, "documents"), word_tokenizer())


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_packing": op2_packing,
        "op3_url_filters": op3_url_filters,
        "op4_ppm": op4_ppm,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_minhash": op8_minhash,
        "op9_repeats": op9_repeats,
        "op10_licences": op10_licences,
        "op11_lexical": op11_lexical,
        "op12_best_fit": op12_best_fit,
        "op13_spelling": op13_spelling,
    }
