"""One query per operator over the given tables, with production parameters, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from fraudspark.llm import (
    decontaminate,
    digest_index,
    hash_tree,
    jaccard_join,
    language_id,
    line_dedup,
    quality,
    repeated_phrases,
    sentencepiece_bpe,
    spelling,
    toxicity,
    warc,
    whitening,
)
from fraudspark.llm.shared import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digest(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), n=5, percent=80)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_phrases.digest(repeated_phrases.remove_repeats(table(spark, sf_dir, "documents"), window=13))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.deduplicate(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_rows(table(spark, sf_dir, "documents"), shards=40)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.archive(table(spark, sf_dir, "pages"), least_bytes=0))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_line_dedup": op9_line_dedup,
    "op10_sharding": op10_sharding,
    "op11_warc": op11_warc,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op6_exact_dedup": digest_index.SQL,
    "op9_line_dedup": line_dedup.SQL,
    "op10_sharding": hash_tree.sql(40),
    "op11_warc": warc.SQL,
    "op12_spelling_variants": spelling.SQL,
}
