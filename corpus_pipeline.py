"""A training-corpus pipeline over ``documents``; every stage calls one operator of fraudspark.llm.

Each stage gets what its predecessor kept, as a table in the shared folder. All but the last return
the columns of ``documents``. The stages that drop rows decide by row: their operators get a key of
id and text in place of the id, so rows without id, and rows that share one, are judged by their own text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.llm import decontaminate, jaccard_join, language_id, line_dedup, sentencepiece_bpe, shared

#: A document is rejected without a letter, or if the best language has less probability than this.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the learned languages."""
    found = language_id.predicted(spark, language_id.fitted(docs), F.col("text"))
    kept = docs.select(*docs.columns, found.alias("__found")).where(
        (F.col("__found.lang_pred") != language_id.UNKNOWN) & (F.col("__found.score") >= LEAST_SCORE)
    )
    return kept.select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reduce every text to its first occurrences of lines; all documents stay."""
    reduced = line_dedup.remove_repeated_lines(docs)
    return reduced.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their key, and what an operator gets of them: the key as id, and the text."""
    rows = docs.withColumn("__row", shared.row_key())
    return rows, rows.select(F.col("__row").alias("doc_id"), "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of linked documents: of the smallest id, and with an id if any has one.

    Repeated rows, in id and text, are one row, also where a text without words links nothing.
    """
    rows, judged = _keyed(docs)
    groups = jaccard_join.jaccard_join(judged, n=5, percent=80).groupBy(F.col("doc_id").alias("__row"))
    ids = rows.groupBy("__row").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    known = shared.stored(ids.join(groups.agg(F.min("component_id").alias("component")), "__row"), "near-copies")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "__row")
    first = known.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.__row").alias("__row"))
    dropped = shared.settled(known.join(first, "__row", "left_anti").select("__row", "copies"))
    kept, _ = shared.parted(rows, dropped, "__row", "copies")
    repeated = shared.settled(known.where("copies > 1").join(first, "__row", "left_semi").select("__row", "copies"))
    if repeated.isEmpty():
        return kept.select(docs.columns)
    single, several = shared.parted(kept, repeated, "__row", "copies")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = several.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest")).select("doc_id", "text", "rest.*")
    return single.select(docs.columns).unionByName(once)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    rows, judged = _keyed(docs)
    found = decontaminate.decontaminate(judged, shared.table(spark, sf_dir, "benchmark")).where("contaminated")
    dropped = shared.settled(found.groupBy(F.col("doc_id").alias("__row")).agg(F.count(F.lit(1)).alias("copies")))
    kept, _ = shared.parted(rows, dropped, "__row", "copies")
    return kept.select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the text decoded from them."""
    return sentencepiece_bpe.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("sentencepiece", tokenize),
]

#: Learned languages and token ids can't be had from SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
