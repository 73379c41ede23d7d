"""Exact deduplication against a persistent index of text digests.

The index is two tables in the warehouse, bucketed and sorted by digest alike. The first has one row
per digest: the largest document id and the number of rows of the batch that brought it. A batch is
digested (A-Z lower-cased only, null as empty), grouped, and split by a sort-merge anti-join with
that table, which is read in bucket order without a shuffle: new digests are appended to it, known
ones are duplicates and go to the table of updates, because a later row may have the larger id.
``append`` reports which is which. ``resolve`` joins each digest with the sum of its updates, again
without a shuffle. The number of buckets follows the number of rows expected and stays with the tables.

Hot texts: groups are pre-aggregated before the shuffle. Rows get their group back by a sort-merge
join, but the few very large groups are broadcast instead (``shared.attach``), so no task gets all
copies of one text.

Defined cases: a null text equals an empty one; rows that share the largest id of their text are
all kept; a row without id is a copy of any that has one; of a group without any id one row is kept,
and its ``keep_id`` is null.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.llm import shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text with A-Z in lower case."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER).cast("binary"), 256)


def digested(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(F.col("text")).alias("text_sha256"))


#: Digests per bucket, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1_000_000, 16
_COLUMNS = "text_sha256 string, keep_id bigint, n_rows bigint"


class DigestIndex:
    """An index in the warehouse; ``name`` finds it again in later sessions with the same catalog."""

    def __init__(self, spark: SparkSession, name: str, expected_rows: int = BUCKET_ROWS):
        self.spark, self.name, self.updates = spark, name, f"{name}_updates"
        self.buckets = max(LEAST_BUCKETS, math.ceil(expected_rows / BUCKET_ROWS))
        nothing = spark.createDataFrame([], _COLUMNS)
        if spark.catalog.tableExists(name):
            told = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
            self.buckets = int(told["data_type"])
        else:
            self._write(nothing, name)
        if not spark.catalog.tableExists(self.updates):
            self._write(nothing, self.updates)

    def _write(self, rows: DataFrame, name: str) -> None:
        # One task per bucket, hashed as the table does, so that a batch adds one file to a bucket.
        bucket = F.pmod(F.hash("text_sha256"), F.lit(self.buckets))
        (
            rows.select("text_sha256", "keep_id", "n_rows")
            .repartition(bucket)
            .write.bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .mode("append")
            .format("parquet")
            .saveAsTable(name)
        )

    def append(self, digests: DataFrame) -> DataFrame:
        """Add a batch of ``digested`` documents; ``text_sha256, keep_id, n_rows, known`` of the batch."""
        batch = shared.stored(
            digests.groupBy("text_sha256").agg(
                F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n_rows")
            ),
            "batch",
        )
        index = self.spark.table(self.name).select("text_sha256").hint("merge")
        new = batch.join(index, "text_sha256", "left_anti").withColumn("known", F.lit(False))
        known = batch.join(index, "text_sha256", "left_semi").withColumn("known", F.lit(True))
        # Both are settled before the table that they read grows.
        arrived = shared.stored(new.unionAll(known), "arrived")
        self._write(arrived.where("NOT known"), self.name)
        self._write(arrived.where("known"), self.updates)
        return arrived

    def resolve(self) -> DataFrame:
        """One row per digest: the largest id and the number of rows of all batches."""
        later = (
            self.spark.table(self.updates)
            .groupBy("text_sha256")
            .agg(F.max("keep_id").alias("later_id"), F.sum("n_rows").alias("later_rows"))
        )
        return (
            self.spark.table(self.name)
            .join(later.hint("merge"), "text_sha256", "left")
            .select(
                "text_sha256",
                F.greatest("keep_id", "later_id").alias("keep_id"),
                (F.col("n_rows") + F.coalesce("later_rows", F.lit(0))).alias("group_size"),
            )
        )


def mark(digests: DataFrame, index: DigestIndex) -> DataFrame:
    """Every digested row with its group: the id that stays, the size, and whether it stays.

    ``digests`` is stored and has a number of its own in every row (``row``).
    """
    joined = shared.attach(digests, index.resolve(), "text_sha256", "group_size")
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False))
    columns = ["doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"]
    nameless = shared.settled(
        digests.groupBy("text_sha256")
        .agg(F.max("doc_id").alias("any"), F.max("row").alias("last"), F.count(F.lit(1)).alias("size"))
        .where("any IS NULL")
        .select("text_sha256", "last", "size")
    )
    if nameless.isEmpty():
        return joined.select(columns)
    known = joined.where("keep_id IS NOT NULL").select(columns)
    # Of a group without ids the row of the largest number stays.
    rest = shared.attach(joined.where("keep_id IS NULL"), nameless, "text_sha256", "size")
    return known.unionAll(rest.select(*columns[:3], F.col("row").eqNullSafe(F.col("last")).alias("kept"), "text_sha256"))


def deduplicate(docs: DataFrame, batches: int = 2) -> DataFrame:
    """Feed the documents, in batches as they might arrive, to a fresh index and mark every row."""
    spark = docs.sparkSession
    digests = shared.stored(digested(docs).withColumn("row", F.monotonically_increasing_id()), "digests")
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", digests.count())
    for k in range(batches):
        index.append(digests.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
    return mark(digests, index)


SQL = f"""
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL AND n = 1) AS kept, text_sha256
FROM (SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER w AS n, h AS text_sha256
      FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h FROM documents)
      WINDOW w AS (PARTITION BY h))"""
