"""Published records, dead letters and metrics, and the micro-batch writer that ties them."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.config import EngineConfig
from fraudspark.operators.parse import per_provider
from fraudspark.operators.reports import latency_quantiles, provider_metrics, tokeniser_counters

Writer = Callable[[DataFrame], None]

# Producer settings of the published topics.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "snappy",
}


def _topic(topics: Mapping[str, str]):
    return per_provider({p: F.lit(t) for p, t in topics.items()}).alias("topic")


def tokenised_records(tokenised: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    """``key, value, topic`` of good events; the topic column serves every provider in one write."""
    events = [
        c
        for c in tokenised.columns
        if c not in ("message_key", "error_reason", "raw", "topic", "partition", "offset", "record_time")
    ]
    return tokenised.where(F.col("error_reason").isNull()).select(
        F.col("message_key").alias("key"),
        F.to_json(F.struct(*[c for c in events if c != "provider"])).alias("value"),
        _topic(topics),
    )


def tokeniser_dead_letters(routed: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    """Rejected messages with their place in the source."""
    record = F.struct(
        F.col("raw").alias("original_message"),
        "error_reason",
        F.current_timestamp().alias("failed_at"),
        "topic",
        "partition",
        "offset",
        F.concat(F.coalesce(F.lower("provider"), F.lit("unknown")), F.lit("-tokeniser")).alias("service"),
    )
    # A record of an unknown topic goes next to the topic that it came from.
    to = F.coalesce(_topic(topics), F.concat("topic", F.lit("_dlq"))).alias("topic")
    return routed.where(F.col("error_reason").isNotNull()).select(
        F.lit(None).cast("string").alias("key"), F.to_json(record).alias("value"), to
    )


def enriched_records(enriched: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    return enriched.select(
        F.col("card_token").alias("key"),
        F.to_json(F.struct(*enriched.columns)).alias("value"),
        _topic(topics),
    )


def enrichment_dead_letters(failed: DataFrame, topic: str, reason: str = "ENRICHMENT_FAILURE") -> DataFrame:
    """Transactions that could not be enriched; a row's own ``error_reason`` wins over ``reason``.

    Of late transactions the record also says by how much they were late.
    """
    why = F.coalesce("error_reason", F.lit(reason)) if "error_reason" in failed.columns else F.lit(reason)
    record = F.struct(
        "transaction_id",
        "provider",
        why.alias("error_reason"),
        F.current_timestamp().alias("failed_at"),
        F.col("event_timestamp").cast("string").alias("event_timestamp"),
        *[c for c in ("late_by_us",) if c in failed.columns],
    )
    return failed.select(
        F.lit(None).cast("string").alias("key"), F.to_json(record).alias("value"), F.lit(topic).alias("topic")
    )


def append_to(fmt: str, options: Mapping[str, str] | None = None, path: str | None = None) -> Writer:
    """A writer that appends to any batch sink. Kafka needs Spark's Kafka package."""
    settings = (PRODUCER_OPTIONS if fmt == "kafka" else {}) | dict(options or {})

    def write(df: DataFrame) -> None:
        df.write.format(fmt).options(**settings).mode("append").save(path)

    return write


def batch_table(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A writer whose rows of one batch replace what an earlier try of that batch wrote."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def batch_metrics(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Records, high-risk records and latency quantiles per provider of one batch."""
    counted = provider_metrics(df, config)
    if {"event_timestamp", "pipeline_enrichment_ts"} <= set(df.columns):
        counted = counted.join(latency_quantiles(df), "provider", "left")
    return counted.withColumn("written_at", F.current_timestamp())


def write_metrics(path: str, config: EngineConfig = EngineConfig()) -> Callable[[DataFrame, int], None]:
    """Records, high-risk records and latency quantiles per provider, one set of rows per batch."""
    table = batch_table(path)

    def write(df: DataFrame, batch_id: int) -> None:
        table(batch_metrics(df, config).coalesce(1), batch_id)

    return write


def write_tokeniser_metrics(path: str) -> Callable[[DataFrame, int], None]:
    """Consumed, tokenised and rejected messages and tokens of each kind per provider and batch."""
    table = batch_table(path)

    def write(df: DataFrame, batch_id: int) -> None:
        table(tokeniser_counters(df).withColumn("written_at", F.current_timestamp()).coalesce(1), batch_id)

    return write


def in_micro_batches(*steps: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: keep the batch while several steps read it.

    A failing step raises, so the batch is not committed and is replayed from the checkpoint.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if len(steps) > 1 else batch
        try:
            for step in steps:
                step(kept, batch_id)
        finally:
            if len(steps) > 1:
                kept.unpersist()

    return run


def start(df: DataFrame, function, checkpoint: str, every: str | None = None, name: str | None = None):
    """Start an append query. Without ``every`` it handles what is available and stops."""
    writer = df.writeStream.foreachBatch(function).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
