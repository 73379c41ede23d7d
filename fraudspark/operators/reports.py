"""Counters and reports. All are grouped aggregates over a handful of groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.config import EngineConfig
from fraudspark.functions.text import is_filled, luhn_valid


def records_per_provider(df: DataFrame) -> DataFrame:
    return df.groupBy("provider").agg(F.count(F.lit(1)).alias("records"))


def _high_risk(config: EngineConfig) -> Column:
    return F.coalesce("composite_risk_score", F.lit(0)) > config.high_risk_score_over


def high_risk_per_provider(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    return df.where(_high_risk(config)).groupBy("provider").agg(F.count(F.lit(1)).alias("high_risk"))


def provider_metrics(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Records and high-risk records per provider in one pass."""
    return df.groupBy("provider").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(_high_risk(config)).alias("high_risk")
    )


def batch_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("batch_size"))


def latency_seconds(start: str = "event_timestamp", end: str = "pipeline_enrichment_ts") -> Column:
    return (F.unix_micros(F.col(end)) - F.unix_micros(F.col(start))) / 1e6


def latency_histogram(
    df: DataFrame, seconds: Column | None = None, config: EngineConfig = EngineConfig()
) -> DataFrame:
    """Rows per provider and latency bucket; ``le`` is the upper bound, null above the last one."""
    value = latency_seconds() if seconds is None else seconds
    bounds = config.latency_buckets
    bucket = reduce(lambda chain, b: chain.when(value <= b, F.lit(b)), bounds[1:], F.when(value <= bounds[0], F.lit(bounds[0])))
    return df.groupBy("provider", bucket.alias("le")).agg(F.count(F.lit(1)).alias("records"))


def latency_quantiles(
    df: DataFrame, seconds: Column | None = None, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)
) -> DataFrame:
    value = latency_seconds() if seconds is None else seconds
    return df.groupBy("provider").agg(
        F.percentile_approx(value, list(quantiles), 10_000).alias("latency_quantiles")
    )


# Token columns counted per kind.
TOKEN_KINDS = (
    "card_token",
    "msisdn_token",
    "account_token",
    "customer_token",
    "ref_token",
    "customer_email_token",
    "customer_phone_token",
    "payment_account_token",
    "merchant_reference_token",
)


def tokeniser_counters(routed: DataFrame) -> DataFrame:
    """Per provider: consumed, tokenised, dead letters and tokens of each kind."""
    good = F.col("error_reason").isNull()
    return routed.groupBy("provider").agg(
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(good).alias("tokenised"),
        F.count_if(~good).alias("dead_letters"),
        *[F.count_if(good & is_filled(F.col(t))).alias(f"{t}s") for t in TOKEN_KINDS],
    )


def dead_letters_per_reason(routed: DataFrame) -> DataFrame:
    return (
        routed.where(F.col("error_reason").isNotNull())
        .groupBy("provider", "error_reason")
        .agg(F.count(F.lit(1)).alias("dead_letters"))
    )


def running_totals(per_batch: DataFrame, counters: list[str], by: str = "provider") -> DataFrame:
    """Totals of a metrics table that gets one set of rows per batch.

    A replayed batch writes its rows again; the last write of a batch counts.
    """
    once = per_batch.groupBy("batch_id", by).agg(
        *[F.max_by(c, "written_at").alias(c) for c in counters]
    )
    return once.groupBy(by).agg(*[F.sum(c).alias(c) for c in counters])


def _is_fraud() -> Column:
    return F.coalesce("is_fraud", F.lit(False))


def fraud_per_source(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_is_fraud()).alias("fraud"),
        F.round(F.avg(F.when(_is_fraud(), 100.0).otherwise(0.0)), 1).alias("fraud_pct"),
    )


def fraud_patterns(df: DataFrame) -> DataFrame:
    return (
        df.where(_is_fraud())
        .groupBy(F.coalesce("fraud_pattern", F.lit("UNKNOWN")).alias("fraud_pattern"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "fraud_pattern")
    )


def fraud_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~_is_fraud()).alias("normal"),
        F.count_if(_is_fraud()).alias("fraud"),
        F.round(F.avg(_is_fraud().cast("double")), 4).alias("fraud_rate"),
    )


def invalid_card_numbers(df: DataFrame, pan: str = "pan") -> DataFrame:
    return df.where(F.col(pan).isNotNull()).agg(
        F.count_if(~luhn_valid(F.col(pan))).alias("invalid_pans")
    )


def sample_per_source(df: DataFrame, source: str = "source", order: str = "transaction_id") -> DataFrame:
    """The first row of each source by ``order``; a grouped minimum, combined before the shuffle."""
    others = [c for c in df.columns if c != source]
    first = F.min_by(F.struct(*others), F.col(order)).alias("_first")
    return df.groupBy(source).agg(first).select(source, "_first.*")
