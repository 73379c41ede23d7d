"""The two jobs: tokenise raw messages, enrich tokenised events. For tables and for streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.config import EngineConfig
from fraudspark.functions import crypto
from fraudspark.operators import features, parse, reports, state, tokenise, validate, velocity
from fraudspark.operators.joins import join_reference
from fraudspark.operators.normalise import canonical_columns as normalised_columns
from fraudspark.operators.normalise import normalise, with_usability
from fraudspark.sources.refdata import ReferenceTables
from fraudspark.sources.wire import decode_tokenised, tag_provider
from fraudspark.streaming import sinks
from fraudspark.streaming.publication import Publication, publishing
from fraudspark.streaming.ring import ring_velocity
from fraudspark.streaming.state import stream_device_history
from fraudspark.streaming.velocity import stream_velocity


def tokenise_wire(
    wire: DataFrame,
    secrets: bytes | Mapping[str, bytes] | DataFrame,
    config: EngineConfig = EngineConfig(),
    check_gateway_email: bool = False,
    keep_names: bool = False,
) -> DataFrame:
    """Raw wire records to tokenised events and rejects, told apart by ``error_reason``.

    A chain of projections after one small broadcast join: no shuffle, batch or stream alike.
    """
    keys = secrets if isinstance(secrets, DataFrame) else crypto.key_table(wire.sparkSession, secrets)
    return (
        tag_provider(wire, config.raw_topics)
        .transform(crypto.with_keys, keys)
        .transform(parse.parse_messages)
        .transform(validate.validate_messages, check_gateway_email)
        .transform(tokenise.tokenise_messages, keep_names)
    )


def canonical(tokenised: DataFrame) -> DataFrame:
    """Canonical transactions with ``error_reason`` where a required column is missing."""
    return tokenised.transform(normalise).transform(with_usability)


def enrich_statelessly(
    df: DataFrame, refs: ReferenceTables, config: EngineConfig = EngineConfig(), fx_history: DataFrame | None = None
) -> DataFrame:
    """Reference joins: everything before velocity."""
    return join_reference(df, refs, fx_history)


def score(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Features, score, packed columns and metadata: everything after velocity."""
    return (
        df.transform(features.add_features, config)
        .transform(features.add_packed_columns, config)
        .transform(features.add_metadata, config)
    )


def enrich(
    transactions: DataFrame,
    refs: ReferenceTables,
    config: EngineConfig = EngineConfig(),
    device_history: bool = True,
    fx_history: DataFrame | None = None,
) -> DataFrame:
    """Enriched and scored transactions of a table of canonical transactions.

    With ``fx_history`` (``currency_alpha, fx_rate_to_usd, as_of``) amounts have the rate of their own time.
    """
    usable = transactions
    if "error_reason" in transactions.columns:
        usable = transactions.where(F.col("error_reason").isNull()).drop("error_reason")
    # The wide columns of the reference joins are added after the shuffles of velocity and history.
    moved = usable.transform(velocity.velocity, config)
    if device_history:
        moved = state.device_history(moved, config, source=usable)
    return moved.transform(enrich_statelessly, refs, config, fx_history).transform(score, config)


def start_tokeniser(
    wire: DataFrame,
    secrets,
    publish,
    dead_letters,
    checkpoint: str,
    config: EngineConfig = EngineConfig(),
    every: str | None = None,
    metrics=None,
):
    """Raw wire stream to tokenised records and dead letters, in one query.

    ``publish`` and ``dead_letters`` append a batch frame to a sink (``sinks.append_to``); ``metrics``
    gets the routed batch and its number (``sinks.write_tokeniser_metrics``).
    """
    routed = tokenise_wire(wire, secrets, config)
    steps = [
        lambda df, _: publish(sinks.tokenised_records(df, config.tokenised_topics)),
        lambda df, _: dead_letters(sinks.tokeniser_dead_letters(df, config.dead_letter_topics)),
    ]
    step = sinks.in_micro_batches(*steps, *([metrics] if metrics else []))
    return sinks.start(routed, step, checkpoint, every)


def _enrichment_stream(
    wire: DataFrame, config: EngineConfig, device_history: bool, immediate: bool, forget: bool
) -> DataFrame:
    """Canonical transactions with history and velocity; unusable and late rows have an ``error_reason``."""
    events = decode_tokenised(wire, config.tokenised_topics)
    rows = events.select(
        *normalised_columns(), F.col("error_reason").alias("_unreadable")
    ).transform(with_usability)
    rows = rows.withColumn("error_reason", F.coalesce("_unreadable", "error_reason")).drop("_unreadable")
    usable = rows.where(F.col("error_reason").isNull()).drop("error_reason")
    if device_history:
        # An always-on query may also let the store forget keys by processing time.
        usable = stream_device_history(usable, config, forget=forget)
    if immediate:
        moved = ring_velocity(usable, config).withColumnRenamed("late_reason", "error_reason")
    else:
        moved = stream_velocity(usable, config).drop("window")
    failed = rows.where(F.col("error_reason").isNotNull())
    return moved.unionByName(failed, allowMissingColumns=True)


def _enriched(batch: DataFrame, refs: ReferenceTables, config: EngineConfig) -> DataFrame:
    return (
        batch.where(F.col("error_reason").isNull())
        .drop("error_reason", "late_by_us")
        .transform(enrich_statelessly, refs, config)
        .transform(score, config)
    )


def start_enrichment(
    wire: DataFrame,
    refs: ReferenceTables,
    publish,
    dead_letters,
    metrics,
    checkpoint: str,
    config: EngineConfig = EngineConfig(),
    every: str | None = None,
    device_history: bool = True,
    immediate: bool = False,
):
    """Tokenised wire stream to enriched records, dead letters and metrics, in one query.

    Device history and velocity run in the stream; reference joins, features and score run per micro-batch, with
    exchange rates read again for each. Unusable rows skip velocity and go to the dead letters.

    With ``immediate`` a row leaves in its own micro-batch, with the velocity known so far, and late
    rows go to the dead letters; otherwise it waits for its hour, and late rows are dropped.
    """
    stream = _enrichment_stream(wire, config, device_history, immediate, forget=every is not None)

    def run(batch: DataFrame, batch_id: int) -> None:
        refs.refresh_fx()
        kept = batch.persist()
        try:
            done = _enriched(kept, refs, config).persist()
            try:
                publish(sinks.enriched_records(done, config.enriched_topics))
                metrics(done, batch_id)
            finally:
                done.unpersist()
            bad = kept.where(F.col("error_reason").isNotNull())
            dead_letters(sinks.enrichment_dead_letters(bad, config.enrichment_dlq_topic))
        finally:
            kept.unpersist()

    return sinks.start(stream, run, checkpoint, every)


def publish_tokenised(
    wire: DataFrame,
    secrets,
    publication: Publication,
    checkpoint: str,
    config: EngineConfig = EngineConfig(),
    every: str | None = None,
):
    """As ``start_tokeniser``; records, dead letters and metrics of a batch are published together, once."""

    def channels(batch: DataFrame):
        yield "records", sinks.tokenised_records(batch, config.tokenised_topics)
        yield "dead_letters", sinks.tokeniser_dead_letters(batch, config.dead_letter_topics)
        yield "metrics", reports.tokeniser_counters(batch).coalesce(1)

    return sinks.start(tokenise_wire(wire, secrets, config), publishing(publication, channels), checkpoint, every)


def publish_enriched(
    wire: DataFrame,
    refs: ReferenceTables,
    publication: Publication,
    checkpoint: str,
    config: EngineConfig = EngineConfig(),
    every: str | None = None,
    device_history: bool = True,
    immediate: bool = False,
):
    """As ``start_enrichment``; records, dead letters and metrics of a batch are published together, once."""
    stream = _enrichment_stream(wire, config, device_history, immediate, forget=every is not None)

    def channels(batch: DataFrame):
        refs.refresh_fx()
        done = _enriched(batch, refs, config).persist()
        try:
            yield "records", sinks.enriched_records(done, config.enriched_topics)
            yield "metrics", sinks.batch_metrics(done, config).coalesce(1)
        finally:
            done.unpersist()
        bad = batch.where(F.col("error_reason").isNotNull())
        yield "dead_letters", sinks.enrichment_dead_letters(bad, config.enrichment_dlq_topic)

    return sinks.start(stream, publishing(publication, channels), checkpoint, every)
