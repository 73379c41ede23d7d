"""Signals and features of one transaction: projections only, applied in a few wide selects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.config import EngineConfig

# Fixed values of the rules.
UNATTENDED_MODES = ("01", "10", "81")
CARD_NOT_PRESENT_MODES = ("01", "10", "00")
WEAK_AUTH_MODELS = ("NOAUTH", "VBV", "3DS")
CHIP_MODES = ("051", "071", "091")
ISSUER_COUNTRIES_AFRICA = ("KE", "UG", "TZ", "RW", "ZA", "NG", "GH")
EAST_AFRICA = ("KE", "UG", "TZ")
HARD_CURRENCIES = ("USD", "GBP", "EUR")
US_AND_GB = ("US", "GB")
AFRICAN_CURRENCIES = ("KES", "NGN", "ZAR")
ATM_MCC = "6011"
NIGHT_HOURS = (1, 4)
BUSINESS_HOURS = (8, 20)
WEEKEND_DAYS = (1, 7)

Features = dict[str, Column]


def _usd_or_amount() -> Column:
    return F.coalesce(F.col("amount_usd"), F.col("amount"))


def _at_night(hour: Column) -> Column:
    return hour.between(*NIGHT_HOURS)


def derived_signals(config: EngineConfig = EngineConfig()) -> Features:
    c, ts = F.col, F.col("event_timestamp")
    return {
        "is_high_value": _usd_or_amount() > config.high_value_usd,
        "is_cnp": c("pos_entry_mode").isin(*UNATTENDED_MODES)
        | F.coalesce(c("auth_model"), F.lit("")).isin(*WEAK_AUTH_MODELS)
        | (c("channel") == "WEB"),
        "is_unusual_hour": _at_night(F.hour(ts)),
        "is_weekend": F.dayofweek(ts).isin(*WEEKEND_DAYS),
        "is_cross_border": F.coalesce(c("currency"), F.lit("USD")) != "USD",
    }


def temporal_features(config: EngineConfig = EngineConfig()) -> Features:
    ts = F.col("event_timestamp")
    return {
        "txn_hour": F.hour(ts),
        "txn_day_of_week": F.dayofweek(ts),
        "txn_day_of_month": F.dayofmonth(ts),
        "txn_month": F.month(ts),
        "is_business_hours": F.hour(ts).between(*BUSINESS_HOURS),
        "is_late_night": _at_night(F.hour(ts)),
        "is_month_end": F.dayofmonth(ts) >= config.month_end_from_day,
        "event_unix_ts": F.unix_seconds(ts),
    }


def location_features(config: EngineConfig = EngineConfig()) -> Features:
    issuer, region, currency = F.col("bin_country"), F.col("currency_region"), F.col("currency")
    african_issuer, african_region = issuer.isin(*ISSUER_COUNTRIES_AFRICA), region == "AFRICA"
    pays_abroad = (issuer.isin(*EAST_AFRICA) & currency.isin(*HARD_CURRENCIES)) | (
        issuer.isin(*US_AND_GB) & currency.isin(*AFRICAN_CURRENCIES)
    )
    return {
        # One side African and the other not; false while either is unknown.
        "is_international": F.coalesce(african_issuer != african_region, F.lit(False)),
        "is_cross_border_currency": F.coalesce(pays_abroad, F.lit(False)),
    }


def behaviour_features(config: EngineConfig = EngineConfig()) -> Features:
    c = F.col
    mean = c("card_amount_avg_1hr")
    ratio = F.when(mean > 0, c("amount") / mean).otherwise(F.lit(1.0))
    return {
        "amount_vs_avg_ratio": ratio,
        "is_amount_spike": ratio > config.spike_ratio,
        "is_rapid_succession": F.coalesce(c("card_txn_count_1min"), F.lit(1))
        > config.rapid_succession_over,
        "is_high_velocity": F.coalesce(c("card_txn_count_1hr"), F.lit(1)) > config.high_velocity_over,
        "is_round_amount": (c("amount") % config.round_step == 0) & (c("amount") >= config.round_step),
        "is_micro_transaction": _usd_or_amount() < config.micro_amount,
    }


def network_features(config: EngineConfig = EngineConfig()) -> Features:
    c = F.col
    remote = (
        c("pos_entry_mode").isin(*CARD_NOT_PRESENT_MODES)
        | c("auth_model").isin(*WEAK_AUTH_MODELS)
        | c("channel").isin("WEB", "MOBILE_APP")
    )
    return {
        "is_card_not_present": F.coalesce(remote, F.lit(False)),
        "is_chip_transaction": c("pos_entry_mode").isin(*CHIP_MODES),
        "has_device_fingerprint": c("device_fingerprint").isNotNull(),
    }


def merchant_features(config: EngineConfig = EngineConfig()) -> Features:
    c, no = F.col, F.lit(False)
    return {
        "is_high_volume_merchant": F.coalesce(c("merchant_txn_count_1hr"), F.lit(1))
        > config.high_volume_merchant_over,
        "prepaid_at_high_risk_mcc": F.coalesce(c("bin_prepaid"), no)
        & F.coalesce(c("is_high_risk_mcc"), no),
        "is_high_value_atm": (c("mcc") == ATM_MCC) & (_usd_or_amount() > config.high_value_atm_usd),
    }


def risk_score(config: EngineConfig = EngineConfig()) -> Column:
    """Points of the raised flags, capped; a null flag counts as not raised."""
    points = [F.when(F.col(f), F.lit(p)).otherwise(F.lit(0)) for f, p in config.score_points.items()]
    return F.least(reduce(lambda a, b: a + b, points), F.lit(config.score_cap)).cast("int")


FEATURE_GROUPS = (
    derived_signals,
    location_features,
    temporal_features,
    behaviour_features,
    network_features,
    merchant_features,
)


def add_features(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """All features in one projection (none depends on another), then the score."""
    made: Features = {}
    for group in FEATURE_GROUPS:
        made |= group(config)
    return df.withColumns(made).withColumn("composite_risk_score", risk_score(config))


def add_metadata(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns(
        {
            "enrichment_timestamp": now,
            "enrichment_version": F.lit(config.enrichment_version),
            "pipeline_enrichment_ts": now,
        }
    )


# Contents of the packed columns of the output contract.
VELOCITY_FEATURES = (
    "card_txn_count_1min",
    "card_txn_count_5min",
    "card_txn_count_1hr",
    "merchant_txn_count_1hr",
)
AGGREGATE_FEATURES = (
    "card_txn_sum_1min",
    "card_amount_sum_5min",
    "card_amount_sum_1hr",
    "card_amount_avg_1hr",
    "card_amount_max_1hr",
    "merchant_amount_sum_1hr",
    "amount_vs_avg_ratio",
)
RISK_SIGNALS = (
    "is_high_value",
    "is_cnp",
    "is_unusual_hour",
    "is_weekend",
    "is_cross_border",
    "is_high_risk_mcc",
    "is_international",
    "is_late_night",
    "is_amount_spike",
    "is_rapid_succession",
    "is_card_not_present",
    "is_cross_border_currency",
    "is_high_velocity",
    "prepaid_at_high_risk_mcc",
    "is_micro_transaction",
    "is_round_amount",
    "is_high_volume_merchant",
    "is_high_value_atm",
)


def _packed(names: tuple[str, ...], dtype: str) -> Column:
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast(dtype))])


def add_packed_columns(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Feature maps of the output contract, and the scored flags that are raised."""
    raised = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in config.score_points]))
    return df.withColumns(
        {
            "velocity_features": _packed(VELOCITY_FEATURES, "bigint"),
            "aggregate_features": _packed(AGGREGATE_FEATURES, "double"),
            "risk_signals": _packed(RISK_SIGNALS, "boolean"),
            "rule_triggers": raised,
        }
    )
