"""Settings of the engine. No secrets live here: MAC keys are arguments of the jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

VISA = "VISA"
MASTERCARD = "MASTERCARD"
MPESA = "MPESA"
FLUTTERWAVE = "FLUTTERWAVE"
PESAPAL = "PESAPAL"
PROVIDERS = (VISA, MASTERCARD, MPESA, FLUTTERWAVE, PESAPAL)

MICROS = 1_000_000
MINUTE_US = 60 * MICROS
HOUR_US = 3_600 * MICROS
DAY_US = 86_400 * MICROS


def _topics(suffix: str) -> Mapping[str, str]:
    return MappingProxyType({p: f"{p.lower()}_{suffix}" for p in PROVIDERS})


@dataclass(frozen=True)
class WindowSpec:
    """One tumbling window: its width and the output column of each measure."""

    width_us: int
    count: str | None = None
    total: str | None = None
    mean: str | None = None
    largest: str | None = None


CARD_WINDOWS = (
    WindowSpec(MINUTE_US, count="card_txn_count_1min", total="card_txn_sum_1min"),
    WindowSpec(5 * MINUTE_US, count="card_txn_count_5min", total="card_amount_sum_5min"),
    WindowSpec(
        HOUR_US,
        count="card_txn_count_1hr",
        total="card_amount_sum_1hr",
        mean="card_amount_avg_1hr",
        largest="card_amount_max_1hr",
    ),
)
MERCHANT_WINDOWS = (
    WindowSpec(HOUR_US, count="merchant_txn_count_1hr", total="merchant_amount_sum_1hr"),
)

# Points per risk flag.
SCORE_POINTS = MappingProxyType(
    {
        "is_high_risk_mcc": 20,
        "is_international": 15,
        "is_late_night": 10,
        "is_amount_spike": 20,
        "is_rapid_succession": 25,
        "is_card_not_present": 10,
        "is_cross_border_currency": 10,
        "is_high_velocity": 15,
        "prepaid_at_high_risk_mcc": 20,
        "is_micro_transaction": 15,
    }
)


@dataclass(frozen=True)
class EngineConfig:
    raw_topics: Mapping[str, str] = field(default_factory=lambda: _topics("raw"))
    tokenised_topics: Mapping[str, str] = field(default_factory=lambda: _topics("tokenised"))
    enriched_topics: Mapping[str, str] = field(default_factory=lambda: _topics("enriched"))
    dead_letter_topics: Mapping[str, str] = field(default_factory=lambda: _topics("dlq"))
    enrichment_dlq_topic: str = "enrichment_dlq"

    # Read and trigger settings of the streams.
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 50_000
    min_partitions: int = 20
    trigger_interval: str = "1 second"
    watermark_delay: str = "60 seconds"

    # Velocity windows and their thresholds.
    card_windows: tuple[WindowSpec, ...] = CARD_WINDOWS
    merchant_windows: tuple[WindowSpec, ...] = MERCHANT_WINDOWS
    velocity_amount: str = "amount"
    rapid_succession_over: int = 3
    high_velocity_over: int = 10
    high_volume_merchant_over: int = 100

    # Feature thresholds.
    high_value_usd: float = 2000.0
    high_value_atm_usd: float = 500.0
    micro_amount: float = 1.0
    spike_ratio: float = 3.0
    round_step: int = 1000
    month_end_from_day: int = 28
    score_cap: int = 100
    high_risk_score_over: int = 50
    score_points: Mapping[str, int] = field(default_factory=lambda: SCORE_POINTS)

    device_ttl_us: int = 90 * DAY_US
    latency_buckets: tuple[float, ...] = (0.05, 0.1, 0.2, 0.5, 1.0, 2.0)
    enrichment_version: str = "1.0"

    # Placement of heavy groups in joins back onto the transactions (see operators/skew.py).
    hot_groups_max: int = 100_000
    hot_group_min_rows: int = 50_000
