"""Counts and amounts per key and tumbling event-time window, on every row of the window.

Rows are first aggregated to the finest window (with map-side combine), the wider windows are
summed from those few rows (at most widest/finest per key and widest window), and one join per key
brings all windows back to the transactions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.config import MICROS, EngineConfig, WindowSpec
from fraudspark.operators import skew

_ROWS, _SUM, _VALUES, _MAX = "_rows", "_sum", "_values", "_max"


def window_start(us: Column, width_us: int) -> Column:
    """Start of the tumbling window, in microseconds; windows are aligned to the epoch."""
    return us - F.pmod(us, F.lit(width_us))


def base_width(windows: tuple[WindowSpec, ...]) -> int:
    return math.gcd(*[w.width_us for w in windows])


def base_groups(
    rows: DataFrame, key: str, us: str, amount: str, width_us: int
) -> DataFrame:
    """One row per key and finest window, for rows that have both."""
    return (
        rows.where(F.col(key).isNotNull() & F.col(us).isNotNull())
        .groupBy(key, window_start(F.col(us), width_us).alias("_start"))
        .agg(
            F.count(F.lit(1)).alias(_ROWS),
            F.sum(amount).alias(_SUM),
            F.count(amount).alias(_VALUES),
            F.max(amount).alias(_MAX),
        )
    )


def _measures(w: WindowSpec, over=None) -> dict[str, Column]:
    def agg(function, column):
        return F.col(column) if over is None else function(column).over(over)

    made = {}
    if w.count:
        made[w.count] = agg(F.sum, _ROWS)
    if w.total:
        made[w.total] = agg(F.sum, _SUM)
    if w.mean:
        values = agg(F.sum, _VALUES)
        made[w.mean] = F.when(values > 0, agg(F.sum, _SUM) / values)
    if w.largest:
        made[w.largest] = agg(F.max, _MAX)
    return made


def window_results(groups: DataFrame, key: str, windows: tuple[WindowSpec, ...], width_us: int) -> DataFrame:
    """All windows of a key next to each of its finest windows."""
    ordered = sorted(windows, key=lambda w: -w.width_us)
    out = groups
    enclosing: list[Column] = []
    for w in ordered:
        if w.width_us == width_us:
            out = out.withColumns(_measures(w))
            continue
        # Listing the enclosing windows as well changes nothing when windows nest, and lets all of
        # them share the exchange of the widest one.
        start = window_start(F.col("_start"), w.width_us)
        nests = all(o.width_us % w.width_us == 0 for o in ordered if o.width_us > w.width_us)
        parts = [*enclosing, start] if nests else [start]
        enclosing = parts
        out = out.withColumns(_measures(w, Window.partitionBy(key, *parts)))
    names = [n for w in windows for n in (w.count, w.total, w.mean, w.largest) if n]
    return out.select(key, "_start", _ROWS, *names)


def add_velocity(
    df: DataFrame,
    key: str,
    windows: tuple[WindowSpec, ...],
    amount: str = "amount",
    ts: str = "event_timestamp",
    row_id: str = "transaction_id",
    config: EngineConfig = EngineConfig(),
    source: DataFrame | None = None,
) -> DataFrame:
    """Add the measures of every window; rows without key or time count as one transaction.

    ``source`` holds the same transactions as ``df`` before other joins; it is what gets grouped, so
    that a second window set does not run the joins of the first one again.
    """
    width = base_width(windows)
    source = df if source is None else source
    us = F.unix_micros(F.col(ts))
    groups = window_results(
        base_groups(source.withColumn("_us", us), key, "_us", amount, width), key, windows, width
    )
    joined = skew.attach(
        df.withColumn("_start", window_start(us, width)),
        groups,
        [key, "_start"],
        size=_ROWS,
        spread_by=row_id,
        source=source,
        max_hot=config.hot_groups_max,
        min_rows=config.hot_group_min_rows,
    )
    return fill_counts(joined.drop("_start"), windows)


def fill_counts(df: DataFrame, windows: tuple[WindowSpec, ...]) -> DataFrame:
    """Counts that found no window become 1; sums, means and maxima stay null."""
    return df.fillna({w.count: 1 for w in windows if w.count})


def card_velocity(
    df: DataFrame, config: EngineConfig = EngineConfig(), source: DataFrame | None = None
) -> DataFrame:
    return add_velocity(
        df, "card_token", config.card_windows, config.velocity_amount, config=config, source=source
    )


def merchant_velocity(
    df: DataFrame, config: EngineConfig = EngineConfig(), source: DataFrame | None = None
) -> DataFrame:
    return add_velocity(
        df, "merchant_id", config.merchant_windows, config.velocity_amount, config=config, source=source
    )


def velocity(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    return df.transform(card_velocity, config, df).transform(merchant_velocity, config, df)


def trailing_count(
    df: DataFrame,
    key: str = "card_token",
    name: str = "card_txn_count_trailing",
    span_us: int = 60 * MICROS,
    bucket_us: int | None = None,
    ts: str = "event_timestamp",
    row_id: str = "transaction_id",
) -> DataFrame:
    """Rows of the same key in the closed interval [t - span, t], as of each row.

    A running sum over +1 at each row's time and -1 just after it leaves the interval. A key's time
    line is cut into buckets of bounded length, so that a busy key is spread over tasks; rows in the
    last ``span`` of a bucket are also counted in the next one.
    """
    width = bucket_us or 10 * span_us
    if width < span_us:
        raise ValueError("bucket_us must not be shorter than span_us")
    us = F.unix_micros(F.col(ts))
    start = window_start(us, width)
    nothing = F.lit(None).cast(df.schema)
    row = F.struct(*df.columns)

    def event(bucket: Column, at: Column, step: int, payload: Column) -> Column:
        return F.struct(
            bucket.alias("bucket"), at.alias("at"), F.lit(step).alias("step"), payload.alias("row")
        )

    leaves = us + span_us + 1
    spills_over = us - start >= width - span_us
    counted = F.array_compact(
        F.array(
            event(start, us, 1, row),
            event(start, leaves, -1, nothing),
            F.when(spills_over, event(start + width, us, 1, nothing)),
            F.when(spills_over, event(start + width, leaves, -1, nothing)),
        )
    )
    # Rows without key or time are counted as one and spread by their id.
    usable = F.col(key).isNotNull() & us.isNotNull()
    alone = F.array(event(F.xxhash64(row_id), F.lit(0).cast("long"), 1, row))
    events = df.select(
        F.when(usable, F.col(key)).alias("_key"),
        F.explode(F.when(usable, counted).otherwise(alone)).alias("_e"),
    ).select("_key", "_e.*")
    running = F.sum("step").over(
        Window.partitionBy("_key", "bucket")
        .orderBy("at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        events.withColumn(name, running)
        .where(F.col("row").isNotNull())
        .select("row.*", F.when(F.col("_key").isNull(), 1).otherwise(F.col(name)).alias(name))
    )
