"""First-sight history over tables: has this key been seen before, with an expiry.

A key is set at its first sight and stays set for a fixed time that later sights do not renew; the
first row at or after expiry sets it again. The rows that set the key ("starts") form a chain per
key. Every row is linked once to the first row at or after its expiry, by a sorted merge of times and
expiries in buckets of time; the links are then doubled, so a chain of n rows is found by about log2(n)
joins, whatever the expiry. No key is ever folded row by row, and a busy key is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.config import EngineConfig
from fraudspark.functions.text import blank_to_null
from fraudspark.operators import skew
from fraudspark.plans.storage import settle

_US, _ID, _ROWS = "_us", "_id", "_rows"


def _earliest(events: DataFrame, keys: list[str]) -> DataFrame:
    """Earliest (time, id) per key, with the key's last time and row count."""
    return events.groupBy(*keys).agg(
        F.min(F.struct(_US, _ID)).alias("_first"),
        F.max(_US).alias("_last"),
        F.count(F.lit(1)).alias(_ROWS),
    )


#: Buckets of time per expiry, so that a busy key's rows of one expiry are not one group.
BUCKETS = 8


def _first_at_or_after(rows: DataFrame, group: list[str], at: str, value: str) -> Column:
    """The smallest ``value`` in the group at or after each row's time; rows to be found have a value."""
    # Backwards in time; rows to be found come before the others of their time.
    order = Window.partitionBy(*group).orderBy(F.desc(at), F.col(value).isNull())
    return F.last(value, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def links(times: DataFrame, keys: list[str], ttl_us: int) -> DataFrame:
    """``keys, _us, _to``: from each time of a key to its first time at or after expiry, if there is one.

    ``times`` has one row per key and time.
    """
    width = max(ttl_us // BUCKETS, 1)
    nothing = F.lit(None).cast("bigint")
    seen = times.select(*keys, F.col(_US).alias("_at"), nothing.alias("_from"), F.col(_US).alias("_own"))
    asks = times.select(*keys, (F.col(_US) + ttl_us).alias("_at"), F.col(_US).alias("_from"), nothing.alias("_own"))
    merged = seen.unionAll(asks).withColumn("_bucket", F.floor(F.col("_at") / width))
    near = merged.withColumn("_to", _first_at_or_after(merged, [*keys, "_bucket"], "_at", "_own")).where("_from IS NOT NULL")
    # What is not in its own bucket is the first time of the next bucket that has any. Many rows ask
    # from one bucket; each bucket asks once.
    open_buckets = near.where("_to IS NULL").select(*keys, "_bucket", nothing.alias("_first")).distinct()
    firsts = times.groupBy(*keys, F.floor(F.col(_US) / width).alias("_bucket")).agg(F.min(_US).alias("_first"))
    order = firsts.unionByName(open_buckets)
    later = order.select(
        *keys, "_bucket", "_first",
        F.last("_first", ignorenulls=True)
        .over(Window.partitionBy(*keys).orderBy(F.desc("_bucket"), F.col("_first").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_later"),
    ).where("_first IS NULL").drop("_first")
    found = near.join(later, [*keys, "_bucket"], "left")
    return found.select(*keys, F.col("_from").alias(_US), F.coalesce("_to", "_later").alias("_to")).where("_to IS NOT NULL")


def chains(roots: DataFrame, jumps: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """All times that links lead to from the roots (``keys, _us``), and the number of rounds.

    After k rounds the first 2^k times of a chain are known; the links then reach 2^k times ahead.
    """
    found, rounds = roots, 0
    while True:
        ahead = settle(found.join(jumps, [*keys, _US]).select(*keys, F.col("_to").alias(_US)))
        if ahead.isEmpty():
            return found, rounds
        found = settle(found.unionByName(ahead))
        further = jumps.select(*keys, F.col(_US).alias("_to"), F.col("_to").alias("_further"))
        jumps = settle(jumps.join(further, [*keys, "_to"]).select(*keys, _US, F.col("_further").alias("_to")))
        rounds += 1


def starts(
    events: DataFrame, keys: list[str], ttl_us: int | None, config: EngineConfig = EngineConfig()
) -> DataFrame:
    """The rows (keys, time, id) that set their key. ``events`` has ``keys, _us, _id``."""
    first = _earliest(events, keys)
    single = first.select(*keys, F.col("_first")[_US].alias(_US), F.col("_first")[_ID].alias(_ID))
    if ttl_us is None:
        return single
    low, high = events.agg(F.min(_US), F.max(_US)).first()
    if low is None or high - low < ttl_us:
        return single
    # Most keys end before their first expiry and have no chain.
    live = settle(first.where(F.col("_last") >= F.col("_first")[_US] + ttl_us).select(*keys, F.col("_first")[_US].alias("_root"), _ROWS))
    if live.isEmpty():
        return single
    within = skew.attach(
        events, live, keys, size=_ROWS, spread_by=_ID, max_hot=config.hot_groups_max, min_rows=config.hot_group_min_rows
    ).where(F.col("_root").isNotNull())
    times = settle(within.groupBy(*keys, _US).agg(F.min(_ID).alias(_ID)))
    jumps = settle(links(times.select(*keys, _US), keys, ttl_us))
    found, _ = chains(live.select(*keys, F.col("_root").alias(_US)), jumps, keys)
    later = found.join(live.select(*keys, F.col("_root").alias(_US)), [*keys, _US], "left_anti")
    return single.unionByName(times.join(later, [*keys, _US]).select(*keys, _US, _ID))


def seen_before(
    df: DataFrame,
    keys: list[str],
    name: str,
    ttl_us: int | None = None,
    ts: str = "event_timestamp",
    row_id: str = "transaction_id",
    config: EngineConfig = EngineConfig(),
    source: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: false on rows that set their key, true on the others, null without a key.

    Ties in time are broken by ``row_id``, which need not be unique: a row sets its key only if it
    agrees in key, time and id with the earliest one, and repeated deliveries of one event get one
    answer. ``source`` holds the same transactions before other joins, and is what gets searched.
    """
    us = F.unix_micros(F.col(ts))
    usable = us.isNotNull()
    for k in keys:
        usable = usable & blank_to_null(F.col(k)).isNotNull()
    events = (df if source is None else source).where(usable).select(*keys, us.alias(_US), F.col(row_id).alias(_ID))
    setters = starts(events, keys, ttl_us, config).withColumn("_sets", F.lit(True))
    # A setter is one row per key and time, so no row is multiplied; with the id among the join keys,
    # the size of a key does not matter. Rows without a key or time match nothing and are spread by id.
    by = [*keys, _US, row_id]
    return (
        df.withColumn(_US, us)
        .join(setters.withColumnRenamed(_ID, row_id), by, "left")
        .select(*df.columns, F.when(usable, F.col("_sets").isNull()).alias(name))
    )


def device_history(
    df: DataFrame, config: EngineConfig = EngineConfig(), source: DataFrame | None = None
) -> DataFrame:
    return seen_before(
        df,
        ["customer_id", "device_fingerprint"],
        "device_seen_before",
        ttl_us=config.device_ttl_us,
        config=config,
        source=source,
    )


def merchant_first_seen(df: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    return (
        seen_before(df, ["merchant_id"], "_seen", config=config)
        .withColumn("is_merchant_first_seen", ~F.col("_seen"))
        .drop("_seen")
    )
