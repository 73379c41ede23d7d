"""Keyed state on a stream: first sight of a device or merchant, and trailing card counts.

Rows of one key and micro-batch are ordered by (time, id). Their number is bounded by the source's
limit per trigger, and the state of a key is one number (first sight) or the times of the last span
(trailing counts). Keys share groups by their hash, and a group answers all of its rows of a
micro-batch at once (``streaming/blocks.py``). Rows without a key bypass the state.
"""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from fraudspark.config import MICROS, EngineConfig
from fraudspark.functions.text import blank_to_null
from fraudspark.streaming.blocks import GROUP, BlockProcessor, runs, through_blocks

# How far ahead of the clock an event's time may be before it stops moving the trailing span.
_AHEAD_US = 3600 * MICROS
_NAME, _US, _ID, _FLAG = "_name", "_us", "_id", "_flag"
# Groups of keys; checkpoints depend on their number.
_GROUPS = 1024
_NARROW = T.StructType().add(_NAME, "string").add(_US, "long").add(_ID, "string")


class _Keyed(BlockProcessor):
    """Flags of a key's rows in order of time and id; rows that have no key get none."""

    flag: T.DataType

    def __init__(self) -> None:
        super().__init__(_NARROW, T.StructType([T.StructField(_FLAG, self.flag)]))

    def answers(self, rows: pa.Table, keyed: bool, timer_values) -> dict[str, pa.Array]:
        arrow = pa.bool_() if isinstance(self.flag, T.BooleanType) else pa.int64()
        if not keyed:
            return {_FLAG: pa.nulls(rows.num_rows, arrow)}
        by_time = pc.sort_indices(
            pa.table({"us": rows[_US], "id": pc.fill_null(rows[_ID], "")}), [("us", "ascending"), ("id", "ascending")]
        ).to_numpy()
        order, starts, keys = runs(rows[_NAME].take(pa.array(by_time)))
        order = by_time[order]
        times = rows[_US].to_numpy()[order]
        out = np.empty(len(order), bool if isinstance(self.flag, T.BooleanType) else np.int64)
        for key, a, b in zip(keys, starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
            out[order[a:b]] = self.flags((key,), times[a:b])
        return {_FLAG: pa.array(out, arrow)}

    def flags(self, key: tuple[str], times: np.ndarray) -> np.ndarray:
        raise NotImplementedError


class FirstSight(_Keyed):
    """Flags rows whose key was seen before and is not expired. The state is the time it was set."""

    flag = T.BooleanType()

    def __init__(self, ttl_us: int | None, forget: bool):
        super().__init__()
        self.ttl_us, self.forget = ttl_us, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl_ms = self.ttl_us // 1000 if self.forget else None
        self.set_at = handle.getMapState("set_at", "key string", "us bigint", ttl_ms)

    def flags(self, key: tuple[str], times: np.ndarray) -> np.ndarray:
        known = self.set_at.getValue(key)
        before = None if known is None else known[0]
        at, seen, k = before, np.ones(len(times), bool), 0
        while k < len(times):
            # A row that comes in late, from before the key was set, sees the later state.
            if at is not None:
                k = len(times) if self.ttl_us is None else int(np.searchsorted(times, at + self.ttl_us))
            if k < len(times):
                at, seen[k] = int(times[k]), False
                k += 1
        if at != before:
            self.set_at.updateValue(key, (at,))
        return seen


class Trailing(_Keyed):
    """Rows of the key in [t - span, t], as of each row."""

    flag = T.LongType()

    def __init__(self, span_us: int, forget: bool = False):
        super().__init__()
        self.span_us, self.forget = span_us, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        # An idle card may go once no row of its span can still come in order.
        ttl_ms = 2 * self.span_us // 1000 + _AHEAD_US // 1000 if self.forget else None
        self.recent = handle.getMapState("recent", "key string", "times array<bigint>", ttl_ms)

    def flags(self, key: tuple[str], fresh: np.ndarray) -> np.ndarray:
        known = self.recent.getValue(key)
        times = np.sort(np.concatenate([np.array([] if known is None else known[0], np.int64), fresh]), kind="stable")
        counts = np.searchsorted(times, fresh, "right") - np.searchsorted(times, fresh - self.span_us, "left")
        # A time from the future is counted but must not push the others out.
        limit = time.time_ns() // 1000 + _AHEAD_US
        past = int(np.searchsorted(times, limit, "right"))
        newest = times[past - 1] if past else times[0]
        self.recent.updateValue(key, (times[np.searchsorted(times, newest - self.span_us, "left") :].tolist(),))
        return counts


def _through_state(
    df: DataFrame, keys: list[str], processor: _Keyed, name: str, flag: T.DataType,
    without_key: Column, ts: str, row_id: str, time_mode: str = "None",
) -> DataFrame:
    """Rows keep their columns and types on the way; times travel as numbers, so no zone touches them."""
    us = F.unix_micros(F.col(ts))
    usable = us.isNotNull()
    for k in keys:
        usable = usable & blank_to_null(F.col(k)).isNotNull()
    own = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    packed = df.withColumns({_NAME: F.when(usable, own), _US: us, _ID: F.col(row_id).cast("string")})
    group = F.concat(F.lit("="), F.pmod(F.xxhash64(_NAME), F.lit(_GROUPS)).cast("string"))
    packed = packed.withColumns(
        {GROUP: F.when(F.col(_NAME).isNotNull(), group)} | {c: F.unix_micros(c) for c in times}
    )
    made = through_blocks(packed, processor, time_mode)
    back = made.withColumns({c: F.timestamp_micros(c) for c in times})
    return back.select(*df.columns, F.coalesce(_FLAG, without_key.cast(flag)).alias(name))


def stream_seen_before(
    df: DataFrame,
    keys: list[str],
    name: str,
    ttl_us: int | None = None,
    ts: str = "event_timestamp",
    row_id: str = "transaction_id",
    forget: bool = False,
) -> DataFrame:
    """Add ``name`` as in the table form; a key expires by event time.

    With ``forget`` the store also drops a key after the same span of processing time, which keeps
    the state of an always-on query small. Leave it off for ``availableNow`` runs: state that expires
    by processing time makes Spark schedule empty batches without end.
    """
    forget = forget and ttl_us is not None
    return _through_state(
        df, keys, FirstSight(ttl_us, forget), name, T.BooleanType(), F.lit(None), ts, row_id,
        "ProcessingTime" if forget else "None",
    )


def stream_device_history(
    df: DataFrame, config: EngineConfig = EngineConfig(), forget: bool = False
) -> DataFrame:
    keys = ["customer_id", "device_fingerprint"]
    return stream_seen_before(df, keys, "device_seen_before", config.device_ttl_us, forget=forget)


def stream_merchant_first_seen(df: DataFrame) -> DataFrame:
    return (
        stream_seen_before(df, ["merchant_id"], "_seen")
        .withColumn("is_merchant_first_seen", ~F.col("_seen"))
        .drop("_seen")
    )


def stream_trailing_count(
    df: DataFrame,
    key: str = "card_token",
    name: str = "card_txn_count_trailing",
    span_us: int = 60 * MICROS,
    ts: str = "event_timestamp",
    row_id: str = "transaction_id",
    forget: bool = False,
) -> DataFrame:
    """Low-latency counts: each row leaves with its own micro-batch. Rows without a key count as 1.

    A late row counts what is still in state; rows that left earlier keep the count they had. With
    ``forget``, for always-on queries, the store drops cards that have been idle for a while.
    """
    mode = "ProcessingTime" if forget else "None"
    return _through_state(df, [key], Trailing(span_us, forget), name, T.LongType(), F.lit(1), ts, row_id, mode)
