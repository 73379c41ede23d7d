"""Tumbling-window velocity on a stream, in append mode.

A row leaves when its widest window (an hour) and the watermark have passed, with the final values of
all its windows. Rows later than the watermark are dropped; ``trailing`` counts do not wait.

State holds no single rows. Each task packs the rows of a micro-batch into blocks, one per hour and
bucket of keys, and the blocks wait in a stream-stream join for the number of rows of their hour and
bucket, which leaves its aggregate once the watermark has passed. Then all blocks of an hour and
bucket are together, and with them all rows of its keys: their windows are summed at once. Cards go
first; their blocks are packed anew by merchant. So state is read and written once per block, and
what it has read is never written again. An hour of one key is summed by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fraudspark.config import EngineConfig, WindowSpec
from fraudspark.operators.velocity import fill_counts

#: Rows and bytes that a task packs at a time.
_PACK_ROWS, _PACK_BYTES = 262_144, 64 << 20
_WINDOW, _BUCKET, _ROWS, _BODY, _TOTAL = "window", "_bucket", "_rows", "_body", "_total"
_US, _AMOUNT = "_us", "_amount"


def _bucket(key: str, row_id: str, buckets: int) -> Column:
    """Rows without a key belong to no group and may go anywhere."""
    own = F.coalesce(F.col(key).cast("string"), F.col(row_id).cast("string"))
    return F.pmod(F.xxhash64(own), F.lit(buckets)).cast("int")


def _fields(windows: tuple[WindowSpec, ...]) -> list[T.StructField]:
    fields = []
    for w in windows:
        fields += [T.StructField(w.count, T.LongType())] if w.count else []
        fields += [T.StructField(n, T.DoubleType()) for n in (w.total, w.mean, w.largest) if n]
    return fields


def _cut(table: pa.Table, bucket: str) -> Iterator[pa.RecordBatch]:
    """The rows as blocks, one per window and bucket."""
    table = table.combine_chunks()
    if not table.num_rows:
        return
    starts = table[_WINDOW].combine_chunks().field("start").cast(pa.int64()).to_numpy()
    buckets = table[bucket].to_numpy()
    order = np.lexsort((buckets, starts))
    starts, buckets, table = starts[order], buckets[order], table.take(pa.array(order)).combine_chunks()
    first = np.flatnonzero(np.append(True, (starts[1:] != starts[:-1]) | (buckets[1:] != buckets[:-1])))
    (rows,) = table.drop_columns([_WINDOW]).to_batches()
    ends = [*first[1:].tolist(), table.num_rows]
    bodies = [rows.slice(a, b - a).serialize().to_pybytes() for a, b in zip(first.tolist(), ends, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [
            table[_WINDOW].combine_chunks().take(pa.array(first)),
            pa.array(buckets[first], pa.int32()),
            pa.array(np.diff([*first.tolist(), table.num_rows]), pa.int64()),
            pa.array(bodies, pa.binary()),
        ],
        names=[_WINDOW, _BUCKET, _ROWS, _BODY],
    )


def _packed(rows: DataFrame, bucket: str) -> DataFrame:
    """The blocks of a frame; its window column keeps the watermark."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= _PACK_ROWS or size >= _PACK_BYTES:
                yield from _cut(pa.Table.from_batches(held), bucket)
                held, n, size = [], 0, 0
        if held:
            yield from _cut(pa.Table.from_batches(held), bucket)

    return rows.mapInArrow(pack, _block_schema(rows))


def _block_schema(rows: DataFrame) -> T.StructType:
    return T.StructType([rows.schema[_WINDOW]]).add(_BUCKET, "integer").add(_ROWS, "long").add(_BODY, "binary")


def _gathered(blocks: DataFrame, counted: DataFrame) -> DataFrame:
    """The blocks of every window that has passed, with the number of rows of their window and bucket."""
    totals = counted.groupBy(_WINDOW, _BUCKET).agg(F.sum(_ROWS).alias(_TOTAL))
    # Spark wants distinct columns on both sides of a stream-stream join.
    right = totals.select(F.col(_WINDOW).alias("_r_window"), F.col(_BUCKET).alias("_r_bucket"), _TOTAL)
    on = (blocks[_WINDOW] == right["_r_window"]) & (blocks[_BUCKET] == right["_r_bucket"])
    return blocks.join(right, on).select(*[blocks[c] for c in (_WINDOW, _BUCKET, _BODY)], right[_TOTAL])


def _whole(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.Table]:
    """All rows of a window and bucket at a time, with their window."""
    held: dict[tuple[int, int], list[pa.RecordBatch]] = {}
    lacking: dict[tuple[int, int], int] = {}
    for batch in batches:
        totals, buckets = batch[_TOTAL].to_pylist(), batch[_BUCKET].to_pylist()
        for k, start in enumerate(batch[_WINDOW].field("start").cast(pa.int64()).to_pylist()):
            at = (start, buckets[k])
            part = pa.ipc.read_record_batch(pa.py_buffer(batch[_BODY][k].as_py()), schema)
            held.setdefault(at, []).append(part)
            lacking[at] = lacking.get(at, totals[k]) - part.num_rows
            if not lacking[at]:
                del lacking[at]
                rows = pa.Table.from_batches(held.pop(at)).combine_chunks()
                yield rows.append_column(_WINDOW, batch[_WINDOW].take(pa.array(np.full(rows.num_rows, k))))
    if held:
        raise RuntimeError(f"{len(held)} windows lack blocks")


def _measured(rows: pa.Table, key: str, windows: tuple[WindowSpec, ...]) -> pa.Table:
    """The rows with the measures of their key's windows; rows without key have none."""
    keys = rows[key].combine_chunks().dictionary_encode().indices
    known = keys.is_valid().to_numpy(zero_copy_only=False)
    codes, us = keys.fill_null(0).to_numpy().astype(np.int64), rows[_US].to_numpy()
    there = rows[_AMOUNT].is_valid().to_numpy() & known
    amounts = rows[_AMOUNT].fill_null(0.0).to_numpy()
    made = {}
    for w in windows:
        slot = us // w.width_us
        slot -= slot.min()
        _, group = np.unique(codes * (slot.max() + 1) + slot, return_inverse=True)
        values = np.bincount(group, weights=there)[group]
        total = np.bincount(group, weights=np.where(there, amounts, 0.0))[group]
        none = ~known | (values == 0)
        if w.count:
            made[w.count] = pa.array(np.bincount(group, weights=known)[group].astype(np.int64), mask=~known)
        if w.total:
            made[w.total] = pa.array(total, mask=none)
        if w.mean:
            made[w.mean] = pa.array(total / np.maximum(values, 1), mask=none)
        if w.largest:
            largest = np.full(group.max() + 1, -np.inf)
            np.maximum.at(largest, group[there], amounts[there])
            made[w.largest] = pa.array(largest[group], mask=none)
    for name, values in made.items():
        rows = rows.append_column(name, values)
    return rows


def stream_velocity(
    transactions: DataFrame,
    config: EngineConfig = EngineConfig(),
    row_id: str = "transaction_id",
    buckets: int = 8,
) -> DataFrame:
    """Add card and merchant velocity to a stream of canonical transactions.

    The result carries ``window``, the enclosing widest window, as its event-time column;
    ``event_timestamp`` is rebuilt as a plain column. The keys of an hour are dealt into ``buckets``.
    """
    timed = transactions.withWatermark("event_timestamp", config.watermark_delay)
    card, merchant = config.card_windows, config.merchant_windows
    widths = {max(w.width_us for w in ws) for ws in (card, merchant)}
    if len(widths) != 1:
        raise ValueError("card and merchant windows must share their widest window on a stream")
    widest = widths.pop()
    if any(widest % w.width_us for w in (*card, *merchant)):
        raise ValueError("streaming windows must divide the widest one")
    # Blocks carry one event-time column: the window stays, times become numbers that no zone touches.
    times = [f.name for f in transactions.schema if isinstance(f.dataType, T.TimestampType)]
    rows = (
        timed.withColumn(_WINDOW, F.window("event_timestamp", f"{widest} microseconds"))
        .withColumns({_US: F.unix_micros("event_timestamp"), _AMOUNT: F.col(config.velocity_amount).cast("double")})
        .drop("event_timestamp")
        .withColumns({c: F.unix_micros(c) for c in times if c != "event_timestamp"})
        .withColumns({"_card": _bucket("card_token", row_id, buckets), "_merchant": _bucket("merchant_id", row_id, buckets)})
    )
    plain = [f for f in rows.schema.fields if f.name != _WINDOW]
    carded = [*plain, *_fields(card)]
    before, between = to_arrow_schema(T.StructType(plain)), to_arrow_schema(T.StructType(carded))
    out = [f for f in (*carded, *_fields(merchant)) if f.name not in (_AMOUNT, "_card", "_merchant")]
    names = [c for c in rows.columns if c in {f.name for f in out} or c == _WINDOW]
    names += [f.name for f in out if f.name not in names]
    schema = T.StructType([rows.schema[c] if c in rows.columns else next(f for f in out if f.name == c) for c in names])

    def cards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole(batches, before):
            yield from _cut(_measured(whole, "card_token", card).select([*between.names, _WINDOW]), "_merchant")

    def merchants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole(batches, between):
            yield from _measured(whole, "merchant_id", merchant).select(names).to_batches()

    first = _gathered(_packed(rows, "_card"), _numbers(rows, "_card"))
    again = first.mapInArrow(cards, _block_schema(rows))
    moved = _gathered(again, _numbers(rows, "_merchant")).mapInArrow(merchants, schema)
    filled = fill_counts(moved, (*card, *merchant))
    return filled.withColumns(
        {c: F.timestamp_micros(c) for c in times if c != "event_timestamp"} | {"event_timestamp": F.timestamp_micros(_US)}
    ).drop(_US)


def _numbers(rows: DataFrame, bucket: str) -> DataFrame:
    """What is summed to the number of rows of a window and bucket."""
    return rows.select(_WINDOW, F.col(bucket).alias(_BUCKET), F.lit(1).cast("long").alias(_ROWS))
