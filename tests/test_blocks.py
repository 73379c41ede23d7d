"""Keyed state in blocks: a busy key costs few values of state and wire, and its rows keep their order."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql.pandas.types import to_arrow_schema

from fraudspark.config import MERCHANT_WINDOWS, MICROS
from fraudspark.streaming import state
from fraudspark.streaming.blocks import BODY, BLOCK, KIND
from fraudspark.streaming.ring import MinuteRing


class Held(dict):
    getValue, updateValue = dict.get, dict.__setitem__


class Clock:
    def getCurrentWatermarkInMs(self):
        return 0


def answered(processor, parts):
    """Answers by block, of parts that arrive as one value each."""
    schema = to_arrow_schema(processor.narrow)
    rows = [
        Row(**{BLOCK: f"b{k}", KIND: 1, BODY: pa.RecordBatch.from_pylist(part, schema).serialize().to_pybytes()})
        for k, part in enumerate(parts)
    ]
    out = list(processor.handleInputRows(("=busy",), iter(rows), Clock()))
    assert [r[BLOCK] for r in out] == [r[BLOCK] for r in rows]
    made = to_arrow_schema(processor.made)
    return [pa.ipc.read_record_batch(pa.py_buffer(r[BODY]), made).to_pylist() for r in out]


def test_first_sight_and_trailing_counts_of_a_busy_key_in_blocks():
    rng = random.Random(4)
    rows = [(rng.choice(["busy", "busy", "a"]), rng.randrange(40) * MICROS, f"t{i % 50:02d}") for i in range(400)]
    parts = [[{"_name": n, "_us": u, "_id": i, "_at": k} for k, (n, u, i) in enumerate(rows[s : s + 150])] for s in (0, 150, 300)]
    ttl, span = 7 * MICROS, 3 * MICROS
    for processor in (state.FirstSight(ttl, False), state.FirstSight(None, False), state.Trailing(span)):
        processor.set_at = processor.recent = Held()
        got = [r["_flag"] for part in answered(processor, parts) for r in part]
        expected, at = [None] * len(rows), {}
        for k in sorted(range(len(rows)), key=lambda k: rows[k][1:]):
            name, us, _ = rows[k]
            if isinstance(processor, state.Trailing):
                expected[k] = sum(n == name and us - span <= u <= us for n, u, _ in rows)
            else:
                expected[k] = name in at and (processor.ttl_us is None or us < at[name] + processor.ttl_us)
                if not expected[k]:
                    at[name] = us
        assert got == expected
        assert set(processor.set_at) == {("busy",), ("a",)}


def test_ring_of_a_busy_key_in_blocks():
    class Handle:
        def registerTimer(self, ms):
            pass

    class Value:
        def get(self):
            return None

        def update(self, value):
            pass

    processor = MinuteRing(MERCHANT_WINDOWS, judge=False)
    processor.buckets, processor.until, processor.handle = Value(), Value(), Handle()
    times = np.random.default_rng(5).integers(0, 7200, 300)
    rows = [{"_us": int(t) * MICROS, "_id": f"t{i:03d}", "_amount": float(i), "_is_late": i % 10 == 0, "_at": i % 100} for i, t in enumerate(times)]
    got = [r for part in answered(processor, [rows[:100], rows[100:200], rows[200:]]) for r in part]
    for row, answer in zip(rows, got, strict=True):
        own = [
            r["_amount"] for r in rows
            if not r["_is_late"] and r["_us"] // (3600 * MICROS) == row["_us"] // (3600 * MICROS)
            and (r["_us"], r["_id"]) <= (row["_us"], row["_id"])
        ]
        want = (None, None) if row["_is_late"] else (len(own), sum(own))
        assert (answer["merchant_txn_count_1hr"], answer["merchant_amount_sum_1hr"]) == want
