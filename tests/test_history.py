"""History by doubled links against a plain fold, with its rounds and plan."""

import random

import pytest
from pyspark.sql import functions as F

from fraudspark.operators import state

HOUR = 3_600_000_000
DDL = "transaction_id string, merchant_id string, event_us bigint"


def rows(seed=2):
    rng = random.Random(seed)
    out = [(f"b{i:05d}", "busy", rng.randrange(900) * HOUR // 3) for i in range(1500)]
    out += [(f"q{i:05d}", f"quiet-{i % 90}", rng.randrange(300 * HOUR)) for i in range(300)]
    out += [("t1", "exact", 0), ("t2", "exact", HOUR), ("t3", "exact", HOUR), ("t4", "exact", 2 * HOUR - 1), ("t5", "exact", 2 * HOUR)]
    return out + [("n1", None, 5), ("n2", "busy", None), ("n3", "", 7), out[3], out[3]]


def fold(data, ttl):
    set_at, seen = {}, {}
    for i, key, us in sorted((r for r in data if r[1] and r[1].strip() and r[2] is not None), key=lambda r: (r[2], r[0])):
        at = set_at.get(key)
        if at is None or us >= at[0] + ttl:
            set_at[key] = at = (us, i)
        seen[i, us] = (us, i) != at
    return {(i, us): seen.get((i, us)) for i, _, us in data}


def flagged(spark, data, ttl):
    df = spark.createDataFrame(data, DDL).repartition(4).withColumn("event_timestamp", F.timestamp_micros("event_us"))
    return state.seen_before(df, ["merchant_id"], "seen", ttl)


@pytest.mark.parametrize("ttl", [HOUR, HOUR // 3 + 1, 5000 * HOUR])
def test_flags_equal_a_fold(spark, ttl):
    data = rows()
    found = flagged(spark, data, ttl).collect()
    assert len(found) == len(data)
    assert {(r.transaction_id, r.event_us): r.seen for r in found} == fold(data, ttl)


def test_rounds_grow_as_the_logarithm_of_the_chain(spark):
    times = spark.createDataFrame([("k", n * HOUR) for n in range(1000)] + [("one", 0)], "k string, _us bigint")
    roots = times.groupBy("k").agg(F.min("_us").alias("_us"))
    found, rounds = state.chains(roots, state.links(times, ["k"], HOUR), ["k"])
    assert found.count() == 1001 and rounds <= 10
    found, rounds = state.chains(roots, state.links(times, ["k"], 10 * HOUR), ["k"])
    assert found.count() == 101 and rounds <= 7


def test_links_take_no_key_as_one_group(spark):
    times = spark.createDataFrame([("k", n * HOUR) for n in range(50)], "k string, _us bigint")
    linked = state.links(times, ["k"], 2 * HOUR)
    assert {(r._us, r._to) for r in linked.collect()} == {(n * HOUR, (n + 2) * HOUR) for n in range(48)}
    plan = linked._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(k#" in plan and "_bucket" in plan.split("windowspecdefinition(k#", 1)[1][:60]


def test_no_rows(spark):
    assert flagged(spark, [], HOUR).count() == 0
    assert [r.seen for r in flagged(spark, [("a", None, None)], HOUR).collect()] == [None]
