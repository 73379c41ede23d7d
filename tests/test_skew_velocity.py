"""Velocity, history and trailing counts against brute force, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fraudspark.config import CARD_WINDOWS, EngineConfig
from fraudspark.operators import skew, state, velocity

START = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
COLUMNS = "transaction_id string, card_token string, merchant_id string, event_timestamp timestamp, amount double"


def _us(t):
    return None if t is None else int((t - START) / dt.timedelta(microseconds=1))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = []
    for i in range(900):
        card = None if i % 50 == 0 else ("busy" if i % 3 == 0 else f"c{rng.randrange(12)}")
        merchant = None if i % 70 == 0 else ("big" if i % 2 else f"m{rng.randrange(5)}")
        when = None if i % 90 == 1 else START + dt.timedelta(microseconds=rng.randrange(3 * 3_600_000_000))
        amount = None if i % 40 == 3 else rng.randrange(1, 100_000) / 100
        made.append((f"t{i:04d}", card, merchant, when, amount))
    same = START + dt.timedelta(minutes=5)
    made += [(f"u{i:04d}", "busy", "big", same, 10.0) for i in range(300)]
    return made


def _expected(rows, key, width):
    out = {}
    groups = {}
    for r in rows:
        if r[key] is not None and r[3] is not None:
            groups.setdefault((r[key], _us(r[3]) // width), []).append(r[4])
    for r in rows:
        if r[key] is None or r[3] is None:
            out[r[0]] = (1, None, None)
            continue
        values = groups[(r[key], _us(r[3]) // width)]
        known = [v for v in values if v is not None]
        total = round(sum(known), 4) if known else None
        out[r[0]] = (len(values), total, max(known) if known else None)
    return out


@pytest.mark.parametrize("min_rows", [10, 1_000_000])
def test_velocity_matches_brute_force(spark, rows, min_rows):
    config = EngineConfig(hot_groups_max=1_000, hot_group_min_rows=min_rows)
    got = velocity.velocity(spark.createDataFrame(rows, COLUMNS), config).collect()
    assert len(got) == len(rows)
    minute, five, hour = (_expected(rows, 1, w.width_us) for w in CARD_WINDOWS)
    merchant = _expected(rows, 2, 3_600_000_000)
    for g in got:
        i = g.transaction_id
        assert g.card_txn_count_1min == minute[i][0]
        assert g.card_txn_count_5min == five[i][0]
        assert (g.card_txn_count_1hr, g.card_amount_max_1hr) == (hour[i][0], hour[i][2])
        assert g.merchant_txn_count_1hr == merchant[i][0]
        for mine, theirs in (
            (g.card_txn_sum_1min, minute[i][1]),
            (g.card_amount_sum_5min, five[i][1]),
            (g.card_amount_sum_1hr, hour[i][1]),
            (g.merchant_amount_sum_1hr, merchant[i][1]),
        ):
            assert (mine is None) == (theirs is None)
            assert mine is None or mine == pytest.approx(theirs, abs=1e-4)


def test_heavy_rows_are_spread_in_the_shuffled_join(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(rows, COLUMNS)
        groups = df.where("card_token is not null").groupBy("card_token").agg(F.count("*").alias("n"))
        out = skew.attach(df, groups, ["card_token"], "n", "transaction_id", min_rows=100, drop_size=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
        shuffled = [line for line in plan.splitlines() if "SortMergeJoin" in line]
        assert shuffled and all("_salt" in line.split("LeftOuter")[0] for line in shuffled)
        assert out.where("card_token = 'busy'").select("n").distinct().count() == 1
        assert out.count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_groups_are_few(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    groups = df.groupBy("card_token").agg(F.count("*").alias("n"))
    limit = skew.heavy_threshold(df, max_hot=5, min_rows=0)
    assert groups.where(F.col("n") > limit).count() < 5


def test_trailing_count_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS)
    got = {r[0]: r[1] for r in velocity.trailing_count(df).select("transaction_id", "card_txn_count_trailing").collect()}
    times = {}
    for r in rows:
        if r[1] is not None and r[3] is not None:
            times.setdefault(r[1], []).append(_us(r[3]))
    for r in rows:
        if r[1] is None or r[3] is None:
            assert got[r[0]] == 1
        else:
            t = _us(r[3])
            assert got[r[0]] == sum(t - 60_000_000 <= x <= t for x in times[r[1]])


@pytest.mark.parametrize("ttl_minutes", [None, 20, 500])
def test_seen_before_matches_a_fold(spark, rows, ttl_minutes):
    ttl = None if ttl_minutes is None else ttl_minutes * 60_000_000
    config = EngineConfig(hot_groups_max=1_000, hot_group_min_rows=50)
    df = spark.createDataFrame(rows, COLUMNS)
    got = {
        r[0]: r[1]
        for r in state.seen_before(df, ["card_token"], "seen", ttl_us=ttl, config=config)
        .select("transaction_id", "seen")
        .collect()
    }
    assert len(got) == len(rows)
    set_at = {}
    for r in sorted((r for r in rows if r[1] and r[3]), key=lambda r: (r[3], r[0])):
        at, now = set_at.get(r[1]), _us(r[3])
        seen = at is not None and (ttl is None or now < at + ttl)
        if not seen:
            set_at[r[1]] = now
        assert got[r[0]] is seen, r
    assert all(got[r[0]] is None for r in rows if not (r[1] and r[3]))
