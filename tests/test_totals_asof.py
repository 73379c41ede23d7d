"""Totals that survive replays and folding, mergeable quantiles, and rates as of the payment."""

import random

import pytest
from pyspark.sql import functions as F

from fraudspark.operators import joins
from fraudspark.operators.asof import as_of
from fraudspark.sources.refdata import ReferenceTables
from fraudspark.streaming.totals import RANK_ERROR, SKETCH_K, Totals, quantiles


def batch(spark, values, provider="VISA"):
    rows = spark.createDataFrame([(provider, float(v)) for v in values], "provider string, v double")
    return rows.groupBy("provider").agg(F.count(F.lit(1)).alias("records"), F.kll_sketch_agg_double("v", SKETCH_K).alias("latency"))


def records(totals):
    return {r.provider: r.records for r in totals.read().collect()}


def test_replays_and_folding_change_no_total(spark, tmp_path):
    totals = Totals(spark, str(tmp_path), ["records"], ("latency",))
    assert totals.read() is None and totals.compact() == 0
    for n in range(4):
        totals.write(batch(spark, range(10 * (n + 1))), n)
    totals.write(batch(spark, range(40)), 3)
    assert records(totals) == {"VISA": 100} and totals.files() == 4
    assert totals.compact() == 3 and totals.files() == 2 and records(totals) == {"VISA": 100}
    # A batch that is folded is not written again; the newest one is.
    totals.write(batch(spark, range(999)), 1)
    totals.write(batch(spark, range(41)), 3)
    assert records(totals) == {"VISA": 101}
    # Stopped between snapshot and removal: the folded batch is still there and is ignored.
    batch(spark, range(30)).write.parquet(str(tmp_path / "batches" / "batch=2"))
    assert records(totals) == {"VISA": 101}
    for n in range(4, 9):
        totals.write(batch(spark, range(1), "MPESA"), n)
        totals.compact()
        assert totals.files() <= 3
    assert records(totals) == {"VISA": 101, "MPESA": 5}


def test_merged_quantiles_keep_their_rank_error(spark, tmp_path):
    rng = random.Random(4)
    totals, everything = Totals(spark, str(tmp_path), ["records"], ("latency",)), []
    for n in range(4):
        values = [rng.gauss(n, 3) for _ in range(4000)]
        everything += values
        totals.write(batch(spark, values), n)
        totals.compact()
    everything.sort()
    for r in quantiles(totals.read(), "latency").collect():
        at = sum(v <= r.value for v in everything) / len(everything)
        assert abs(at - r.rank) <= RANK_ERROR + 1 / len(everything) and r.seen == 16_000 and r.records == 16_000
    nothing = spark.createDataFrame([("VISA", None)], "provider string, v double").groupBy("provider").agg(
        F.kll_sketch_agg_double("v", SKETCH_K).alias("latency")
    )
    assert {(r.rank, r.value) for r in quantiles(nothing, "latency").collect()} == {(0.5, None), (0.95, None), (0.99, None)}


ROWS = "transaction_id string, currency string, event_us bigint, amount double"
QUOTES = "currency string, at bigint, rate double"


def plain(rows, quotes):
    out = []
    for i, c, us, _ in rows:
        past = [(at, rate) for k, at, rate in quotes if k is not None and k == c and None not in (at, rate, us) and at <= us]
        out.append((i, max(past)[1] if past else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket,salts", [(10, 3), (10**9, 8)])
def test_as_of_against_a_loop(spark, bucket, salts):
    rng = random.Random(7)
    rows = [(f"t{i}", rng.choice(["KES", "KES", "USD", "EUR", None]), rng.randrange(5000), 1.0) for i in range(400)]
    rows += [("n1", "KES", None, 1.0), ("n2", "KES", 17, 1.0), rows[0], ("old", "USD", -5, 1.0)]
    quotes = [(rng.choice(["KES", "USD", "GBP"]), rng.randrange(5000), rng.randrange(1, 99) / 8) for _ in range(60)]
    quotes += [("KES", 17, 2.5), ("KES", 17, 1.5), (None, 3, 1.0), ("KES", None, 9.0), ("USD", 40, None)]
    df = spark.createDataFrame(rows, ROWS).repartition(3).withColumn("event_timestamp", F.timestamp_micros("event_us"))
    given = spark.createDataFrame(quotes, QUOTES).withColumn("as_of", F.timestamp_micros("at"))
    found = as_of(df, given, "currency", "rate", bucket_us=bucket, salts=salts)
    assert found.columns == [*df.columns, "rate"]
    assert sorted(((r.transaction_id, r.rate) for r in found.collect()), key=repr) == plain(rows, quotes)
    none = as_of(df, given.limit(0), "currency", "rate", bucket_us=bucket, salts=salts)
    assert none.count() == len(rows) and none.where("rate IS NOT NULL").count() == 0
    assert as_of(df.limit(0), given, "currency", "rate").count() == 0


def test_rates_of_the_payments_time(spark):
    rows = [("a", "KES", 10, 100.0), ("b", "KES", 30, 100.0), ("c", "XXX", 30, 100.0)]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'1' AS mcc", "'2' AS currency_code", "'3' AS bin")
    df = df.withColumn("event_timestamp", F.timestamp_micros("event_us"))
    history = spark.createDataFrame([("KES", 20, 0.5)], "currency_alpha string, at bigint, fx_rate_to_usd double")
    history = history.select("currency_alpha", "fx_rate_to_usd", F.timestamp_micros("at").alias("as_of"))
    refs = ReferenceTables(spark)
    default = refs.fx.where("currency_alpha = 'KES'").first().fx_rate_to_usd
    found = {r.transaction_id: r.amount_usd for r in joins.join_reference(df, refs, history).collect()}
    assert found == {"a": 100 * default, "b": 50.0, "c": None}
