"""Rules with nulls, the score cap, reference joins."""

import datetime as dt

from pyspark.sql import functions as F

from fraudspark.config import EngineConfig
from fraudspark.operators import features, joins, reports
from fraudspark.sources import refdata

DDL = """id int, event_timestamp timestamp, amount double, amount_usd double, currency string, currency_region string,
bin_country string, bin_prepaid boolean, is_high_risk_mcc boolean, mcc string, pos_entry_mode string,
auth_model string, channel string, device_fingerprint string, card_txn_count_1min bigint,
card_txn_count_1hr bigint, card_amount_avg_1hr double, merchant_txn_count_1hr bigint"""
BASE = dict(
    event_timestamp=dt.datetime(2024, 3, 30, 2, 0, tzinfo=dt.timezone.utc), amount=10.0, amount_usd=10.0,
    currency="USD", currency_region="NORTH_AMERICA", bin_country="US", bin_prepaid=False, is_high_risk_mcc=False,
    mcc="5311", pos_entry_mode="05", auth_model="PIN", channel="POS", device_fingerprint=None,
    card_txn_count_1min=1, card_txn_count_1hr=1, card_amount_avg_1hr=10.0, merchant_txn_count_1hr=1,
)
NAMES = [c.split()[0] for c in DDL.replace("\n", " ").split(", ")]


def one(spark, **changes):
    row = dict(id=1) | BASE | changes
    df = spark.createDataFrame([tuple(row[n] for n in NAMES)], DDL)
    return features.add_features(df, EngineConfig()).first()


def test_calendar(spark):
    r = one(spark)
    assert (r.txn_hour, r.txn_day_of_week, r.txn_day_of_month, r.txn_month) == (2, 7, 30, 3)
    assert r.is_weekend and r.is_late_night and r.is_unusual_hour and r.is_month_end and not r.is_business_hours
    assert r.event_unix_ts == 1711764000


def test_nulls_follow_three_valued_logic(spark):
    assert one(spark, amount=None, amount_usd=None).is_high_value is None
    assert one(spark, amount=3000.0, amount_usd=None).is_high_value is True
    assert one(spark, pos_entry_mode=None).is_cnp is None
    assert one(spark, pos_entry_mode=None, channel="WEB").is_cnp is True
    assert one(spark, auth_model=None).is_cnp is False
    assert one(spark, pos_entry_mode=None).is_chip_transaction is None
    assert one(spark, pos_entry_mode=None, auth_model=None, channel=None).is_card_not_present is False
    assert one(spark, amount=None, amount_usd=None, mcc="6011").is_high_value_atm is None
    assert one(spark, mcc="6011", amount_usd=600.0).is_high_value_atm is True
    assert one(spark, currency=None).is_cross_border is False
    assert one(spark, bin_country=None).is_international is False
    assert one(spark, currency_region=None).is_international is False
    assert one(spark, bin_country="KE").is_international is True
    assert one(spark, bin_country="US", currency_region="AFRICA").is_international is True
    assert one(spark, bin_country="KE", currency="EUR").is_cross_border_currency is True
    assert one(spark, bin_country="US", currency="KES").is_cross_border_currency is True
    assert one(spark, bin_country=None, currency=None).is_cross_border_currency is False
    assert one(spark, card_amount_avg_1hr=None).amount_vs_avg_ratio == 1.0
    assert one(spark, card_amount_avg_1hr=0.0).amount_vs_avg_ratio == 1.0
    assert one(spark, amount=None).is_round_amount is None
    assert one(spark, amount=5000.0).is_round_amount is True
    assert one(spark, amount=0.0).is_round_amount is False
    assert one(spark, bin_prepaid=None, is_high_risk_mcc=True).prepaid_at_high_risk_mcc is False


def test_thresholds(spark):
    assert not one(spark, card_txn_count_1min=3).is_rapid_succession
    assert one(spark, card_txn_count_1min=4).is_rapid_succession
    assert not one(spark, card_txn_count_1hr=10).is_high_velocity
    assert one(spark, card_txn_count_1hr=11).is_high_velocity
    assert not one(spark, merchant_txn_count_1hr=100).is_high_volume_merchant
    assert one(spark, merchant_txn_count_1hr=101).is_high_volume_merchant
    assert one(spark, card_txn_count_1min=None).is_rapid_succession is False


def test_score_adds_and_caps(spark):
    noon = dt.datetime(2024, 3, 27, 12, 0, tzinfo=dt.timezone.utc)
    assert one(spark, event_timestamp=noon).composite_risk_score == 0
    assert one(spark).composite_risk_score == 10
    assert one(spark, is_high_risk_mcc=None).composite_risk_score == 10
    everything = one(
        spark, is_high_risk_mcc=True, bin_prepaid=True, bin_country="KE", amount=0.9, amount_usd=0.9,
        card_amount_avg_1hr=0.1, card_txn_count_1min=9, card_txn_count_1hr=99, channel="WEB",
    )
    assert everything.composite_risk_score == 100


def test_reference_joins_keep_every_row(spark):
    df = spark.createDataFrame(
        [(1, "6011", "404", "KES", "639301", 100.0), (2, "9999", None, None, None, None)],
        "id int, mcc string, currency_code string, currency string, bin string, amount double",
    )
    got = {r.id: r for r in joins.join_reference(df, refdata.ReferenceTables(spark)).collect()}
    assert got[1].is_high_risk_mcc and got[1].currency_region == "AFRICA" and got[1].bin_prepaid
    assert got[1].amount_usd == 100.0 * 0.0077
    assert got[2].amount_usd is None and got[2].mcc_category is None


def test_a_callers_table_is_not_broadcast_by_hint(spark):
    big = spark.range(10).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("bin"), F.lit("x").alias("bin_brand"))
    refs = refdata.ReferenceTables(spark, bins=big)
    assert "bins" not in refs.fixed
    df = spark.createDataFrame([("000003",), ("999999",)], "bin string")
    plan = joins.join_bin(df, refs)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert joins.join_bin(df, refs).where("bin_brand = 'x'").count() == 1


def test_live_rates_override_and_refresh(spark):
    rates = {"v": [("KES", 0.01, 1), ("KES", 0.02, 2), ("XXX", 9.0, 1), ("USD", None, 3)]}
    refs = refdata.ReferenceTables(
        spark, lambda: spark.createDataFrame(rates["v"], "currency_alpha string, fx_rate_to_usd double, as_of int")
    )
    now = {r[0]: r[1] for r in refs.fx.collect()}
    assert now["KES"] == 0.02 and now["USD"] == 1.0 and "XXX" not in now and len(now) == 14
    rates["v"] = [("KES", 0.03, 9)]
    assert {r[0]: r[1] for r in refs.refresh_fx().collect()}["KES"] == 0.03


def test_histogram_buckets(spark):
    df = spark.createDataFrame([("VISA", x) for x in (0.05, 0.06, 2.0, 2.1)], "provider string, s double")
    got = {r.le: r.records for r in reports.latency_histogram(df, F.col("s")).collect()}
    assert got == {0.05: 1, 0.1: 1, 2.0: 1, None: 1}


def test_schema_text_is_read_or_absent(spark, tmp_path):
    (tmp_path / "visa_tokenised.avsc").write_text('{"type": "record"}')
    assert refdata.read_schema_text(spark, str(tmp_path), "VISA") == '{"type": "record"}'
    assert refdata.read_schema_text(spark, str(tmp_path), "MPESA") is None


def test_history_keeps_one_row_per_row_when_ids_repeat(spark):
    """Ids shared by keys or delivered twice neither multiply rows nor mark the wrong ones."""
    import datetime as dt

    from fraudspark.operators import state

    at = [dt.datetime(2024, 1, 1, 0, m, tzinfo=dt.timezone.utc) for m in range(4)]
    rows = [("A", "c", "d", at[0]), ("A", "c", "e", at[1]), ("B", "c", "d", at[2]), ("A", "c", "d", at[3]), ("A", "c", "d", at[0])]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, device_fingerprint string, event_timestamp timestamp")
    got = sorted((r[1], r[2], r[3]) for r in state.device_history(df).select("transaction_id", "device_fingerprint", F.minute("event_timestamp"), "device_seen_before").collect())
    assert got == [("d", 0, False), ("d", 0, False), ("d", 2, True), ("d", 3, True), ("e", 1, False)]


def test_unreadable_times_and_records_do_not_fail_the_batch(spark):
    from fraudspark.config import EngineConfig
    from fraudspark.operators import normalise
    from fraudspark.sources import wire

    far = spark.createDataFrame([("x", 2**63 - 1), ("x", 0)], "t string, ms bigint")
    assert [r[0] is None for r in far.select(normalise.event_time(F.col("t"), F.col("ms"))).collect()] == [True, False]
    topic = EngineConfig().tokenised_topics["VISA"]
    values = ['{"amount": "abc"}', '{"amount": 1} x', "[1]", '"x"', '{"amount": 1.5}\n']
    records = [(bytearray(v.encode()), topic) for v in values] + [(bytearray(b"{}"), "other")]
    decoded = wire.decode_tokenised(spark.createDataFrame(records, "value binary, topic string"), EngineConfig().tokenised_topics)
    assert [r["error_reason"] for r in decoded.collect()] == ["Parse failure"] * 4 + [None, "Unknown topic"]
