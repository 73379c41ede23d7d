"""Parsing, checks and tokens on hand-written messages."""

import datetime as dt
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from fraudspark import schemas
from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, VISA, EngineConfig
from fraudspark.functions import crypto
from fraudspark.operators import validate
from fraudspark.plans import jobs
from fraudspark.streaming import sinks

KEY = b"a-test-key"
CONFIG = EngineConfig()
RECEIVED = dt.datetime(2024, 5, 1, 12, 0, tzinfo=dt.timezone.utc)


def mac(text: str) -> str:
    return hmac.new(KEY, text.encode(), hashlib.sha256).hexdigest().upper()


def shaped(pan: str, letters: str) -> str:
    middle = mac(pan)[: len(pan) - 10].translate(str.maketrans("ABCDEF", letters))
    return pan[:6] + middle + pan[-4:]


def visa(pan="4111111111111111", **more):
    bitmap = {"DE002": pan, "DE004": 10.5, "DE049": "840"} | more
    return {"bitmap": bitmap, "transaction_id": "v"}


def flw(card=None, **data):
    body = {"flw_ref": "F1", "tx_ref": "X1", "amount": 5} | data
    if card:
        body["card"] = {"first_6digits": card[0], "last_4digits": card[1]}
    return {"webhook_payload": {"event": "charge.completed", "data": body}}


def ipn(**payload):
    return {"ipn_payload": {"pesapal_transaction_tracking_id": "K1", "amount": 7} | payload}


def paybill(**payload):
    return {"webhook_payload": {"TransactionType": "PayBill", "TransID": "M1", "TransAmount": 3} | payload}


# provider, message, expected reason (None = accepted), expected columns
CASES = [
    (VISA, visa(), None, {"card_token": shaped("4111111111111111", "567890"), "currency": "USD", "amount": 10.5}),
    (VISA, visa("4111-1111 1111-1111"), None, {"bin": "411111", "last4": "1111"}),
    (VISA, "not json", "Parse failure", {}),
    (VISA, "[1]", "Parse failure", {}),
    (VISA, '{"bitmap": null}', "Parse failure", {}),
    (VISA, '{"bitmap": {"DE002": "4111111111111111"}} trailing', "Parse failure", {}),
    (VISA, visa(""), "PAN validation failed: PAN is empty", {}),
    (VISA, {"bitmap": {}}, "PAN validation failed: PAN is empty", {}),
    (VISA, visa("4111x11111111111"), "PAN validation failed: PAN must contain only digits", {}),
    (VISA, visa("411111111111"), "PAN validation failed: PAN length 12 invalid (must be 13-19)", {}),
    (VISA, visa("4111111111111112"), "PAN validation failed: PAN failed Luhn validation", {}),
    (VISA, {"bitmap": {"DE002": "4111111111111111"}}, None, {"amount": 0.0, "currency": "KES"}),
    (VISA, visa(DE004=None), "Parse failure", {}),
    (VISA, visa(DE004="ten"), "Parse failure", {}),
    (VISA, visa(DE004="12.5"), None, {"amount": 12.5}),
    (VISA, visa(DE004="5d"), "Parse failure", {}),
    (VISA, visa(DE004=" 1e2 "), None, {"amount": 100.0}),
    (VISA, visa(DE049=None), None, {"currency_code": None, "currency": "KES"}),
    (VISA, json.dumps(visa()) + "\r\n", None, {"amount": 10.5}),
    (VISA, {"bitmap": {"DE002": "4111111111111111"}, "meta": {"DE049": None, "bitmap": None}}, None,
     {"currency_code": "404"}),
    (FLUTTERWAVE, flw(("520000", "1234"), meta={"customer": None, "card": None, "data": None}), None, {"amount": 5.0}),
    (FLUTTERWAVE, flw(customer=None), "Parse failure - unknown format", {}),
    (FLUTTERWAVE, flw() | {"meta": {"webhook_payload": None}}, None, {"amount": 5.0}),
    (VISA, visa(DE049="156"), None, {"currency_code": "156", "currency": "KES"}),
    (MASTERCARD, visa("5555555555554444", DE049="156"), None,
     {"card_token": shaped("5555555555554444", "123456"), "currency": "USD"}),
    (MASTERCARD, {"pan": "5555555555554444", "amount": 4, "mcc": "5311", "merchant_id": "m"}, None,
     {"amount": 4.0, "mcc": "5311", "merchant_id": "m", "currency_code": "404"}),
    (MASTERCARD, {"bitmap": {}}, "Parse failure - unknown format", {}),
    (MASTERCARD, visa("555555555555444"),
     "PAN validation failed: Mastercard PAN length 15 invalid (must be 16)", {}),
    (MASTERCARD, visa("2220000000000008"), "PAN validation failed: PAN does not start with valid Mastercard BIN", {}),
    (MASTERCARD, visa("2221000000000009"), None, {"bin": "222100"}),
    (MASTERCARD, visa("2720000000000005"), None, {"bin": "272000"}),
    (MASTERCARD, visa("2721000000000004"), "PAN validation failed: PAN does not start with valid Mastercard BIN", {}),
    (MPESA, "not json", "JSON parse error", {}),
    (MPESA, {"webhook_payload": {"x": 1}}, "Parse failure - unknown format", {}),
    (MPESA, paybill(MSISDN="0712345678"), None, {"msisdn_token": "MPESA_MSISDN_" + mac("254712345678")[:16]}),
    (MPESA, paybill(MSISDN="712345678"), None, {"msisdn_token": "MPESA_MSISDN_" + mac("254712345678")[:16]}),
    (MPESA, paybill(MSISDN="+254 712345678"), None, {"msisdn_token": "MPESA_MSISDN_" + mac("254712345678")[:16]}),
    (MPESA, paybill(MSISDN="25471234567"),
     "MSISDN validation failed: Kenyan MSISDN with country code must be 12 digits", {}),
    (MPESA, paybill(), None, {"message_key": "M1", "msisdn_token": None, "transaction_role": "CUSTOMER"}),
    (MPESA, paybill(BusinessShortCode=600123, TransTime="20240102030405"), None,
     {"account_token": "MPESA_ACC_" + mac("600123")[:12], "transaction_role": "MERCHANT",
      "timestamp": "2024-01-02T03:04:05"}),
    (MPESA, paybill(TransTime="20241302030405"), None, {"timestamp": "2024-05-01T12:00:00.000000"}),
    (MPESA, {"Body": {"stkCallback": {"CheckoutRequestID": "ws1", "Amount": 9, "PhoneNumber": 254712345678}}}, None,
     {"transaction_id": "ws1", "amount": 9.0, "transaction_type": "STKPush"}),
    (FLUTTERWAVE, flw(("52000", "1234")), "Card validation failed: BIN must be 6 digits, got 5", {}),
    (FLUTTERWAVE, flw(("520000", "1234")), None,
     {"card_token": f"FLW_520000_TOKEN_{mac('520000:1234:F1')[:12]}_1234", "currency": "USD",
      "ref_token": "FLW_REF_" + mac("X1")[:12]}),
    (FLUTTERWAVE, flw(flw_ref="", card=("520000", "1234")), None,
     {"card_token": f"FLW_520000_TOKEN_{mac('520000:1234')[:12]}_1234", "transaction_id": "X1"}),
    (FLUTTERWAVE, flw(), None, {"card_token": "FLW_REF_" + mac("F1")[:12], "customer_token": None}),
    (FLUTTERWAVE, flw(customer={"id": 12}), None, {"customer_token": "FLW_CUST_" + mac("12::")[:16]}),
    (FLUTTERWAVE, flw(customer={"email": "a@b.c"}), None,
     {"customer_token": "FLW_CUST_" + mac("a@b.c:")[:16],
      "customer_email_hash": hashlib.md5(b"a@b.c").hexdigest()[:16]}),
    (FLUTTERWAVE, flw(authorization={"first_6digits": "530000", "last_4digits": "9876"}), None,
     {"bin": "530000", "last4": "9876"}),
    (FLUTTERWAVE, {"event": "e", "flw_ref": "F2", "amount": 8, "currency": "KES"}, None,
     {"transaction_id": "F2", "amount": 8.0, "currency": "KES"}),
    (FLUTTERWAVE, "{", "JSON parse error", {}),
    (PESAPAL, ipn(customer_email="no-at-sign"), "Email validation failed: Invalid email format: no-at-sign", {}),
    (PESAPAL, ipn(customer_phone="1234567"), "Phone validation failed: Phone length 7 invalid (must be 8-15)", {}),
    (PESAPAL, ipn(payment_account="abc"), "Payment account validation failed: Payment account too short", {}),
    (PESAPAL, ipn(payment_account="4000000000000002"), None,
     {"payment_account_token": shaped("4000000000000002", "567890")}),
    (PESAPAL, ipn(payment_account="254700000001", customer_email=" A@B.com "), None,
     {"payment_account_token": "PESAPAL_ACC_" + mac("254700000001")[:12],
      "customer_email_token": "PESAPAL_EMAIL_" + mac("a@b.com")[:16]}),
    (PESAPAL, ipn(), None, {"payment_status": "PENDING", "payment_method": "UNKNOWN", "currency": "KES"}),
    (PESAPAL, ipn(currency=None), None, {"currency": None}),
    (PESAPAL, "not json", "Parse failure - unknown format", {}),
]


@pytest.fixture(scope="module")
def wire(spark):
    rows = [
        (None, bytearray((m if isinstance(m, str) else json.dumps(m)).encode()), CONFIG.raw_topics[p], 0, i, RECEIVED)
        for i, (p, m, *_) in enumerate(CASES)
    ]
    rows.append((None, None, CONFIG.raw_topics[VISA], 0, len(CASES), RECEIVED))
    return spark.createDataFrame(rows, schemas.WIRE)


@pytest.fixture(scope="module")
def routed(wire):
    return jobs.tokenise_wire(wire, KEY, CONFIG).persist()


def test_every_message(routed):
    got = {r["offset"]: r for r in routed.collect()}
    assert len(got) == len(CASES)  # the record without a value is skipped
    for i, (provider, message, reason, columns) in enumerate(CASES):
        row = got[i]
        assert row.provider == provider
        assert row.error_reason == reason, message
        for name, value in columns.items():
            assert row[name] == value, (message, name)


def test_missing_id_is_a_digest_of_the_message(wire, routed):
    i = next(i for i, c in enumerate(CASES) if c[1] == {"bitmap": {"DE002": "4111111111111111"}})
    row = routed.where(F.col("offset") == i).first()
    assert row.transaction_id == hashlib.sha256(json.dumps(CASES[i][1]).encode()).hexdigest()
    assert row.event_time_ms == int(RECEIVED.timestamp() * 1000)


def test_no_secret_leaves_with_good_events(routed):
    secrets = ["4111111111111111", "5555555555554444", "254712345678", "0712345678", "A@B.com", "a@b.com",
               "a@b.c", "4000000000000002", "600123"]
    for record in sinks.tokenised_records(routed, CONFIG.tokenised_topics).collect():
        assert not any(s in record.value or s in (record.key or "") for s in secrets)
    good = routed.where("error_reason is null")
    assert good.where("raw is not null").count() == 0


def test_key_is_not_in_the_plan(wire, capsys):
    jobs.tokenise_wire(wire, KEY, CONFIG).explain("extended")
    text = capsys.readouterr().out
    block = KEY.ljust(64, b"\0")
    for pad in (0x36, 0x5C):
        assert bytes(b ^ pad for b in block).hex()[:20].upper() not in text.upper()
    assert KEY.decode() not in text


def test_mac_equals_the_standard_one(spark):
    for key in (b"k", b"x" * 64, b"y" * 100):
        df = spark.createDataFrame([("VISA", "4111"), ("VISA", "ünïcode")], "provider string, m string")
        got = crypto.with_keys(df, crypto.key_table(spark, key)).select("m", crypto.hmac_hex(F.col("m")).alias("h"))
        for r in got.collect():
            assert r.h == hmac.new(key, r.m.encode(), hashlib.sha256).hexdigest().upper()
    with pytest.raises(ValueError):
        crypto.key_table(spark, b"")


def test_dead_letters_keep_the_message(routed):
    letters = sinks.tokeniser_dead_letters(routed, CONFIG.dead_letter_topics).collect()
    assert len(letters) == sum(c[2] is not None for c in CASES)
    one = json.loads(next(r.value for r in letters if r.topic == "mpesa_dlq"))
    assert one["original_message"] == "not json" and one["service"] == "mpesa-tokeniser"


def test_gateway_email_check_is_optional(wire):
    strict = jobs.tokenise_wire(wire, KEY, CONFIG, check_gateway_email=True)
    assert validate.rejected(strict).count() >= sum(c[2] is not None for c in CASES)


def test_canonical_has_the_contract_columns(routed):
    canonical = jobs.canonical(validate.accepted(routed))
    assert canonical.columns == [*schemas.CANONICAL.fieldNames(), "error_reason"]
    assert [f.dataType for f in canonical.schema.fields[:-1]] == [f.dataType for f in schemas.CANONICAL.fields]
    assert canonical.where("error_reason is not null").count() == 0
