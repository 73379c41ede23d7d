"""The given ``events`` table as payments, stated once in SQL that Spark and DuckDB both run.

``TRANSACTIONS`` is the canonical shape, ``PAYMENTS`` the contents of raw provider messages. A third
of all transactions carry one card, so heavy keys are part of every check. Event times keep their
hour but are folded into three minutes of it, so that velocity rules fire.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, PROVIDERS, VISA, EngineConfig
from fraudspark.functions.plan import computed_once
from fraudspark.operators.parse import per_provider
from fraudspark.sources.refdata import CURRENCY_ROWS, MCC_ROWS
from fraudspark.sources.wire import with_min_partitions

# Rows of a task that makes and parses messages.
TASK_ROWS = 100_000

# The few functions that the two engines name differently.
_SPARK = {
    "us": "unix_micros(CAST(ts AS TIMESTAMP))",
    "k": "get_json_object(props, '$.k')",
    "iso": "date_format(timestamp_micros({0}), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
    "compact": "date_format(timestamp_micros({0}), 'yyyyMMddHHmmss')",
}
_DUCKDB = {
    "us": "epoch_us(ts)",
    "k": "json_extract_string(props, '$.k')",
    "iso": "strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S.%f')",
    "compact": "strftime(make_timestamp({0}), '%Y%m%d%H%M%S')",
}


def _cases(on: str, values: list[str | None]) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"CASE {on} % {len(values)} {arms} END"


_PROVIDER = _cases("event_id", list(PROVIDERS))
_EVENT_US = "{us} - {us} % 3600000000 + {us} % 180000000"
_AMOUNT = """CASE WHEN event_id % 53 = 0 THEN NULL
    WHEN event_id % 10 = 0 THEN CAST((1 + event_id % 7) * 1000 AS DOUBLE)
    WHEN event_id % 4 = 1 THEN round(value * 100) ELSE value END"""

_TRANSACTIONS = f"""
SELECT event_id, 'T' || lpad(CAST(event_id AS STRING), 12, '0') AS transaction_id,
  {_PROVIDER} AS provider, 'EVENT' AS source_type,
  CAST({_EVENT_US} AS BIGINT) AS event_us,
  CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'card-busy'
       ELSE 'card-' || CAST(user_id AS STRING) END AS card_token,
  {_cases("user_id", ["411111", "512345", "498765", "639301", "000000", None])} AS bin,
  lpad(CAST(user_id % 10000 AS STRING), 4, '0') AS last4,
  {_AMOUNT} AS amount,
  {_cases("event_id", [r[1] for r in CURRENCY_ROWS] + [None])} AS currency,
  {_cases("event_id", [r[0] for r in CURRENCY_ROWS] + ["999"])} AS currency_code,
  CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'merchant-busy'
       ELSE event_type || '-' || CAST(event_id % 40 AS STRING) END AS merchant_id,
  {_cases("event_id", [r[0] for r in MCC_ROWS] + ["1234"])} AS mcc,
  {_cases("event_id", ["01", "10", "81", "00", "05", "051", "071", None, "02"])} AS pos_entry_mode,
  {_cases("event_id", ["POS", "WEB", "MOBILE_APP", None])} AS channel,
  'cust-' || CAST(user_id AS STRING) AS customer_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'dev-' || {{k}} END AS device_fingerprint,
  {_cases("event_id", ["NOAUTH", "VBV", "3DS", "PIN", None, "OTP", None])} AS auth_model,
  value > 150 AS is_fraud, value / 5 AS risk_score,
  {_cases("event_id", ["VELOCITY_SPIKE", "MICRO_DEPOSIT", "UNUSUAL_AMOUNT", None])} AS fraud_pattern
FROM {{events}}
"""

_PAYMENTS = f"""
SELECT event_id, {_PROVIDER} AS provider, event_id % 97 AS noise, {_AMOUNT} AS amount,
  event_id % 79 = 3 AS bad_amount, CAST({{us}} AS BIGINT) AS us,
  {{iso_us}} AS sent_at, {{iso_record}} AS received_at, {{compact_us}} AS compact_time,
  'R' || CAST(event_id AS STRING) AS ref, event_type, user_id,
  CASE WHEN event_id % 31 = 4 THEN NULL
       WHEN event_id % 29 = 1 THEN '' WHEN event_id % 29 = 2 THEN '4111x11111111111'
       WHEN event_id % 29 = 3 THEN '411111111111'
       WHEN event_id % 7 = 1 THEN '412345' || lpad(CAST(user_id AS STRING), 9, '0') || CAST(event_id % 10 AS STRING)
       WHEN event_id % 7 = 2 THEN '4111-1111 1111-1111'
       ELSE {_cases("user_id", ["4111111111111111", "4012888888881881", "4242424242424242", "4000056655665556"])}
  END AS visa_pan,
  CASE WHEN event_id % 31 = 5 THEN NULL
       WHEN event_id % 29 = 4 THEN '555555555555444' WHEN event_id % 29 = 5 THEN '2220000000000000'
       WHEN event_id % 29 = 6 THEN '2721000000000000'
       WHEN event_id % 7 = 1 THEN '512345' || lpad(CAST(user_id AS STRING), 9, '0') || CAST(event_id % 10 AS STRING)
       ELSE {_cases("user_id", ["5555555555554444", "5105105105105100", "2223003122003222", "5200828282828210"])}
  END AS mastercard_pan,
  {_cases("event_id", ["404", "840", "826", "978", "710", "800", "156", None])} AS currency_code,
  {_cases("event_id", ["KES", "USD", "GBP", "EUR", "UGX", None])} AS currency,
  {_cases("event_id", ["5311", "5812", "6011", "7995", None])} AS mcc,
  {_cases("event_id", ["01", "02", "05", "07"])} AS entry_mode,
  'M' || CAST(event_id % 40 AS STRING) AS merchant,
  CASE WHEN event_id % 7 = 0 THEN '07' || lpad(CAST(user_id AS STRING), 8, '0')
       WHEN event_id % 7 = 1 THEN '7' || lpad(CAST(user_id AS STRING), 8, '0')
       WHEN event_id % 7 = 2 THEN '+254 7' || lpad(CAST(user_id AS STRING), 8, '0')
       WHEN event_id % 7 = 3 THEN '2547' || lpad(CAST(user_id AS STRING), 7, '0')
       WHEN event_id % 7 = 4 THEN '07x' || lpad(CAST(user_id AS STRING), 7, '0')
       WHEN event_id % 7 = 5 THEN NULL
       ELSE '2547' || lpad(CAST(user_id AS STRING), 8, '0') END AS phone,
  CASE WHEN event_id % 8 = 3 THEN NULL ELSE 600000 + user_id % 50 END AS short_code,
  event_id % 9 = 2 AS is_push,
  CASE WHEN event_id % 13 = 3 THEN NULL WHEN event_id % 17 = 3 THEN '52000' ELSE '520000' END AS first6,
  CASE WHEN event_id % 13 = 3 THEN NULL ELSE lpad(CAST(user_id % 10000 AS STRING), 4, '0') END AS last4,
  event_id % 4 = 1 AS in_authorization,
  CASE WHEN event_id % 6 = 1 THEN NULL ELSE user_id END AS customer_no,
  CASE WHEN event_id % 19 = 4 THEN 'user at example' WHEN event_id % 6 = 5 THEN NULL
       ELSE ' User' || CAST(user_id AS STRING) || '@Example.com' END AS email,
  CASE WHEN event_id % 29 = 9 THEN 'abc' WHEN event_id % 23 = 9 THEN NULL
       WHEN event_id % 2 = 0 THEN '4000' || lpad(CAST(user_id AS STRING), 12, '0')
       ELSE '2547' || lpad(CAST(user_id AS STRING), 8, '0') END AS account,
  'dev-' || {{k}} AS device,
  {_cases("event_id", ["NOAUTH", "VBV", "PIN"])} AS auth_model,
  {_cases("event_id", ["COMPLETED", "PENDING", "FAILED"])} AS payment_status,
  value > 150 AS is_fraud
FROM {{events}}
"""


def _fill(sql: str, dialect: dict[str, str]) -> str:
    us = dialect["us"]
    return sql.format(
        us=us,
        k=dialect["k"],
        events="{events}" if dialect is _SPARK else "events",
        iso_us=dialect["iso"].format(us),
        iso_record=dialect["iso"].format(f"({us} + 1000000)"),
        compact_us=dialect["compact"].format(us),
    )


DUCKDB_TRANSACTIONS = _fill(_TRANSACTIONS, _DUCKDB)
DUCKDB_PAYMENTS = _fill(_PAYMENTS, _DUCKDB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_of(events: DataFrame) -> DataFrame:
    """Canonical transactions of an ``events`` frame, batch or stream."""
    raw = _fill(_TRANSACTIONS, _SPARK).replace("{events}", "").rsplit("FROM", 1)[0]
    columns = _select_list(raw)
    return (
        events.selectExpr(*columns)
        .withColumn("event_timestamp", F.timestamp_micros("event_us"))
    )


def _select_list(select: str) -> list[str]:
    """Split ``SELECT a, b, ..`` at its top-level commas, for ``selectExpr`` on streams."""
    body, depth, quoted, parts, start = select.strip()[len("SELECT") :], 0, "", [], 0
    for i, ch in enumerate(body):
        if quoted:
            quoted = "" if ch == quoted else quoted
        elif ch in "'\"":
            quoted = ch
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        elif ch == "," and depth == 0:
            parts.append(body[start:i].strip())
            start = i + 1
    return [*parts, body[start:].strip()]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(table(spark, sf_dir, "events"))


def spread(events: DataFrame) -> DataFrame:
    """The events in tasks of bounded length: messages take far longer to make and parse than to read.

    The count comes from the footers of the files.
    """
    cores = events.sparkSession.sparkContext.defaultParallelism
    return with_min_partitions(events, max(cores, -(-events.count() // TASK_ROWS)), "event_id")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = spark.sql(_fill(_PAYMENTS, _SPARK), events=spread(table(spark, sf_dir, "events")))
    return computed_once(paid)


def _amount() -> Column:
    """Missing (null), malformed text, or a number; as JSON text."""
    return F.when(F.col("bad_amount"), F.lit("n/a")).otherwise(F.col("amount").cast("string"))


def _obj(**fields: Column | str) -> Column:
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def _card_message(pan: str, prefix: str) -> Column:
    bitmap = _obj(
        DE002=F.col(pan),
        DE003=F.lit("PURCHASE"),
        DE004=_amount(),
        DE011="ref",
        DE018="mcc",
        DE022="entry_mode",
        DE032=F.lit("77001"),
        DE033=F.lit("88001"),
        DE041=F.concat(F.lit("TERM"), F.col("merchant")),
        DE042="merchant",
        DE043="event_type",
        DE049="currency_code",
    )
    return F.to_json(
        _obj(
            source=F.lit(prefix),
            source_type=F.lit("ISO_8583"),
            message_type=F.lit("0100"),
            transaction_id="ref",
            bitmap=bitmap,
            timestamp="sent_at",
            event_time_ms=F.expr("us div 1000"),
            is_fraud="is_fraud",
        )
    )


def _mobile_message() -> Column:
    first = _obj(
        TransactionType=F.lit("CustomerPayBillOnline"),
        TransID="ref",
        TransTime="compact_time",
        TransAmount=_amount(),
        BusinessShortCode="short_code",
        BillRefNumber=F.concat(F.lit("INV"), F.col("ref")),
        MSISDN="phone",
        FirstName=F.lit("Ann"),
        LastName=F.lit("Example"),
        TransactionReceipt=F.concat(F.lit("RCT"), F.col("ref")),
    )
    push = _obj(
        Body=_obj(
            stkCallback=_obj(
                CheckoutRequestID="ref",
                PhoneNumber="phone",
                Amount=_amount(),
                MerchantRequestID="merchant",
                ResultCode=F.lit(0),
                ResultDesc=F.lit("ok"),
                MpesaReceiptNumber=F.concat(F.lit("PSH"), F.col("ref")),
            )
        )
    )
    outer = dict(timestamp="sent_at", event_time_ms=F.expr("us div 1000"), is_fraud="is_fraud")
    return F.when(F.col("is_push"), F.to_json(_obj(webhook_payload=push, **outer))).otherwise(
        F.to_json(_obj(webhook_payload=first, **outer))
    )


def _gateway_message() -> Column:
    card = F.when(F.col("first6").isNotNull(), _obj(first_6digits="first6", last_4digits="last4"))
    place = F.col("in_authorization")
    data = _obj(
        tx_ref=F.concat(F.lit("TX"), F.col("ref")),
        flw_ref=F.when(F.col("event_id") % 11 != 3, F.concat(F.lit("FLW"), F.col("ref"))),
        device_fingerprint="device",
        amount=_amount(),
        currency="currency",
        auth_model="auth_model",
        status=F.lit("successful"),
        processor_response=F.lit("Approved"),
        customer=_obj(id="customer_no", email="email", phone_number="phone"),
        card=F.when(~place, card),
        authorization=F.when(place, card),
    )
    return F.to_json(
        _obj(
            webhook_payload=_obj(event=F.lit("charge.completed"), data=data),
            timestamp="sent_at",
            event_time_ms=F.expr("us div 1000"),
            is_fraud="is_fraud",
        )
    )


def _ipn_message() -> Column:
    payload = _obj(
        pesapal_merchant_reference="merchant",
        pesapal_transaction_tracking_id=F.concat(F.lit("TRACK"), F.col("ref")),
        payment_status="payment_status",
        payment_method=F.lit("VISA"),
        amount=_amount(),
        currency="currency",
        confirmation_code=F.concat(F.lit("CODE"), F.col("ref")),
        payment_account="account",
        customer_email="email",
        customer_phone="phone",
        customer_first_name=F.lit("Ann"),
        customer_last_name=F.lit("Example"),
        description="event_type",
    )
    return F.to_json(
        _obj(
            ipn_payload=payload,
            timestamp="sent_at",
            event_time_ms=F.expr("us div 1000"),
            is_fraud="is_fraud",
        )
    )


def wire(paid: DataFrame, config: EngineConfig = EngineConfig()) -> DataFrame:
    """Raw wire records of payments: one topic per provider, some empty and some not JSON."""
    message = per_provider(
        {
            VISA: _card_message("visa_pan", "VISA"),
            MASTERCARD: _card_message("mastercard_pan", "MASTERCARD"),
            MPESA: _mobile_message(),
            FLUTTERWAVE: _gateway_message(),
            PESAPAL: _ipn_message(),
        }
    )
    text = F.when(F.col("noise") == 11, F.lit("not json")).when(F.col("noise") != 13, message)
    topic = per_provider({p: F.lit(t) for p, t in config.raw_topics.items()})
    records = paid.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(F.col("us") + 1_000_000).alias("timestamp"),
    )
    return computed_once(records)
