"""One query per operator over the given tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as o
from checks import workload as w
from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, VISA, EngineConfig, WindowSpec
from fraudspark.functions import crypto, text
from fraudspark.operators import (
    features,
    joins,
    normalise,
    parse,
    reports,
    state,
    tokenise,
    validate,
    velocity,
)
from fraudspark.plans import jobs
from fraudspark.plans.session import tune
from fraudspark.plans.storage import fresh_path
from fraudspark.sources import contract, exports, refdata, wire
from fraudspark.streaming import sinks
from fraudspark.streaming import state as stream_state
from fraudspark.streaming.publication import Publication, publishing
from fraudspark.streaming.ring import ring_velocity
from fraudspark.streaming.totals import RANK_ERROR, SKETCH_K, Totals, quantiles
from fraudspark.streaming.velocity import stream_velocity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CONFIG = replace(EngineConfig(), high_volume_merchant_over=o.VOLUME_OVER)


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# ---------------------------------------------------------------- inputs


def txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.transactions(spark, sf_dir)


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_reference(txns(spark, sf_dir), refdata.ReferenceTables(spark))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = velocity.velocity(txns(spark, sf_dir), CONFIG)
    return joins.join_reference(moved, refdata.ReferenceTables(spark)).transform(
        features.add_features, CONFIG
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = w.wire(w.payments(spark, sf_dir), CONFIG)
    return wire.with_min_partitions(records, spark.sparkContext.defaultParallelism)


def parsed(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    tagged = wire.tag_provider(raw(spark, sf_dir), CONFIG.raw_topics)
    return parse.parse_messages(normalise.only_provider(tagged, provider)).withColumnRenamed(
        "offset", "event_id"
    )


def routed(spark: SparkSession, sf_dir: str, provider: str | None = None) -> DataFrame:
    """All messages, or those of one provider's topic."""
    records = w.wire(w.payments(spark, sf_dir), CONFIG)
    if provider:
        records = records.where(F.col("topic") == CONFIG.raw_topics[provider])
    records = wire.with_min_partitions(records, spark.sparkContext.defaultParallelism)
    return jobs.tokenise_wire(records, o.CHECK_KEY, CONFIG)


def tokenised(spark: SparkSession, sf_dir: str, provider: str | None = None) -> DataFrame:
    return validate.accepted(routed(spark, sf_dir, provider)).withColumnRenamed("offset", "event_id")


def keyed(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    paid = normalise.only_provider(w.payments(spark, sf_dir), provider)
    return crypto.with_keys(paid, crypto.key_table(spark, o.CHECK_KEY))


def cents(c: str) -> Column:
    return F.round(F.col(c), 2).alias(c)


# ---------------------------------------------------------------- sources and sinks


def _stored_wire(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "wire")
    raw(spark, sf_dir).write.parquet(path)
    return path


def _drained(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Run a stream over what is available, into a table in the shared folder."""
    out = fresh_path(spark, "drained")
    started = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", fresh_path(spark, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query(
    "S1_read_stream",
    o.over_payments(
        "SELECT lower(provider) || '_raw' AS topic, COUNT(*) AS records, COUNT(*) FILTER (noise <> 13) AS filled, "
        "SUM(event_id) AS offsets FROM p GROUP BY ALL"
    ),
)
def _s1(spark, sf_dir):
    stream = wire.read_stream(spark, "parquet", {"maxFilesPerTrigger": "4"}, _stored_wire(spark, sf_dir))
    return (
        _drained(stream, spark)
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("value").alias("filled"),
            F.sum("offset").alias("offsets"),
        )
    )


@query(
    "S3_decode_by_topic",
    o.over_tokenised("SELECT provider, transaction_id, amount, currency, bin FROM k"),
)
def _s3(spark, sf_dir):
    records = sinks.tokenised_records(routed(spark, sf_dir), CONFIG.tokenised_topics)
    return wire.decode_tokenised(records, CONFIG.tokenised_topics).select(
        "provider", "transaction_id", "amount", "currency", "bin"
    )


@query(
    "S4_raw_consumer",
    o.over_payments("SELECT event_id, provider FROM p"),
)
def _s4(spark, sf_dir):
    stream = wire.read_stream(spark, "parquet", {"maxFilesPerTrigger": "4"}, _stored_wire(spark, sf_dir))
    tagged = wire.tag_provider(stream, CONFIG.raw_topics)
    return _drained(tagged.select(F.col("offset").alias("event_id"), "provider"), spark)


_KEY_SQL = (
    "CASE provider WHEN 'MPESA' THEN COALESCE(msisdn_token, transaction_id) WHEN 'FLUTTERWAVE' THEN "
    "COALESCE(card_token, customer_token, ref_token) WHEN 'PESAPAL' THEN transaction_id ELSE card_token END"
)


@query(
    "S5_tokenised_records",
    o.over_tokenised(
        f"SELECT {_KEY_SQL} AS key, lower(provider) || '_tokenised' AS topic, transaction_id FROM k"
    ),
)
def _s5(spark, sf_dir):
    return sinks.tokenised_records(routed(spark, sf_dir), CONFIG.tokenised_topics).select(
        "key", "topic", F.get_json_object("value", "$.transaction_id").alias("transaction_id")
    )


@query(
    "S6_tokeniser_dead_letters",
    o.over_routed(
        "SELECT event_id, lower(provider) || '_dlq' AS topic, error_reason, lower(provider) || '_raw' AS came_from, "
        "lower(provider) || '-tokeniser' AS service FROM r WHERE error_reason IS NOT NULL"
    ),
)
def _s6(spark, sf_dir):
    letters = sinks.tokeniser_dead_letters(routed(spark, sf_dir), CONFIG.dead_letter_topics)

    def of(name: str) -> Column:
        return F.get_json_object("value", f"$.{name}")

    return letters.select(
        of("offset").cast("bigint").alias("event_id"),
        "topic",
        of("error_reason").alias("error_reason"),
        of("topic").alias("came_from"),
        of("service").alias("service"),
    )


@query(
    "S7_enriched_records",
    o.over_scored(
        "SELECT card_token AS key, lower(provider) || '_enriched' AS topic, transaction_id, composite_risk_score FROM s"
    ),
)
def _s7(spark, sf_dir):
    records = sinks.enriched_records(scored(spark, sf_dir), CONFIG.enriched_topics)
    return records.select(
        "key",
        "topic",
        F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("value", "$.composite_risk_score").cast("int").alias("composite_risk_score"),
    )


@query(
    "S8_enrichment_dead_letters",
    o.over_transactions(
        "SELECT transaction_id, provider, 'Missing event_timestamp' AS error_reason, 'enrichment_dlq' AS topic "
        "FROM t WHERE event_id % 43 = 0"
    ),
)
def _s8(spark, sf_dir):
    broken = txns(spark, sf_dir).withColumn(
        "event_timestamp", F.when(F.col("event_id") % 43 != 0, F.col("event_timestamp"))
    )
    bad = validate.rejected(normalise.with_usability(broken))
    letters = sinks.enrichment_dead_letters(bad, CONFIG.enrichment_dlq_topic)
    return letters.select(
        *[
            F.get_json_object("value", f"$.{n}").alias(n)
            for n in ("transaction_id", "provider", "error_reason")
        ],
        "topic",
    )


@query(
    "S9_reference_tables",
    o.over_joined(
        "SELECT mcc_category, currency_region, bin_issuer, COUNT(*) AS records FROM j GROUP BY ALL"
    ),
)
def _s9(spark, sf_dir):
    return (
        joined(spark, sf_dir)
        .groupBy("mcc_category", "currency_region", "bin_issuer")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def _live_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest observed rate of each of some currencies, from the transactions."""
    return (
        txns(spark, sf_dir)
        .where(F.col("currency").isin("KES", "EUR", "INR"))
        .select(
            F.col("currency").alias("currency_alpha"),
            F.when(F.col("amount") > 50, F.col("amount") / 100).alias("fx_rate_to_usd"),
            F.col("event_id").alias("as_of"),
        )
    )


@query(
    "S10_fx_live_rates",
    o.over_joined(
        "SELECT currency_alpha, ROUND(COALESCE(l.rate, CAST(x.fx_rate_to_usd AS DOUBLE)), 8) AS fx_rate_to_usd "
        "FROM r_fx x LEFT JOIN (SELECT currency, arg_max(amount, event_id) / 100 AS rate FROM t "
        "WHERE currency IN ('KES', 'EUR', 'INR') AND amount > 50 GROUP BY currency) l ON x.currency_alpha = l.currency"
    ),
)
def _s10(spark, sf_dir):
    return refdata.fx_table(spark, _live_rates(spark, sf_dir)).select(
        "currency_alpha", F.round("fx_rate_to_usd", 8).alias("fx_rate_to_usd")
    )


@query(
    "S11_refresh_fx",
    o.over_joined(
        "SELECT j.transaction_id, ROUND(j.amount * COALESCE(l.rate, j.fx_rate_to_usd), 8) AS amount_usd FROM j "
        "LEFT JOIN (SELECT currency, arg_max(amount, event_id) / 100 AS rate FROM t "
        "WHERE currency IN ('KES', 'EUR', 'INR') AND amount > 50 GROUP BY currency) l ON j.currency = l.currency"
    ),
)
def _s11(spark, sf_dir):
    given: list[DataFrame] = []
    refs = refdata.ReferenceTables(spark, live_rates=lambda: given[0] if given else None)
    given.append(_live_rates(spark, sf_dir))
    refs.refresh_fx()
    return joins.join_fx(txns(spark, sf_dir), refs).select(
        "transaction_id", F.round("amount_usd", 8).alias("amount_usd")
    )


@query(
    "S12_json_export",
    o.over_transactions("SELECT transaction_id, provider, amount, currency, event_us, is_fraud FROM t"),
)
def _s12(spark, sf_dir):
    path = fresh_path(spark, "export")
    df = txns(spark, sf_dir).select(
        "transaction_id", "provider", "amount", "currency", "event_us", "is_fraud"
    )
    exports.write_json(df, path)
    return exports.read_json(spark, path, df.schema)


@query(
    "S12_wrapped_export",
    o.over_transactions("SELECT transaction_id, provider, amount, currency, event_us, is_fraud FROM t"),
)
def _s12_wrapped(spark, sf_dir):
    # One document in one file, read back by a task for every 50,000 bytes of it.
    path = fresh_path(spark, "wrapped")
    df = txns(spark, sf_dir).select("transaction_id", "provider", "amount", "currency", "event_us", "is_fraud")
    exports.write_wrapped_json(df, path, {"made_by": 'checks {[ \\"', "lists": [{"transactions": [{"transaction_id": "no"}]}]})
    return exports.read_wrapped_json(spark, path, df.schema, range_bytes=50_000)


_BROKEN = (
    {
        f: ("MISSING_FIELD", "TRUE")
        for f in "processing_timestamp amount_usd transaction_type status velocity_features aggregate_features risk_signals "
        "rule_triggers enrichment_latency_ms partition_key".split()
    }
    | {f: ("NULL_VALUE", f"{f} IS NULL") for f in "transaction_id provider amount currency is_fraud".split()}
    | {"event_timestamp": ("NULL_VALUE", "event_us IS NULL"), "customer_token": ("NULL_VALUE", "customer_id IS NULL")}
)
_CHANNEL = "channel NOT IN ('POS', 'ATM', 'ECOMMERCE', 'MOBILE', 'USSD', 'QR')"


@query(
    "S2_contract",
    o.over_transactions(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{f}' AS field, '{reason}' AS reason, COUNT(*) FILTER ({when}) AS rows FROM t"
            for f, reason, when in (
                *((f, *v) for f, v in _BROKEN.items()),
                ("payment_channel", "NULL_VALUE", "channel IS NULL"),
                ("payment_channel", "UNKNOWN_SYMBOL", _CHANNEL),
            )
        )
        + ") WHERE rows > 0"
    ),
)
def _s2(spark, sf_dir):
    folder = fresh_path(spark, "schemas")
    text = spark.createDataFrame([(contract.canonical_text(),)], "value string")
    text.coalesce(1).write.text(f"{folder}/visa_tokenised.avsc")
    read = contract.compiled(refdata.read_schema_text(spark, folder, VISA))
    found = {"payment_channel": "channel", "customer_token": "customer_id", "fraud_score": "risk_score"}
    return contract.violations(txns(spark, sf_dir), read.with_aliases(found))


@query(
    "S3_conform_to_contract",
    o.over_transactions(
        "SELECT transaction_id, provider, event_us, amount, currency, channel AS payment_channel, FALSE AS is_prepaid, "
        "COALESCE(is_fraud, FALSE) AS is_fraud, risk_score AS fraud_score, CAST(NULL AS BOOLEAN) AS risk_signal, "
        "CAST(NULL AS INTEGER) AS enrichment_latency_ms, "
        f"channel IS NULL OR {_CHANNEL} AS bad_channel FROM t WHERE is_fraud IS NOT NULL"
    ),
)
def _s3_conform(spark, sf_dir):
    found = {"payment_channel": "channel", "customer_token": "customer_id", "fraud_score": "risk_score"}
    read = contract.compiled(contract.canonical_text()).with_aliases(found)
    marked = contract.checked(txns(spark, sf_dir), read).where("is_fraud IS NOT NULL")
    rows = contract.conform(marked, contract.Contract(read.name, (*read.fields, contract.Field("violations", marked.schema["violations"].dataType))))
    return rows.select(
        "transaction_id", "provider", F.unix_micros("event_timestamp").alias("event_us"), "amount", "currency",
        "payment_channel", "is_prepaid", "is_fraud", "fraud_score", F.col("risk_signals")["x"].alias("risk_signal"),
        "enrichment_latency_ms", F.exists("violations", lambda v: v.startswith("payment_channel")).alias("bad_channel"),
    )


# ---------------------------------------------------------------- parsing and checks

# What every provider makes of a message that can't be read; empty records are no messages.
_UNREADABLE = {
    "transaction_id": "sha256('not json')",
    "timestamp": "received_at",
    "event_time_ms": "(us + 1000000) // 1000",
    "amount": "0.0",
}


def _parse_query(name: str, provider: str, columns: dict[str, str], error: str, unreadable: dict[str, str]):
    broken = _UNREADABLE | unreadable | {"parse_error": f"'{error}'"}
    # A number that is none makes a message unreadable too, but its other fields are there.
    bad = "bad_amount OR mastercard_pan IS NULL" if provider == MASTERCARD else "bad_amount"
    reason = "Parse failure" if provider == VISA else "Parse failure - unknown format"
    columns = columns | {"parse_error": f"CASE WHEN {bad} THEN '{reason}' END"}
    listed = ", ".join(
        f"CASE WHEN noise = 11 THEN {broken.get(c, 'NULL')} ELSE {sql} END AS {c}" for c, sql in columns.items()
    )

    @query(name, o.over_payments(f"SELECT event_id, {listed} FROM p WHERE provider = '{provider}' AND noise <> 13"))
    def _run(spark, sf_dir):
        return parsed(spark, sf_dir, provider).select("event_id", *columns)


_CARD_COLUMNS = {
    "transaction_id": "ref",
    "message_type": "'0100'",
    "timestamp": "sent_at",
    "event_time_ms": "us // 1000",
    "amount": o.AMOUNT,
    "currency_code": "COALESCE(currency_code, '404')",
    "merchant_id": "merchant",
    "terminal_id": "'TERM' || merchant",
    "merchant_name": "event_type",
    "mcc": "mcc",
    "transaction_type": "'PURCHASE'",
    "pos_entry_mode": "entry_mode",
    "stan": "ref",
    "acquirer_id": "'77001'",
    "is_fraud": "is_fraud",
}
_parse_query("P1_parse_visa", VISA, _CARD_COLUMNS | {"pan": "visa_pan"}, "Parse failure", {"currency_code": "'404'"})
_parse_query(
    "P2_parse_mastercard",
    MASTERCARD,
    _CARD_COLUMNS | {"pan": "NULLIF(mastercard_pan, '')", "forwarder_id": "'88001'"},
    "Parse failure - unknown format",
    {"currency_code": "'404'"},
)
_parse_query(
    "P3_parse_mpesa",
    MPESA,
    {
        "transaction_id": "ref",
        "transaction_type": "CASE WHEN is_push THEN 'STKPush' ELSE 'CustomerPayBillOnline' END",
        "msisdn": "phone",
        "amount": o.AMOUNT,
        "business_shortcode": o.SHORT_CODE,
        "bill_ref_number": "CASE WHEN NOT is_push THEN 'INV' || ref END",
        "transaction_receipt": "CASE WHEN NOT is_push THEN 'RCT' || ref END",
        "mpesa_receipt_number": "CASE WHEN is_push THEN 'PSH' || ref END",
        "merchant_request_id": "CASE WHEN is_push THEN merchant END",
        "result_code": "CASE WHEN is_push THEN '0' END",
        "event_time_ms": "us // 1000",
    },
    "JSON parse error",
    {},
)
_parse_query(
    "P4_mpesa_timestamp",
    MPESA,
    {
        "timestamp": "CASE WHEN is_push THEN sent_at ELSE strftime(strptime(compact_time, '%Y%m%d%H%M%S'), "
        "'%Y-%m-%dT%H:%M:%S') END"
    },
    "JSON parse error",
    {},
)
_parse_query(
    "P5_parse_flutterwave",
    FLUTTERWAVE,
    {
        "transaction_id": "COALESCE(CASE WHEN event_id % 11 <> 3 THEN 'FLW' || ref END, 'TX' || ref)",
        "event": "'charge.completed'",
        "bin": "COALESCE(first6, '')",
        "last4": "COALESCE(last4, '')",
        "customer_id": "COALESCE(CAST(customer_no AS VARCHAR), '')",
        "customer_email": "COALESCE(email, '')",
        "customer_phone": "COALESCE(phone, '')",
        "amount": o.AMOUNT,
        "currency": "COALESCE(currency, 'USD')",
        "status": "'successful'",
        "payment_type": "'card'",
        "device_fingerprint": "device",
        "auth_model": "auth_model",
        "timestamp": "sent_at",
    },
    "JSON parse error",
    dict.fromkeys(["event", "bin", "last4", "customer_id", "customer_email", "customer_phone", "status"], "''")
    | {"currency": "'USD'", "payment_type": "'card'"},
)
_parse_query(
    "P6_parse_pesapal",
    PESAPAL,
    {
        "transaction_id": "'TRACK' || ref",
        "merchant_reference": "merchant",
        "payment_status": "payment_status",
        "payment_method": "'VISA'",
        "amount": o.AMOUNT,
        "currency": "COALESCE(currency, 'KES')",
        "confirmation_code": "'CODE' || ref",
        "payment_account": "account",
        "customer_email": "email",
        "customer_phone": "phone",
        "description": "event_type",
        "timestamp": "sent_at",
    },
    "Parse failure - unknown format",
    {"currency": "'KES'", "payment_status": "'PENDING'", "payment_method": "'UNKNOWN'"},
)


@query(
    "P7_missing_id_and_time",
    o.over_payments(
        "SELECT event_id, sha256('{\"bitmap\":{\"DE002\":\"' || merchant || '\"}}') AS transaction_id, "
        "received_at AS timestamp, us // 1000 + 1000 AS event_time_ms FROM p WHERE provider = 'VISA'"
    ),
)
def _p7(spark, sf_dir):
    # Messages that hold nothing but a card number.
    bare = normalise.only_provider(w.payments(spark, sf_dir), VISA).select(
        F.lit(VISA).alias("provider"),
        F.concat(F.lit('{"bitmap":{"DE002":"'), "merchant", F.lit('"}}')).cast("binary").alias("value"),
        F.lit("visa_raw").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_micros(F.col("us") + 1_000_000).alias("timestamp"),
    )
    return parse.parse_messages(bare).select(
        F.col("offset").alias("event_id"), "transaction_id", "timestamp", "event_time_ms"
    )


def _check_query(name: str, provider: str | None, make: Callable[[], Column], sql: str):
    where = f" WHERE provider = '{provider}'" if provider else ""

    @query(name, o.over_payments(f"SELECT event_id, {sql} AS reason FROM p{where}"))
    def _run(spark, sf_dir):
        paid = w.payments(spark, sf_dir)
        chosen = normalise.only_provider(paid, provider) if provider else paid
        return chosen.select("event_id", make().alias("reason"))


_check_query("F1_validate_visa_pan", None, lambda: validate.visa_pan_reason(F.col("visa_pan")), o.visa_reason())
_check_query(
    "F2_validate_mastercard_pan",
    None,
    lambda: validate.mastercard_pan_reason(F.col("mastercard_pan")),
    o.mastercard_reason(),
)
_check_query(
    "F3_validate_partial_card",
    None,
    lambda: validate.partial_card_reason(F.col("first6"), F.col("last4")),
    o.partial_reason(),
)
_check_query(
    "F4_validate_customer_email",
    None,
    lambda: validate.loose_email_reason(F.col("email")),
    "CASE WHEN email <> '' AND NOT (email LIKE '%@%' AND email LIKE '%.%') THEN 'Invalid email format: ' || email END",
)
_check_query("F5_validate_msisdn", None, lambda: validate.msisdn_reason(F.col("phone")), o.msisdn_reason())
_check_query("F6_validate_email", None, lambda: validate.email_reason(F.col("email")), o.email_reason())
_check_query("F7_validate_phone", None, lambda: validate.phone_reason(F.col("phone")), o.phone_reason())
_check_query(
    "F8_validate_payment_account",
    None,
    lambda: validate.payment_account_reason(F.col("account")),
    o.account_reason(),
)


@query("F9_route_messages", o.over_routed("SELECT event_id, provider, error_reason FROM r"))
def _f9(spark, sf_dir):
    return routed(spark, sf_dir).select(F.col("offset").alias("event_id"), "provider", "error_reason")


@query(
    "F10_provider_filter",
    o.over_transactions("SELECT transaction_id, amount FROM t WHERE provider = 'PESAPAL'"),
)
def _f10(spark, sf_dir):
    return normalise.only_provider(txns(spark, sf_dir), PESAPAL).select("transaction_id", "amount")


# ---------------------------------------------------------------- tokens


def _token_query(name: str, provider: str, make: Callable[[], Column], sql: str, good: str = "TRUE"):
    where = f"provider = '{provider}' AND {good}"

    @query(name, o.over_payments(f"SELECT event_id, {sql} AS token FROM p WHERE {where}"))
    def _run(spark, sf_dir):
        return keyed(spark, sf_dir, provider).where(good).select("event_id", make().alias("token"))


_c = F.col
_token_query(
    "T1_visa_card_token",
    VISA,
    lambda: tokenise.visa_card_token(_c("visa_pan")),
    f"CASE WHEN length({o.card_digits('visa_pan')}) >= 13 THEN {o.TOKENS['visa']} END",
)
_token_query(
    "T2_mastercard_card_token",
    MASTERCARD,
    lambda: tokenise.mastercard_card_token(_c("mastercard_pan")),
    f"CASE WHEN length({o.card_digits('mastercard_pan')}) >= 13 THEN {o.TOKENS['mastercard']} END",
)
_token_query("T3_normalise_phone", MPESA, lambda: text.international_phone(_c("phone")), o.e164("phone"))
_token_query("T4_msisdn_token", MPESA, lambda: tokenise.msisdn_token(_c("phone")), o.TOKENS["msisdn"])
_token_query(
    "T5_account_token",
    MPESA,
    lambda: tokenise.account_token(_c("short_code").cast("string")),
    o.prefixed("MPESA_ACC_", "CAST(short_code AS VARCHAR)", 12),
)


def _flw_ref() -> Column:
    return F.when(F.col("event_id") % 11 != 3, F.concat(F.lit("FLW"), F.col("ref")))


_token_query(
    "T6_gateway_card_token",
    FLUTTERWAVE,
    lambda: tokenise.gateway_card_token(_c("first6"), _c("last4"), _flw_ref()),
    o.TOKENS["card"],
)
_token_query(
    "T7_customer_token",
    FLUTTERWAVE,
    lambda: tokenise.customer_token(_c("customer_no").cast("string"), _c("email"), _c("phone")),
    o.TOKENS["customer"],
)
_token_query(
    "T8_reference_token",
    FLUTTERWAVE,
    lambda: tokenise.reference_token(F.concat(F.lit("TX"), _c("ref"))),
    o.TOKENS["reference"],
)
_token_query(
    "T10_email_digest", FLUTTERWAVE, lambda: tokenise.email_digest(_c("email")), "substr(md5(email), 1, 16)"
)
_token_query("T11_email_token", PESAPAL, lambda: tokenise.email_token(_c("email")), o.TOKENS["email"])
_token_query("T12_phone_token", PESAPAL, lambda: tokenise.phone_token(_c("phone")), o.TOKENS["phone"])
_token_query(
    "T13_payment_account_token",
    PESAPAL,
    lambda: tokenise.payment_account_token(_c("account")),
    o.TOKENS["payment_account"],
)
_token_query(
    "T14_merchant_reference_token",
    PESAPAL,
    lambda: tokenise.merchant_reference_token(_c("merchant")),
    o.TOKENS["merchant"],
)


@query(
    "T9_card_token_or_reference",
    o.over_tokenised(
        f"SELECT event_id, card_token, {_KEY_SQL} AS message_key FROM k WHERE provider = 'FLUTTERWAVE'"
    ),
)
def _t9(spark, sf_dir):
    return tokenised(spark, sf_dir, FLUTTERWAVE).select("event_id", "card_token", "message_key")


@query(
    "T15_currency_letters",
    o.over_payments(
        "SELECT event_id, CASE COALESCE(currency_code, '') WHEN '840' THEN 'USD' WHEN '826' THEN 'GBP' "
        "WHEN '978' THEN 'EUR' WHEN '710' THEN 'ZAR' ELSE 'KES' END AS visa, "
        "CASE COALESCE(currency_code, '') WHEN '404' THEN 'KES' WHEN '826' THEN 'GBP' WHEN '978' THEN 'EUR' "
        "WHEN '710' THEN 'ZAR' WHEN '800' THEN 'UGX' ELSE 'USD' END AS mastercard FROM p"
    ),
)
def _t15(spark, sf_dir):
    return w.payments(spark, sf_dir).select(
        "event_id",
        tokenise.visa_currency(F.col("currency_code")).alias("visa"),
        tokenise.mastercard_currency(F.col("currency_code")).alias("mastercard"),
    )


_TOKENISED_COLUMNS = [
    "provider", "transaction_id", "amount", "currency", "currency_code", "card_token", "bin", "last4",
    "msisdn_token", "account_token", "transaction_role", "customer_token", "ref_token",
    "customer_email_hash", "customer_email_token", "customer_phone_token", "payment_account_token",
    "merchant_reference_token",
]


@query(
    "T16_tokenised_message",
    o.over_tokenised(f"SELECT event_id, {', '.join(_TOKENISED_COLUMNS)} FROM k"),
)
def _t16(spark, sf_dir):
    return tokenised(spark, sf_dir).select("event_id", *_TOKENISED_COLUMNS)


@query(
    "T17_masked_card",
    "SELECT c_custkey, '412345******' || right('412345' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || "
    "CAST(c_custkey % 10 AS VARCHAR), 4) AS masked FROM customer",
)
def _t17(spark, sf_dir):
    return w.table(spark, sf_dir, "customer").select(
        "c_custkey", text.masked_card(_customer_pan()).alias("masked")
    )


def _customer_pan() -> Column:
    key = F.col("c_custkey")
    return F.concat(
        F.lit("412345"), F.lpad(key.cast("string"), 9, "0"), (key % 10).cast("string")
    )


# ---------------------------------------------------------------- canonical transactions

_SECOND_US = "(us // 1000000) * 1000000"
_CANONICAL_SQL = {
    "provider": "provider",
    "transaction_id": "transaction_id",
    "source_type": "CASE provider WHEN 'MPESA' THEN 'DARAJA_WEBHOOK' WHEN 'FLUTTERWAVE' THEN 'WEBHOOK' "
    "WHEN 'PESAPAL' THEN 'IPN_CALLBACK' ELSE 'ISO_8583' END",
    "event_us": f"CASE WHEN provider = 'MPESA' AND NOT is_push THEN {_SECOND_US} ELSE us END",
    "event_time_ms": "us // 1000",
    "card_token": "CASE provider WHEN 'MPESA' THEN msisdn_token WHEN 'PESAPAL' THEN payment_account_token "
    "ELSE card_token END",
    "bin": "CASE provider WHEN 'MPESA' THEN '639301' WHEN 'PESAPAL' THEN '000000' ELSE bin END",
    "last4": "last4",
    "amount": "amount",
    "currency": "currency",
    "currency_code": "CASE provider WHEN 'MPESA' THEN '404' WHEN 'FLUTTERWAVE' THEN CASE currency "
    "WHEN 'KES' THEN '404' WHEN 'USD' THEN '840' WHEN 'GBP' THEN '826' WHEN 'EUR' THEN '978' WHEN 'UGX' THEN '800' END "
    "WHEN 'PESAPAL' THEN CASE currency WHEN 'KES' THEN '404' WHEN 'USD' THEN '840' WHEN 'GBP' THEN '826' "
    "WHEN 'EUR' THEN '978' WHEN 'UGX' THEN '800' END ELSE currency_code END",
    "merchant_id": "CASE provider WHEN 'MPESA' THEN account_token WHEN 'FLUTTERWAVE' THEN 'UNKNOWN' "
    "WHEN 'PESAPAL' THEN merchant_reference_token ELSE merchant END",
    "mcc": "CASE provider WHEN 'MPESA' THEN '4814' WHEN 'FLUTTERWAVE' THEN '5999' WHEN 'PESAPAL' THEN '5999' ELSE mcc END",
    "transaction_type": "CASE provider WHEN 'MPESA' THEN CASE WHEN is_push THEN 'STKPush' ELSE "
    "'CustomerPayBillOnline' END ELSE 'PURCHASE' END",
    "pos_entry_mode": "CASE provider WHEN 'MPESA' THEN NULL WHEN 'FLUTTERWAVE' THEN '01' WHEN 'PESAPAL' THEN '01' "
    "ELSE entry_mode END",
    "channel": "CASE provider WHEN 'MPESA' THEN 'MOBILE_APP' WHEN 'FLUTTERWAVE' THEN 'WEB' WHEN 'PESAPAL' THEN 'WEB' "
    "ELSE 'POS' END",
    "customer_id": "CASE provider WHEN 'MPESA' THEN msisdn_token WHEN 'PESAPAL' THEN payment_account_token "
    "ELSE card_token END",
    "device_fingerprint": "CASE provider WHEN 'FLUTTERWAVE' THEN device END",
    "payment_method": "CASE provider WHEN 'MPESA' THEN 'MOBILE_MONEY' ELSE 'CARD' END",
    "auth_model": "CASE provider WHEN 'FLUTTERWAVE' THEN auth_model END",
    "status": "CASE provider WHEN 'FLUTTERWAVE' THEN 'successful' WHEN 'PESAPAL' THEN payment_status ELSE 'APPROVED' END",
    "stan": "CASE provider WHEN 'MPESA' THEN CASE WHEN is_push THEN 'PSH' || ref ELSE 'RCT' || ref END "
    "WHEN 'FLUTTERWAVE' THEN transaction_id WHEN 'PESAPAL' THEN transaction_id ELSE ref END",
    "is_fraud": "is_fraud",
}
_CANONICAL_LIST = ", ".join(f"{sql} AS {c}" for c, sql in _CANONICAL_SQL.items())


def _canonical(spark, sf_dir, provider: str | None = None) -> DataFrame:
    return (
        jobs.canonical(validate.accepted(routed(spark, sf_dir, provider)))
        .withColumn("event_us", F.unix_micros("event_timestamp"))
        .select(*_CANONICAL_SQL)
    )


@query("N1_normalise", o.over_tokenised(f"SELECT {_CANONICAL_LIST} FROM k"))
def _n1(spark, sf_dir):
    return _canonical(spark, sf_dir)


def _mapping_query(name: str, provider: str):
    @query(name, o.over_tokenised(f"SELECT {_CANONICAL_LIST} FROM k WHERE k.provider = '{provider}'"))
    def _run(spark, sf_dir):
        return _canonical(spark, sf_dir, provider)


for _n, _p in (("N2_visa", VISA), ("N3_mastercard", MASTERCARD), ("N4_mpesa", MPESA),
               ("N5_flutterwave", FLUTTERWAVE), ("N6_pesapal", PESAPAL)):
    _mapping_query(f"{_n}_mapping", _p)


@query(
    "N7_event_time",
    o.over_payments(
        "SELECT event_id, CASE event_id % 3 WHEN 0 THEN us WHEN 1 THEN (us // 1000) * 1000 END AS event_us FROM p"
    ),
)
def _n7(spark, sf_dir):
    kind = F.col("event_id") % 3
    written = F.when(kind == 0, F.col("sent_at")).otherwise(F.lit("no time"))
    millis = F.when(kind == 1, F.expr("us div 1000"))
    return w.payments(spark, sf_dir).select(
        "event_id", F.unix_micros(normalise.event_time(written, millis)).alias("event_us")
    )


@query(
    "U1_union",
    o.over_transactions("SELECT transaction_id, provider FROM t"),
)
def _u1(spark, sf_dir):
    t = txns(spark, sf_dir)
    return normalise.union_of(
        *[normalise.only_provider(t, p) for p in (VISA, MASTERCARD, MPESA, FLUTTERWAVE, PESAPAL)]
    ).select("transaction_id", "provider")


# ---------------------------------------------------------------- joins


def _join_query(name: str, step, columns: list[str]):
    @query(name, o.over_joined(f"SELECT transaction_id, {', '.join(columns)} FROM j"))
    def _run(spark, sf_dir):
        return step(txns(spark, sf_dir), refdata.ReferenceTables(spark)).select("transaction_id", *columns)


_MCC = ["mcc", "mcc_description", "mcc_category", "is_high_risk_mcc"]
_CURRENCY = ["currency_code", "currency_alpha", "currency_name", "currency_region"]
_FX = ["currency", "fx_rate_to_usd", "amount_usd"]
_BIN = ["bin", "bin_brand", "bin_card_type", "bin_country", "bin_issuer", "bin_prepaid"]
_join_query("J1_join_mcc", joins.join_mcc, _MCC)
_join_query("J2_join_currency", joins.join_currency, _CURRENCY)
_join_query("J3_join_fx", joins.join_fx, _FX)
_join_query("J4_join_bin", joins.join_bin, _BIN)
_join_query("J5_join_reference", joins.join_reference, _MCC + _CURRENCY + _FX + _BIN)

# Rates quoted over time: every fiftieth event quotes its currency, to the dollar.
_QUOTES_SQL = (
    "SELECT currency AS currency_alpha, event_us AS as_of, MAX(0.5 + (event_id % 997) / 1000.0) AS fx_rate_to_usd FROM t "
    "WHERE event_id % 50 = 0 AND currency IS NOT NULL AND event_us IS NOT NULL GROUP BY ALL"
)


@query(
    "J3_fx_as_of",
    o.over_joined(
        f"SELECT j.transaction_id, ROUND(COALESCE(q.fx_rate_to_usd, j.fx_rate_to_usd), 8) AS fx_rate_to_usd, "
        "ROUND(j.amount * COALESCE(q.fx_rate_to_usd, j.fx_rate_to_usd), 8) AS amount_usd FROM j "
        f"ASOF LEFT JOIN ({_QUOTES_SQL}) q ON j.currency = q.currency_alpha AND j.event_us >= q.as_of"
    ),
)
def _j3_as_of(spark, sf_dir):
    rows = txns(spark, sf_dir)
    quoted = rows.where("event_id % 50 = 0").select(
        F.col("currency").alias("currency_alpha"), F.col("event_timestamp").alias("as_of"),
        (0.5 + F.col("event_id") % 997 / 1000.0).alias("fx_rate_to_usd"),
    )
    joined = joins.join_reference(rows, refdata.ReferenceTables(spark), quoted)
    return joined.select(
        "transaction_id", F.round("fx_rate_to_usd", 8).alias("fx_rate_to_usd"), F.round("amount_usd", 8).alias("amount_usd")
    )


_VELOCITY_SQL = {
    "card_txn_count_1min": "card_txn_count_1min",
    "card_txn_sum_1min": "ROUND(card_txn_sum_1min, 2)",
    "card_txn_count_5min": "card_txn_count_5min",
    "card_amount_sum_5min": "ROUND(card_amount_sum_5min, 2)",
    "card_txn_count_1hr": "card_txn_count_1hr",
    "card_amount_sum_1hr": "ROUND(card_amount_sum_1hr, 2)",
    "card_amount_avg_1hr": "ROUND(card_amount_avg_1hr, 5)",
    "card_amount_max_1hr": "card_amount_max_1hr",
    "merchant_txn_count_1hr": "merchant_txn_count_1hr",
    "merchant_amount_sum_1hr": "ROUND(merchant_amount_sum_1hr, 2)",
}


def _rounded(name: str) -> Column:
    digits = 5 if "_avg_" in name else 2
    return F.round(name, digits).alias(name) if "_sum_" in name or "_avg_" in name else F.col(name)


def _velocity_query(name: str, columns: list[str], step):
    listed = ", ".join(f"{_VELOCITY_SQL[c]} AS {c}" for c in columns)

    @query(name, o.over_scored(f"SELECT transaction_id, {listed} FROM s"))
    def _run(spark, sf_dir):
        return step(txns(spark, sf_dir)).select("transaction_id", *[_rounded(c) for c in columns])


def _card_window(index: int):
    config = replace(CONFIG, card_windows=(CONFIG.card_windows[index],))
    return lambda df: velocity.card_velocity(df, config)


_velocity_query("V1_card_velocity_1min", ["card_txn_count_1min", "card_txn_sum_1min"], _card_window(0))
_velocity_query("V2_card_velocity_5min", ["card_txn_count_5min", "card_amount_sum_5min"], _card_window(1))
_velocity_query(
    "V3_card_velocity_1hr",
    ["card_txn_count_1hr", "card_amount_sum_1hr", "card_amount_avg_1hr", "card_amount_max_1hr"],
    _card_window(2),
)
_velocity_query(
    "V4_merchant_velocity_1hr",
    ["merchant_txn_count_1hr", "merchant_amount_sum_1hr"],
    lambda df: velocity.merchant_velocity(df, CONFIG),
)
_velocity_query("J6_velocity_join_back", list(_VELOCITY_SQL), lambda df: velocity.velocity(df, CONFIG))


@query(
    "V5_velocity_defaults",
    o.over_transactions(
        "SELECT transaction_id, 1 AS card_txn_count_1hr, CAST(NULL AS DOUBLE) AS card_amount_sum_1hr FROM t "
        "WHERE card_token IS NULL"
    ),
)
def _v5(spark, sf_dir):
    return (
        velocity.card_velocity(txns(spark, sf_dir), CONFIG)
        .where(F.col("card_token").isNull())
        .select("transaction_id", "card_txn_count_1hr", "card_amount_sum_1hr")
    )


_DAY_WINDOWS = (
    WindowSpec(o.HOUR, count="n_hour", total="sum_hour"),
    WindowSpec(o.DAY, count="n_day", total="sum_day", largest="max_day"),
)


@query(
    "V6_wider_windows",
    o.over_transactions(
        "SELECT transaction_id, "
        + ", ".join(
            f"{sql} AS {c}"
            for c, sql in {
                "n_hour": o._count("card_token", o.HOUR),
                "sum_hour": f"ROUND({o._over('SUM(amount)', 'card_token', o.HOUR)}, 2)",
                "n_day": o._count("card_token", o.DAY),
                "sum_day": f"ROUND({o._over('SUM(amount)', 'card_token', o.DAY)}, 2)",
                "max_day": o._over("MAX(amount)", "card_token", o.DAY),
            }.items()
        )
        + " FROM t"
    ),
)
def _v6(spark, sf_dir):
    # A low limit makes the busiest groups take the broadcast path.
    config = replace(CONFIG, hot_groups_max=100, hot_group_min_rows=5)
    return velocity.add_velocity(
        txns(spark, sf_dir), "card_token", _DAY_WINDOWS, config=config
    ).select("transaction_id", "n_hour", cents("sum_hour"), "n_day", cents("sum_day"), "max_day")


# ---------------------------------------------------------------- features

_FEATURE_IDS = {
    "G1_is_high_value": ["is_high_value"],
    "G2_is_cnp": ["is_cnp"],
    "G3_is_unusual_hour": ["is_unusual_hour"],
    "G4_is_weekend": ["is_weekend"],
    "G5_is_cross_border": ["is_cross_border"],
    "G6_calendar_fields": ["txn_hour", "txn_day_of_week", "txn_day_of_month", "txn_month"],
    "G7_is_business_hours": ["is_business_hours"],
    "G8_is_late_night": ["is_late_night"],
    "G9_is_month_end": ["is_month_end"],
    "G10_event_unix_ts": ["event_unix_ts"],
    "G11_is_international": ["is_international"],
    "G12_is_cross_border_currency": ["is_cross_border_currency"],
    "G14_is_amount_spike": ["is_amount_spike"],
    "G15_is_rapid_succession": ["is_rapid_succession"],
    "G16_is_high_velocity": ["is_high_velocity"],
    "G17_is_round_amount": ["is_round_amount"],
    "G18_is_micro_transaction": ["is_micro_transaction"],
    "G19_is_card_not_present": ["is_card_not_present"],
    "G20_is_chip_transaction": ["is_chip_transaction"],
    "G21_has_device_fingerprint": ["has_device_fingerprint"],
    "G22_is_high_volume_merchant": ["is_high_volume_merchant"],
    "G23_prepaid_at_high_risk_mcc": ["prepaid_at_high_risk_mcc"],
    "G24_is_high_value_atm": ["is_high_value_atm"],
    "G25_composite_risk_score": ["composite_risk_score"],
}
_NEEDS_VELOCITY = {"G14", "G15", "G16", "G22", "G25"}
_PROJECTIONS = (
    features.derived_signals,
    features.temporal_features,
    features.location_features,
    features.network_features,
    features.merchant_features,
    features.behaviour_features,
)


def _one_projection(df: DataFrame, columns: list[str]) -> DataFrame:
    made = {}
    for group in _PROJECTIONS:
        made |= group(CONFIG)
    return df.select("transaction_id", *[made[c].alias(c) for c in columns])


def _feature_query(name: str, columns: list[str]):
    @query(name, o.over_scored(f"SELECT transaction_id, {', '.join(columns)} FROM s"))
    def _run(spark, sf_dir):
        if name.split("_")[0] in _NEEDS_VELOCITY:
            return scored(spark, sf_dir).select("transaction_id", *columns)
        return _one_projection(joined(spark, sf_dir), columns)


for _name, _columns in _FEATURE_IDS.items():
    _feature_query(_name, _columns)


@query(
    "G13_amount_vs_avg_ratio",
    o.over_scored("SELECT transaction_id, ROUND(ratio, 5) AS amount_vs_avg_ratio FROM s"),
)
def _g13(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "transaction_id", F.round("amount_vs_avg_ratio", 5).alias("amount_vs_avg_ratio")
    )


@query(
    "G26_metadata",
    o.over_transactions("SELECT transaction_id, '1.0' AS enrichment_version, TRUE AS stamped FROM t"),
)
def _g26(spark, sf_dir):
    return features.add_metadata(txns(spark, sf_dir), CONFIG).select(
        "transaction_id",
        "enrichment_version",
        (F.col("enrichment_timestamp") == F.col("pipeline_enrichment_ts")).alias("stamped"),
    )


@query(
    "G27_packed_columns",
    o.over_scored(
        "SELECT transaction_id, card_txn_count_1hr AS n_hour, ROUND(card_amount_sum_1hr, 2) AS sum_hour, is_cnp AS cnp, "
        "concat_ws(',', CASE WHEN is_high_risk_mcc THEN 'is_high_risk_mcc' END, "
        "CASE WHEN is_international THEN 'is_international' END, CASE WHEN is_late_night THEN 'is_late_night' END, "
        "CASE WHEN is_amount_spike THEN 'is_amount_spike' END, "
        "CASE WHEN is_rapid_succession THEN 'is_rapid_succession' END, "
        "CASE WHEN is_card_not_present THEN 'is_card_not_present' END, "
        "CASE WHEN is_cross_border_currency THEN 'is_cross_border_currency' END, "
        "CASE WHEN is_high_velocity THEN 'is_high_velocity' END, "
        "CASE WHEN prepaid_at_high_risk_mcc THEN 'prepaid_at_high_risk_mcc' END, "
        "CASE WHEN is_micro_transaction THEN 'is_micro_transaction' END) AS triggers FROM s"
    ),
)
def _g27(spark, sf_dir):
    packed = features.add_packed_columns(scored(spark, sf_dir), CONFIG)
    return packed.select(
        "transaction_id",
        F.col("velocity_features")["card_txn_count_1hr"].alias("n_hour"),
        F.round(F.col("aggregate_features")["card_amount_sum_1hr"], 2).alias("sum_hour"),
        F.col("risk_signals")["is_cnp"].alias("cnp"),
        F.array_join("rule_triggers", ",").alias("triggers"),
    )


# ---------------------------------------------------------------- reports


@query("A1_records_per_provider", o.over_transactions("SELECT provider, COUNT(*) AS records FROM t GROUP BY ALL"))
def _a1(spark, sf_dir):
    return reports.records_per_provider(txns(spark, sf_dir))


@query(
    "A2_high_risk_per_provider",
    o.over_scored(
        "SELECT provider, COUNT(*) AS high_risk FROM s WHERE composite_risk_score > 50 GROUP BY provider"
    ),
)
def _a2(spark, sf_dir):
    return reports.high_risk_per_provider(scored(spark, sf_dir), CONFIG)


@query("A3_batch_size", "SELECT COUNT(*) AS batch_size FROM events")
def _a3(spark, sf_dir):
    return reports.batch_size(txns(spark, sf_dir))


_LATENCY = "((event_id * 37) % 3000) / 1000.0"


@query(
    "A4_latency_histogram",
    o.over_transactions(
        f"SELECT provider, CASE WHEN {_LATENCY} <= 0.05 THEN 0.05 WHEN {_LATENCY} <= 0.1 THEN 0.1 "
        f"WHEN {_LATENCY} <= 0.2 THEN 0.2 WHEN {_LATENCY} <= 0.5 THEN 0.5 WHEN {_LATENCY} <= 1.0 THEN 1.0 "
        f"WHEN {_LATENCY} <= 2.0 THEN 2.0 END::DOUBLE AS le, COUNT(*) AS records FROM t GROUP BY ALL"
    ),
)
def _a4(spark, sf_dir):
    late = F.col("event_timestamp") + F.make_dt_interval(
        secs=((F.col("event_id") * 37) % 3000).cast("decimal(10,0)") / 1000
    )
    timed = txns(spark, sf_dir).withColumn("pipeline_enrichment_ts", late)
    return reports.latency_histogram(timed, config=CONFIG)


_KINDS = {
    "card_tokens": "card_token", "msisdn_tokens": "msisdn_token", "account_tokens": "account_token",
    "customer_tokens": "customer_token", "ref_tokens": "ref_token",
    "customer_email_tokens": "customer_email_token", "customer_phone_tokens": "customer_phone_token",
    "payment_account_tokens": "payment_account_token",
    "merchant_reference_tokens": "merchant_reference_token",
}


@query(
    "A5_tokeniser_counters",
    o.over_tokenised(
        "SELECT c.*, " + ", ".join(f"d.{n}" for n in _KINDS) + " FROM (SELECT provider, COUNT(*) AS consumed, "
        "COUNT(*) FILTER (error_reason IS NULL) AS tokenised, COUNT(error_reason) AS dead_letters FROM r "
        "GROUP BY provider) c JOIN (SELECT provider, "
        + ", ".join(f"COUNT({c}) AS {n}" for n, c in _KINDS.items())
        + " FROM k GROUP BY provider) d USING (provider)"
    ),
)
def _a5(spark, sf_dir):
    return reports.tokeniser_counters(routed(spark, sf_dir))


@query(
    "A5_dead_letters_per_reason",
    o.over_routed(
        "SELECT provider, error_reason, COUNT(*) AS dead_letters FROM r WHERE error_reason IS NOT NULL GROUP BY ALL"
    ),
)
def _a5b(spark, sf_dir):
    return reports.dead_letters_per_reason(routed(spark, sf_dir))


@query(
    "A6_running_totals",
    o.over_transactions("SELECT provider, COUNT(*) AS records FROM t GROUP BY provider"),
)
def _a6(spark, sf_dir):
    # Three batches; the second one was written twice, the first time incompletely.
    t = txns(spark, sf_dir)
    batch = (F.col("event_id") % 3).alias("batch_id")
    whole = t.groupBy(batch, "provider").agg(F.count(F.lit(1)).alias("records"))
    first_try = whole.where("batch_id = 1").select(
        "batch_id", "provider", (F.col("records") - 1).alias("records"), F.lit(1).alias("written_at")
    )
    written = whole.withColumn("written_at", F.lit(2)).unionByName(first_try)
    return reports.running_totals(written, ["records"])


@query(
    "A7_fraud_per_source",
    o.over_transactions(
        "SELECT provider, COUNT(*) AS total, COUNT(*) FILTER (is_fraud) AS fraud, "
        "ROUND(COUNT(*) FILTER (is_fraud) * 100.0 / COUNT(*), 1) AS fraud_pct FROM t GROUP BY provider"
    ),
)
def _a7(spark, sf_dir):
    return reports.fraud_per_source(txns(spark, sf_dir), "provider")


@query(
    "A8_fraud_patterns",
    o.over_transactions(
        "SELECT COALESCE(fraud_pattern, 'UNKNOWN') AS fraud_pattern, COUNT(*) AS records FROM t WHERE is_fraud "
        "GROUP BY ALL ORDER BY records DESC, fraud_pattern"
    ),
)
def _a8(spark, sf_dir):
    return reports.fraud_patterns(txns(spark, sf_dir))


@query(
    "A9_fraud_summary",
    o.over_transactions(
        "SELECT COUNT(*) AS total, COUNT(*) FILTER (NOT is_fraud) AS normal, COUNT(*) FILTER (is_fraud) AS fraud, "
        "ROUND(AVG(CAST(is_fraud AS INT)), 4) AS fraud_rate FROM t"
    ),
)
def _a9(spark, sf_dir):
    return reports.fraud_summary(txns(spark, sf_dir))


_PAN_SQL = "'412345' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || CAST(c_custkey % 10 AS VARCHAR)"


@query(
    "A10_luhn_audit",
    f"SELECT COUNT(*) FILTER (NOT ({o.luhn('pan')})) AS invalid_pans FROM (SELECT {_PAN_SQL} AS pan FROM customer)",
)
def _a10(spark, sf_dir):
    pans = w.table(spark, sf_dir, "customer").select(_customer_pan().alias("pan"))
    return reports.invalid_card_numbers(pans)


@query(
    "A11_sample_per_source",
    o.over_transactions(
        "SELECT provider, transaction_id, amount, currency FROM t "
        "QUALIFY row_number() OVER (PARTITION BY provider ORDER BY transaction_id) = 1"
    ),
)
def _a11(spark, sf_dir):
    t = txns(spark, sf_dir).select("provider", "transaction_id", "amount", "currency")
    return reports.sample_per_source(t, "provider")


# ---------------------------------------------------------------- state over tables

_DEVICE_FOLD = """
WITH RECURSIVE t AS ({t}), e AS (
  SELECT customer_id, device_fingerprint, event_us, transaction_id, row_number() OVER (
    PARTITION BY customer_id, device_fingerprint ORDER BY event_us, transaction_id) AS n
  FROM t WHERE customer_id IS NOT NULL AND device_fingerprint IS NOT NULL),
walk AS (
  SELECT *, event_us AS set_at, FALSE AS seen FROM e WHERE n = 1
  UNION ALL
  SELECT e.*, CASE WHEN e.event_us >= w.set_at + {ttl} THEN e.event_us ELSE w.set_at END,
    e.event_us < w.set_at + {ttl}
  FROM walk w JOIN e ON e.customer_id = w.customer_id AND e.device_fingerprint = w.device_fingerprint
    AND e.n = w.n + 1)
SELECT t.transaction_id, walk.seen AS device_seen_before FROM t LEFT JOIN walk USING (transaction_id)
"""


_MERCHANT_CHAIN = f"""
WITH RECURSIVE t AS ({w.DUCKDB_TRANSACTIONS}),
f AS (SELECT merchant_id, event_us, min(transaction_id) AS first FROM t WHERE merchant_id IS NOT NULL AND event_us IS NOT NULL GROUP BY ALL),
walk AS (
  SELECT merchant_id, min(event_us) AS at FROM f GROUP BY merchant_id
  UNION ALL
  SELECT w.merchant_id, (SELECT min(f.event_us) FROM f WHERE f.merchant_id = w.merchant_id AND f.event_us >= w.at + {o.HOUR})
  FROM walk w WHERE w.at IS NOT NULL)
SELECT t.transaction_id, CASE WHEN t.merchant_id IS NOT NULL AND t.event_us IS NOT NULL
  THEN coalesce(t.transaction_id <> s.first, TRUE) END AS merchant_seen_before
FROM t LEFT JOIN (SELECT f.* FROM f JOIN walk ON f.merchant_id = walk.merchant_id AND f.event_us = walk.at) s
  ON t.merchant_id = s.merchant_id AND t.event_us = s.event_us
"""


def _device_sql(ttl_us: int) -> str:
    return _DEVICE_FOLD.format(t=w.DUCKDB_TRANSACTIONS, ttl=ttl_us)


@query("K1_device_history", _device_sql(90 * o.DAY))
def _k1(spark, sf_dir):
    return state.device_history(txns(spark, sf_dir), CONFIG).select("transaction_id", "device_seen_before")


@query("K1_device_history_expiring", _device_sql(4 * o.DAY))
def _k1_expiring(spark, sf_dir):
    config = replace(CONFIG, device_ttl_us=4 * o.DAY)
    return state.device_history(txns(spark, sf_dir), config).select("transaction_id", "device_seen_before")


@query("K1_device_history_hourly", _device_sql(o.HOUR))
def _k1_hourly(spark, sf_dir):
    config = replace(CONFIG, device_ttl_us=o.HOUR)
    return state.device_history(txns(spark, sf_dir), config).select("transaction_id", "device_seen_before")


@query("K1_merchant_history_hourly", _MERCHANT_CHAIN)
def _k1_merchant(spark, sf_dir):
    # Half of all rows have one merchant, whose chain has a link for nearly every hour.
    flagged = state.seen_before(txns(spark, sf_dir), ["merchant_id"], "merchant_seen_before", o.HOUR, config=CONFIG)
    return flagged.select("transaction_id", "merchant_seen_before")


_TRAILING_SQL = o.over_transactions(
    "SELECT transaction_id, CASE WHEN card_token IS NULL THEN 1 ELSE COUNT(*) OVER (PARTITION BY card_token "
    "ORDER BY event_us RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW) END AS card_txn_count_trailing FROM t"
)


@query("K2_trailing_count", _TRAILING_SQL)
def _k2(spark, sf_dir):
    return velocity.trailing_count(txns(spark, sf_dir)).select("transaction_id", "card_txn_count_trailing")


_FIRST_SQL = o.over_transactions(
    "SELECT transaction_id, CASE WHEN merchant_id IS NOT NULL THEN row_number() OVER (PARTITION BY merchant_id "
    "ORDER BY event_us, transaction_id) = 1 END AS is_merchant_first_seen FROM t"
)


@query("K3_merchant_first_seen", _FIRST_SQL)
def _k3(spark, sf_dir):
    return state.merchant_first_seen(txns(spark, sf_dir)).select("transaction_id", "is_merchant_first_seen")


def _shared_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose ids repeat, within a provider and between providers."""
    shared = F.concat(F.lit("S"), (F.col("event_id") % 500).cast("string"))
    return txns(spark, sf_dir).withColumn("transaction_id", shared)


def _shared_sql(keys: str, flag: str, name: str) -> str:
    first = f"rank() OVER (PARTITION BY {keys} ORDER BY event_us, 'S' || CAST(event_id % 500 AS VARCHAR))"
    usable = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return o.over_transactions(f"SELECT event_id, CASE WHEN {usable} THEN {first} {flag} 1 END AS {name} FROM t")


@query("K1_device_history_shared_ids", _shared_sql("customer_id, device_fingerprint", ">", "device_seen_before"))
def _k1_shared(spark, sf_dir):
    return state.device_history(_shared_ids(spark, sf_dir), CONFIG).select("event_id", "device_seen_before")


@query("K3_merchant_first_seen_shared_ids", _shared_sql("merchant_id", "=", "is_merchant_first_seen"))
def _k3_shared(spark, sf_dir):
    return state.merchant_first_seen(_shared_ids(spark, sf_dir)).select("event_id", "is_merchant_first_seen")


# ---------------------------------------------------------------- streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of transactions; the glob serves one file and a folder alike."""
    schema = w.table(spark, sf_dir, "events").schema
    return w.transactions_of(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


_FUTURE_ID, _CLOSING_ID = -3, -6


def _event_parts(spark: SparkSession, sf_dir: str, parts: int) -> tuple[DataFrame, Column]:
    """The events and the number of their part, by rising time; those without a time are in the first."""
    events = w.table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    order = at - at % 3_600_000_000 + at % 180_000_000
    low, high = events.select(order.alias("us")).agg(F.min("us"), F.max("us")).first()
    number = F.least(F.floor((order - low) * parts / (high - low + 1)), F.lit(parts - 1))
    return events, F.coalesce(number, F.lit(0).cast("bigint"))


def _busy_event(events: DataFrame, row_id: int, when: str) -> DataFrame:
    """One event more of the busiest card, at the given time."""
    return events.limit(1).withColumns(
        {"event_id": F.lit(row_id).cast("bigint"), "ts": F.lit(when).cast(events.schema["ts"].dataType)}
    )


def _drained_in_batches(
    spark: SparkSession, batches: list[DataFrame], steps: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Run ``steps`` over events that arrive batch by batch, one micro-batch for each.

    All tasks write and read a batch; the query starts again for each of them from its checkpoint.
    """
    folder, out, progress = (fresh_path(spark, n) for n in ("batches", "drained", "progress"))
    schema = batches[0].schema
    for k, batch in enumerate(batches):
        batch.write.parquet(f"{folder}/b={k}")
        stream = steps(w.transactions_of(spark.readStream.schema(schema).parquet(f"{folder}/b=*")))
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _four_batches(spark: SparkSession, sf_dir: str, future: bool = False) -> list[DataFrame]:
    """The events in four parts, the second of them with an event from the far future if asked for."""
    events, number = _event_parts(spark, sf_dir, 4)
    parts = [events.where(number == k) for k in range(4)]
    if future:
        parts[1] = parts[1].unionByName(_busy_event(events, _FUTURE_ID, "2199-01-01 00:00:00"))
    return parts


_GIVEN = "transaction_id NOT LIKE '%-%'"


@query("K1_stream_device_history", _device_sql(90 * o.DAY))
def _k1_stream(spark, sf_dir):
    def flag(stream: DataFrame) -> DataFrame:
        return stream_state.stream_device_history(stream, CONFIG).select("transaction_id", "device_seen_before")

    return _drained_in_batches(spark, _four_batches(spark, sf_dir), flag)


@query("K2_stream_trailing_count", _TRAILING_SQL)
def _k2_stream(spark, sf_dir):
    def count(stream: DataFrame) -> DataFrame:
        return stream_state.stream_trailing_count(stream).select("transaction_id", "card_txn_count_trailing")

    return _drained_in_batches(spark, _four_batches(spark, sf_dir, future=True), count).where(_GIVEN)


@query("K3_stream_merchant_first_seen", _FIRST_SQL)
def _k3_stream(spark, sf_dir):
    def flag(stream: DataFrame) -> DataFrame:
        return stream_state.stream_merchant_first_seen(stream).select("transaction_id", "is_merchant_first_seen")

    return _drained_in_batches(spark, _four_batches(spark, sf_dir, future=True), flag).where(_GIVEN)


@query(
    "W1_stream_velocity",
    o.over_scored(
        "SELECT transaction_id, "
        + ", ".join(f"{sql} AS {c}" for c, sql in _VELOCITY_SQL.items())
        + " FROM s"
    ),
)
def _w1(spark, sf_dir):
    # Rows leave once their hour and the watermark have passed; a last event closes the last hour.
    events = w.table(spark, sf_dir, "events")
    batches = [events, _busy_event(events, _CLOSING_ID, "2199-01-01 00:00:00")]
    done = _drained_in_batches(spark, batches, lambda stream: stream_velocity(stream, CONFIG).drop("window"))
    return done.where(_GIVEN).select("transaction_id", *[_rounded(c) for c in _VELOCITY_SQL])


def _sofar(measure: str, key: str, width_us: int) -> str:
    order = f"PARTITION BY {key}, event_us // {width_us} ORDER BY event_us, transaction_id ROWS UNBOUNDED PRECEDING"
    return f"CASE WHEN {key} IS NOT NULL AND event_us IS NOT NULL THEN {measure} OVER ({order}) END"


def _ring_sql() -> dict[str, str]:
    made = {}
    for key, windows in (("card_token", CONFIG.card_windows), ("merchant_id", CONFIG.merchant_windows)):
        for v in windows:
            named = {v.count: "COUNT(*)", v.total: "SUM(amount)", v.mean: "AVG(amount)", v.largest: "MAX(amount)"}
            for name, measure in named.items():
                if name == v.count:
                    made[name] = f"COALESCE({_sofar(measure, key, v.width_us)}, 1)"
                elif name:
                    made[name] = f"ROUND({_sofar(measure, key, v.width_us)}, {5 if name == v.mean else 2})"
    return made


@query(
    "V1_stream_ring",
    o.over_transactions("SELECT transaction_id, " + ", ".join(f"{sql} AS {c}" for c, sql in _ring_sql().items()) + " FROM t"),
)
def _v1_ring(spark, sf_dir):
    done = _drained_in_batches(spark, _four_batches(spark, sf_dir), lambda stream: ring_velocity(stream, CONFIG))
    return done.where("late_reason IS NULL").select("transaction_id", *[_rounded(c) for c in _ring_sql()])


_AGAIN = -1_000_000
_PART_SQL = (
    "COALESCE(LEAST(FLOOR((event_us - MIN(event_us) OVER ()) * 4 / (MAX(event_us) OVER () - MIN(event_us) OVER () + 1)), 3), 0)"
)


@query(
    "W1_late_rows",
    o.over_transactions(
        f"SELECT event_id, late_reason, late_by_us FROM (SELECT *, {_PART_SQL} AS part FROM t) p, "
        "LATERAL (SELECT CAST(NULL AS VARCHAR) AS late_reason, CAST(NULL AS BIGINT) AS late_by_us) UNION ALL "
        f"SELECT {_AGAIN} - event_id, 'LATE_EVENT', seen // 1000 * 1000 - 60000000 - event_us FROM ("
        "SELECT *, MAX(event_us) FILTER (part <= 1) OVER () AS seen "
        f"FROM (SELECT *, {_PART_SQL} AS part FROM t)) WHERE part = 0 AND event_us IS NOT NULL AND event_id % 50 = 7"
    ),
)
def _w1_late(spark, sf_dir):
    # Every fiftieth event of the first part comes again, two parts too late, under another id.
    events, number = _event_parts(spark, sf_dir, 4)
    parts = _four_batches(spark, sf_dir)
    again = events.where((number == 0) & F.col("ts").isNotNull() & (F.col("event_id") % 50 == 7))
    parts[2] = parts[2].unionByName(again.withColumn("event_id", _AGAIN - F.col("event_id")))
    done = _drained_in_batches(spark, parts, lambda stream: ring_velocity(stream, CONFIG))
    return done.select("event_id", "late_reason", "late_by_us")


@query(
    "W2_tumbling_windows",
    o.over_transactions(
        "SELECT * FROM (SELECT provider, (event_us // 300000000) * 300000000 AS window_us, COUNT(*) AS records "
        "FROM t GROUP BY 1, 2) WHERE window_us + 300000000 <= (SELECT MAX(event_us) FROM t) - 60000000"
    ),
)
def _w2(spark, sf_dir):
    counted = (
        _event_stream(spark, sf_dir)
        .withWatermark("event_timestamp", CONFIG.watermark_delay)
        .groupBy("provider", F.window("event_timestamp", "5 minutes"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select("provider", F.unix_micros("window.start").alias("window_us"), "records")
    )
    return _drained(counted, spark)


@query("W3_timed_trigger", o.over_transactions("SELECT provider, COUNT(*) AS records FROM t GROUP BY provider"))
def _w3(spark, sf_dir):
    out = fresh_path(spark, "timed")
    counted = sinks.batch_table(out)
    started = sinks.start(
        _event_stream(spark, sf_dir),
        sinks.in_micro_batches(lambda df, i: counted(reports.records_per_provider(df), i)),
        fresh_path(spark, "progress"),
        every=CONFIG.trigger_interval,
    )
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    return spark.read.parquet(out).groupBy("provider").agg(F.sum("records").alias("records"))


@query("W4_checkpointed_append", o.over_transactions("SELECT transaction_id, amount FROM t"))
def _w4(spark, sf_dir):
    # The second run finds everything done in the checkpoint and adds nothing.
    out, progress = fresh_path(spark, "appended"), fresh_path(spark, "progress")
    append = sinks.append_to("parquet", path=out)
    for _ in range(2):
        stream = _event_stream(spark, sf_dir).select("transaction_id", "amount")
        sinks.start(stream, sinks.in_micro_batches(lambda df, _: append(df)), progress).awaitTermination()
    return spark.read.parquet(out)


@query(
    "X2_micro_batch_metrics",
    o.over_scored(
        "SELECT provider, COUNT(*) AS records, COUNT(*) FILTER (composite_risk_score > 50) AS high_risk "
        "FROM s GROUP BY provider"
    ),
)
def _x2(spark, sf_dir):
    out = fresh_path(spark, "metrics")
    refs, count = refdata.ReferenceTables(spark), sinks.write_metrics(out, CONFIG)

    def score_and_count(batch: DataFrame, batch_id: int) -> None:
        moved = joins.join_reference(velocity.velocity(batch, CONFIG), refs)
        count(moved.transform(features.add_features, CONFIG), batch_id)

    step = sinks.in_micro_batches(score_and_count)
    sinks.start(_event_stream(spark, sf_dir), step, fresh_path(spark, "progress")).awaitTermination()
    return reports.running_totals(spark.read.parquet(out), ["records", "high_risk"])


@query(
    "S7_committed_publication",
    o.over_scored(
        "SELECT 'records' AS channel, transaction_id AS name, CAST(composite_risk_score AS BIGINT) AS number FROM s "
        "WHERE event_id % 97 <> 5 UNION ALL SELECT 'dead_letters', transaction_id, NULL FROM s WHERE event_id % 97 = 5 "
        "UNION ALL SELECT 'metrics', provider, COUNT(*) FROM s GROUP BY provider"
    ),
)
def _s7_committed(spark, sf_dir):
    # The sink fails once, with two of three channels written; the batch is replayed and then gathered.
    out, progress = Publication(spark, fresh_path(spark, "published")), fresh_path(spark, "progress")
    refs, failed = refdata.ReferenceTables(spark), []

    def channels(batch: DataFrame):
        done = velocity.velocity(batch, CONFIG).transform(joins.join_reference, refs).transform(features.add_features, CONFIG)
        yield "records", done.where("event_id % 97 <> 5").select("transaction_id", "composite_risk_score")
        yield "dead_letters", done.where("event_id % 97 = 5").select("transaction_id")
        if not failed:
            failed.append(True)
            raise RuntimeError("the sink is down")
        yield "metrics", reports.records_per_provider(batch)

    def run() -> None:
        sinks.start(_event_stream(spark, sf_dir), publishing(out, channels), progress).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        if out.counts():
            raise
    run()
    out.compact()

    def told(channel: str, name: str, number: Column) -> DataFrame:
        return out.read(channel).select(F.lit(channel).alias("channel"), F.col(name).alias("name"), number.cast("bigint").alias("number"))

    return (
        told("records", "transaction_id", F.col("composite_risk_score"))
        .unionAll(told("dead_letters", "transaction_id", F.lit(None)))
        .unionAll(told("metrics", "provider", F.col("records")))
    )


def _life_totals(spark: SparkSession, sf_dir: str) -> Totals:
    """Five batches of events, folded twice, with replays of folded and of open batches in between."""
    kept = Totals(spark, fresh_path(spark, "totals"), ["records", "amount"], ("amounts",))

    def write(k: int) -> None:
        part = txns(spark, sf_dir).where(F.col("event_id") % 5 == k)
        sketch = F.kll_sketch_agg_double("amount", SKETCH_K).alias("amounts")
        kept.write(part.groupBy("provider").agg(F.count(F.lit(1)).alias("records"), F.sum("amount").alias("amount"), sketch), k)

    for k in (0, 1, 2, 2):
        write(k)
    kept.compact()
    for k in (0, 2, 3, 4):
        write(k)
    kept.compact()
    write(4)
    return kept


@query(
    "A6_compacted_totals",
    o.over_transactions("SELECT provider, COUNT(*) AS records, ROUND(SUM(amount), 2) AS amount FROM t GROUP BY provider"),
)
def _a6_compacted(spark, sf_dir):
    return _life_totals(spark, sf_dir).read().select("provider", "records", F.round("amount", 2).alias("amount"))


@query(
    "A4_merged_quantiles",
    o.over_transactions(
        "SELECT provider, CAST(r AS DOUBLE) AS rank, COUNT(amount) AS seen, TRUE AS within FROM t, (VALUES (0.5), (0.95), (0.99)) v(r) "
        "GROUP BY provider, r"
    ),
)
def _a4_merged(spark, sf_dir):
    # A quantile is right if the exact ranks of its value reach the one asked for, up to the sketch's error.
    found = quantiles(_life_totals(spark, sf_dir).read(), "amounts").select("provider", "rank", "seen", "value")
    held = txns(spark, sf_dir).where("amount IS NOT NULL").join(F.broadcast(found), "provider")
    below, upto = F.count_if(F.col("amount") < F.col("value")), F.count_if(F.col("amount") <= F.col("value"))
    near = (below / F.max("seen") <= F.col("rank") + RANK_ERROR) & (upto / F.max("seen") >= F.col("rank") - RANK_ERROR)
    return held.groupBy("provider", "rank").agg(F.max("seen").alias("seen"), near.alias("within"))


# ---------------------------------------------------------------- whole jobs


@query(
    "job_enrich",
    o.over_scored(
        "SELECT transaction_id, provider, composite_risk_score, ROUND(amount_usd, 8) AS amount_usd, is_international, "
        "card_txn_count_1hr, merchant_txn_count_1hr FROM s"
    ),
)
def job_enrich(spark, sf_dir):
    done = jobs.enrich(txns(spark, sf_dir), refdata.ReferenceTables(spark), CONFIG)
    return done.select(
        "transaction_id", "provider", "composite_risk_score", F.round("amount_usd", 8).alias("amount_usd"),
        "is_international", "card_txn_count_1hr", "merchant_txn_count_1hr",
    )


@query(
    "job_tokenise",
    o.over_tokenised(
        f"SELECT provider, COUNT(*) AS events, COUNT(DISTINCT {_KEY_SQL}) AS keys, ROUND(SUM(amount), 2) AS amount "
        "FROM k GROUP BY provider"
    ),
)
def _job_tokenise(spark, sf_dir):
    return (
        tokenised(spark, sf_dir)
        .groupBy("provider")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.countDistinct("message_key").alias("keys"),
            F.round(F.sum("amount"), 2).alias("amount"),
        )
    )
