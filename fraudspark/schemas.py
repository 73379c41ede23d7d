"""Column contracts: wire records, parsed and tokenised events, canonical and packed transactions."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _B, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    """Build a schema from (type, 'name name name!') groups; ``!`` marks a required column."""
    fields = []
    for dtype, names in groups:
        for name in names.split():
            fields.append(T.StructField(name.rstrip("!"), dtype, not name.endswith("!")))
    return T.StructType(fields)


WIRE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", _S),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", _L),
        T.StructField("timestamp", _TS),
    ]
)

LABELS = _struct((_B, "is_fraud"), (_D, "risk_score"), (_S, "fraud_pattern"))

# Tokenised event: the union of what the five providers publish, free of card numbers, phone
# numbers and e-mail addresses.
TOKENISED = T.StructType(
    _struct(
        (_S, "transaction_id source source_type message_type timestamp"),
        (_L, "event_time_ms"),
        (_S, "tokenisation_timestamp tokenisation_method"),
        (_D, "amount"),
        (_S, "currency currency_code transaction_type"),
        # card networks
        (_S, "card_token bin last4 merchant_id merchant_name terminal_id mcc"),
        (_S, "pos_entry_mode stan acquirer_id forwarder_id"),
        # mobile money
        (_S, "msisdn_token account_token bill_ref_number invoice_number transaction_receipt"),
        (_S, "mpesa_receipt_number result_code result_desc transaction_role"),
        (_S, "third_party_trans_id merchant_request_id checkout_request_id"),
        # first gateway
        (_S, "event tx_ref flw_ref customer_token ref_token status payment_type charge_type"),
        (_S, "device_fingerprint auth_model processor_response customer_email_hash"),
        # second gateway
        (_S, "merchant_reference_token tracking_id payment_status payment_method"),
        (_S, "customer_email_token customer_phone_token payment_account_token"),
        (_S, "confirmation_code description pesapal_notification_type pesapal_payment_id"),
        (_S, "error_code error_message"),
    ).fields
    + LABELS.fields
)

CANONICAL = T.StructType(
    _struct(
        (_S, "transaction_id! provider! source_type"),
        (_TS, "event_timestamp!"),
        (_L, "event_time_ms"),
        (_S, "card_token bin last4"),
        (_D, "amount"),
        (_S, "currency currency_code merchant_id merchant_name mcc terminal_id transaction_type"),
        (_S, "pos_entry_mode channel customer_id device_fingerprint payment_method auth_model"),
        (_S, "status acquirer_id stan"),
    ).fields
    + LABELS.fields
)

MCC = _struct((_S, "mcc! mcc_description mcc_category"), (_B, "is_high_risk_mcc"))
CURRENCY = _struct((_S, "currency_code! currency_alpha currency_name currency_region"))
FX = _struct((_S, "currency_alpha!"), (_D, "fx_rate_to_usd"))
BIN = _struct((_S, "bin! bin_brand bin_card_type bin_country bin_issuer"), (_B, "bin_prepaid"))
