"""Raw provider messages to typed columns.

All providers go through one projection: each output column is a CASE over the provider, so the
input is read once and never fanned out per provider. A message is decoded once, into text fields.
Decoding cannot tell a missing field (its default applies) from an explicit JSON null (it stays
null), so the paths that a message sets to null are kept next to it; only messages that contain the
word null are read a second time for that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, PROVIDERS, VISA
from fraudspark.functions.plan import built_once, computed_once
from fraudspark.functions.text import blank_to_null, is_filled

PARSE_FAILURE = "Parse failure - unknown format"
JSON_FAILURE = "JSON parse error"

_CORRUPT = "_corrupt"
_JSON_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": _CORRUPT}
_NULLS = "_null_paths"
_VARIANT = "_variant"
_JSON_BLANKS = " \t\r\n"
# What may be a number; a cast alone would also take suffixes such as 5d.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _names(names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), "string")


def _ddl(fields: dict) -> str:
    return ", ".join(
        f"{n}: struct<{_ddl(t)}>" if isinstance(t, dict) else f"{n}: {t}" for n, t in fields.items()
    )


# Field names of the messages (fixed values).
_LABELS = _names("is_fraud risk_score fraud_pattern")
_OUTER = _names("timestamp event_time_ms") | _LABELS
_BITMAP = _names(
    "DE002 DE003 DE004 DE011 DE018 DE022 DE032 DE033 DE041 DE042 DE043 DE049 message_type"
)
_CARD = (
    _BITMAP
    | _names(
        "transaction_id source source_type timestamp event_time_ms pan amount currency_code merchant_id"
        " terminal_id merchant_name mcc transaction_type pos_entry_mode stan acquirer_id forwarder_id"
    )
    | _LABELS
    | {"bitmap": _BITMAP}
)
_MPESA = _names(
    "source source_type TransactionType TransID TransTime MSISDN TransAmount BusinessShortCode"
    " BillRefNumber InvoiceNumber ThirdPartyTransID TransactionReceipt FirstName LastName"
) | {
    "Body": {
        "stkCallback": _names(
            "CheckoutRequestID PhoneNumber Amount MerchantRequestID ResultCode ResultDesc"
            " MpesaReceiptNumber"
        )
    }
}
_DATA = _names(
    "tx_ref flw_ref amount currency status payment_type charge_type device_fingerprint auth_model"
    " processor_response"
) | {
    "customer": _names("id email phone_number"),
    "card": _names("first_6digits last_4digits"),
    "authorization": _names("first_6digits last_4digits"),
}
# A message without a data part carries its fields itself.
_FLW = _names("event event_type") | _DATA | {"data": _DATA}
_IPN = _names(
    "source source_type transaction_id pesapal_transaction_tracking_id pesapal_merchant_reference"
    " payment_status status payment_method amount currency confirmation_code payment_account"
    " customer_email customer_phone customer_first_name customer_last_name description timestamp"
    " event_time_ms pesapal_notification_type pesapal_payment_id error_code error_message"
)

# Per message family: its providers, the wrapper it may come in, its fields, and the part of the
# message that holds the payment (fixed values).
FAMILIES = {
    "_card": ((VISA, MASTERCARD), None, _CARD, "bitmap"),
    "_mpesa": ((MPESA,), "webhook_payload", _MPESA, "Body.stkCallback"),
    "_flw": ((FLUTTERWAVE,), "webhook_payload", _FLW, "data"),
    "_ipn": ((PESAPAL,), "ipn_payload", _IPN, None),
}
FAMILY_OF = {p: f for f, (providers, *_) in FAMILIES.items() for p in providers}


def per_provider(branches: dict[str, Column], default: Column | None = None) -> Column:
    """CASE over the provider column; providers not named get ``default`` (null)."""
    chain = F
    for provider, value in branches.items():
        chain = chain.when(F.col("provider") == provider, value)
    return chain if default is None else chain.otherwise(default)


def _whole(family: str) -> dict:
    """All fields of a family's messages, with and without the wrapper."""
    _, wrapper, fields, _ = FAMILIES[family]
    return fields if wrapper is None else _OUTER | fields | {wrapper: fields}


def _paths(fields: dict, above: str = "") -> list[str]:
    out = []
    for name, inner in fields.items():
        out.append(f"{above}{name}")
        if isinstance(inner, dict):
            out += _paths(inner, f"{above}{name}.")
    return out


def _value(path: str) -> Column:
    """A decoded field; the path begins with the family."""
    return F.col(path)


def _is_null(path: str) -> Column:
    """Whether the message has a JSON null exactly there; the path begins with the family."""
    inside = path.split(".", 1)[1]
    return F.coalesce(F.array_contains(_NULLS, f"$.{inside}"), F.lit(False))


def _reader(provider: str):
    """Field access for one provider: ``'.x'`` is in the body, ``'^.x'`` in the message, ``'^^.x'``
    in the envelope. The first place that has the field decides, even if it holds a null."""
    family = FAMILY_OF[provider]
    _, wrapper, _, part = FAMILIES[family]

    def at(view: str, name: str, get=_value) -> Column:
        envelope = get(f"{family}.{name}")
        if view == "^^" or (view == "^" and wrapper is None):
            return envelope
        inside = f"{family}.{wrapper}" if wrapper else family
        message = (
            F.when(F.col(inside).isNotNull(), get(f"{inside}.{name}")).otherwise(envelope)
            if wrapper and name in FAMILIES[family][2] or wrapper and "." in name
            else envelope
        )
        if view == "^" or part is None:
            return message
        outer = get(f"{family}.{part}.{name}")
        if provider == VISA:
            return outer
        if provider == MPESA:
            wrapped = get(f"{inside}.{part}.{name}")
            return F.coalesce(wrapped, outer) if get is _value else wrapped | outer
        if provider == MASTERCARD:
            return F.when(F.col(f"{family}.{part}").isNotNull(), outer).otherwise(envelope)
        return (
            F.when(F.col(f"{inside}.{part}").isNotNull(), get(f"{inside}.{part}.{name}"))
            .when(F.col(inside).isNotNull(), get(f"{inside}.{name}"))
            .when(F.col(f"{family}.{part}").isNotNull(), outer)
            .otherwise(envelope)
        )

    def read(*places: str, default: Column | str | None = None) -> Column:
        place, *rest = places
        view, name = place[: -len(place.lstrip("^"))] , place.lstrip("^.")
        value = at(view, name)
        if rest:
            fallback = read(*rest, default=default)
        elif default is None:
            return value
        else:
            fallback = default if isinstance(default, Column) else F.lit(default)
        nothing = F.lit(None).cast("string")
        given_null = at(view, name, _is_null)
        return F.when(value.isNotNull(), value).when(given_null, nothing).otherwise(fallback)

    read.at = at
    return read


def _record_time() -> Column:
    return F.date_format(F.col("record_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _record_ms() -> Column:
    return F.unix_millis(F.col("record_time")).cast("string")


def _content_id() -> Column:
    """Stand-in for a missing id: a digest of the message, so that replays agree."""
    return F.sha2(F.col("raw"), 256)


def compact_time(text: Column) -> Column:
    """yyyyMMddHHmmss to ISO text; null unless it is exactly 14 characters and a real time."""
    parsed = F.try_to_timestamp(F.when(F.length(text) == 14, text), F.lit("yyyyMMddHHmmss"))
    return F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss")


def visa_fields() -> dict[str, Column]:
    read = _reader(VISA)
    return {
        "transaction_id": read("^.transaction_id", default=_content_id()),
        "source": read("^.source", default="VISA_ISO8583"),
        "source_type": read("^.source_type"),
        "message_type": read("^.message_type"),
        "timestamp": read("^.timestamp", default=_record_time()),
        "event_time_ms": read("^.event_time_ms", default=_record_ms()),
        "pan": read(".DE002"),
        "amount": read(".DE004", default="0"),
        "currency_code": read(".DE049", default="404"),
        "merchant_id": read(".DE042"),
        "terminal_id": read(".DE041"),
        "merchant_name": read(".DE043"),
        "mcc": read(".DE018"),
        "transaction_type": read(".DE003"),
        "pos_entry_mode": read(".DE022"),
        "stan": read(".DE011"),
        "acquirer_id": read(".DE032"),
    }


def mastercard_fields() -> dict[str, Column]:
    read = _reader(MASTERCARD)
    return {
        "transaction_id": read("^.transaction_id", default=_content_id()),
        "source": read("^.source", default="MASTERCARD_ISO8583"),
        "source_type": F.lit("ISO_8583"),
        "message_type": read("^.message_type", ".message_type"),
        "timestamp": read("^.timestamp", default=_record_time()),
        "event_time_ms": read("^.event_time_ms", default=_record_ms()),
        "pan": F.coalesce(blank_to_null(read(".DE002")), read("^.pan")),
        "amount": read(".DE004", "^.amount", default="0"),
        "currency_code": read(".DE049", "^.currency_code", default="404"),
        "merchant_id": read(".DE042", "^.merchant_id"),
        "terminal_id": read(".DE041", "^.terminal_id"),
        "merchant_name": read(".DE043", "^.merchant_name"),
        "mcc": read(".DE018", "^.mcc"),
        "transaction_type": read(".DE003", "^.transaction_type"),
        "pos_entry_mode": read(".DE022", "^.pos_entry_mode"),
        "stan": read(".DE011", "^.stan"),
        "acquirer_id": read(".DE032", "^.acquirer_id"),
        "forwarder_id": read(".DE033", "^.forwarder_id"),
    }


def _is_push_callback() -> Column:
    """The second mobile-money shape; the first one has a TransactionType."""
    read = _reader(MPESA)
    first_shape = read("^.TransactionType").isNotNull() | read.at("^", "TransactionType", _is_null)
    return ~first_shape & _push_part().isNotNull()


def _push_part() -> Column:
    return F.coalesce(
        F.col("_mpesa.webhook_payload.Body.stkCallback"), F.col("_mpesa.Body.stkCallback")
    )


def mpesa_fields() -> dict[str, Column]:
    read = _reader(MPESA)
    push = _is_push_callback()

    def shape(first: Column | None, second: Column | None) -> Column:
        nothing = F.lit(None).cast("string")
        return F.when(push, nothing if second is None else second).otherwise(
            nothing if first is None else first
        )

    return {
        "transaction_id": shape(
            read("^.TransID", default=_content_id()), read(".CheckoutRequestID", default=_content_id())
        ),
        "source": read("^.source", "^.source_type", default="MPESA_DARAJA"),
        "source_type": F.lit("MPESA_DARAJA"),
        "timestamp": F.coalesce(
            F.when(~push, compact_time(read("^.TransTime"))), read("^^.timestamp"), _record_time()
        ),
        "event_time_ms": F.coalesce(read("^^.event_time_ms"), _record_ms()),
        "transaction_type": shape(read("^.TransactionType"), F.lit("STKPush")),
        "msisdn": shape(read("^.MSISDN"), read(".PhoneNumber")),
        "amount": F.when(push, read(".Amount", default="0")).otherwise(
            read("^.TransAmount", default="0")
        ),
        "business_shortcode": shape(read("^.BusinessShortCode"), None),
        "bill_ref_number": shape(read("^.BillRefNumber"), None),
        "invoice_number": shape(read("^.InvoiceNumber"), None),
        "third_party_trans_id": shape(read("^.ThirdPartyTransID"), None),
        "transaction_receipt": shape(read("^.TransactionReceipt"), None),
        "first_name": shape(read("^.FirstName"), None),
        "last_name": shape(read("^.LastName"), None),
        "merchant_request_id": shape(None, read(".MerchantRequestID")),
        "checkout_request_id": shape(None, read(".CheckoutRequestID")),
        "result_code": shape(None, read(".ResultCode")),
        "result_desc": shape(None, read(".ResultDesc")),
        "mpesa_receipt_number": shape(None, read(".MpesaReceiptNumber")),
    }


def flutterwave_fields() -> dict[str, Column]:
    read = _reader(FLUTTERWAVE)
    card = [read(".card.first_6digits", default=""), read(".card.last_4digits", default="")]
    other = [
        read(".authorization.first_6digits", default=""),
        read(".authorization.last_4digits", default=""),
    ]
    no_card = ~is_filled(card[0]) & ~is_filled(card[1])
    flw_ref = read(".flw_ref", "^.flw_ref", default="")
    tx_ref = read(".tx_ref", "^.tx_ref", default="")
    return {
        "transaction_id": F.coalesce(blank_to_null(flw_ref), blank_to_null(tx_ref), _content_id()),
        "source": F.lit(FLUTTERWAVE),
        "source_type": F.lit("WEBHOOK"),
        "timestamp": F.coalesce(read("^^.timestamp"), _record_time()),
        "event_time_ms": F.coalesce(read("^^.event_time_ms"), _record_ms()),
        "event": read("^.event", "^.event_type", default=""),
        "tx_ref": tx_ref,
        "flw_ref": flw_ref,
        "bin": F.when(no_card, other[0]).otherwise(card[0]),
        "last4": F.when(no_card, other[1]).otherwise(card[1]),
        "customer_id": F.coalesce(read(".customer.id"), F.lit("")),
        "customer_email": F.coalesce(read(".customer.email"), F.lit("")),
        "customer_phone": F.coalesce(read(".customer.phone_number"), F.lit("")),
        "amount": read(".amount", "^.amount", default="0"),
        "currency": read(".currency", "^.currency", default="USD"),
        "status": read(".status", "^.status", default=""),
        "payment_type": read(".payment_type", "^.payment_type", default="card"),
        "charge_type": read(".charge_type", default=""),
        "device_fingerprint": read(".device_fingerprint"),
        "auth_model": read(".auth_model"),
        "processor_response": read(".processor_response"),
    }


def pesapal_fields() -> dict[str, Column]:
    read = _reader(PESAPAL)
    tracking = read(".pesapal_transaction_tracking_id")
    return {
        "transaction_id": F.coalesce(
            blank_to_null(tracking), read(".transaction_id", default=_content_id())
        ),
        "source": read(".source", ".source_type", default="PESAPAL_IPN"),
        "source_type": F.lit("IPN_CALLBACK"),
        "timestamp": F.coalesce(read(".timestamp"), read("^^.timestamp"), _record_time()),
        "event_time_ms": F.coalesce(
            read(".event_time_ms"), read("^^.event_time_ms"), _record_ms()
        ),
        "merchant_reference": read(".pesapal_merchant_reference"),
        "tracking_id": tracking,
        "payment_status": read(".payment_status", ".status", default="PENDING"),
        "payment_method": read(".payment_method", default="UNKNOWN"),
        "amount": read(".amount", default="0"),
        "currency": read(".currency", default="KES"),
        "confirmation_code": read(".confirmation_code"),
        "payment_account": read(".payment_account"),
        "customer_email": read(".customer_email"),
        "customer_phone": read(".customer_phone"),
        "first_name": read(".customer_first_name"),
        "last_name": read(".customer_last_name"),
        "description": read(".description"),
        "pesapal_notification_type": read(".pesapal_notification_type"),
        "pesapal_payment_id": read(".pesapal_payment_id"),
        "error_code": read(".error_code"),
        "error_message": read(".error_message"),
    }


FIELDS: dict[str, Callable[[], dict[str, Column]]] = {
    VISA: visa_fields,
    MASTERCARD: mastercard_fields,
    MPESA: mpesa_fields,
    FLUTTERWAVE: flutterwave_fields,
    PESAPAL: pesapal_fields,
}


# Columns that are not text.
_TYPES = {"amount": "double", "event_time_ms": "bigint", "is_fraud": "boolean", "risk_score": "double"}


@built_once
def parse_error() -> Column:
    """Why a message cannot be read at all, else null. Expects the decoded and parsed columns."""
    raw = F.col("raw")
    unreadable = F.col("amount").isNull() | ~F.rtrim(raw, F.lit(_JSON_BLANKS)).endswith("}")
    no_shape = _reader(MPESA)("^.TransactionType").isNull() & _push_part().isNull()

    def reason(provider: str, extra: Column, text: str = PARSE_FAILURE, invalid: str | None = None) -> Column:
        decoded = F.col(FAMILY_OF[provider])
        said = F.lit(text)
        if invalid:
            said = F.when(F.try_parse_json(raw).isNull(), F.lit(invalid)).otherwise(said)
        return F.when(
            decoded.isNull() | decoded[_CORRUPT].isNotNull() | unreadable | extra, said
        )

    def null_part(family: str, *names: str) -> Column:
        return reduce(or_, (_is_null(f"{family}.{n}") for n in names))

    gateway = _reader(FLUTTERWAVE)

    return per_provider(
        {
            VISA: reason(VISA, null_part("_card", "bitmap"), "Parse failure"),
            MASTERCARD: reason(MASTERCARD, null_part("_card", "bitmap") | ~is_filled(F.col("pan"))),
            MPESA: reason(MPESA, null_part("_mpesa", "webhook_payload") | no_shape, invalid=JSON_FAILURE),
            FLUTTERWAVE: reason(
                FLUTTERWAVE,
                null_part("_flw", "webhook_payload")
                | gateway.at("^", "data", _is_null)
                | gateway.at(".", "card", _is_null)
                | gateway.at(".", "customer", _is_null),
                invalid=JSON_FAILURE,
            ),
            PESAPAL: reason(PESAPAL, null_part("_ipn", "ipn_payload")),
        },
        F.lit("Unknown topic"),
    )


def decode_messages(wire: DataFrame) -> DataFrame:
    """Wire records with a value become text plus one decoded struct per message family."""
    raw = F.col("raw")
    opened = wire.where(F.col("value").isNotNull()).withColumn("raw", F.col("value").cast("string"))
    decoded = {}
    paths = F
    for family, (providers, *_) in FAMILIES.items():
        schema = f"struct<{_ddl(_whole(family) | {_CORRUPT: 'string'})}>"
        mine = F.col("provider").isin(*providers)
        decoded[family] = F.from_json(F.when(mine, raw), schema, _JSON_OPTIONS)
        paths = paths.when(mine, F.array(*[F.lit(f"$.{p}") for p in _paths(_whole(family))]))
    decoded[_VARIANT] = F.when(raw.contains("null"), F.try_parse_json(raw))
    null_paths = F.filter(paths, lambda p: F.is_variant_null(F.variant_get(F.col(_VARIANT), p, "variant")))
    with_variant = opened.drop("key", "value").withColumns(decoded)
    return with_variant.withColumn(_NULLS, F.when(F.col(_VARIANT).isNotNull(), null_paths)).drop(_VARIANT)


@built_once
def parsed_columns() -> dict[str, Column]:
    """Each parsed column as a CASE over the providers that have it."""
    by_provider = {p: FIELDS[p]() for p in PROVIDERS}
    for provider, fields in by_provider.items():
        read = _reader(provider)
        fields |= {n: read(f"^^.{n}") for n in _LABELS}
    parsed = {}
    for name in dict.fromkeys(n for fields in by_provider.values() for n in fields):
        text = per_provider({p: f[name] for p, f in by_provider.items() if name in f})
        if _TYPES.get(name) == "double":
            text = F.when(text.rlike(_NUMBER), text)
        parsed[name] = text.try_cast(_TYPES[name]) if name in _TYPES else text
    return parsed


def parse_messages(wire: DataFrame) -> DataFrame:
    """Parsed columns of every provider in one frame, with ``parse_error``.

    Input: ``provider, value, topic, partition, offset, timestamp`` (wire record, provider tagged).
    Records without a value are skipped.
    """
    decoded = decode_messages(wire.withColumnRenamed("timestamp", "record_time"))
    checked = decoded.withColumns(parsed_columns()).withColumn("parse_error", parse_error())
    return computed_once(checked.drop(*FAMILIES, _NULLS))


