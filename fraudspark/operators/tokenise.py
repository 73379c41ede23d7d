"""Replace card numbers, phone numbers, e-mail addresses and accounts by keyed tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark import schemas
from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, VISA
from fraudspark.functions import crypto
from fraudspark.functions.plan import built_once, computed_once
from fraudspark.functions.text import (
    blank_to_null,
    card_digits,
    international_phone,
    is_filled,
    looked_up,
)
from fraudspark.operators.parse import per_provider

# Digit that replaces each hex letter A..F.
LETTERS = "ABCDEF"
NETWORK_DIGITS = {VISA: "567890", MASTERCARD: "123456"}

# ISO currency numbers known to each card network, and its default.
VISA_CURRENCIES = {"404": "KES", "840": "USD", "826": "GBP", "978": "EUR", "710": "ZAR"}
VISA_CURRENCY_DEFAULT = "KES"
MASTERCARD_CURRENCIES = {
    "404": "KES",
    "840": "USD",
    "826": "GBP",
    "978": "EUR",
    "710": "ZAR",
    "800": "UGX",
    "834": "TZS",
    "124": "CAD",
    "392": "JPY",
    "756": "CHF",
}
MASTERCARD_CURRENCY_DEFAULT = "USD"

SHORTEST_CARD = 13

CARD_METHOD = "FORMAT_PRESERVING_HMAC"
OTHER_METHOD = "HMAC_SHA256_PSEUDONYMISATION"


def card_shaped(digits: Column, mac: Column, replacements: str) -> Column:
    """First six and last four digits stay; the middle is taken from the MAC, as digits."""
    # A SHA-256 MAC has 64 hex digits, so no middle part up to that length is cut short. Numbers too
    # short for a card have no token.
    middle = F.translate(mac.substr(F.lit(1), F.length(digits) - 10), LETTERS, replacements)
    shaped = F.concat(F.substring(digits, 1, 6), middle, F.right(digits, F.lit(4)))
    return F.when(F.length(digits) >= SHORTEST_CARD, shaped)


def prefixed(prefix: str, mac: Column, length: int) -> Column:
    return F.concat(F.lit(prefix), F.substring(mac, 1, length))


def visa_card_token(pan: Column) -> Column:
    digits = card_digits(pan)
    return card_shaped(digits, crypto.hmac_hex(digits), NETWORK_DIGITS[VISA])


def mastercard_card_token(pan: Column) -> Column:
    digits = card_digits(pan)
    return card_shaped(digits, crypto.hmac_hex(digits), NETWORK_DIGITS[MASTERCARD])


def msisdn_token(msisdn: Column) -> Column:
    return prefixed("MPESA_MSISDN_", crypto.hmac_hex(international_phone(blank_to_null(msisdn))), 16)


def account_token(short_code: Column) -> Column:
    filled = F.nullif(blank_to_null(short_code), F.lit("0"))
    return prefixed("MPESA_ACC_", crypto.hmac_hex(filled), 12)


def _card_composite(first6: Column, last4: Column, flw_ref: Column) -> Column:
    return F.when(
        is_filled(first6) & is_filled(last4), F.concat_ws(":", first6, last4, blank_to_null(flw_ref))
    )


def _gateway_card(first6: Column, last4: Column, mac: Column) -> Column:
    return F.concat(
        F.lit("FLW_"), first6, F.lit("_TOKEN_"), F.substring(mac, 1, 12), F.lit("_"), last4
    )


def gateway_card_token(first6: Column, last4: Column, flw_ref: Column) -> Column:
    return _gateway_card(first6, last4, crypto.hmac_hex(_card_composite(first6, last4, flw_ref)))


def _customer_composite(customer_id: Column, email: Column, phone: Column) -> Column:
    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    contact = F.concat(text(email), F.lit(":"), text(phone))
    return F.when(is_filled(customer_id), F.concat(customer_id, F.lit(":"), contact)).when(
        is_filled(email) | is_filled(phone), contact
    )


def customer_token(customer_id: Column, email: Column, phone: Column) -> Column:
    return prefixed("FLW_CUST_", crypto.hmac_hex(_customer_composite(customer_id, email, phone)), 16)


def reference_token(ref: Column) -> Column:
    return prefixed("FLW_REF_", crypto.hmac_hex(blank_to_null(ref)), 12)


def email_digest(email: Column) -> Column:
    return F.substring(F.md5(blank_to_null(email)), 1, 16)


def email_token(email: Column) -> Column:
    return prefixed("PESAPAL_EMAIL_", crypto.hmac_hex(F.lower(F.trim(blank_to_null(email)))), 16)


def phone_token(phone: Column) -> Column:
    return prefixed("PESAPAL_PHONE_", crypto.hmac_hex(international_phone(blank_to_null(phone))), 16)


def _payment_account(account: Column, mac: Column) -> Column:
    return F.when(
        account.rlike("^[0-9]{16,}$"), card_shaped(account, mac, NETWORK_DIGITS[VISA])
    ).otherwise(prefixed("PESAPAL_ACC_", mac, 12))


def payment_account_token(account: Column) -> Column:
    trimmed = F.trim(blank_to_null(account))
    return _payment_account(trimmed, crypto.hmac_hex(trimmed))


def merchant_reference_token(ref: Column) -> Column:
    return prefixed("PESAPAL_MERCHANT_", crypto.hmac_hex(F.trim(blank_to_null(ref))), 12)


def visa_currency(code: Column) -> Column:
    return looked_up(code, VISA_CURRENCIES, VISA_CURRENCY_DEFAULT)


def mastercard_currency(code: Column) -> Column:
    return looked_up(code, MASTERCARD_CURRENCIES, MASTERCARD_CURRENCY_DEFAULT)


# Up to four secrets per message; the same four MACs serve every provider, so a row pays only for
# the secrets it has (the MAC of null is null).
_MACS = ("_mac_1", "_mac_2", "_mac_3", "_mac_4")


@built_once
def _secrets() -> tuple[Column, ...]:
    c = F.col
    digits = card_digits(c("pan"))
    first = per_provider(
        {
            VISA: digits,
            MASTERCARD: digits,
            MPESA: international_phone(blank_to_null(c("msisdn"))),
            FLUTTERWAVE: F.coalesce(
                _card_composite(c("bin"), c("last4"), c("flw_ref")), blank_to_null(c("flw_ref"))
            ),
            PESAPAL: F.lower(F.trim(blank_to_null(c("customer_email")))),
        }
    )
    second = per_provider(
        {
            MPESA: F.nullif(blank_to_null(c("business_shortcode")), F.lit("0")),
            FLUTTERWAVE: _customer_composite(
                c("customer_id"), c("customer_email"), c("customer_phone")
            ),
            PESAPAL: international_phone(blank_to_null(c("customer_phone"))),
        }
    )
    third = per_provider(
        {
            FLUTTERWAVE: blank_to_null(c("tx_ref")),
            PESAPAL: F.trim(blank_to_null(c("payment_account"))),
        }
    )
    fourth = per_provider({PESAPAL: F.trim(blank_to_null(c("merchant_reference")))})
    return first, second, third, fourth


@built_once
def _token_columns() -> dict[str, Column]:
    c = F.col
    m1, m2, m3, m4 = (c(m) for m in _MACS)
    digits = card_digits(c("pan"))
    whole_card = is_filled(c("bin")) & is_filled(c("last4"))
    return {
        "card_token": per_provider(
            {
                VISA: card_shaped(digits, m1, NETWORK_DIGITS[VISA]),
                MASTERCARD: card_shaped(digits, m1, NETWORK_DIGITS[MASTERCARD]),
                FLUTTERWAVE: F.when(
                    whole_card, _gateway_card(c("bin"), c("last4"), m1)
                ).otherwise(prefixed("FLW_REF_", m1, 12)),
            }
        ),
        "msisdn_token": per_provider({MPESA: prefixed("MPESA_MSISDN_", m1, 16)}),
        "account_token": per_provider({MPESA: prefixed("MPESA_ACC_", m2, 12)}),
        "customer_token": per_provider({FLUTTERWAVE: prefixed("FLW_CUST_", m2, 16)}),
        "ref_token": per_provider({FLUTTERWAVE: prefixed("FLW_REF_", m3, 12)}),
        "customer_email_token": per_provider({PESAPAL: prefixed("PESAPAL_EMAIL_", m1, 16)}),
        "customer_phone_token": per_provider({PESAPAL: prefixed("PESAPAL_PHONE_", m2, 16)}),
        "payment_account_token": per_provider(
            {PESAPAL: _payment_account(F.trim(c("payment_account")), m3)}
        ),
        "merchant_reference_token": per_provider({PESAPAL: prefixed("PESAPAL_MERCHANT_", m4, 12)}),
    }


@built_once
def _other_columns() -> dict[str, Column]:
    c = F.col
    digits = card_digits(c("pan"))
    return {
        "bin": per_provider(
            {
                VISA: F.substring(digits, 1, 6),
                MASTERCARD: F.substring(digits, 1, 6),
                FLUTTERWAVE: c("bin"),
            }
        ),
        "last4": per_provider(
            {
                VISA: F.right(digits, F.lit(4)),
                MASTERCARD: F.right(digits, F.lit(4)),
                FLUTTERWAVE: c("last4"),
            }
        ),
        "currency": per_provider(
            {
                VISA: visa_currency(c("currency_code")),
                MASTERCARD: mastercard_currency(c("currency_code")),
                MPESA: F.lit("KES"),
            },
            c("currency"),
        ),
        "customer_email_hash": per_provider({FLUTTERWAVE: email_digest(c("customer_email"))}),
        "transaction_role": per_provider(
            {
                MPESA: F.when(
                    F.coalesce(c("business_shortcode"), F.lit("")).isin("", "0"), F.lit("CUSTOMER")
                ).otherwise(F.lit("MERCHANT"))
            }
        ),
        "tokenisation_method": F.when(
            c("provider").isin(VISA, MASTERCARD), F.lit(CARD_METHOD)
        ).otherwise(F.lit(OTHER_METHOD)),
        "tokenisation_timestamp": F.date_format(
            F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        ),
    }


@built_once
def message_key() -> Column:
    """Partition key of the published event: the first token present, else the transaction id."""
    c = F.col
    return F.coalesce(
        per_provider(
            {
                VISA: c("card_token"),
                MASTERCARD: c("card_token"),
                MPESA: c("msisdn_token"),
                FLUTTERWAVE: F.coalesce(c("card_token"), c("customer_token"), c("ref_token")),
                PESAPAL: blank_to_null(c("tracking_id")),
            }
        ),
        c("transaction_id"),
    )


def tokenise_messages(validated: DataFrame, keep_names: bool = False) -> DataFrame:
    """Validated messages, with their MAC keys attached, to tokenised events and routing columns.

    Output: ``provider, message_key, <tokenised columns>, error_reason, raw, topic, partition,
    offset``. ``raw`` is null on good rows, so no clear-text secret leaves with them. First and
    last names are dropped unless ``keep_names``.
    """
    good = F.col("error_reason").isNull()
    secrets = {m: crypto.hmac_hex(F.when(good, s)) for m, s in zip(_MACS, _secrets())}
    with_macs = crypto.without_keys(validated.withColumns(secrets))
    with_tokens = with_macs.withColumns(_token_columns() | _other_columns())
    names = list(schemas.TOKENISED.fieldNames())
    if keep_names:
        names += ["first_name", "last_name"]
    out = with_tokens.select(
        "provider",
        message_key().alias("message_key"),
        *[
            F.col(n) if n in with_tokens.columns else F.lit(None).cast("string").alias(n)
            for n in names
        ],
        "error_reason",
        F.when(~good, F.col("raw")).alias("raw"),
        "topic",
        "partition",
        "offset",
        "record_time",
    )
    return computed_once(out)
