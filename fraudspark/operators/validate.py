"""Field checks. Each returns the first failing reason as text, or null for a good value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, VISA
from fraudspark.functions.text import all_digits, card_digits, is_filled, luhn_valid, phone_digits
from fraudspark.operators.parse import per_provider


def _length_reason(what: str, digits: Column, wanted: str) -> Column:
    return F.concat(
        F.lit(f"{what} length "), F.length(digits).cast("string"), F.lit(f" invalid (must be {wanted})")
    )


def _outside(digits: Column, low: int, high: int) -> Column:
    return ~F.length(digits).between(low, high)


def visa_pan_reason(pan: Column) -> Column:
    digits = card_digits(pan)
    return (
        F.when(~is_filled(pan), F.lit("PAN is empty"))
        .when(~all_digits(digits), F.lit("PAN must contain only digits"))
        .when(_outside(digits, 13, 19), _length_reason("PAN", digits, "13-19"))
        .when(~luhn_valid(digits), F.lit("PAN failed Luhn validation"))
    )


def mastercard_pan_reason(pan: Column) -> Column:
    digits = card_digits(pan)
    in_range = F.substring(digits, 1, 2).between("51", "55") | F.substring(digits, 1, 4).between(
        "2221", "2720"
    )
    return (
        F.when(~is_filled(pan), F.lit("PAN is empty"))
        .when(~all_digits(digits), F.lit("PAN must contain only digits"))
        .when(_outside(digits, 16, 16), _length_reason("Mastercard PAN", digits, "16"))
        .when(~in_range, F.lit("PAN does not start with valid Mastercard BIN"))
        .when(~luhn_valid(digits), F.lit("PAN failed Luhn validation"))
    )


def partial_card_reason(first6: Column, last4: Column) -> Column:
    def wrong(c: Column, n: int) -> Column:
        return ~c.rlike(f"^[0-9]{{{n}}}$")

    def got(what: str, c: Column, n: int) -> Column:
        return F.concat(F.lit(f"{what} must be {n} digits, got "), F.length(c).cast("string"))

    return (
        F.when(~is_filled(first6) | ~is_filled(last4), F.lit("First 6 or last 4 digits missing"))
        .when(wrong(first6, 6), got("BIN", first6, 6))
        .when(wrong(last4, 4), got("Last4", last4, 4))
    )


def loose_email_reason(email: Column) -> Column:
    """Optional check of the first gateway; an empty address is fine."""
    return F.when(
        is_filled(email) & ~(email.contains("@") & email.contains(".")),
        F.concat(F.lit("Invalid email format: "), email),
    )


def msisdn_reason(msisdn: Column) -> Column:
    digits = phone_digits(msisdn)
    return (
        F.when(~is_filled(msisdn), F.lit("MSISDN is empty"))
        .when(_outside(digits, 9, 13), _length_reason("MSISDN", digits, "9-13"))
        .when(~all_digits(digits), F.lit("MSISDN must contain only digits"))
        .when(
            digits.startswith("254") & (F.length(digits) != 12),
            F.lit("Kenyan MSISDN with country code must be 12 digits"),
        )
        .when(
            digits.startswith("0") & (F.length(digits) != 10),
            F.lit("Kenyan MSISDN without country code must be 10 digits"),
        )
    )


# Fixed value: address pattern of the second gateway.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def email_reason(email: Column) -> Column:
    address = F.lower(F.trim(email))
    return F.when(~is_filled(email), F.lit("Email is empty")).when(
        ~address.rlike(EMAIL_PATTERN), F.concat(F.lit("Invalid email format: "), address)
    )


def phone_reason(phone: Column) -> Column:
    digits = phone_digits(phone)
    return (
        F.when(~is_filled(phone), F.lit("Phone is empty"))
        .when(_outside(digits, 8, 15), _length_reason("Phone", digits, "8-15"))
        .when(~all_digits(digits), F.lit("Phone must contain only digits"))
    )


def payment_account_reason(account: Column) -> Column:
    return F.when(~is_filled(account), F.lit("Payment account is empty")).when(
        F.length(F.trim(account)) < 4, F.lit("Payment account too short")
    )


def _labelled(label: str, applies: Column, reason: Column) -> Column:
    return F.when(applies, F.concat(F.lit(f"{label} validation failed: "), reason))


def field_error(check_gateway_email: bool = False) -> Column:
    """First failing field check of a parsed message, with the label of the field."""
    c = F.col
    gateway_card = _labelled(
        "Card", is_filled(c("bin")) & is_filled(c("last4")), partial_card_reason(c("bin"), c("last4"))
    )
    if check_gateway_email:
        gateway_card = F.coalesce(
            gateway_card, _labelled("Email", F.lit(True), loose_email_reason(c("customer_email")))
        )
    return per_provider(
        {
            VISA: _labelled("PAN", F.lit(True), visa_pan_reason(c("pan"))),
            MASTERCARD: _labelled("PAN", F.lit(True), mastercard_pan_reason(c("pan"))),
            MPESA: _labelled("MSISDN", is_filled(c("msisdn")), msisdn_reason(c("msisdn"))),
            FLUTTERWAVE: gateway_card,
            PESAPAL: F.coalesce(
                _labelled("Email", is_filled(c("customer_email")), email_reason(c("customer_email"))),
                _labelled("Phone", is_filled(c("customer_phone")), phone_reason(c("customer_phone"))),
                _labelled(
                    "Payment account",
                    is_filled(c("payment_account")),
                    payment_account_reason(c("payment_account")),
                ),
            ),
        }
    )


def validate_messages(parsed: DataFrame, check_gateway_email: bool = False) -> DataFrame:
    """Set ``error_reason``: the parse failure, else the first failing field check, else null."""
    return parsed.withColumn(
        "error_reason", F.coalesce(F.col("parse_error"), field_error(check_gateway_email))
    ).drop("parse_error")


def accepted(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("error_reason").isNull())


def rejected(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("error_reason").isNotNull())
