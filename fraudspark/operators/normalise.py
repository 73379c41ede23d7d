"""Tokenised events of every provider to the canonical transaction, in one projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudspark import schemas
from fraudspark.config import FLUTTERWAVE, MASTERCARD, MPESA, PESAPAL, PROVIDERS, VISA
from fraudspark.functions.plan import built_once
from fraudspark.functions.text import looked_up
from fraudspark.operators.parse import per_provider
from fraudspark.sources.refdata import CURRENCY_ROWS

# 0001-01-01 and 9999-12-31T23:59:59.999 in UTC.
_REAL_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)
_ALPHA_TO_CODE = {row[1]: row[0] for row in CURRENCY_ROWS}


def event_time(text: Column, millis: Column) -> Column:
    """ISO text if it can be read, else epoch milliseconds of years 1 to 9999, else null."""
    real = F.when(millis.between(*_REAL_MILLIS), millis)
    return F.coalesce(F.try_to_timestamp(text), F.timestamp_millis(real))


def _networks() -> dict[str, Column]:
    c, lit = F.col, F.lit
    return {
        "source_type": F.coalesce(c("source_type"), lit("ISO_8583")),
        "card_token": c("card_token"),
        "bin": c("bin"),
        "last4": c("last4"),
        "currency": c("currency"),
        "currency_code": c("currency_code"),
        "merchant_id": c("merchant_id"),
        "merchant_name": c("merchant_name"),
        "mcc": c("mcc"),
        "terminal_id": c("terminal_id"),
        "transaction_type": c("transaction_type"),
        "pos_entry_mode": c("pos_entry_mode"),
        "channel": lit("POS"),
        "customer_id": c("card_token"),
        "payment_method": lit("CARD"),
        "status": lit("APPROVED"),
        "acquirer_id": c("acquirer_id"),
        "stan": c("stan"),
    }


def _mobile_money() -> dict[str, Column]:
    c, lit = F.col, F.lit
    return {
        "source_type": lit("DARAJA_WEBHOOK"),
        "card_token": c("msisdn_token"),
        "bin": lit("639301"),
        "currency": lit("KES"),
        "currency_code": lit("404"),
        "merchant_id": c("account_token"),
        "mcc": lit("4814"),
        "transaction_type": c("transaction_type"),
        "channel": lit("MOBILE_APP"),
        "customer_id": c("msisdn_token"),
        "payment_method": lit("MOBILE_MONEY"),
        "status": lit("APPROVED"),
        "stan": F.coalesce(c("mpesa_receipt_number"), c("transaction_receipt")),
    }


def _web_gateway(token: str, source_type: str, extra: dict[str, Column]) -> dict[str, Column]:
    c, lit = F.col, F.lit
    return {
        "source_type": lit(source_type),
        "card_token": c(token),
        "currency": c("currency"),
        "currency_code": F.coalesce(c("currency_code"), looked_up(c("currency"), _ALPHA_TO_CODE)),
        "mcc": F.coalesce(c("mcc"), lit("5999")),
        "transaction_type": lit("PURCHASE"),
        "pos_entry_mode": lit("01"),
        "channel": lit("WEB"),
        "customer_id": c(token),
        "payment_method": lit("CARD"),
        "stan": c("transaction_id"),
    } | extra


def mappings() -> dict[str, dict[str, Column]]:
    c, lit = F.col, F.lit
    return {
        VISA: _networks(),
        MASTERCARD: _networks(),
        MPESA: _mobile_money(),
        FLUTTERWAVE: _web_gateway(
            "card_token",
            "WEBHOOK",
            {
                "bin": c("bin"),
                "last4": c("last4"),
                "merchant_id": F.coalesce(c("merchant_id"), lit("UNKNOWN")),
                "device_fingerprint": c("device_fingerprint"),
                "auth_model": c("auth_model"),
                "status": c("status"),
            },
        ),
        PESAPAL: _web_gateway(
            "payment_account_token",
            "IPN_CALLBACK",
            {
                "bin": F.coalesce(c("bin"), lit("000000")),
                "merchant_id": F.coalesce(c("merchant_id"), c("merchant_reference_token")),
                "status": c("payment_status"),
            },
        ),
    }


@built_once
def canonical_columns() -> list[Column]:
    by_provider = mappings()
    shared = {
        "transaction_id": F.col("transaction_id"),
        "provider": F.col("provider"),
        "event_timestamp": event_time(F.col("timestamp"), F.col("event_time_ms")),
        "event_time_ms": F.col("event_time_ms"),
        "amount": F.col("amount"),
        "is_fraud": F.col("is_fraud"),
        "risk_score": F.col("risk_score"),
        "fraud_pattern": F.col("fraud_pattern"),
    }
    out = []
    for f in schemas.CANONICAL.fields:
        value = shared.get(f.name)
        if value is None:
            value = per_provider({p: m[f.name] for p, m in by_provider.items() if f.name in m})
        out.append(value.cast(f.dataType).alias(f.name))
    return out


def normalise(tokenised: DataFrame) -> DataFrame:
    """Canonical columns; rows of unknown providers are dropped, as no mapping names them."""
    return tokenised.where(F.col("provider").isin(*PROVIDERS)).select(*canonical_columns())


def with_usability(canonical: DataFrame) -> DataFrame:
    """Add ``error_reason``: set where a required canonical column is missing."""
    missing = [
        F.when(F.col(f.name).isNull(), F.lit(f"Missing {f.name}"))
        for f in schemas.CANONICAL.fields
        if not f.nullable
    ]
    return canonical.withColumn("error_reason", F.coalesce(*missing))


def only_provider(df: DataFrame, provider: str) -> DataFrame:
    return df.where(F.col("provider") == provider)


def union_of(*frames: DataFrame) -> DataFrame:
    """Union by name, for inputs that really are separate tables."""
    return reduce(lambda a, b: a.unionByName(b), frames)
