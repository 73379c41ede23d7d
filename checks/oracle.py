"""SQL counterparts, for an independent engine. Formulas are stated from the rules, not shared."""

from __future__ import annotations

from checks.workload import DUCKDB_PAYMENTS, DUCKDB_TRANSACTIONS
from fraudspark.sources import refdata

# Key used by the checks only.
CHECK_KEY = b"key-for-checks-only"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return str(v) if isinstance(v, float) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


_REFERENCE = ", ".join(
    [
        _values("r_mcc", "mcc, mcc_description, mcc_category, is_high_risk_mcc", refdata.MCC_ROWS),
        _values("r_cur", "currency_code, currency_alpha, currency_name, currency_region", refdata.CURRENCY_ROWS),
        _values("r_fx", "currency_alpha, fx_rate_to_usd", [(a, float(b)) for a, b in refdata.FX_ROWS]),
        _values("r_bin", "bin, bin_brand, bin_card_type, bin_country, bin_issuer, bin_prepaid", refdata.BIN_ROWS),
    ]
)

_JOINED = """
SELECT t.*, m.mcc_description, m.mcc_category, m.is_high_risk_mcc, c.currency_alpha, c.currency_name,
  c.currency_region, CAST(x.fx_rate_to_usd AS DOUBLE) AS fx_rate_to_usd,
  t.amount * CAST(x.fx_rate_to_usd AS DOUBLE) AS amount_usd,
  b.bin_brand, b.bin_card_type, b.bin_country, b.bin_issuer, b.bin_prepaid
FROM t LEFT JOIN r_mcc m ON t.mcc = m.mcc LEFT JOIN r_cur c ON t.currency_code = c.currency_code
LEFT JOIN r_fx x ON t.currency = x.currency_alpha LEFT JOIN r_bin b ON t.bin = b.bin
"""


def _over(measure: str, key: str, width_us: int) -> str:
    return (
        f"CASE WHEN {key} IS NOT NULL THEN {measure} OVER (PARTITION BY {key}, event_us // {width_us}) END"
    )


def _count(key: str, width_us: int) -> str:
    return f"COALESCE({_over('COUNT(*)', key, width_us)}, 1)"


MINUTE, FIVE, HOUR, DAY = 60_000_000, 300_000_000, 3_600_000_000, 86_400_000_000

_VELOCITY = f"""
SELECT *, {_count("card_token", MINUTE)} AS card_txn_count_1min,
  {_over("SUM(amount)", "card_token", MINUTE)} AS card_txn_sum_1min,
  {_count("card_token", FIVE)} AS card_txn_count_5min,
  {_over("SUM(amount)", "card_token", FIVE)} AS card_amount_sum_5min,
  {_count("card_token", HOUR)} AS card_txn_count_1hr,
  {_over("SUM(amount)", "card_token", HOUR)} AS card_amount_sum_1hr,
  {_over("AVG(amount)", "card_token", HOUR)} AS card_amount_avg_1hr,
  {_over("MAX(amount)", "card_token", HOUR)} AS card_amount_max_1hr,
  {_count("merchant_id", HOUR)} AS merchant_txn_count_1hr,
  {_over("SUM(amount)", "merchant_id", HOUR)} AS merchant_amount_sum_1hr,
  make_timestamp(event_us) AS ts
FROM j
"""

# Lower merchant threshold than the default, so that both outcomes occur at this scale.
VOLUME_OVER = 4

_FEATURES = f"""
SELECT *,
  COALESCE(amount_usd, amount) > 2000 AS is_high_value,
  pos_entry_mode IN ('01', '10', '81') OR COALESCE(auth_model, '') IN ('NOAUTH', 'VBV', '3DS')
    OR channel = 'WEB' AS is_cnp,
  hour(ts) BETWEEN 1 AND 4 AS is_unusual_hour,
  dayofweek(ts) IN (0, 6) AS is_weekend,
  COALESCE(currency, 'USD') <> 'USD' AS is_cross_border,
  CAST(hour(ts) AS INT) AS txn_hour, CAST(dayofweek(ts) + 1 AS INT) AS txn_day_of_week,
  CAST(day(ts) AS INT) AS txn_day_of_month, CAST(month(ts) AS INT) AS txn_month,
  hour(ts) BETWEEN 8 AND 20 AS is_business_hours, hour(ts) BETWEEN 1 AND 4 AS is_late_night,
  day(ts) >= 28 AS is_month_end, event_us // 1000000 AS event_unix_ts,
  CASE WHEN bin_country IS NULL OR currency_region IS NULL THEN FALSE
    WHEN bin_country IN ('KE', 'UG', 'TZ', 'RW', 'ZA', 'NG', 'GH') THEN currency_region <> 'AFRICA'
    ELSE currency_region = 'AFRICA' END AS is_international,
  CASE WHEN bin_country IN ('KE', 'UG', 'TZ') AND currency IN ('USD', 'GBP', 'EUR') THEN TRUE
    WHEN bin_country IN ('US', 'GB') AND currency IN ('KES', 'NGN', 'ZAR') THEN TRUE
    ELSE FALSE END AS is_cross_border_currency,
  CASE WHEN card_amount_avg_1hr > 0 THEN amount / card_amount_avg_1hr ELSE 1.0 END AS ratio,
  card_txn_count_1min > 3 AS is_rapid_succession,
  card_txn_count_1hr > 10 AS is_high_velocity,
  amount % 1000 = 0 AND amount >= 1000 AS is_round_amount,
  COALESCE(amount_usd, amount) < 1 AS is_micro_transaction,
  CASE WHEN pos_entry_mode IN ('01', '10', '00') OR auth_model IN ('NOAUTH', 'VBV', '3DS')
    OR channel IN ('WEB', 'MOBILE_APP') THEN TRUE ELSE FALSE END AS is_card_not_present,
  pos_entry_mode IN ('051', '071', '091') AS is_chip_transaction,
  device_fingerprint IS NOT NULL AS has_device_fingerprint,
  merchant_txn_count_1hr > {VOLUME_OVER} AS is_high_volume_merchant,
  COALESCE(bin_prepaid, FALSE) AND COALESCE(is_high_risk_mcc, FALSE) AS prepaid_at_high_risk_mcc,
  mcc = '6011' AND COALESCE(amount_usd, amount) > 500 AS is_high_value_atm
FROM v
"""

_SCORED = """
SELECT *, ratio > 3.0 AS is_amount_spike, CAST(LEAST(100,
    CASE WHEN is_high_risk_mcc THEN 20 ELSE 0 END + CASE WHEN is_international THEN 15 ELSE 0 END
  + CASE WHEN is_late_night THEN 10 ELSE 0 END + CASE WHEN ratio > 3.0 THEN 20 ELSE 0 END
  + CASE WHEN is_rapid_succession THEN 25 ELSE 0 END + CASE WHEN is_card_not_present THEN 10 ELSE 0 END
  + CASE WHEN is_cross_border_currency THEN 10 ELSE 0 END + CASE WHEN is_high_velocity THEN 15 ELSE 0 END
  + CASE WHEN prepaid_at_high_risk_mcc THEN 20 ELSE 0 END
  + CASE WHEN is_micro_transaction THEN 15 ELSE 0 END) AS INT) AS composite_risk_score
FROM f
"""

_CTES = {
    "t": DUCKDB_TRANSACTIONS,
    "p": DUCKDB_PAYMENTS,
    "j": _JOINED,
    "v": _VELOCITY,
    "f": _FEATURES,
    "s": _SCORED,
}


def with_ctes(sql: str, upto: str) -> str:
    """``sql`` over the named common tables, up to and including ``upto``."""
    parts = []
    for name, body in _CTES.items():
        parts.append(f"{name} AS ({body})")
        if name == upto:
            break
        if name == "p":
            parts.append(_REFERENCE)
    return f"WITH {', '.join(parts)} {sql}"


def over_transactions(sql: str) -> str:
    return with_ctes(sql, "t")


def over_joined(sql: str) -> str:
    return with_ctes(sql, "j")


def over_scored(sql: str) -> str:
    return with_ctes(sql, "s")


def mac(text: str) -> str:
    """Upper-case hex HMAC-SHA256 of a SQL text expression under the check key."""
    block = CHECK_KEY.ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in block).hex() for x in (0x36, 0x5C))
    return (
        f"upper(sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || CAST({text} AS BLOB)))))"
    )


def luhn(digits: str) -> str:
    """Luhn test of a SQL text expression that holds digits only."""
    digit = f"CAST(substr({digits}, length({digits}) - i, 1) AS INT)"
    doubled = f"(CASE WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)"
    return (
        f"list_sum(list_transform(range(length({digits})), lambda i: "
        f"CASE WHEN i % 2 = 1 THEN {doubled} ELSE {digit} END)) % 10 = 0"
    )


def card_digits(pan: str) -> str:
    return f"replace(replace({pan}, ' ', ''), '-', '')"


def phone_digits(phone: str) -> str:
    return f"replace(replace({phone}, ' ', ''), '+', '')"


def e164(phone: str) -> str:
    d = phone_digits(phone)
    return (
        f"CASE WHEN {d} LIKE '0%' AND length({d}) = 10 THEN '254' || substr({d}, 2) "
        f"WHEN {d} LIKE '7%' AND length({d}) = 9 THEN '254' || {d} ELSE {d} END"
    )


def shaped(digits: str, letters: str) -> str:
    return (
        f"substr({digits}, 1, 6) || translate(substr({mac(digits)}, 1, length({digits}) - 10), 'ABCDEF', "
        f"'{letters}') || right({digits}, 4)"
    )


def _pan_reason(pan: str, checks: str) -> str:
    d = card_digits(pan)
    safe = f"regexp_replace({d}, '[^0-9]', '0', 'g')"  # the engine may look at every branch
    return (
        f"CASE WHEN {pan} IS NULL OR {pan} = '' THEN 'PAN is empty' "
        f"WHEN NOT regexp_full_match({d}, '[0-9]+') THEN 'PAN must contain only digits' {checks} "
        f"WHEN NOT ({luhn(safe)}) "
        f"THEN 'PAN failed Luhn validation' END"
    )


def visa_reason(pan: str = "visa_pan") -> str:
    n = f"length({card_digits(pan)})"
    return _pan_reason(
        pan,
        f"WHEN {n} NOT BETWEEN 13 AND 19 THEN 'PAN length ' || CAST({n} AS VARCHAR) || ' invalid (must be 13-19)'",
    )


def mastercard_reason(pan: str = "mastercard_pan") -> str:
    d = card_digits(pan)
    n = f"length({d})"
    return _pan_reason(
        pan,
        f"WHEN {n} <> 16 THEN 'Mastercard PAN length ' || CAST({n} AS VARCHAR) || ' invalid (must be 16)' "
        f"WHEN NOT (substr({d}, 1, 2) IN ('51', '52', '53', '54', '55') OR "
        f"TRY_CAST(substr({d}, 1, 4) AS INT) BETWEEN 2221 AND 2720) "
        f"THEN 'PAN does not start with valid Mastercard BIN'",
    )


def msisdn_reason(phone: str = "phone") -> str:
    d = phone_digits(phone)
    return (
        f"CASE WHEN {phone} IS NULL OR {phone} = '' THEN 'MSISDN is empty' "
        f"WHEN length({d}) NOT BETWEEN 9 AND 13 THEN 'MSISDN length ' || CAST(length({d}) AS VARCHAR) || "
        f"' invalid (must be 9-13)' WHEN NOT regexp_full_match({d}, '[0-9]+') THEN 'MSISDN must contain only digits' "
        f"WHEN {d} LIKE '254%' AND length({d}) <> 12 THEN 'Kenyan MSISDN with country code must be 12 digits' "
        f"WHEN {d} LIKE '0%' AND length({d}) <> 10 THEN 'Kenyan MSISDN without country code must be 10 digits' END"
    )


def phone_reason(phone: str = "phone") -> str:
    d = phone_digits(phone)
    return (
        f"CASE WHEN {phone} IS NULL OR {phone} = '' THEN 'Phone is empty' "
        f"WHEN length({d}) NOT BETWEEN 8 AND 15 THEN 'Phone length ' || CAST(length({d}) AS VARCHAR) || "
        f"' invalid (must be 8-15)' WHEN NOT regexp_full_match({d}, '[0-9]+') THEN 'Phone must contain only digits' END"
    )


def email_reason(email: str = "email") -> str:
    a = f"lower(trim({email}))"
    return (
        f"CASE WHEN {email} IS NULL OR {email} = '' THEN 'Email is empty' WHEN NOT regexp_full_match({a}, "
        f"'[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z][a-zA-Z]+') THEN 'Invalid email format: ' || {a} END"
    )


def account_reason(account: str = "account") -> str:
    return (
        f"CASE WHEN {account} IS NULL OR {account} = '' THEN 'Payment account is empty' "
        f"WHEN length(trim({account})) < 4 THEN 'Payment account too short' END"
    )


def partial_reason(first6: str = "first6", last4: str = "last4") -> str:
    return (
        f"CASE WHEN COALESCE({first6}, '') = '' OR COALESCE({last4}, '') = '' "
        f"THEN 'First 6 or last 4 digits missing' "
        f"WHEN NOT regexp_full_match({first6}, '[0-9]*') OR length({first6}) <> 6 "
        f"THEN 'BIN must be 6 digits, got ' || CAST(length({first6}) AS VARCHAR) "
        f"WHEN NOT regexp_full_match({last4}, '[0-9]*') OR length({last4}) <> 4 "
        f"THEN 'Last4 must be 4 digits, got ' || CAST(length({last4}) AS VARCHAR) END"
    )


def _labelled(label: str, applies: str, reason: str) -> str:
    return f"CASE WHEN {applies} THEN '{label} validation failed: ' || ({reason}) END"


# The amount as parsed: 0 when missing, null when it cannot be read.
AMOUNT = "CASE WHEN bad_amount THEN NULL ELSE COALESCE(amount, 0.0) END"
_BAD = "(noise = 11 OR bad_amount)"
_UNKNOWN = "'Parse failure - unknown format'"

ERROR_REASON = f"""CASE provider
  WHEN 'VISA' THEN CASE WHEN {_BAD} THEN 'Parse failure'
    ELSE {_labelled("PAN", "TRUE", visa_reason())} END
  WHEN 'MASTERCARD' THEN CASE WHEN {_BAD} OR mastercard_pan IS NULL THEN {_UNKNOWN}
    ELSE {_labelled("PAN", "TRUE", mastercard_reason())} END
  WHEN 'MPESA' THEN CASE WHEN noise = 11 THEN 'JSON parse error' WHEN bad_amount THEN {_UNKNOWN}
    ELSE {_labelled("MSISDN", "phone IS NOT NULL", msisdn_reason())} END
  WHEN 'FLUTTERWAVE' THEN CASE WHEN noise = 11 THEN 'JSON parse error' WHEN bad_amount THEN {_UNKNOWN}
    ELSE {_labelled("Card", "first6 IS NOT NULL", partial_reason())} END
  ELSE CASE WHEN {_BAD} THEN {_UNKNOWN} ELSE COALESCE(
    {_labelled("Email", "email IS NOT NULL", email_reason())},
    {_labelled("Phone", "phone IS NOT NULL", phone_reason())},
    {_labelled("Payment account", "account IS NOT NULL", account_reason())}) END END"""

_FLW_REF = "CASE WHEN event_id % 11 <> 3 THEN 'FLW' || ref END"
_CUSTOMER = (
    "CASE WHEN customer_no IS NOT NULL THEN CAST(customer_no AS VARCHAR) || ':' || COALESCE(email, '') || ':' "
    "|| COALESCE(phone, '') WHEN email IS NOT NULL OR phone IS NOT NULL THEN COALESCE(email, '') || ':' || "
    "COALESCE(phone, '') END"
)
SHORT_CODE = "CASE WHEN NOT is_push THEN CAST(short_code AS VARCHAR) END"


def prefixed(prefix: str, text: str, n: int) -> str:
    return f"'{prefix}' || substr({mac(text)}, 1, {n})"


CARD_TEXT = f"first6 || ':' || last4 || COALESCE(':' || ({_FLW_REF}), '')"
TOKENS = {
    "visa": shaped(card_digits("visa_pan"), "567890"),
    "mastercard": shaped(card_digits("mastercard_pan"), "123456"),
    "msisdn": prefixed("MPESA_MSISDN_", e164("phone"), 16),
    "account": prefixed("MPESA_ACC_", SHORT_CODE, 12),
    "card": f"'FLW_' || first6 || '_TOKEN_' || substr({mac(CARD_TEXT)}, 1, 12) || '_' || last4",
    "customer": prefixed("FLW_CUST_", _CUSTOMER, 16),
    "reference": prefixed("FLW_REF_", "'TX' || ref", 12),
    "flw_reference": prefixed("FLW_REF_", _FLW_REF, 12),
    "email": prefixed("PESAPAL_EMAIL_", "lower(trim(email))", 16),
    "phone": prefixed("PESAPAL_PHONE_", e164("phone"), 16),
    "payment_account": f"CASE WHEN regexp_full_match(account, '[0-9]+') AND length(account) >= 16 "
    f"THEN {shaped('account', '567890')} ELSE {prefixed('PESAPAL_ACC_', 'account', 12)} END",
    "merchant": prefixed("PESAPAL_MERCHANT_", "merchant", 12),
}
GATEWAY_CARD = f"COALESCE({TOKENS['card']}, {TOKENS['flw_reference']})"

# Tokenised event of each good message, as far as the checks look at it.
TOKENISED = f"""
SELECT event_id, provider, sent_at, us,
  CASE provider WHEN 'FLUTTERWAVE' THEN COALESCE({_FLW_REF}, 'TX' || ref)
    WHEN 'PESAPAL' THEN 'TRACK' || ref ELSE ref END AS transaction_id,
  {AMOUNT} AS amount,
  CASE provider WHEN 'VISA' THEN {TOKENS["visa"]} WHEN 'MASTERCARD' THEN {TOKENS["mastercard"]}
    WHEN 'FLUTTERWAVE' THEN {GATEWAY_CARD} END AS card_token,
  CASE provider WHEN 'VISA' THEN substr({card_digits("visa_pan")}, 1, 6)
    WHEN 'MASTERCARD' THEN substr({card_digits("mastercard_pan")}, 1, 6)
    WHEN 'FLUTTERWAVE' THEN COALESCE(first6, '') END AS bin,
  CASE provider WHEN 'VISA' THEN right({card_digits("visa_pan")}, 4)
    WHEN 'MASTERCARD' THEN right({card_digits("mastercard_pan")}, 4)
    WHEN 'FLUTTERWAVE' THEN COALESCE(last4, '') END AS last4,
  CASE WHEN provider IN ('VISA', 'MASTERCARD') THEN COALESCE(currency_code, '404') END AS currency_code,
  CASE provider
    WHEN 'VISA' THEN CASE COALESCE(currency_code, '404') WHEN '404' THEN 'KES' WHEN '840' THEN 'USD'
      WHEN '826' THEN 'GBP' WHEN '978' THEN 'EUR' WHEN '710' THEN 'ZAR' ELSE 'KES' END
    WHEN 'MASTERCARD' THEN CASE COALESCE(currency_code, '404') WHEN '404' THEN 'KES' WHEN '840' THEN 'USD'
      WHEN '826' THEN 'GBP' WHEN '978' THEN 'EUR' WHEN '710' THEN 'ZAR' WHEN '800' THEN 'UGX'
      WHEN '834' THEN 'TZS' WHEN '124' THEN 'CAD' WHEN '392' THEN 'JPY' WHEN '756' THEN 'CHF' ELSE 'USD' END
    WHEN 'MPESA' THEN 'KES' WHEN 'FLUTTERWAVE' THEN COALESCE(currency, 'USD')
    ELSE COALESCE(currency, 'KES') END AS currency,
  CASE provider WHEN 'MPESA' THEN {TOKENS["msisdn"]} END AS msisdn_token,
  CASE provider WHEN 'MPESA' THEN {TOKENS["account"]} END AS account_token,
  CASE WHEN provider = 'MPESA' THEN
    CASE WHEN is_push OR short_code IS NULL THEN 'CUSTOMER' ELSE 'MERCHANT' END END AS transaction_role,
  CASE provider WHEN 'FLUTTERWAVE' THEN {TOKENS["customer"]} END AS customer_token,
  CASE provider WHEN 'FLUTTERWAVE' THEN {TOKENS["reference"]} END AS ref_token,
  CASE provider WHEN 'FLUTTERWAVE' THEN substr(md5(email), 1, 16) END AS customer_email_hash,
  CASE provider WHEN 'PESAPAL' THEN {TOKENS["email"]} END AS customer_email_token,
  CASE provider WHEN 'PESAPAL' THEN {TOKENS["phone"]} END AS customer_phone_token,
  CASE provider WHEN 'PESAPAL' THEN {TOKENS["payment_account"]} END AS payment_account_token,
  CASE provider WHEN 'PESAPAL' THEN {TOKENS["merchant"]} END AS merchant_reference_token,
  merchant, event_type, mcc, entry_mode, device, auth_model, payment_status, is_push, compact_time,
  ref, is_fraud
FROM r WHERE error_reason IS NULL
"""

_ROUTED = f"SELECT *, {ERROR_REASON} AS error_reason FROM p WHERE noise <> 13"


def over_payments(sql: str) -> str:
    return f"WITH p AS ({DUCKDB_PAYMENTS}) {sql}"


def over_routed(sql: str) -> str:
    return f"WITH p AS ({DUCKDB_PAYMENTS}), r AS ({_ROUTED}) {sql}"


def over_tokenised(sql: str) -> str:
    return f"WITH p AS ({DUCKDB_PAYMENTS}), r AS ({_ROUTED}), k AS ({TOKENISED}) {sql}"
