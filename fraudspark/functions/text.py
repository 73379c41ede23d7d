"""Small string and JSON helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_filled(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def card_digits(pan: Column) -> Column:
    """A card number without blanks and dashes."""
    return F.translate(pan, " -", "")


def phone_digits(phone: Column) -> Column:
    """A phone number without blanks and the plus sign."""
    return F.translate(F.trim(phone), " +", "")


def all_digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def international_phone(phone: Column) -> Column:
    """Kenyan local forms (0XXXXXXXXX, 7XXXXXXXX) become 254XXXXXXXXX; others stay as they are."""
    n = phone_digits(phone)
    return (
        F.when(n.startswith("0") & (F.length(n) == 10), F.concat(F.lit("254"), F.substring(n, 2, 9)))
        .when(n.startswith("7") & (F.length(n) == 9), F.concat(F.lit("254"), n))
        .otherwise(n)
    )


def masked_card(pan: Column) -> Column:
    """First six and last four digits around six stars, for display."""
    return F.concat(F.substring(pan, 1, 6), F.lit("******"), F.right(pan, F.lit(4)))


def looked_up(code: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Value of ``code`` in a small fixed map, else ``default``."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, code), F.lit(default))


def luhn_valid(digits: Column) -> Column:
    """Check-digit test of a card number."""
    return F.call_function("luhn_check", digits)
