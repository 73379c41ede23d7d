"""Keyed hashing with built-in functions only.

HMAC-SHA256 is two SHA-256 passes over a padded key. The padded keys travel as rows of a tiny
table joined on the provider, so no key appears as a literal in a plan or in ``explain`` output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.config import PROVIDERS

INNER, OUTER = "_mac_inner", "_mac_outer"
_BLOCK = 64


def _pads(secret: bytes) -> tuple[bytes, bytes]:
    if not secret:
        raise ValueError("a MAC key must not be empty")
    block = (hashlib.sha256(secret).digest() if len(secret) > _BLOCK else secret).ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def key_table(spark: SparkSession, secrets: bytes | Mapping[str, bytes]) -> DataFrame:
    """One row per provider (five at most): the two padded keys."""
    per_provider = dict.fromkeys(PROVIDERS, secrets) if isinstance(secrets, bytes) else secrets
    rows = [(p, *map(bytearray, _pads(s))) for p, s in per_provider.items()]
    return spark.createDataFrame(rows, f"provider string, {INNER} binary, {OUTER} binary")


def with_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Attach the provider's keys; the key table has one row per provider, so it is broadcast."""
    return df.join(F.broadcast(keys), "provider", "left")


def without_keys(df: DataFrame) -> DataFrame:
    return df.drop(INNER, OUTER)


def hmac_hex(message: Column) -> Column:
    """Upper-case hex HMAC-SHA256 of a string under the keys attached to the row."""
    inner = F.sha2(F.concat(F.col(INNER), F.encode(message, "UTF-8")), 256)
    return F.upper(F.sha2(F.concat(F.col(OUTER), F.unhex(inner)), 256))
