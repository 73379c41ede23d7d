"""Contracts: an Avro record schema, compiled to Spark types and held against tables.

``compiled`` turns the schema's text into fields with a Spark type, whether they may be null, their
default, aliases and symbols. ``conform`` brings a table into that form by one projection, as a reader
of the schema would: fields are found by name or alias, numbers are widened, what is absent gets its
default. ``checked`` lists per row what breaks the contract, ``violations`` counts it per field in one
pass.

Field lists may hold plain ``"name": type`` pairs among the records; such a pair's default may stand
next to its type. Of unions, ``null`` makes a field optional, and several numbers become the widest;
other unions of several types have no column type and are refused. Decimals have their precision and scale,
times of day become numbers of their unit, enums and uuids are strings. An optional field that is
absent is null.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN: dict[str, T.DataType] = {
    "null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(),
}
_LOGICAL: dict[str, T.DataType] = {
    "date": T.DateType(), "timestamp-millis": T.TimestampType(), "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(), "local-timestamp-micros": T.TimestampNTZType(),
}
#: Numbers from narrow to wide, and what a reader of a type accepts besides it.
_WIDER = ("int", "long", "float", "double")
_PROMOTED = {
    T.LongType: (T.IntegerType, T.ShortType, T.ByteType),
    T.IntegerType: (T.ShortType, T.ByteType),
    T.FloatType: (T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    T.DoubleType: (T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType),
    T.StringType: (T.BinaryType,),
    T.BinaryType: (T.StringType,),
}

MISSING, NULL, TYPE, VALUE, SYMBOL = "MISSING_FIELD", "NULL_VALUE", "WRONG_TYPE", "UNFIT_VALUE", "UNKNOWN_SYMBOL"


class ContractError(ValueError):
    """A schema that has no Spark form."""


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    optional: bool = False
    has_default: bool = False
    default: Any = None
    aliases: tuple[str, ...] = ()
    symbols: tuple[str, ...] = ()
    #: Times given as numbers count in this many to the second.
    per_second: int = 0


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.optional) for f in self.fields])

    def with_aliases(self, aliases: dict[str, str]) -> Contract:
        """Fields are also found under these names."""
        return replace(
            self,
            fields=tuple(replace(f, aliases=(*f.aliases, aliases[f.name])) if f.name in aliases else f for f in self.fields),
        )


# ---------------------------------------------------------------- reading the text


def _value(text: str, at: int) -> tuple[Any, int]:
    return json.JSONDecoder().raw_decode(text, at)


def _space(text: str, at: int) -> int:
    while at < len(text) and text[at] in " \t\r\n,":
        at += 1
    return at


def _field_list(text: str, at: int) -> tuple[str, int]:
    """The list that begins here as plain JSON, pairs made records; and where it ends."""
    items, at = [], _space(text, at + 1)
    while text[at : at + 1] != "]":
        item, at = _value(text, at)
        at = _space(text, at)
        if text[at : at + 1] == ":":
            own, at = _value(text, _space(text, at + 1))
            pair = {"name": item, "type": own}
            if isinstance(own, dict) and "default" in own:
                pair["default"] = own["default"]
            item, at = pair, _space(text, at)
        items.append(item)
    return json.dumps(items), at + 1


def _loads(text: str) -> Any:
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        mark = text.find('"fields"')
        begin = text.find("[", mark)
        if mark < 0 or begin < 0:
            raise
        try:
            items, end = _field_list(text, begin)
        except (json.JSONDecodeError, IndexError) as e:
            raise ContractError(f"the schema can't be read: {e}") from e
        return json.loads(text[:begin] + items + text[end:])


class _Compiler:
    """Types of one schema; named types may be used again by their name."""

    def __init__(self) -> None:
        self.named: dict[str, Any] = {}

    def field(self, spec: dict) -> Field:
        made = self._of(spec["type"], spec["name"])
        return replace(
            made,
            has_default="default" in spec,
            default=spec.get("default"),
            aliases=tuple(spec.get("aliases", ())),
        )

    def _of(self, kind: Any, name: str) -> Field:
        if isinstance(kind, list):
            return self._union(kind, name)
        if isinstance(kind, str):
            if kind in _PLAIN:
                return Field(name, _PLAIN[kind], optional=kind == "null")
            if kind not in self.named:
                raise ContractError(f"{name}: unknown type {kind}")
            return self._of(self.named[kind], name)
        own = kind["type"]
        if own in ("record", "enum", "fixed"):
            self.named[kind["name"]] = kind
            if "namespace" in kind:
                self.named[f"{kind['namespace']}.{kind['name']}"] = kind
        logical = kind.get("logicalType")
        if logical == "decimal":
            return Field(name, T.DecimalType(kind["precision"], kind.get("scale", 0)))
        if logical in _LOGICAL:
            return Field(name, _LOGICAL[logical], per_second=1_000_000 if "micros" in logical else 1000 if "millis" in logical else 0)
        if own == "record":
            inner = [self.field(f) for f in kind["fields"]]
            return Field(name, T.StructType([T.StructField(f.name, f.type, f.optional) for f in inner]))
        if own == "enum":
            return Field(name, T.StringType(), symbols=tuple(kind["symbols"]))
        if own == "fixed":
            return Field(name, T.BinaryType())
        if own == "array":
            item = self._of(kind["items"], name)
            return Field(name, T.ArrayType(item.type, item.optional))
        if own == "map":
            item = self._of(kind["values"], name)
            return Field(name, T.MapType(T.StringType(), item.type, item.optional))
        return self._of(own, name)

    def _union(self, kinds: list, name: str) -> Field:
        rest = [k for k in kinds if k != "null"]
        if not rest:
            return Field(name, T.NullType(), optional=True)
        if len(rest) > 1:
            if not all(k in _WIDER for k in rest):
                raise ContractError(f"{name}: a union of {rest} has no column type")
            rest = [max(rest, key=_WIDER.index)]
        return replace(self._of(rest[0], name), optional="null" in kinds)


def compiled(text: str) -> Contract:
    """The contract of an Avro record schema."""
    spec = _loads(text)
    if not isinstance(spec, dict) or spec.get("type") != "record":
        raise ContractError("a contract is a record schema")
    compiler = _Compiler()
    return Contract(spec["name"], tuple(compiler.field(f) for f in spec["fields"]))


# ---------------------------------------------------------------- tables


def _source(df: DataFrame, f: Field) -> str | None:
    return next((n for n in (f.name, *f.aliases) if n in df.columns), None)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _reads(given: T.DataType, f: Field) -> bool:
    """Whether a reader of the field takes columns of this type."""
    if given == f.type or isinstance(given, T.NullType):
        return True
    if f.per_second:
        return isinstance(given, (T.LongType, T.IntegerType, T.TimestampType, T.TimestampNTZType))
    if isinstance(f.type, T.DecimalType):
        return isinstance(given, (T.DecimalType, T.IntegralType))
    if type(given) is type(f.type) and isinstance(f.type, (T.ArrayType, T.MapType, T.StructType)):
        return True
    return isinstance(given, _PROMOTED.get(type(f.type), ()))


def _read(df: DataFrame, f: Field, name: str) -> Column:
    given = df.schema[name].dataType
    if f.per_second and isinstance(given, (T.LongType, T.IntegerType)):
        micros = _quoted(name).cast("bigint") * (1_000_000 // f.per_second)
        return F.timestamp_micros(micros).try_cast(f.type)
    return _quoted(name).try_cast(f.type)


def _default(f: Field) -> Column:
    value = f.default
    if value is None or not f.has_default:
        return F.lit(None).cast(f.type)
    if isinstance(f.type, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(F.lit(json.dumps(value)), f.type)
    if isinstance(f.type, T.BinaryType):
        return F.lit(value.encode("latin-1"))
    if f.per_second:
        return F.timestamp_micros(F.lit(value * (1_000_000 // f.per_second)).cast("bigint")).cast(f.type)
    return F.lit(value).cast(f.type)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns, in its order; what can't be read is null."""
    made = []
    for f in contract.fields:
        name = _source(df, f)
        if name is None or not _reads(df.schema[name].dataType, f):
            column = _default(f)
        else:
            column = _read(df, f, name)
        made.append(column.alias(f.name))
    return df.select(*made)


def _broken(df: DataFrame, f: Field) -> list[tuple[str, Column]]:
    """What can be wrong with a field: the reason, and when it is so."""
    name = _source(df, f)
    if name is None:
        return [] if f.optional or f.has_default else [(MISSING, F.lit(True))]
    if not _reads(df.schema[name].dataType, f):
        return [(TYPE, F.lit(True))]
    given, read = _quoted(name), _read(df, f, name)
    made = [] if f.optional else [(NULL, given.isNull())]
    if not isinstance(df.schema[name].dataType, T.NullType) and df.schema[name].dataType != f.type:
        made.append((VALUE, given.isNotNull() & read.isNull()))
    if f.symbols:
        made.append((SYMBOL, F.coalesce(~read.isin(*f.symbols), F.lit(False))))
    return made


def checked(df: DataFrame, contract: Contract, name: str = "violations") -> DataFrame:
    """Add the list of ``field: reason`` of every row; empty if the row keeps the contract."""
    found = [F.when(when, F.lit(f"{f.name}: {reason}")) for f in contract.fields for reason, when in _broken(df, f)]
    nothing = F.array().cast("array<string>")
    return df.withColumn(name, F.array_compact(F.array(*found)) if found else nothing)


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``field, reason, rows`` of all that breaks the contract, counted in one pass."""
    found = [(f.name, reason, when) for f in contract.fields for reason, when in _broken(df, f)]
    if not found:
        return df.sparkSession.createDataFrame([], "field string, reason string, rows bigint")
    counted = df.agg(*[F.count_if(when).alias(f"_{k}") for k, (_, _, when) in enumerate(found)])
    each = F.array(
        *[F.struct(F.lit(n).alias("field"), F.lit(r).alias("reason"), F.col(f"_{k}").alias("rows")) for k, (n, r, _) in enumerate(found)]
    )
    return counted.select(F.inline(each)).where("rows > 0")


# The fields of a canonical transaction as it is published, in order; ``?`` marks
# fields that may be null, ``=`` a default, and symbols stand in brackets.
CANONICAL_FIELDS = """
transaction_id string
provider (VISA MASTERCARD MPESA PESAPAL FLUTTERWAVE)
event_timestamp timestamp-millis
processing_timestamp timestamp-millis
customer_token string
card_token string?
account_token string?
merchant_id string?
merchant_name string?
merchant_country string?
mcc string?
amount double
currency string
amount_usd double
device_fingerprint string?
ip_address string?
ip_country string?
payment_channel (POS ATM ECOMMERCE MOBILE USSD QR)
transaction_type string
auth_model string?
pos_entry_mode string?
status (APPROVED DECLINED PENDING FAILED)
bin string?
card_type string?
issuer_country string?
issuer_name string?
card_brand string?
is_prepaid boolean =false
mcc_description string?
merchant_risk_score double?
merchant_fraud_rate double?
velocity_features map:long
aggregate_features map:double
risk_signals map:boolean
device_risk_score double?
fraud_score double?
is_fraud boolean =false
rule_triggers array:string
enrichment_latency_ms int
partition_key string
"""


def canonical_text() -> str:
    """The schema text of a published canonical transaction."""
    fields: list[dict[str, Any]] = []
    for line in CANONICAL_FIELDS.strip().splitlines():
        name, _, rest = line.partition(" ")
        spec: dict[str, Any] = {"name": name}
        rest, _, default = rest.partition(" =")
        kind: Any = rest.rstrip("?")
        if kind.startswith("("):
            kind = {"type": "enum", "name": name.title().replace("_", ""), "symbols": kind[1:-1].split()}
        elif kind.startswith("timestamp"):
            kind = {"type": "long", "logicalType": kind}
        elif ":" in kind:
            outer, inner = kind.split(":")
            kind = {"type": outer, "items" if outer == "array" else "values": inner}
        spec["type"] = ["null", kind] if rest.endswith("?") else kind
        if default:
            spec["default"] = json.loads(default)
        fields.append(spec)
    return json.dumps({"type": "record", "name": "CanonicalTransaction", "fields": fields})
