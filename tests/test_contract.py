"""Avro contracts: what compiles to which type, and what breaks a contract."""

import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from fraudspark.sources import contract as c


def record(*fields, **more):
    return json.dumps({"type": "record", "name": "R", "fields": list(fields)} | more)


def one(kind, **more):
    return c.compiled(record({"name": "x", "type": kind} | more)).fields[0]


@pytest.mark.parametrize(
    "kind,expected",
    [
        ("boolean", T.BooleanType()), ("int", T.IntegerType()), ("long", T.LongType()), ("float", T.FloatType()),
        ("double", T.DoubleType()), ("bytes", T.BinaryType()), ("string", T.StringType()),
        ({"type": "fixed", "name": "F", "size": 4}, T.BinaryType()),
        ({"type": "int", "logicalType": "date"}, T.DateType()),
        ({"type": "long", "logicalType": "timestamp-millis"}, T.TimestampType()),
        ({"type": "long", "logicalType": "local-timestamp-micros"}, T.TimestampNTZType()),
        ({"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}, T.DecimalType(9, 2)),
        ({"type": "string", "logicalType": "uuid"}, T.StringType()),
        ({"type": "array", "items": ["null", "int"]}, T.ArrayType(T.IntegerType(), True)),
        ({"type": "map", "values": "long"}, T.MapType(T.StringType(), T.LongType(), False)),
        (["int", "double"], T.DoubleType()),
    ],
)
def test_types(kind, expected):
    assert one(kind).type == expected and not one(kind).optional


def test_unions_names_and_defaults():
    assert one(["null", "string"]).optional and one(["string", "null"]).type == T.StringType()
    assert one("int", default=3).default == 3 and one(["null", "int"], default=None).has_default
    with pytest.raises(c.ContractError):
        one(["int", "string"])
    with pytest.raises(c.ContractError):
        one("Unknown")
    with pytest.raises(c.ContractError):
        c.compiled('"string"')
    inner = {"type": "record", "name": "P", "fields": [{"name": "a", "type": "int"}, {"name": "b", "type": ["null", "E"]}]}
    made = c.compiled(record({"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["U", "V"]}}, {"name": "p", "type": inner}))
    assert made.schema["p"].dataType == T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType(), True)])
    assert made.fields[0].symbols == ("U", "V")


def test_pairs_among_the_fields():
    text = '{"type": "record", "name": "R", "fields": [ {"name": "a", "type": "int"}, "b": ["null", "string"],\n "c": {"type": "boolean", "default": false} ], "version": "1"}'
    made = c.compiled(text)
    assert [(f.name, f.type, f.optional, f.has_default) for f in made.fields] == [
        ("a", T.IntegerType(), False, False), ("b", T.StringType(), True, False), ("c", T.BooleanType(), False, True)
    ]
    for broken in ('{"type": "record", "fields": [', '{"fields": [ "a": }', "nothing"):
        with pytest.raises((c.ContractError, json.JSONDecodeError)):
            c.compiled(broken)


def test_rows_against_a_contract(spark):
    made = c.compiled(
        record(
            {"name": "id", "type": "string"},
            {"name": "n", "type": "long"},
            {"name": "kind", "type": {"type": "enum", "name": "K", "symbols": ["A", "B"]}, "aliases": ["sort"]},
            {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
            {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 2}},
            {"name": "tags", "type": {"type": "array", "items": "string"}, "default": ["none"]},
            {"name": "note", "type": ["null", "string"]},
            {"name": "flag", "type": "boolean"},
            {"name": "gone", "type": "int"},
        )
    )
    rows = [("a", 1, "A", 1_000, 12, "yes"), ("b", 2, "Z", None, 1234, "no"), (None, None, None, 5, 1, None)]
    df = spark.createDataFrame(rows, "id string, n int, sort string, at bigint, price int, flag string")
    found = {tuple(r) for r in c.violations(df, made).collect()}
    assert found == {
        ("id", c.NULL, 1), ("n", c.NULL, 1), ("kind", c.SYMBOL, 1), ("kind", c.NULL, 1), ("at", c.NULL, 1),
        ("price", c.VALUE, 1), ("flag", c.TYPE, 3), ("gone", c.MISSING, 3),
    }
    by_id = {r.id: r.violations for r in c.checked(df, made).collect()}
    assert by_id["a"] == ["flag: WRONG_TYPE", "gone: MISSING_FIELD"]
    assert set(by_id["b"]) == {"kind: UNKNOWN_SYMBOL", "at: NULL_VALUE", "price: UNFIT_VALUE", "flag: WRONG_TYPE", "gone: MISSING_FIELD"}
    out = {r.id: r for r in c.conform(df, made).collect()}
    assert c.conform(df, made).columns == [f.name for f in made.fields]
    assert [f.dataType.simpleString() for f in c.conform(df, made).schema] == [f.type.simpleString() for f in made.fields]
    assert out["a"].at == dt.datetime(1970, 1, 1, 0, 0, 1) and out["a"].kind == "A" and out["a"].tags == ["none"]
    assert out["b"].price is None and str(out["a"].price) == "12.00" and out["a"].note is None and out["a"].gone is None


def test_one_projection_and_one_pass(spark):
    made = c.compiled(c.canonical_text())
    df = spark.range(3).selectExpr("cast(id as string) AS transaction_id")
    plan = c.conform(df, made)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1 and "Join" not in plan and len(made.fields) == 40
    plan = c.violations(df, made)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_an_empty_table_and_nothing_to_break(spark):
    made = c.compiled(record({"name": "a", "type": ["null", "int"]}))
    empty = spark.createDataFrame([], "a int, other string")
    assert c.violations(empty, made).count() == 0 and c.checked(empty, made).count() == 0
    assert c.conform(empty, made).columns == ["a"]
    kept = spark.createDataFrame([(1, "x")], "a int, other string")
    assert c.checked(kept, made).first().violations == []
