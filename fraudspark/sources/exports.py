"""JSON exports of a whole batch of transactions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudspark.sources import ranges

# Text of a chunk that goes to the writing task; it holds some thousands of them at once.
_CHUNK_CHARS = 8_192
_CHUNKS = "part int, number bigint, value string"


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON object per line, written in parallel."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_wrapped_json(df: DataFrame, path: str, metadata: dict, field: str = "transactions") -> None:
    """One document ``{"metadata": .., field: [..]}``, with the rows in their order.

    It is one file, so one task writes it; all others make the text, in chunks of some lines.
    """
    head = json.dumps({"metadata": metadata})[:-1] + f', "{field}": ['
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, held, size = [], [], 0
            for value in batch["value"].to_pylist():
                held.append("," + value)
                size += len(value)
                if size >= _CHUNK_CHARS:
                    texts.append("\n".join(held))
                    held, size = [], 0
            if held:
                texts.append("\n".join(held))
            numbers = pa.array(range(number, number + len(texts)), pa.int64())
            number += len(texts)
            partitions = pa.array([partition] * len(texts), pa.int32())
            yield pa.RecordBatch.from_pydict({"part": partitions, "number": numbers, "value": pa.array(texts, pa.string())})

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            values = batch["value"].to_pylist()
            # The head comes first, and the chunk behind it has nothing to follow.
            if seen <= 1 < seen + len(values):
                values[1 - seen] = values[1 - seen][1:]
            seen += len(values)
            yield pa.RecordBatch.from_pydict({"value": pa.array(values, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["]}"]})

    made = rows.mapInArrow(chunks, _CHUNKS)
    begin = df.sparkSession.createDataFrame([(-1, -1, head)], _CHUNKS)
    ordered = made.unionByName(begin).repartition(1).sortWithinPartitions("part", "number").select("value")
    ordered.mapInArrow(lines, "value string").write.text(path)


def read_wrapped_json(
    spark: SparkSession, path: str, schema: T.StructType, range_bytes: int | None = None
) -> DataFrame:
    """Read documents of the form ``{"metadata": .., "transactions": [..]}``.

    A document is one JSON value and so one task per file. With ``range_bytes`` large documents are
    cut into ranges of that size and read by as many tasks (``sources/ranges.py``).
    """
    if range_bytes:
        return ranges.read_wrapped(spark, path, schema, range_bytes=range_bytes)
    whole = T.StructType([T.StructField("transactions", T.ArrayType(schema))])
    docs = spark.read.schema(whole).json(path, multiLine=True)
    return docs.select(F.explode("transactions").alias("t")).select("t.*")
