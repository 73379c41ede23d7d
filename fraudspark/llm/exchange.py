"""What a block of documents needs to know of the whole corpus about each of its hashed keys.

Documents are dealt into blocks of some megabytes by a hash of their id and text. Rows that agree in
both, if they are many, are counted and dealt as few rows of up to ``COPIES`` copies each, with a
salt, so that neither a missing id nor one id nor one row repeated without end fills a block. A block
sends each distinct key it holds once, with a number per key, packed by part (a hash of the key): few large rows instead
of one per occurrence. A part sums the numbers of equal keys up over all blocks and sends every block
its answers in the order of its keys. A key therefore costs one entry per block, however many
documents hold it, so no key is too hot for its part; parts and blocks follow the size of the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import shared, words

#: Text per block and per part. A task holds a few dozen bytes per word of its block or part.
BLOCK_BYTES = 4_000_000
PART_BYTES = 12_000_000
#: Equal rows that one dealt row stands for at most, and what a row counts besides its text.
COPIES, ROW_BYTES = 1000, 64

KEYED = "block bigint, part int, keys binary, numbers binary"


def blocked(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id``, ``text`` as bytes, ``copies`` and ``block``; the number of parts for the same input.

    A row of the result stands for ``copies`` equal rows; ``spread`` brings them back.
    """
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES).cast("bigint")
    size = docs.agg(F.sum(weight).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), shared.binary_text())
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    # Fewer keys than four a block, counting ROW_BYTES for each row.
    heavy = shared.settled(
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"))
        .where((F.col("n") > 1) & (F.col("n") * (F.col("bytes") + ROW_BYTES) > BLOCK_BYTES // 4))
        .select("key")
    )
    one = F.lit(1).cast("bigint")
    frame = rows.withColumns({"copies": one, "salt": F.lit(0).cast("bigint")})
    if not heavy.isEmpty():
        counted = rows.join(F.broadcast(heavy), "key", "left_semi").groupBy("key", "doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
        salts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES))
        dealt = counted.select("key", "doc_id", "text", "n", F.explode(salts).alias("salt"))
        copies = F.least(F.lit(COPIES).cast("bigint"), F.col("n") - F.col("salt") * COPIES).alias("copies")
        frame = frame.join(F.broadcast(heavy), "key", "left_anti").unionByName(
            dealt.select("key", "doc_id", "text", copies, "salt")
        )
    return (
        frame.select("doc_id", "text", "copies", F.pmod(F.xxhash64("key", "salt"), F.lit(blocks)).alias("block")),
        max(1, math.ceil(size / PART_BYTES)),
    )


def spread(rows: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say, without that column."""
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("__copy")
    return rows.select("*", each).drop("copies", "__copy")


def in_order(block: pa.Table) -> pa.Table:
    """The rows of a block in an order that does not depend on how they arrived."""
    return block.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (words.mix(keys, 5) % np.uint64(parts)).astype(np.int32)


def packed(block: int, keys: np.ndarray, parts_of: np.ndarray, numbers: np.ndarray) -> pa.Table:
    """Rows of ``KEYED``: the keys and their numbers (any fixed width), by part, in the given order."""
    order = np.argsort(parts_of, kind="stable")
    owner = parts_of[order]
    edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, int)
    ends = np.append(edges, len(owner))[1:]
    keys, numbers = keys[order], numbers[order]
    return pa.table(
        {
            "block": pa.array(np.full(len(edges), block), pa.int64()),
            "part": pa.array(owner[edges], pa.int32()),
            "keys": pa.array([keys[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
            "numbers": pa.array([numbers[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
        }
    )


def unpacked(replies: pa.Table, parts_of: np.ndarray, kind: type) -> np.ndarray:
    """The numbers of all replies to a block, in the order of its keys; keys without a reply get 0."""
    order = np.argsort(parts_of, kind="stable")
    owner = parts_of[order]
    out = np.zeros(len(parts_of), kind)
    for part, numbers in zip(replies["part"].to_pylist(), replies["numbers"].to_pylist(), strict=True):
        a, b = np.searchsorted(owner, [part, part + 1])
        out[order[a:b]] = np.frombuffer(numbers, kind)
    return out


def answered(
    keyed: DataFrame, answer: Callable[[np.ndarray, np.ndarray, pa.Table], pa.Table], kind: type = np.uint64
) -> DataFrame:
    """Let each part answer all blocks; ``kind`` is the type of the keys.

    ``answer`` gets, for the keys of a part laid end to end, the group number of each key (equal keys
    have one number, ascending) and where each block's row begins, and the part itself.
    """

    def combine(part: pa.Table) -> pa.Table:
        shared.give_back()
        part = part.combine_chunks()
        rows = [np.frombuffer(k.as_py(), kind) for k in part["keys"]]
        _, group = np.unique(np.concatenate(rows), return_inverse=True)
        return answer(group, np.cumsum([0] + [len(r) for r in rows]), part)

    return keyed.groupBy("part").applyInArrow(combine, KEYED)


def numbers_of(part: pa.Table, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(n.as_py(), kind) for n in part["numbers"]])
