"""Sharding by a hierarchical weighted hash tree.

A row descends from the root through region and rack to a shard. At each level every child draws
``-ln(u) / weight`` with ``u`` from a hash of the row's key and the child's name, and the smallest
draw wins, so a child gets rows in proportion to its weight, and a change of weight moves rows only
between the changed subtree and its siblings. A tree deals its first ``base`` shards, 40 or what it
began with if that is less, over regions and racks, and holds each further shard as a region of its
own: no weight inside another region changes, so one more shard only takes rows, and only into itself
(law ``key``).

Slots number the rows of a shard without gaps. Rows are counted by shard and by the first digits of
their hash; sums of those counts are where each such group begins, and a group is small.

Defined cases: a null key hashes as an empty one; a null text has 0 bytes and crc32 0; rows with the
same key and text are numbered in any order among themselves; repeated rows each get a slot.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of one group of slots, on average.
SLOT_GROUP = 5000
#: Shards in the regular part of the tree, and its fan-out.
BASE, REGIONS, RACKS = 40, 4, 2


class Node(NamedTuple):
    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int = -1


def parent(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def tree(shards: int, base: int = BASE) -> Node:
    """Shards of weight 1: the first ``base`` dealt evenly over racks, the others one a region."""
    regular = min(shards, base)
    racks: list[list[Node]] = [[] for _ in range(REGIONS * RACKS)]
    for k in range(regular):
        racks[k % len(racks)].append(Node(f"shard{k}", 1.0, shard=k))
    regions = [
        parent(
            f"region{r}",
            [parent(f"region{r}rack{k}", s) for k, s in enumerate(racks[r::REGIONS]) if s],
        )
        for r in range(REGIONS)
        if any(racks[r::REGIONS])
    ]
    regions += [
        parent(f"region-{k}", [parent(f"rack-{k}", [Node(f"shard{k}", 1.0, shard=k)])])
        for k in range(regular, shards)
    ]
    return parent("root", regions)


def _draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight, with u of 52 bits from the md5 of the child's name and the key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{node.name}/"), key).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(u) / node.weight


def descend(key: Column, node: Node) -> Column:
    """Shard that the key reaches below the node. Equal draws go to the earlier child."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return descend(key, node.children[0])
    draws = F.array(*[F.struct(_draw(key, c).alias("draw"), F.lit(k).alias("child")) for k, c in enumerate(node.children)])
    won = F.array_min(draws)["child"]
    below = [descend(key, c) for c in node.children]
    return F.element_at(F.array(*below), won + 1) if all(not c.children for c in node.children) else _choose(won, below)


def _choose(won: Column, below: list[Column]) -> Column:
    """Only the branch that won is computed."""
    out = F.when(won == 0, below[0])
    for k, branch in enumerate(below[1:], 1):
        out = out.when(won == k, branch)
    return out


def shard_rows(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Shard and slot of every row, and its shard in a tree of one more shard."""
    base = min(shards, BASE)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        descend(key, tree(shards, base)).cast("int").alias("shard"),
        descend(key, tree(shards + 1, base)).cast("int").alias("grown_shard"),
        F.md5(key.cast("binary")).alias("_hash"),
    )
    groups = max(1, docs.count() / (SLOT_GROUP * shards))
    digits = max(0, math.ceil(math.log(groups, 16)))
    rows = rows.withColumn("_head", F.substring("_hash", 1, digits) if digits else F.lit(""))
    counts = rows.groupBy("shard", "_head").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_head").rowsBetween(W.unboundedPreceding, -1)
    begins = counts.select("shard", "_head", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    within = W.partitionBy("shard", "_head").orderBy("_hash", "doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_place", F.row_number().over(within))
        .join(begins, ["shard", "_head"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_begin") + F.col("_place") - 1).cast("bigint").alias("slot"),
            "grown_shard",
        )
    )


def sql(shards: int = 40) -> str:
    """The same law in DuckDB SQL: every draw of every level, then the winners."""

    def draw(node: Node) -> str:
        return f"-ln((CAST('0x' || substr(md5('{node.name}/' || k), 1, 13) AS BIGINT) + 0.5) / {2**52}.0) / {node.weight}"

    def choice(node: Node) -> str:
        if not node.children:
            return str(node.shard)
        if len(node.children) == 1:
            return choice(node.children[0])
        draws = ", ".join(draw(c) for c in node.children)
        cases = " ".join(f"WHEN {n} THEN {choice(c)}" for n, c in enumerate(node.children, 1))
        return f"CASE list_position([{draws}], list_min([{draws}])) {cases} END"

    crc = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        crc.append(byte)
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, coalesce(text, '') AS t FROM documents),
placed AS (
  SELECT doc_id, k, CAST(octet_length(encode(t)) + 16 AS BIGINT) AS size,
         CAST({choice(tree(shards))} AS INTEGER) AS shard,
         CAST({choice(tree(shards + 1))} AS INTEGER) AS grown_shard,
         xor(4294967295, list_reduce(
           [4294967295] || list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
           lambda c, b: xor(c >> 8, ({crc}::BIGINT[])[xor(c & 255, b) + 1]))) AS text_crc32
  FROM rows)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY md5(k), doc_id, text_crc32, size) - 1 AS BIGINT) AS slot
FROM placed"""
