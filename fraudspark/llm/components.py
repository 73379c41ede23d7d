"""Connected components of a table of links, by alternating star contractions.

Each step hangs the neighbours of every node on the smallest of them: first the larger neighbours,
then the smaller ones. The number of steps grows with the logarithm of the longest path. Links stay
distributed; every step is one grouped minimum and one join, and is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.llm import shared


#: With more links than this, nodes that many of them meet in are joined by broadcast.
MANY = 1_000_000


def _star(links: DataFrame, large: bool, many: bool) -> DataFrame:
    """Links (node, other), both ways for the large star, from the larger node for the small one."""
    if large:
        both = links.unionAll(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    else:
        both = links.select(
            F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
        )
    least = both.groupBy("node").agg(
        F.least(F.min("other"), F.col("node")).alias("least"), F.count(F.lit(1)).alias("size")
    )
    # The root of a large component has a link from each of its members.
    joined = shared.attach(both, shared.settled(least), "node", "size") if many else both.join(least, "node")
    if large:
        out = joined.where("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
    else:
        out = joined.where("other <> least").select(F.col("other").alias("node"), F.col("least").alias("other"))
        out = out.unionAll(least.select("node", F.col("least").alias("other")))
    return out.where("node <> other").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is linked to, for all nodes but the roots.

    ``links`` has the columns ``node`` and ``other``; loops and repeated links do no harm.
    """
    links = shared.settled(links.where("node <> other").distinct())
    before = None
    while True:
        many = before is not None and before[0] > MANY
        links = shared.settled(_star(_star(links, True, many), False, many))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other") % 2**32)).first()
        if now == before:
            return links.select("node", F.col("other").alias("root"))
        before = now
