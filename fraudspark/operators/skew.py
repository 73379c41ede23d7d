"""Join per-group results back onto the rows they came from, whatever the group sizes.

A plain join by group key sends all rows of a group to one task. Here the heavy groups are taken
out of the shuffle's way:

* a group is heavy if it holds more than ``total rows / max_hot`` rows, so there are fewer than
  ``max_hot`` heavy groups however large the data is; that bound makes their results safe to
  broadcast;
* rows that found their group among the heavy ones, and rows without a key, take part in the second,
  shuffled join under a salt that matches nothing, so they spread evenly over the tasks.

Every row keeps its exact result. Both joins read the same aggregate, so Spark reuses its exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"
_SPREAD = 1 << 16


def heavy_threshold(source: DataFrame, max_hot: int, min_rows: int) -> Column:
    """Group size above which fewer than ``max_hot`` groups of ``source`` can exist."""
    total = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return F.greatest(F.lit(min_rows).cast("double"), total / F.lit(max_hot))


def attach(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    size: str,
    spread_by: str,
    source: DataFrame | None = None,
    max_hot: int = 100_000,
    min_rows: int = 50_000,
    drop_size: bool = True,
) -> DataFrame:
    """Left join ``rows`` with ``groups`` (one row per key; ``size`` counts its rows).

    ``spread_by`` is a column with many values (an id) that spreads rows over salts. ``source`` is
    the frame that was grouped; it is counted for the threshold (default ``rows``).
    """
    limit = heavy_threshold(rows if source is None else source, max_hot, min_rows)
    values = [c for c in groups.columns if c not in keys]
    heavy = groups.where(F.col(size) > limit).select(
        *keys, F.struct(*values).alias("_heavy")
    )
    # Always zero, but not a literal: the optimizer would fold a literal out of the join key, and
    # rows would then be placed by the group key alone.
    zero = F.least(F.col(size), F.lit(0)).cast("int")
    light = groups.where(F.col(size) <= limit).select(
        *keys, F.struct(*values).alias("_light"), zero.alias(_SALT)
    )
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    salt = F.when(
        no_key | F.col("_heavy").isNotNull(),
        1 + F.pmod(F.xxhash64(F.col(spread_by)), F.lit(_SPREAD)).cast("int"),
    ).otherwise(0)
    found = F.coalesce("_heavy", "_light")
    kept = [v for v in values if not (drop_size and v == size)]
    return (
        rows.join(F.broadcast(heavy), keys, "left")
        .withColumn(_SALT, salt)
        .join(light, [*keys, _SALT], "left")
        .select(
            *[F.col(c) for c in rows.columns],
            *[found.getField(v).alias(v) for v in kept],
        )
    )
