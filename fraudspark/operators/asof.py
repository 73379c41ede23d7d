"""As-of joins: every row with the last quote of its key at or before its time.

Rows and quotes are laid in one line per key, cut into buckets of time, and the last quote is carried
along each bucket by a running window. Where a bucket has no quote before a row, the last one of the
earlier buckets is carried over the border: of every bucket one quote, and one narrow join. A key with
very many rows is spread over its buckets, and over ``salts`` within one; quotes, which are few, are repeated
for each salt. Rows cross the network once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudspark.config import DAY_US
from fraudspark.sources.refdata import ReferenceTables


def as_of(
    rows: DataFrame,
    quotes: DataFrame,
    key: str,
    value: str,
    ts: str = "event_timestamp",
    quoted_at: str = "as_of",
    row_id: str = "transaction_id",
    bucket_us: int = DAY_US,
    salts: int = 8,
) -> DataFrame:
    """Add ``value``, null where no quote is old enough. ``quotes`` has ``key, quoted_at, value``.

    Quotes without key, time or value do not count; of several at one time the largest does. Rows
    without key or time get null.
    """
    at = F.unix_micros(F.col(quoted_at))
    known = (
        quotes.where(F.col(key).isNotNull() & at.isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key).alias("_k"), at.alias("_at"))
        .agg(F.max(value).alias("_quote"))
    )
    kind = known.schema["_quote"].dataType
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    spread = F.pmod(F.xxhash64(row_id), F.lit(salts))
    asked = rows.select(
        F.when(usable, F.col(key)).alias("_k"),
        F.unix_micros(F.col(ts)).alias("_at"),
        F.lit(None).cast(kind).alias("_quote"),
        # Rows that can find nothing go anywhere.
        F.when(usable, spread).otherwise(F.xxhash64(row_id)).alias("_salt"),
        F.struct(*rows.columns).alias("_row"),
    )
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("_salt")
    line = asked.unionByName(known.select("_k", "_at", "_quote", each), allowMissingColumns=True).withColumn(
        "_bucket", F.floor(F.col("_at") / bucket_us)
    )
    # At one time quotes come before rows.
    order = Window.partitionBy("_k", "_bucket", "_salt").orderBy("_at", F.col("_quote").isNull())
    own = F.last("_quote", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = line.withColumn("_own", own).where(F.col("_row").isNotNull()).select("_k", "_bucket", "_own", "_row")
    last = known.groupBy("_k", F.floor(F.col("_at") / bucket_us).alias("_bucket")).agg(F.max_by("_quote", "_at").alias("_last"))
    asks = rows.where(usable).select(
        F.col(key).alias("_k"), F.floor(F.unix_micros(F.col(ts)) / bucket_us).alias("_bucket")
    ).distinct()
    buckets = last.unionByName(asks, allowMissingColumns=True).groupBy("_k", "_bucket").agg(F.max("_last").alias("_last"))
    before = F.last("_last", ignorenulls=True).over(
        Window.partitionBy("_k").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = buckets.select("_k", "_bucket", before.alias("_carried"))
    return near.join(carried, ["_k", "_bucket"], "left").select("_row.*", F.coalesce("_own", "_carried").alias(value))


def join_fx_as_of(df: DataFrame, refs: ReferenceTables, history: DataFrame) -> DataFrame:
    """As ``joins.join_fx``, with the rate that held when the payment was made.

    ``history`` has ``currency_alpha, fx_rate_to_usd, as_of``; payments before a currency's first rate
    have the rate of ``refs``.
    """
    quotes = history.withColumnsRenamed({"currency_alpha": "currency", "fx_rate_to_usd": "_as_of_rate"})
    dated = as_of(df, quotes, "currency", "_as_of_rate")
    fallback = refs.fx.withColumnRenamed("currency_alpha", "currency")
    joined = dated.join(F.broadcast(fallback) if "fx" in refs.fixed else fallback, "currency", "left")
    rate = F.coalesce("_as_of_rate", "fx_rate_to_usd")
    return joined.withColumn("fx_rate_to_usd", rate).drop("_as_of_rate").withColumn("amount_usd", F.col("amount") * F.col("fx_rate_to_usd"))
