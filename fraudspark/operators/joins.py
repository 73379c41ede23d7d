"""Left joins with the reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark.operators.asof import join_fx_as_of
from fraudspark.sources.refdata import ReferenceTables


def _lookup(df: DataFrame, table: DataFrame, key: str, fixed: bool) -> DataFrame:
    """Left join on a key that is unique in ``table``.

    The fixed tables have at most 17 rows and are broadcast. A table handed in by the caller has no
    known size: it gets no hint, so Spark broadcasts it only below its own size threshold and
    otherwise shuffles, with adaptive execution splitting skewed partitions.
    """
    return df.join(F.broadcast(table) if fixed else table, key, "left")


def join_mcc(df: DataFrame, refs: ReferenceTables) -> DataFrame:
    return _lookup(df, refs.mcc, "mcc", "mcc" in refs.fixed)


def join_currency(df: DataFrame, refs: ReferenceTables) -> DataFrame:
    return _lookup(df, refs.currency, "currency_code", "currency" in refs.fixed)


def join_fx(df: DataFrame, refs: ReferenceTables) -> DataFrame:
    """Rate of the transaction's currency and the amount in US dollars (null without either)."""
    rates = refs.fx.withColumnRenamed("currency_alpha", "currency")
    return _lookup(df, rates, "currency", "fx" in refs.fixed).withColumn(
        "amount_usd", F.col("amount") * F.col("fx_rate_to_usd")
    )


def join_bin(df: DataFrame, refs: ReferenceTables) -> DataFrame:
    return _lookup(df, refs.bins, "bin", "bins" in refs.fixed)


def join_reference(df: DataFrame, refs: ReferenceTables, fx_history: DataFrame | None = None) -> DataFrame:
    """All reference joins; with ``fx_history`` the exchange rates are those of the payment's time."""
    if fx_history is not None:
        # First, so that rows are shuffled before the other tables widen them.
        priced = join_fx_as_of(df, refs, fx_history)
        return priced.transform(join_mcc, refs).transform(join_currency, refs).transform(join_bin, refs)
    return (
        df.transform(join_mcc, refs)
        .transform(join_currency, refs)
        .transform(join_fx, refs)
        .transform(join_bin, refs)
    )
