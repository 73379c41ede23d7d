"""What the operators of this package share: tables, the shared working folder, sizes."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that the cluster shares.

    Only a local session without that setting gets a temporary folder, as in tests.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    named = named or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write the frame to the shared folder and read it again, so that it is computed once."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small frame by a checkpoint in the shared folder."""
    scratch(df.sparkSession, "checkpoint")
    return df.checkpoint(eager=True)


def give_back() -> None:
    """Return memory that a worker no longer uses to the system, as workers are used again."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def binary_text(name: str = "text") -> Column:
    return F.col(name).cast("binary").alias("text")


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the document's id as text leaves this remainder."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.pmod(crc, F.lit(modulus)) == remainder


def row_key() -> Column:
    """60 bits of a row's id and text; rows that agree in both, and no others, share them."""
    digest = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.concat(F.lit(":"), "text"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


#: Groups of more than this share of the rows are broadcast; there are fewer than so many.
HEAVY = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Left-join each row's group, where ``size`` is the number of rows of a group.

    A group of more than a ``1 / HEAVY`` share of all rows goes to its rows by broadcast: by counting
    there are fewer than ``HEAVY``. Rows without key are joined with nothing.
    """
    most = rows.count() // HEAVY
    marked = rows.where(F.col(key).isNotNull()).join(
        F.broadcast(groups.where(F.col(size) > most)), key, "left"
    )
    light = groups.where(F.col(size) <= most)
    rest = marked.where(F.col(size).isNull()).select(rows.columns)
    none = rows.where(F.col(key).isNull())
    return (
        marked.where(F.col(size).isNotNull())
        .unionByName(rest.join(light.hint("merge"), key, "left"))
        .unionByName(none, allowMissingColumns=True)
    )


def parted(rows: DataFrame, keys: DataFrame, key: str, size: str) -> tuple[DataFrame, DataFrame]:
    """The rows without and with one of the keys, where ``size`` is the number of rows of a key.

    As in ``attach``, keys of more than a ``1 / HEAVY`` share of all rows go by broadcast.
    """
    most = rows.count() // HEAVY
    heavy = F.broadcast(keys.where(F.col(size) > most).select(key))
    light = keys.where(F.col(size) <= most).select(key)
    rest = rows.join(heavy, key, "left_anti")
    within = rows.join(heavy, key, "left_semi").unionByName(rest.join(light, key, "left_semi"))
    return rest.join(light, key, "left_anti"), within
