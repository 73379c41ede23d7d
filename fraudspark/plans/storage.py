"""Working folder shared by all executors, for checkpoints and hand-over tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a fresh temporary one only where none is set on local[*]."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not named:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="fraudspark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and go on from there, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
