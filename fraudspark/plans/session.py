"""Session settings that the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may change while a session runs.
SETTINGS = {
    # Hours, weekdays and windows are taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Wide projections make methods that the JVM does not compile above this size; Spark then
    # generates them in smaller pieces instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keyed state with expiry needs this provider.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def builder(app: str = "fraudspark") -> SparkSession.Builder:
    made = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        made = made.config(name, value)
    return made
