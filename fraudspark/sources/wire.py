"""Wire records: streams or tables of ``key, value, topic, partition, offset, timestamp``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudspark import schemas
from fraudspark.config import EngineConfig

_CORRUPT = "_corrupt"


def kafka_options(
    topics: Mapping[str, str], servers: str, config: EngineConfig = EngineConfig(), **extra: str
) -> dict[str, str]:
    """Read options of the Kafka source; security settings come from the caller as ``extra``."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics.values()),
        "startingOffsets": config.starting_offsets,
        "maxOffsetsPerTrigger": str(config.max_offsets_per_trigger),
        "minPartitions": str(config.min_partitions),
        "failOnDataLoss": "false",
        **extra,
    }


def read_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """A stream of wire records. File formats get the wire schema; Kafka brings its own."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if path is None else reader.schema(schemas.WIRE)).load(path)


def read_table(
    spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader if path is None else reader.schema(schemas.WIRE)).load(path)


def with_min_partitions(records: DataFrame, wanted: int, by: str = "offset") -> DataFrame:
    """Spread a table of few files over ``wanted`` tasks before costly per-message work.

    The counterpart of the stream source's ``minPartitions``; a table that already has as many
    partitions is left alone, so large inputs are not shuffled.
    """
    if records.rdd.getNumPartitions() >= wanted:
        return records
    return records.repartition(wanted, by)


def provider_of_topic(topics: Mapping[str, str]) -> Column:
    chain = F
    for provider, topic in topics.items():
        chain = chain.when(F.col("topic") == topic, F.lit(provider))
    return chain


def tag_provider(wire: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    """Add ``provider``; it is null for a topic outside the map, which ends in the dead letters."""
    return wire.withColumn("provider", provider_of_topic(topics))


def decode_tokenised(
    wire: DataFrame, topics: Mapping[str, str], avro_schema: str | None = None
) -> DataFrame:
    """Tokenised wire records to ``provider, <tokenised columns>, error_reason``, in one pass.

    JSON by default. With ``avro_schema`` the value is read as Avro, which needs Spark's Avro
    package on the class path.
    """
    tagged = tag_provider(wire, topics).where(F.col("value").isNotNull())
    if avro_schema is None:
        # A field of the wrong type makes the record corrupt; so does anything but one whole object.
        text = F.col("value").cast("string")
        schema = T.StructType(schemas.TOKENISED.fields + [T.StructField(_CORRUPT, T.StringType())])
        value = F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT})
        bare = F.btrim(text, F.lit(" \t\r\n"))
        whole = bare.startswith("{") & bare.endswith("}") & F.try_parse_json(text).isNotNull()
        readable = whole & value.isNotNull() & value[_CORRUPT].isNull()
    else:
        from pyspark.sql.avro.functions import from_avro

        value = from_avro(F.col("value"), avro_schema, {"mode": "PERMISSIVE"})
        readable = F.col("value").isNotNull()
    return tagged.select(
        "provider",
        value.alias("_event"),
        F.when(F.col("provider").isNull(), F.lit("Unknown topic"))
        .when(~F.coalesce(readable, F.lit(False)), F.lit("Parse failure"))
        .alias("error_reason"),
    ).select("provider", "_event.*", "error_reason").drop(_CORRUPT)
