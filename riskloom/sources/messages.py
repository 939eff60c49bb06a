"""Transactions as JSON messages: sources, decoding and encoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schemas import MESSAGE_SCHEMA

TOPIC = "banking.transactions"  # fixed value

# What a file of captured messages holds; the broker source has these too.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def broker_messages(
    spark: SparkSession, servers: str, topic: str = TOPIC, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Unbounded stream of broker messages, from the latest offset on.

    Security settings go into ``options``. Needs the Kafka connector jar.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .options(**dict(options or {}))
        .load()
    )


def message_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Unbounded stream of captured messages from Parquet files in a folder."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def decode_messages(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Raw rows from messages, batch or streaming.

    A payload that is not a JSON object gives NULL in every field; a field of
    the wrong type gives NULL in that field only. Unknown fields are ignored.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if ingested_at is None else ingested_at
    decoded = messages.select(
        F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).alias("payload"),
        F.col("timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
    )
    return decoded.select("payload.*", "kafka_timestamp", now.alias("ingested_at"))


def encode_messages(raw: DataFrame) -> DataFrame:
    """Messages keyed by customer, so that a customer's events stay in order.

    Missing values are written as explicit nulls.
    """
    payload = F.struct(*MESSAGE_SCHEMA.fieldNames())
    return raw.select(
        F.col("customer_id").alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("value"),
        F.col("kafka_timestamp").cast("timestamp").alias("timestamp"),
    )


def undecodable(messages: DataFrame) -> DataFrame:
    """Messages whose payload holds no transaction id, with the original text."""
    payload = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    return messages.where(payload["transaction_id"].isNull())
