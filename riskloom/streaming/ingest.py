"""Messages to the raw table, continuously and unchanged."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.sources.messages import decode_messages
from riskloom.sources.tables import land_batch, raw_table

TRIGGER = {"processingTime": "30 seconds"}  # fixed value
DRAIN = {"availableNow": True}  # for scheduled runs and tests


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id under which a checkpoint's query numbers its batches."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_stream(messages: DataFrame, path: str, checkpoint: str, trigger: dict = TRIGGER) -> StreamingQuery:
    """Append decoded messages to the raw table.

    Batches land as in ``score_stream``, so readers see the rows of both; each batch
    appears once, and small batches are merged from time to time.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner = query_id(spark, checkpoint)
        land_batch(decode_messages(batch), path, batch_id, owner, replay=True)
        raw_table(spark, path).merge(owner)

    return messages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger).start()
