"""Score transactions while they arrive, one micro-batch at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.plans.cycle import Store, refresh
from riskloom.sources.messages import decode_messages
from riskloom.sources.tables import land_batch
from riskloom.streaming.ingest import TRIGGER, query_id


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def score_stream(
    messages: DataFrame,
    store: Store,
    checkpoint: str,
    clock: Callable[[], dt.datetime] = _utc_now,
    p: RiskParams = RiskParams(),
    policy: HotKeyPolicy = HotKeyPolicy(),
    trigger: dict = TRIGGER,
    strict: bool = False,
) -> StreamingQuery:
    """Land each micro-batch, refresh touched profiles, score what is new.

    Previous rows and trailing counts are ordered windows, which a streaming
    plan does not have; inside ``foreachBatch`` they run on the stored tables.
    Rows that follow a late arrival are scored again, so the table ends up as if
    everything had been scored at once. Every step may be repeated: batches are
    known by the query's id and their number, a landed one is not landed again, and
    scored rows are not scored twice. Rows that cannot be read are set aside; with
    ``strict`` they end the query.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        spark = store.spark
        owner = query_id(spark, checkpoint)
        land_batch(decode_messages(batch), store.raw_path, batch_id, owner, replay=True)
        refresh(store, now.date(), now, p, policy, strict, rescore_later=True)
        store.merge(owner)

    return (
        messages.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
