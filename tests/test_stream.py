from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators.profile import customer_baseline
from riskloom.operators.scoring import score_transactions
from riskloom.operators.staging import stage_transactions
from riskloom.plans.cycle import Store, run_cycle
from riskloom.schemas import RAW_SCHEMA
from riskloom.session import work_folder
from riskloom.sources.messages import encode_messages, message_files
from riskloom.sources.tables import land_batch
from riskloom.streaming.ingest import DRAIN
from riskloom.streaming.score import score_stream
from tests.helpers import random_rows

NOW = dt.datetime(2024, 1, 10, 2)


def raw_table(spark, rows):
    """Raw rows as messages carry them; undated rows would not pass the contract."""
    data = [
        (
            r["transaction_id"], r["customer_id"], None if r["amount"] is None else float(r["amount"]),
            r["currency"], r["merchant_name"], r["merchant_category"], r["transaction_timestamp"].isoformat(),
            r["country"], r["city"], r["latitude"], r["longitude"], r["device_id"], False, None, NOW, NOW,
        )
        for r in rows
        if r["transaction_timestamp"] is not None
    ]
    return spark.createDataFrame(data, RAW_SCHEMA)


def result(df):
    out = {r["transaction_id"]: tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()}
    assert len(out) == df.count()
    return out


def test_stream_in_any_order_equals_batch_and_survives_a_replay(spark):
    rows = random_rows(21, 150)
    store = Store(spark, work_folder(spark, "stream"))
    checkpoint = f"{store.root}/checkpoint"

    def drain():
        source = message_files(spark, f"{store.root}/in")
        score_stream(source, store, checkpoint, lambda: NOW, trigger=DRAIN).awaitTermination()

    for lot in (rows[:70], rows[70:110], rows[110:]):
        encode_messages(raw_table(spark, lot)).write.mode("append").parquet(f"{store.root}/in")
        drain()
    # as if the driver had died before it could note that the last batch was done
    for name in ("2", ".2.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    drain()
    txns = stage_transactions(raw_table(spark, rows))
    # profiles end before the day of the stream, so all rows are new to them
    base = customer_baseline(txns, NOW.date(), NOW)
    assert result(store.mart.read()) == result(score_transactions(txns, base, NOW))


def test_bad_messages_are_set_aside_and_stop_nothing(spark):
    rows = [r for r in random_rows(23, 40) if r["customer_id"] and r["amount"] is not None]
    store = Store(spark, work_folder(spark, "bad"))
    good = raw_table(spark, rows)
    bad = good.limit(1).withColumns({"transaction_id": F.lit("BAD"), "transaction_timestamp": F.lit("soon")})
    nameless = good.limit(1).withColumn("transaction_id", F.lit(None).cast("string"))
    encode_messages(good.unionByName(bad).unionByName(nameless)).write.parquet(f"{store.root}/in")
    source = message_files(spark, f"{store.root}/in")
    score_stream(source, store, f"{store.root}/checkpoint", lambda: NOW, trigger=DRAIN).awaitTermination()
    ids = {r[0] for r in store.mart.read().select("transaction_id").collect()}
    assert ids == {r["transaction_id"] for r in rows if r["transaction_timestamp"] is not None} | {"BAD"}
    held = spark.read.parquet(store.quarantine_path)
    assert {r["reason"]: r["count"] for r in held.groupBy("reason").count().collect()} == {"unreadable_time": 1, "no_id": 1}
    assert store.pending() == [] and run_cycle(store, NOW.date(), NOW).quarantined == 0
    land_batch(bad, store.raw_path, 0)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_cycle(store, NOW.date(), NOW, strict=True)
    assert run_cycle(store, NOW.date(), NOW).quarantined == 1


def test_cycle_gates_alerts_on_quality(spark):
    rows = [r for r in random_rows(22, 80) if r["customer_id"] and r["amount"] is not None]
    store = Store(spark, work_folder(spark, "cycle"))
    land_batch(raw_table(spark, rows), store.raw_path, 0)
    report = run_cycle(store, NOW.date() + dt.timedelta(days=5), NOW)
    assert report.freshness.first()["status"] == "OK"
    assert report.quality.count() == 20 and report.quality.agg(F.sum("failures")).first()[0] == 0
    assert report.alert.first()["route"] in ("none", "standard")
    land_batch(raw_table(spark, rows[:1]), store.raw_path, 1)  # the same id again
    held = run_cycle(store, NOW.date() + dt.timedelta(days=5), NOW)
    assert held.alert is None
    failed = {(r["table_name"], r["check_name"]) for r in held.quality.where("failures > 0").collect()}
    assert failed == {("raw_transactions", "unique"), ("stg_transactions", "unique")}
    land_batch(raw_table(spark, rows[:1]), store.raw_path, 2)  # a key that was repeated before is not a new one
    land_batch(raw_table(spark, rows[1:2] * 2).withColumn("amount", F.lit(-1.0)), store.raw_path, 3)
    later = NOW + dt.timedelta(minutes=4)
    kept = run_cycle(store, NOW.date() + dt.timedelta(days=6), later, full_checks=False)
    full = run_cycle(store, NOW.date() + dt.timedelta(days=6), later, full_checks=True)
    assert sorted(map(tuple, kept.quality.collect())) == sorted(map(tuple, full.quality.collect()))
    assert kept.quality.agg(F.sum("failures")).first()[0] == 6 and kept.freshness.first()["recent_records"] == store.raw().count()
    assert run_cycle(store, NOW.date() + dt.timedelta(days=6), NOW + dt.timedelta(minutes=6)).freshness.first()["status"] == "WARNING"
