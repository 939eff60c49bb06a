from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riskloom.operators.staging import quarantine, stage_transactions
from riskloom.schemas import MESSAGE_SCHEMA, RAW_SCHEMA
from riskloom.session import work_folder
from riskloom.sources.messages import ENVELOPE, broker_messages, decode_messages, encode_messages, message_files, undecodable
from riskloom.sources.tables import read_raw
from riskloom.streaming.ingest import DRAIN, ingest_stream

FULL = {
    "transaction_id": "T1",
    "customer_id": "C1",
    "amount": 12.345,
    "currency": " usd ",
    "merchant_name": " Shop ",
    "merchant_category": " FOOD",
    "transaction_timestamp": "2024-01-02T03:04:05.678901",
    "country": "us ",
    "city": " New York ",
    "latitude": 40.5,
    "longitude": -74.25,
    "device_id": " d1",
    "is_fraud": True,
    "fraud_type": None,
}
AT = dt.datetime(2024, 1, 2, 3, 4, 6)


def sent(spark, *values):
    return spark.createDataFrame([("k", v, AT) for v in values], ENVELOPE)


def test_decode(spark):
    values = [
        json.dumps(FULL),
        json.dumps({**FULL, "transaction_id": "T2", "more": {"a": [1]}}),
        '{"transaction_id":"T3","customer_id":"C1","amount":"x"}',
        "{bad",
        "{}",
        json.dumps(FULL)[:60],
        "",
        None,
    ]
    messages = sent(spark, *values)
    raw = decode_messages(messages)
    got = raw.collect()
    assert [r["transaction_id"] for r in got] == ["T1", "T2", "T3", None, None, None, None, None]
    assert {k: got[0][k] for k in FULL} == FULL and got[0]["kafka_timestamp"] == AT
    assert got[2]["amount"] is None and got[2]["customer_id"] == "C1"
    assert all(r["ingested_at"] is not None for r in got)
    assert undecodable(messages).count() == 5
    assert [(f.name, f.dataType) for f in raw.schema] == [(f.name, f.dataType) for f in RAW_SCHEMA]
    assert stage_transactions(raw).count() == 3


def test_encode_keeps_explicit_nulls_and_the_customer_as_key(spark):
    raw = decode_messages(sent(spark, json.dumps(FULL)))
    out = encode_messages(raw).first()
    assert out["key"] == "C1" and json.loads(out["value"]) == FULL
    assert list(json.loads(out["value"])) == MESSAGE_SCHEMA.fieldNames()


def test_staging(spark):
    r = stage_transactions(decode_messages(sent(spark, json.dumps(FULL)))).first()
    assert (r["currency"], r["merchant_name"], r["merchant_category"]) == ("USD", "Shop", "food")
    assert (r["country"], r["city"], r["device_id"], str(r["amount"])) == ("US", "New York", " d1", "12.35")
    assert r["transaction_timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert r["transaction_date"] == dt.date(2024, 1, 2)
    assert (r["actual_fraud_flag"], r["actual_fraud_type"]) == (True, None)


def test_unreadable_timestamp(spark):
    raw = decode_messages(sent(spark, json.dumps({**FULL, "transaction_timestamp": "soon"}), "{}"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_transactions(raw).collect()
    assert stage_transactions(raw, strict=False).first()["transaction_timestamp"] is None
    assert quarantine(raw).count() == 2
    odd = [raw.limit(1).withColumns({"transaction_id": F.lit(n), "transaction_timestamp": F.lit("2024-01-02"), "amount": F.lit(x)}) for n, x in (("A", float("nan")), ("B", 1e20), ("C", 1e15))]
    held = quarantine(odd[0].unionByName(odd[1]).unionByName(odd[2])).collect()
    assert {(r["transaction_id"], r["reason"]) for r in held} == {("A", "unreadable_amount"), ("B", "unreadable_amount")}


def test_stream_lands_each_message_once_across_restarts(spark):
    folder = work_folder(spark, "stream")
    lots = [json.dumps({**FULL, "transaction_id": f"T{i}"}) for i in range(20)]
    for part in (lots[:10], lots[10:]):
        sent(spark, *part).write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):  # the second time there is nothing to do
            source = message_files(spark, f"{folder}/in", files_per_batch=1)
            ingest_stream(source, f"{folder}/raw", f"{folder}/cp", DRAIN).awaitTermination()
    landed = read_raw(spark, f"{folder}/raw")
    assert landed.count() == landed.select("transaction_id").distinct().count() == 20
    assert [r[0] for r in landed.select("event_date").distinct().collect()] == [dt.date(2024, 1, 2)]
    assert landed.where(F.col("ingested_at").isNull()).count() == 0


def test_broker_source_asks_for_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        broker_messages(spark, "localhost:9", options={"kafka.security.protocol": "SASL_SSL"})
