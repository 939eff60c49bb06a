from __future__ import annotations

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from riskloom.operators.heat import measure_heat
from riskloom.operators.history import PROFILE_BURSTS, burst_counts, previous_transaction, spread_history
from riskloom.params import HotKeyPolicy
from tests.helpers import START, brute_bursts, brute_previous, heats, random_rows, table, txn


@pytest.mark.parametrize("seed", [1, 2])
def test_every_route_matches_brute_force(spark, seed):
    rows = random_rows(seed)
    txns = table(spark, rows)
    bursts = {name: brute_bursts(rows, s) for name, s in PROFILE_BURSTS.items()}
    before = brute_previous(rows)
    for label, heat in heats(txns).items():
        got = burst_counts(txns, PROFILE_BURSTS, heat).collect()
        assert len(got) == len(rows), label
        for r in got:
            for name in PROFILE_BURSTS:
                assert r[name] == bursts[name][r["transaction_id"]], (label, name, r)
        got = previous_transaction(txns, heat).collect()
        assert len(got) == len(rows), label
        for r in got:
            want = before[r["transaction_id"]] or (None,) * 4
            assert (r["prev_lat"], r["prev_lon"], r["prev_country"], r["prev_ts"]) == want, (label, r)


def test_frame_ends(spark):
    at = [0, 300, 600, 600]  # the third is exactly five minutes after the second
    rows = [txn(f"T{i}", at=START + dt.timedelta(seconds=s)) for i, s in enumerate(at)]
    rows.append(txn("T4", at=START + dt.timedelta(seconds=900, microseconds=1)))
    txns = table(spark, rows)
    for heat in heats(txns).values():
        got = {r["transaction_id"]: r["burst_5min"] for r in burst_counts(txns, {"burst_5min": 300}, heat).collect()}
        # equal times count each other; a microsecond beyond five minutes does not count
        assert got == {"T0": 0, "T1": 1, "T2": 2, "T3": 2, "T4": 0}


def test_hot_customers_are_few_and_found_null_safe(spark):
    rows = [txn(f"A{i}", "C1") for i in range(6)] + [txn(f"B{i}", None) for i in range(5)] + [txn("D", "C2")]
    heat = measure_heat(table(spark, rows), HotKeyPolicy(max_keys=4, min_rows=2))
    assert {r[0] for r in heat.keys.collect()} == {"C1", None}
    # a list that is too long for a broadcast is stored
    long = measure_heat(table(spark, rows), HotKeyPolicy(max_keys=0, min_rows=2))
    assert not long.short and sorted(map(str, long.keys.collect())) == sorted(map(str, heat.keys.collect()))
    assert measure_heat(table(spark, rows), HotKeyPolicy(min_rows=1000)).keys is None
    assert measure_heat(table(spark, [])).keys is None


def _dense(spark, n: int, at: str):
    return spark.range(n).select(
        F.lit("C1").alias("customer_id"),
        F.format_string("T%07d", "id").alias("transaction_id"),
        F.expr(at).alias("transaction_timestamp"),
        F.col("id").cast("double").alias("latitude"),
        F.lit(1.0).alias("longitude"),
        F.lit("US").alias("country"),
    )


def test_no_task_holds_a_hot_customer(spark):
    """The rows of one customer end up in many partitions of the spread route."""
    rows = _dense(spark, 20_000, "timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, id)")
    out = spread_history(rows, {"b": 300}, True, 16)
    assert out.count() == 20_000 and out.where("b = 300").count() == 20_000 - 300
    assert out.where("prev_lat = latitude - 1").count() == 20_000 - 1


@pytest.mark.parametrize("at", ["timestamp_ntz'2024-01-10 00:00:00'", "cast(null as timestamp_ntz)"])
def test_a_million_rows_in_one_microsecond(spark, at):
    """No chunk grows with them, and each still counts all others and has one before it."""
    work = pathlib.Path(spark.conf.get("spark.checkpoint.dir"), "riskloom")
    before = set(work.glob("chunks-*"))
    n, chunks = 1_000_000, 50
    out = spread_history(_dense(spark, n, at), {"b": 300, "c": 3600}, True, chunks).persist()
    (folder,) = set(work.glob("chunks-*")) - before
    held = spark.read.parquet(str(folder)).groupBy("_chunk").count()
    # chunks hold the copies that leave the windows too; of undated rows there are none
    assert held.count() >= chunks // 4 and held.agg(F.max("count")).first()[0] <= 2 * 3 * n // chunks
    wrong = out.where(f"b <> {n - 1} or c <> {n - 1} or (prev_lat is null) <> (latitude = 0) or prev_lat <> latitude - 1")
    assert out.count() == n and wrong.isEmpty()
    out.unpersist()


def test_copies_of_one_row_are_spread(spark):
    rows = _dense(spark, 20_000, "timestamp_ntz'2024-01-10 00:00:00'").withColumn("transaction_id", F.lit("T"))
    out = spread_history(rows, {"b": 300}, True, 10)
    assert out.count() == 20_000 and out.where("b = 19999").count() == 20_000
    assert out.where("prev_lat is null").count() == 1
