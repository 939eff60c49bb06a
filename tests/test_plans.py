"""Shapes of physical plans: shuffles, sorts, pushdown, no Python in the way."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.operators import history, profile
from riskloom.operators.heat import Heat, measure_heat
from riskloom.operators.history import PROFILE_BURSTS, SCORE_BURSTS, plain_history
from riskloom.operators.profile import customer_baseline
from riskloom.operators.scoring import score_transactions
from riskloom.operators.staging import lookback, stage_transactions
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.plans.cycle import Store, refresh
from riskloom.session import work_folder
from riskloom.sources.tables import land_batch, read_raw
from checks.fixture import AS_OF, RUN_TS, raw_transactions

COOL = Heat(HotKeyPolicy())


@pytest.fixture(scope="module")
def landed(spark):
    path = work_folder(spark, "plans")
    land_batch(raw_transactions(spark, "/root/testdata/sf0.001"), path, 0)
    return stage_transactions(read_raw(spark, path))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node: str) -> int:
    return sum(line.lstrip(" :+-").startswith(node) for line in plan(df).splitlines())


def test_profile_is_one_shuffle_and_one_sort(landed):
    df = customer_baseline(landed, AS_OF, RUN_TS, heat=COOL)
    assert (count(df, "Exchange"), count(df, "Sort ["), count(df, "FileScan")) == (1, 1, 1)
    assert "Join" not in plan(df) and "Python" not in plan(df)


def test_profile_reads_only_its_days_and_columns(landed):
    text = plan(customer_baseline(landed, AS_OF, RUN_TS, heat=COOL))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    for unused in ("merchant_name", "latitude", "fraud_type", "currency"):
        assert unused not in scan.split("ReadSchema")[1]


def test_history_shares_one_sort(landed):
    df = plain_history(landed, SCORE_BURSTS, previous=True)
    assert (count(df, "Exchange"), count(df, "Sort ["), count(df, "Window [")) == (1, 1, 2)
    assert count(plain_history(landed, PROFILE_BURSTS, previous=False), "Window [") == 1


def test_scoring_a_stored_profile_shuffles_each_side_once(spark, landed, no_broadcast):
    path = work_folder(spark, "profile")
    customer_baseline(landed, AS_OF, RUN_TS, heat=COOL).write.parquet(path)
    df = score_transactions(landed, spark.read.parquet(path), RUN_TS, heat=COOL)
    assert (count(df, "Exchange"), count(df, "SortMergeJoin")) == (2, 1)
    # the transactions stay sorted from the windows to the join
    assert count(df, "Sort [") == 2 and "Python" not in plan(df)


def test_a_bucketed_profile_is_not_shuffled(spark, landed, no_broadcast):
    store = Store(spark, work_folder(spark, "bucketed"), buckets=6)
    base = store.baseline.replace(customer_baseline(landed, AS_OF, RUN_TS, heat=COOL))
    df = score_transactions(landed, base, RUN_TS, heat=COOL, buckets=6)
    assert (count(df, "Exchange"), count(df, "SortMergeJoin")) == (1, 1)
    assert "Bucketed: true" in plan(df)
    want = score_transactions(landed, customer_baseline(landed, AS_OF, RUN_TS, heat=COOL), RUN_TS, heat=COOL)
    assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
    # another session knows the files only
    spark.sql(f"drop table {store.baseline._name(0)}")
    again = score_transactions(landed, store.baseline.read(), RUN_TS, heat=COOL, buckets=6)
    assert count(again, "Exchange") == 1 and again.count() == df.count()
    updates = base.limit(1).withColumn("txn_count_90d", F.lit(7).cast("long"))
    rows = store.baseline.upsert(updates, "customer_id")
    assert rows.count() == base.count() and rows.where("txn_count_90d = 7").count() >= 1
    store.baseline.forget_old_versions(1)
    assert store.baseline.read().count() == rows.count()


def test_the_hot_route_reads_the_source_twice(spark, landed, monkeypatch):
    """Once for all counts, once for the bursts; everything else comes from what they leave."""
    heat = measure_heat(landed, HotKeyPolicy(min_rows=0, max_keys=1_000_000))
    sources = []
    for module in (profile, history):
        kept = module.written
        monkeypatch.setattr(module, "written", lambda rows, name, kept=kept: (sources.append((name, raw_scans(rows))), kept(rows, name))[1])
    df = customer_baseline(landed, AS_OF, RUN_TS, heat=heat)
    assert sorted(sources) == [("chunks", 1), ("counts", 1)]
    assert raw_scans(df) == 1  # customers that are not hot


def raw_scans(df) -> int:
    return sum("FileScan" in line and "event_date" in line for line in plan(df).splitlines())


def test_every_scan_of_a_refresh_is_pruned(spark, monkeypatch):
    """What a run with few new rows reads: by day, by id, or its own small tables."""
    store = Store(spark, work_folder(spark, "pruned"))
    raw = raw_transactions(spark, "/root/testdata/sf0.001")
    new = raw.where("transaction_id is not null").orderBy("transaction_id").limit(3).withColumn("transaction_id", F.concat("transaction_id", F.lit("-new")))
    land_batch(raw, store.raw_path, 0)
    refresh(store, AS_OF, RUN_TS, RiskParams(), HotKeyPolicy())
    before = store.mart.read().count()
    land_batch(new, store.raw_path, 1)
    scans = []
    stored = session._stored

    def watched(rows, path):
        scans.extend((path, line) for line in plan(rows).splitlines() if "FileScan" in line and store.root in line)
        return stored(rows, path)

    monkeypatch.setattr(session, "_stored", watched)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    refresh(store, AS_OF, RUN_TS, RiskParams(), HotKeyPolicy(), rescore_later=True)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) >= 5 and store.mart.read().count() == before + 3
    for path, line in scans:
        folders = line.split("PartitionFilters: [")[1].split("]")[0]
        pushed = line.split("PushedFilters: [")[1].split("]")[0]
        own = "batches=batch~1~1" in line  # the rows that arrived
        assert own or folders or "In(" in pushed or "EqualTo(" in pushed, (path, line)


def test_only_bounded_sides_are_broadcast(spark, landed, no_broadcast):
    heat = measure_heat(landed, HotKeyPolicy(min_rows=10, max_keys=1_000))
    assert 0 < heat.keys.count() < 1_000
    base = customer_baseline(landed, AS_OF, RUN_TS, heat=heat)
    df = score_transactions(landed, base, RUN_TS, heat=heat)
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    for line in plan(df).splitlines():
        if "BroadcastHashJoin" in line:
            # hot customers, or one record per chunk of their rows
            assert "hot_customer_id" in line or "_chunk" in line or "LeftOuter" in line


def test_look_back_filter_reaches_the_files(landed):
    text = plan(lookback(landed, dt.date(2024, 1, 20), 5))
    partition_filters = text.split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "2024-01-15" in partition_filters and "2024-01-20" in partition_filters
