from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch, work_folder, written
from riskloom.sources.batches import Ledger, Span, joined, live, next_merge, without
from riskloom.sources.tables import (
    BatchExists,
    DailyTable,
    SchemaChanged,
    VersionedTable,
    align_schema,
    land_batch,
    latest_per_key,
    raw_table,
    read_raw,
    rows_with_keys,
    without_copies,
)
from riskloom.schemas import RAW_SCHEMA

SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("level", T.StringType()), T.StructField("day", T.DateType())]
)
D = [dt.date(2024, 1, d) for d in range(1, 8)]


@pytest.fixture
def folder(spark):
    return work_folder(spark, "test")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def daily(spark, folder):
    return DailyTable(spark, f"{folder}/daily", SCHEMA, "id", "day", "level")


def test_versioned_upsert_and_history(spark, folder):
    t = VersionedTable(spark, f"{folder}/t", layout_by="id")
    assert t.read() is None
    t.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int"), "id")
    before = t.read()
    t.upsert(spark.createDataFrame([("b", 2), ("c", 2)], "id string, n int"), "id")
    assert rows(t.read()) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(before) == [("a", 1), ("b", 1)]  # older readers are not disturbed
    t.upsert(spark.createDataFrame([], "id string, n int"), "id")
    t.forget_old_versions(keep=1)
    assert t._versions() == [2] and t.read().count() == 3


def test_unfinished_version_is_ignored(spark, folder):
    t = VersionedTable(spark, f"{folder}/t")
    t.replace(spark.createDataFrame([("a", 1)], "id string, n int"))
    spark.createDataFrame([("x", 9)], "id string, n int").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{t.path}/v=1")
    assert rows(t.read()) == [("a", 1)]
    t.replace(spark.createDataFrame([("b", 1)], "id string, n int"))
    assert rows(t.read()) == [("b", 1)]


def test_schema_policies(spark, folder):
    old = spark.createDataFrame([("a", 1)], "id string, n int")
    new = spark.createDataFrame([("b", "x")], "id string, extra string")
    with pytest.raises(SchemaChanged):
        align_schema(old, new, "fail")
    with pytest.raises(SchemaChanged):
        align_schema(old, spark.createDataFrame([("a", "1")], "id string, n string"), "append_new_columns")
    with pytest.raises(ValueError):
        align_schema(old, new, "ignore")
    left, right = align_schema(old, new, "append_new_columns")
    assert left.columns == right.columns == ["id", "n", "extra"]
    t = VersionedTable(spark, f"{folder}/t")
    t.replace(old)
    t.upsert(new, "id", "append_new_columns")
    assert rows(t.read()) == [("a", 1, None), ("b", None, "x")]


def test_daily_upsert_rewrites_touched_days_only(spark, folder):
    t = daily(spark, folder)
    t.append(spark.createDataFrame([("a", "x", D[0]), ("b", "x", D[1]), ("c", "x", D[2]), ("n", "x", None)], SCHEMA))
    files = {f for f in t.read().inputFiles() if "day=2024-01-03" in f}
    # b changes, d is new, a moves to another day and leaves its own one empty
    t.upsert(spark.createDataFrame([("b", "y", D[1]), ("d", "y", D[3]), ("a", "y", D[1]), ("n", "y", None)], SCHEMA))
    want = [("a", "y", D[1]), ("b", "y", D[1]), ("c", "x", D[2]), ("d", "y", D[3]), ("n", "y", None)]
    assert rows(t.read()) == sorted(want, key=str)
    assert files <= set(t.read().inputFiles())
    with pytest.raises(SchemaChanged):
        t.upsert(spark.createDataFrame([("a", 1)], "id string, other int"))


def test_broken_swap_is_finished_before_the_next_write(spark, folder):
    class Dies(DailyTable):
        def _write(self, rows, mode):
            raise RuntimeError("driver lost")

    t = daily(spark, folder)
    t.append(spark.createDataFrame([("a", "x", D[0]), ("b", "x", D[1])], SCHEMA))
    broken = Dies(spark, t.path, SCHEMA, "id", "day", "level")
    with pytest.raises(RuntimeError):
        broken.upsert(spark.createDataFrame([("a", "y", D[2])], SCHEMA))
    t.append(spark.createDataFrame([("z", "x", D[5])], SCHEMA))
    assert rows(t.read()) == [("a", "y", D[2]), ("b", "x", D[1]), ("z", "x", D[5])]
    t.recover()
    assert t.read().count() == 3


def test_copies(spark):
    schema = "id string, at int, v string"
    given = [("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c"), ("b", 1, "x"), (None, 1, "p"), (None, 1, "q")]
    df = spark.createDataFrame(given, schema)
    want = sorted([("a", 2, "c"), ("b", 1, "x"), (None, 1, "p"), (None, 1, "q")], key=str)
    assert rows(latest_per_key(df, "id", "at")) == want
    assert rows(without_copies(df, df, "id", "at", written)) == want
    single = df.where("id = 'b'")
    assert without_copies(single, single, "id", "at", written) is single


def test_landing_a_batch_twice_changes_nothing(spark, folder):
    def raw(i, at):
        return (f"T{i}", "C", 1.0, *[None] * 3, at, *[None] * 7, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))

    path = f"{folder}/raw"
    first = spark.createDataFrame([raw(1, "2024-01-01 00:00:00"), raw(2, "2024-01-02"), raw(3, "soon")], RAW_SCHEMA)
    second = spark.createDataFrame([raw(4, "2024-01-02 10:00:00")], RAW_SCHEMA)
    for df, batch in ((first, 0), (second, 1), (second, 1), (first, 0)):
        land_batch(df, path, batch, owner="q", replay=True)
    with pytest.raises(BatchExists):
        land_batch(second, path, 0, owner="q")
    got = read_raw(spark, path)
    assert sorted(r["transaction_id"] for r in got.collect()) == ["T1", "T2", "T3", "T4"]
    assert got.where(F.col("event_date").isNull()).first()["transaction_id"] == "T3"
    day = got.where(F.col("event_date") == F.lit(D[1]))
    assert day.count() == 2 and "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().toString()


def _raw(spark, i, at="2024-01-01 00:00:00"):
    return spark.createDataFrame([(f"T{i}", "C", 1.0, *[None] * 3, at, *[None] * 7, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))], RAW_SCHEMA)


def test_owners_number_their_batches_apart_and_merging_keeps_all_rows(spark, folder):
    path = f"{folder}/raw"
    table = raw_table(spark, path)
    for i in range(6):
        land_batch(_raw(spark, i), path, i % 3, owner=f"q{i // 3}")
    assert table.spans() == [Span("q0", n, n) for n in range(3)] + [Span("q1", n, n) for n in range(3)]
    before = rows(read_raw(spark, path))
    running = read_raw(spark, path)  # of the second owner, planned before the first one merges
    table.merge("q0", fan=3)
    assert table.spans() == [Span("q0", 0, 2)] + [Span("q1", n, n) for n in range(3)]
    assert rows(running) == before == rows(read_raw(spark, path))
    table.merge("q0", fan=3, grace=0)  # later, when nobody needs the old folders
    assert sorted(n for n in os.listdir(path) if "q0" in n) == ["batches=q0~0~2"]
    land_batch(_raw(spark, 99), path, 1, owner="q0", replay=True)  # known although merged
    with pytest.raises(BatchExists):
        land_batch(_raw(spark, 99), path, 2, owner="q0")
    land_batch(_raw(spark, 7, "2024-01-02"), path, 3, owner="q0")
    assert rows(read_raw(spark, path).select("transaction_id")) == [(f"T{i}",) for i in (0, 1, 2, 3, 4, 5, 7)]
    assert rows(read_raw(spark, path, ["q0-0", "q0-3"]).select("transaction_id", "ingest_batch")) == [("T0", "q0-0"), ("T7", "q0-3")]
    assert read_raw(spark, path, []).count() == 0
    # a merge that broke off before its success marker does not show, and is done again
    read_raw(spark, path).drop("event_date").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/batches=q1~0~2/event_date=2024-01-01")
    assert read_raw(spark, path).count() == 7
    table.merge("q1", fan=3, grace=0)
    assert read_raw(spark, path).count() == 7 and table.spans()[-1] == Span("q1", 0, 2)


def test_ten_thousand_batches_leave_few_folders(spark, folder):
    spans, written_rows = [], 0
    for n in range(10_000):
        spans.append(Span("q", n, n))
        while merge := next_merge(spans, 8):
            parts = [s for s in spans if merge.covers(s)]
            assert len(parts) == 8
            written_rows += merge.size
            spans = [s for s in spans if s not in parts] + [merge]
        assert len(spans) <= 7 * 5
    assert joined(spans) == [Span("q", 0, 9_999)] and written_rows <= 10_000 * 5
    ledger = Ledger(spark, f"{folder}/ledger")
    assert ledger.spans() == []
    ledger.add([f"q-{n}" for n in range(9_999)])
    ledger.add(["q-9999", "other-3"])
    assert ledger.spans() == [Span("other", 3, 3), Span("q", 0, 9_999)]
    assert len([n for n in os.listdir(f"{folder}/ledger") if n.endswith(".json") and n[0] != "."]) <= 2


def test_spans():
    a = [Span("x", 0, 4), Span("x", 5, 5), Span("y", 0, 0), Span("x", 8, 9)]
    assert joined(a) == [Span("x", 0, 5), Span("x", 8, 9), Span("y", 0, 0)]
    assert without(a, [Span("x", 2, 3), Span("x", 9, 20)]) == [Span("x", 0, 1), Span("x", 4, 5), Span("x", 8, 8), Span("y", 0, 0)]
    assert without(a, a) == [] and without([], a) == [] and without(a, []) == joined(a)
    assert live([*a, Span("x", 0, 5)]) == [Span("x", 0, 5), Span("x", 8, 9), Span("y", 0, 0)]
    # a gap in the numbers is never merged over
    assert next_merge([Span("x", 0, 0), Span("x", 2, 2)], 2) is None
    assert next_merge([Span("x", 0, 0), Span("x", 2, 2), Span("x", 3, 3)], 2) == Span("x", 2, 3)
    assert Span.of_folder(Span("a-b~c", 3, 7).folder) == Span("a-b~c", 3, 7) and Span.of_batch("a-b-12") == Span("a-b", 12, 12)


def scanned_rows(df) -> int:
    """Rows that the file scans of a finished query have put out."""

    def leaves(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return leaves(node.executedPlan())
        if kind == "FileSourceScanExec":
            return node.metrics().apply("numOutputRows").value()
        below = [node.plan()] if kind.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
        return sum(map(leaves, below))

    return leaves(df._jdf.queryExecution().executedPlan())


def test_a_look_up_reads_few_row_groups(spark, folder):
    """Ids in no order: only Bloom filters can tell which row groups have them."""
    hadoop = spark._jsc.hadoopConfiguration()
    t = daily(spark, folder)
    many = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit("x").alias("level"), F.date_add(F.lit(D[0]), (F.col("id") % 4).cast("int")).alias("day"))
    hadoop.set("parquet.block.row.count.limit", "500")
    try:
        t.append(many.repartition(4))
    finally:
        hadoop.unset("parquet.block.row.count.limit")
    seen = []

    def watch(df, name):
        df.collect()
        seen.append(scanned_rows(df))
        return df

    ids = spark.range(3).select(F.md5(F.col("id").cast("string")).alias("id"))
    found = t.find(ids.union(spark.createDataFrame([("unknown",), (None,)], "id string")), watch)
    assert {r["day"] for r in found.collect()} == set(D[:3]) and found.count() == 3
    assert 3 <= seen[0] <= 3 * 500
    # more keys than go by value: a join with the same result
    joined_rows = rows_with_keys(t.read().select("id", "day"), "id", ids, lambda df, name: df, most=2)
    assert rows(joined_rows) == rows(found)


def test_work_folder_is_new_each_time(spark):
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir")) and uuid.UUID(a[-32:])


def test_scratch_is_cleared(spark):
    df = spark.range(3)
    with scratch(spark) as keep:
        stored = keep(df, "numbers")
        assert stored.count() == 3
    with pytest.raises(Exception):
        stored.count()
