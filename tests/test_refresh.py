from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators.profile import baseline_from_states, customer_baseline
from riskloom.operators.scoring import score_transactions
from riskloom.operators.states import daily_states
from riskloom.operators.staging import stage_transactions
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.plans.cycle import Store
from riskloom.plans.refresh import _surroundings, new_states, refresh_baseline, refresh_scores, unscored
from riskloom.schemas import RAW_SCHEMA
from riskloom.session import work_folder, written
from riskloom.sources.batches import Span
from riskloom.sources.tables import land_batch
from tests.helpers import START, random_rows, table, txn

AS_OF = dt.date(2024, 1, 12)
RUN, RUN2 = dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 13)
ALL_HOT = HotKeyPolicy(min_rows=1, max_keys=1_000_000)


@pytest.fixture
def store(spark):
    return Store(spark, work_folder(spark, "refresh"))


def by_id(df):
    out = {}
    for r in df.drop("scored_at").collect():
        assert r["transaction_id"] not in out
        out[r["transaction_id"]] = tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    return out


def refresh(spark, store, rows, base, run, **kw):
    txns = table(spark, rows)
    refresh_scores(txns, daily_states(txns), base, store.mart, AS_OF, run, **kw)


def two_runs(spark, store, rows, late, policy=HotKeyPolicy(), **kw):
    """Score ``rows`` first, then ``rows + late``; the profile stays the same."""
    everything = table(spark, rows + late)
    base = customer_baseline(everything, AS_OF, RUN)
    refresh(spark, store, rows, base, RUN, policy=policy)
    first = by_id(store.mart.read())
    refresh(spark, store, rows + late, base, RUN2, policy=policy, **kw)
    return first, by_id(store.mart.read()), by_id(score_transactions(everything, base, RUN))


@pytest.mark.parametrize("policy", [HotKeyPolicy(), ALL_HOT], ids=["plain", "hot"])
def test_incremental_scores_equal_full_scores(spark, store, policy):
    rows = random_rows(11, 200)
    first, got, want = two_runs(spark, store, rows[:120], rows[120:], policy)
    assert got.keys() == want.keys()
    new = {r["transaction_id"] for r in rows[120:]}
    assert {k: got[k] for k in new} == {k: want[k] for k in new}
    # rows of the first run are left as they were
    assert {k: got[k] for k in first} == first


@pytest.mark.parametrize("policy", [HotKeyPolicy(), ALL_HOT], ids=["plain", "hot"])
def test_rescoring_after_late_rows_equals_scoring_at_once(spark, store, policy):
    rows = random_rows(12, 200)
    _, got, want = two_runs(spark, store, rows[:120], rows[120:], policy, rescore_later=True)
    assert got == want


def test_high_water_skips_late_rows_and_slice_forgets_the_past(spark, store):
    minute = dt.timedelta(minutes=1)
    rows = [txn("T1", at=START), txn("T3", at=START + 10 * minute, country="GB")]
    late = [txn("T2", at=START + minute), txn("T4", at=START + 11 * minute, country="JP"), txn("T5", at=START + 12 * minute)]
    _, got, want = two_runs(spark, store, rows, late, mode="high_water", context="slice")
    assert sorted(got) == ["T1", "T3", "T4", "T5"]
    prev = store.mart.read().select("transaction_id", "prev_country").collect()
    assert {r[0]: r[1] for r in prev} == {"T1": None, "T3": "US", "T4": None, "T5": "JP"}
    assert want["T4"] != got["T4"] and want["T5"] != got["T5"]


def test_rows_older_than_the_look_back_are_scored_and_found_as_predecessors(spark, store):
    day = dt.timedelta(days=1)
    rows = [txn("T1", at=START - 200 * day), txn("T2", "C2", at=START - 300 * day), txn("T3", "C3")]
    late = [txn("T4", country="GB"), txn("T5", "C2", at=START - 150 * day, country="GB"), txn("T6", "C4")]
    _, got, want = two_runs(spark, store, rows, late)
    assert got == want
    prev = {r[0]: r[1] for r in store.mart.read().select("transaction_id", "prev_country").collect()}
    assert (prev["T4"], prev["T5"], prev["T6"]) == ("US", "US", None)


def test_a_second_run_of_a_day_recomputes_what_came_late(spark, store):
    rows = [txn("T1", "A"), txn("T2", "B"), txn("T3", "A", at=dt.datetime.combine(AS_OF, dt.time(1)))]
    refresh_baseline(daily_states(table(spark, rows)), store.baseline, AS_OF, RUN)
    versions = store.baseline.newest()
    refresh_baseline(daily_states(table(spark, rows)), store.baseline, AS_OF, RUN2, arrived=table(spark, rows[2:]))
    assert store.baseline.newest() == versions  # the running day is not in a profile
    late = [txn("T4", "B", amount="30.00")]
    refresh_baseline(daily_states(table(spark, rows + late)), store.baseline, AS_OF, RUN2, arrived=table(spark, late))
    got = {r["customer_id"]: (r["txn_count_90d"], r["computed_at"]) for r in store.baseline.read().collect()}
    assert got == {"A": (1, RUN), "B": (2, RUN2)}


def test_duplicates_give_one_scored_row(spark, store):
    copy = txn("T1", amount="99.00", _ingested_at=START + dt.timedelta(hours=1))
    twice = [txn("T1"), copy, txn("T2", "C2")]
    base = customer_baseline(table(spark, twice), AS_OF, RUN)
    refresh(spark, store, twice, base, RUN)
    refresh(spark, store, twice + [txn("T9"), txn("T9")], base, RUN2)
    got = {r["transaction_id"]: r for r in store.mart.read().collect()}
    assert store.mart.read().count() == 3 and float(got["T1"]["amount"]) == 99.0
    before = {r[0]: r[1] for r in store.mart.read().select("transaction_id", "scored_at").collect()}
    refresh(spark, store, twice + [txn("T9"), txn("T9")], base, RUN2)
    assert {r[0]: r[1] for r in store.mart.read().select("transaction_id", "scored_at").collect()} == before


@pytest.mark.parametrize("rescore_later", [False, True])
def test_an_id_that_arrives_again_with_another_date_replaces_its_row(spark, store, rescore_later):
    day, hour = dt.timedelta(days=1), dt.timedelta(hours=1)
    first = [txn("T1"), txn("T2", "C2"), txn("T3", "C3", _ingested_at=START + 9 * hour)]
    base = customer_baseline(table(spark, first), AS_OF, RUN)
    refresh(spark, store, first, base, RUN)
    # T1 and T2 are sent again later; of T3 an older copy comes late; T4 is new
    again = [
        txn("T1", at=START + day, amount="99.00", _ingested_at=START + hour),
        txn("T2", "C9", at=None, _ingested_at=START + hour),
        txn("T3", "C3", at=START + 2 * day, _ingested_at=START - hour),
        txn("T4", at=START + day),
    ]
    refresh(spark, store, first + again, base, RUN2, arrived=table(spark, again), rescore_later=rescore_later)
    got = {r["transaction_id"]: (r["customer_id"], r["transaction_date"]) for r in store.mart.read().collect()}
    assert store.mart.read().count() == 4
    assert got == {"T1": ("C1", (START + day).date()), "T2": ("C9", None), "T3": ("C3", START.date()), "T4": ("C1", (START + day).date())}


def test_selection(spark):
    rows = [txn(f"T{d}", at=START + dt.timedelta(days=d)) for d in range(4)] + [txn("TN", at=None)]
    txns = table(spark, rows)
    done = txns.where(F.col("transaction_id").isin("T1", "T2"))
    ids = lambda df: sorted(r["transaction_id"] for r in df.collect())
    assert ids(unscored(txns, None)) == ["T0", "T1", "T2", "T3", "TN"]
    assert ids(unscored(txns, done)) == ["T0", "T3", "TN"]
    assert ids(unscored(txns, done, first_day=START.date() + dt.timedelta(days=1))) == ["T3", "TN"]
    assert ids(unscored(txns, done, "high_water")) == ["T3"]
    assert ids(unscored(txns, done.limit(0), "high_water")) == ["T0", "T1", "T2", "T3", "TN"]
    with pytest.raises(ValueError):
        unscored(txns, done, "other")


def test_only_active_customers_get_a_new_profile(spark, store):
    day = dt.timedelta(days=1)
    rows = [txn("T1", "QUIET"), txn("T2", "BUSY"), txn("T3", "BUSY", at=START + 2 * day, amount="30.00")]
    later = AS_OF + 3 * day
    refresh_baseline(daily_states(table(spark, rows[:2])), store.baseline, AS_OF, RUN)
    refresh_baseline(daily_states(table(spark, rows)), store.baseline, later, RUN2)
    got = {r["customer_id"]: r for r in store.baseline.read().collect()}
    assert (got["QUIET"]["baseline_date"], got["BUSY"]["baseline_date"]) == (AS_OF, later)
    assert (got["QUIET"]["txn_count_90d"], got["BUSY"]["txn_count_90d"], got["BUSY"]["avg_amount"]) == (1, 2, 20.0)
    refresh_baseline(daily_states(table(spark, rows)), store.baseline, later, RUN2, full=True)
    assert {r["baseline_date"] for r in store.baseline.read().collect()} == {later}


def test_empty_stored_tables_count_as_first_run(spark, store):
    refresh_baseline(daily_states(table(spark, [])), store.baseline, AS_OF, RUN)
    assert store.baseline.read().count() == 0
    base = refresh_baseline(daily_states(table(spark, [txn("T1")])), store.baseline, AS_OF, RUN)
    assert base.count() == 1
    refresh(spark, store, [], base, RUN)
    refresh(spark, store, [txn("T1")], base, RUN)
    refresh(spark, store, [txn("T1")], base, RUN)
    assert store.mart.read().count() == 1


def test_a_row_that_comes_late_changes_two_days(spark, store):
    """One customer with rows on each day: only the late row's day and the next one are read and written."""
    day, minute = dt.timedelta(days=1), dt.timedelta(minutes=1)
    rows = [txn(f"T{d}", at=START - d * day, country="US" if d % 2 else "GB") for d in range(90)]
    rows += [txn("SAME", at=START - 80 * day + 4 * minute), txn("LATER", at=START - 80 * day + 9 * minute)]
    base = customer_baseline(table(spark, rows), AS_OF, RUN)
    refresh(spark, store, rows, base, RUN)
    before = by_id(store.mart.read())
    files = set(store.mart.read().inputFiles())
    late = txn("LATE", at=START - 80 * day + 2 * minute, country="JP", lat=35.0, lon=139.0)
    refresh(spark, store, rows + [late], base, RUN2, arrived=table(spark, [late]), rescore_later=True)
    got, want = by_id(store.mart.read()), by_id(score_transactions(table(spark, rows + [late]), base, RUN))
    assert got == want and {k for k in before if before[k] != got[k]} == {"SAME"}
    again = {r[0] for r in store.mart.read().where(F.col("scored_at") == F.lit(RUN2)).select("transaction_id").collect()}
    assert again == {"LATE", "SAME"}
    new_files = {f.rsplit("/", 2)[1] for f in set(store.mart.read().inputFiles()) - files}
    assert new_files == {f"transaction_date={(START - 80 * day).date()}"}
    # the last row of a day: the next day is written too
    last = txn("LAST", at=START - 50 * day + dt.timedelta(hours=23), country="JP")
    refresh(spark, store, rows + [late, last], base, RUN2, arrived=table(spark, [last]), rescore_later=True)
    assert by_id(store.mart.read()) == by_id(score_transactions(table(spark, rows + [late, last]), base, RUN))
    new_files = {f.rsplit("/", 2)[1] for f in set(store.mart.read().inputFiles()) - files}
    assert new_files == {f"transaction_date={(START - n * day).date()}" for n in (80, 50, 49)}


def test_a_refresh_reads_the_days_that_matter(spark, store):
    """The last row before a gap comes from the states, not from the days before it."""
    day = dt.timedelta(days=1)
    land(spark, store, [txn(f"T{d}", f"C{d % 3}", at=START - d * day) for d in range(40, 120)], 0)
    new = txn("NEW", "C1", country="GB")
    land(spark, store, [new], 1)
    read = []
    found, _ = _surroundings(stage_transactions(store.raw(), strict=False), daily_states(stage_transactions(store.raw())), table(spark, [new]), HotKeyPolicy(), True, lambda df, name: (read.append(name), written(df, name))[1])
    scan = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "event_date" in line)
    assert scan.count("2024-01") == 1 and "2024-01-10" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted((r["transaction_id"], r["_carried"]) for r in found.collect()) == [("NEW", False), ("T40", True)]


def land(spark, store, rows, batch):
    raw = [(r["transaction_id"], r["customer_id"], float(r["amount"]), *[None] * 3, r["transaction_timestamp"].isoformat(), r["country"], r["city"], r["latitude"], r["longitude"], r["device_id"], False, None, RUN, RUN) for r in rows]
    land_batch(spark.createDataFrame(raw, RAW_SCHEMA), store.raw_path, batch)


def test_states_of_batches_merge_to_the_profile_of_all_rows(spark, store):
    """Rows of a day in several batches, in any order, over midnight, with repetition."""
    rows = [r for r in random_rows(31, 240) if r["transaction_timestamp"] is not None and r["amount"] is not None]
    for n in range(4):
        land(spark, store, rows[n::4], n)
        txns = stage_transactions(store.raw())
        span = Span("batch", n, n)
        store.states.write(new_states(stage_transactions(store.raw(span.names())), txns, RiskParams(), HotKeyPolicy(), written), span)
    txns = stage_transactions(store.raw())
    first = min(r["transaction_date"] for r in rows)
    for as_of in (AS_OF, first + dt.timedelta(days=91), first + dt.timedelta(days=93)):
        want = rounded(customer_baseline(txns, as_of, RUN))
        assert rounded(baseline_from_states(store.states.read(), as_of, RUN)) == want and want
    store.states.merge("batch", fan=2, grace=0)
    assert store.states.spans() == [Span("batch", 0, 3)]
    got = baseline_from_states(store.states.read(), as_of, RUN)
    assert rounded(got) == want and "raw_transactions" not in got._jdf.queryExecution().toString()


def rounded(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
