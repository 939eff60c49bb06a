"""Bring the stored profile and the stored scores up to date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.clock import MICROS, epoch_micros, floor_div
from riskloom.operators.heat import Heat, heat_of, measure_heat, split_by_heat
from riskloom.operators.history import SCORE_BURSTS
from riskloom.operators.profile import baseline_from_states, state_counts
from riskloom.operators.scoring import score_transactions
from riskloom.operators.staging import active_customers, lookback, newer_than
from riskloom.operators.states import as_states, burst_states, count_states, customer_days
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.session import scratch
from riskloom.sources.tables import DailyTable, VersionedTable, latest_per_key, on_days, rows_with_keys, without_copies

_NEW = ("transaction_id", "customer_id", "transaction_timestamp", "transaction_date")


def new_states(arrived: DataFrame, txns: DataFrame, p: RiskParams, policy: HotKeyPolicy, keep: Callable) -> DataFrame:
    """States of rows that arrived; ``txns`` are all rows, these included.

    Counts are those of the new rows. Burst records are counted again for the days these
    fall on and the days after, from all rows of the customers on them and on the day
    before.
    """
    day = F.col("transaction_date")
    counts = keep(arrived.groupBy("customer_id", "transaction_date").agg(F.count("*").alias("n")), "touched")
    per_customer = counts.groupBy("customer_id").agg(F.sum("n").alias("n"))
    n, heat = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], heat_of(per_customer, policy)
    counted = as_states(count_states(arrived, p, heat=heat, n=n))
    if txns.count() == n:
        # all rows have just arrived: nothing is around them
        bursts = burst_states(split_by_heat(arrived.where(day.isNotNull()), heat), n=n)
        return counted.unionByName(as_states(bursts))
    touched = counts.where(day.isNotNull())

    def also(*shifts: int) -> DataFrame:
        days = F.explode(F.array(*[F.date_add(day, n) for n in shifts])).alias("transaction_date")
        return touched.select("customer_id", days).distinct()

    read = keep(also(-1, 0, 1), "read")
    pairs = _renamed(read)
    rows = on_days(txns, "transaction_date", read.select("transaction_date").distinct())
    # of all customers on these days, so that the join is made once
    per_customer = keep(rows.groupBy("customer_id").agg(F.count("*").alias("n")), "per_customer")
    n, heat = per_customer.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], heat_of(per_customer, policy)
    rows = rows.select("customer_id", "transaction_id", "transaction_timestamp", "transaction_date")
    rows = rows.join(pairs, _same(rows, pairs, "customer_id", "transaction_date"), "left_semi")
    bursts = burst_states(split_by_heat(rows, heat), also(0, 1), n)
    return counted.unionByName(as_states(bursts))


def refresh_baseline(
    states: DataFrame,
    table: VersionedTable,
    as_of: dt.date,
    run_ts: dt.datetime,
    p: RiskParams = RiskParams(),
    policy: HotKeyPolicy = HotKeyPolicy(),
    full: bool = False,
    arrived: DataFrame | None = None,
) -> DataFrame:
    """Merge the profiles of customers active since the last run from daily states.

    Others keep the profile they have. An empty or missing table, or ``full``,
    makes it a full refresh. ``arrived`` are the rows landed since the last run: a
    customer among them with a row in the look-back gets a new profile, however late
    that row is. A second run on the same day recomputes these customers only, since
    a profile leaves the running day out.
    """
    days = p.baseline_lookback_days

    def profiles(found: DataFrame, only: DataFrame | None = None) -> DataFrame:
        heat = heat_of(state_counts(lookback(found, as_of, days)), policy)
        return baseline_from_states(found, as_of, run_ts, p, heat, only)

    existing = None if full else table.read()
    since = existing.agg(F.max("baseline_date")).first()[0] if existing is not None else None
    if since is None:
        return table.replace(profiles(states))
    late = None if arrived is None else lookback(arrived, as_of, days).select("customer_id").distinct()
    if since >= as_of and (late is None or late.isEmpty()):
        return existing
    with scratch(table.spark) as keep:
        if since >= as_of:
            # few customers: only their states are read
            updates = profiles(rows_with_keys(lookback(states, as_of, days), "customer_id", late, keep))
        else:
            only = active_customers(states.where(F.col("part") == "day"), since)
            updates = profiles(states, only if late is None else only.union(late).distinct())
        rows = table.upsert(updates, "customer_id", on_change="append_new_columns")
    table.forget_old_versions()
    return rows


def _dated_from(day: dt.date) -> Column:
    """Dated ``day`` or later, or not dated at all."""
    return (F.col("transaction_date") >= F.lit(day)) | F.col("transaction_date").isNull()


def unscored(txns: DataFrame, scored: DataFrame | None, mode: str = "missing", first_day: dt.date | None = None) -> DataFrame:
    """Ids and times of the rows to score.

    ``missing``: every row (dated ``first_day`` or later, if that is given) whose id
    is not in the scored table, however late it came. ``high_water``: rows after the latest
    scored timestamp; cheap, but late rows are never scored.
    """
    keys = txns.select(*_NEW)
    if mode not in ("missing", "high_water"):
        raise ValueError(f"unknown selection mode {mode!r}")
    if scored is None:
        return keys
    if mode == "high_water":
        # bound as a literal, so that it reaches the files
        return newer_than(keys, scored.agg(F.max("transaction_timestamp")).first()[0])
    known = scored.select("transaction_id", "transaction_date")
    if first_day is not None:
        in_scope = _dated_from(first_day)
        keys, known = keys.where(in_scope), known.where(in_scope)
    return keys.join(known.select("transaction_id"), "transaction_id", "left_anti")


def refresh_scores(
    txns: DataFrame,
    states: DataFrame,
    baseline: DataFrame,
    table: DailyTable,
    as_of: dt.date,
    run_ts: dt.datetime,
    p: RiskParams = RiskParams(),
    policy: HotKeyPolicy = HotKeyPolicy(),
    mode: str = "missing",
    context: str = "full",
    rescore_later: bool = False,
    late_days: int | None = None,
    arrived: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Score what is new and put it into the scored table; the days that were written.

    New is what is not in the scored table, whatever its date. ``arrived`` names the
    candidates, the rows of batches that were not scored yet; they are looked up in the
    scored table by id. A candidate whose id is scored under another
    date replaces that row if it is the newest copy (by ``_ingested_at``) of its id.
    Without it all rows are candidates, and ``late_days`` may bound how old they are.

    ``context="full"`` lets new rows see the customer's earlier rows, so the result
    equals scoring everything at once; ``"slice"`` shows them each other only. The daily
    ``states`` of all ``txns`` tell on which days a customer has rows and which one was
    the last of each: only the days that matter are read. With ``rescore_later`` rows
    that a late one changes are scored again: the next one of its customer, and those it
    is counted for. ``buckets``: those of the stored profile, for the first run; later
    ones look up the profiles of their customers.
    """
    if context not in ("full", "slice"):
        raise ValueError(f"unknown context {context!r}")
    with scratch(table.spark) as keep:
        scored, moved, ids = table.read(), None, txns
        first = scored is None or scored.isEmpty()
        if first:
            heat = measure_heat(txns, policy)
            rows = score_transactions(txns, baseline, run_ts, p, heat, extra=("_ingested_at",), buckets=buckets)
        else:
            if arrived is None:
                first_day = None if late_days is None else as_of - dt.timedelta(days=late_days)
                new = keep(unscored(txns, scored, mode, first_day), "new")
            else:
                arrived = keep(arrived.select(*_NEW), "arrived")
                if mode == "missing":
                    scored = table.find(arrived, keep)
                    moved = _moved(txns, arrived, scored, keep)
                new = unscored(arrived, scored, mode)
                new = keep(new if moved is None else new.unionByName(moved), "new")
            if new.isEmpty():
                return new.sparkSession.createDataFrame([], "transaction_date date")
            if context == "full":
                found, heat = _surroundings(txns, states, new, policy, rescore_later, keep)
            else:
                found = on_days(txns, "transaction_date", new.select("transaction_date").distinct())
                found, heat = _marked(found, new).where("_new"), measure_heat(new, policy)
            # few customers: only their profiles are read
            baseline = rows_with_keys(baseline, "customer_id", new, keep, "profiles")
            wanted = F.col("_new")
            if rescore_later and context == "full":
                found = _near_new(found, new)
                # undated rows come last, whatever is before them
                wanted = wanted | F.col("_near") | F.coalesce("_after_new", F.lit(False)) | F.col("transaction_timestamp").isNull()
            rows = score_transactions(found, baseline, run_ts, p, heat, only=wanted & ~F.col("_carried"), extra=("_ingested_at", "_new"), more={"_after_new": "_new"})
            rows = keep(rows, "scored")
            if rescore_later and context == "full":
                # an older copy of a row that has moved to another day is not scored again
                at = table.find(rows.where(~F.col("_new")), keep, "again_at").withColumnsRenamed({"transaction_id": "_id", "transaction_date": "_at"})
                here = rows["transaction_id"].eqNullSafe(at["_id"]) & rows["transaction_date"].eqNullSafe(at["_at"])
                rows = keep(rows.where("_new").unionByName(rows.where(~F.col("_new")).join(at, here, "left_semi")), "current")
            rows, ids = rows.drop("_new"), rows
        rows = without_copies(rows, ids, "transaction_id", "_ingested_at", keep).drop("_ingested_at")
        if mode == "missing" and not rescore_later and moved is None:
            table.append(rows)
            # after a first run those of the table, whose folders tell: the rows were not kept
            days = (table.read() if first else rows).select("transaction_date").distinct().collect()
        else:
            days = table.upsert(rows)
        return table.spark.createDataFrame([tuple(r) for r in days], "transaction_date date")


def _moved(txns: DataFrame, arrived: DataFrame, known: DataFrame, keep: Callable) -> DataFrame | None:
    """The newest copies of arriving ids that are scored under another date than
    theirs, or None. Usually there are none, and then the transactions are not read."""
    was = known.select("transaction_id", F.col("transaction_date").alias("_was"))
    elsewhere = ~F.col("transaction_date").eqNullSafe(F.col("_was"))
    days = arrived.select("transaction_id", "transaction_date").distinct()
    again = keep(days.join(was, "transaction_id").where(elsewhere).select("transaction_id").distinct(), "again")
    if again.isEmpty():
        return None
    copies = txns.select(*arrived.columns, "_ingested_at").join(again, "transaction_id", "left_semi")
    newest = latest_per_key(copies, "transaction_id", "_ingested_at").select(*arrived.columns)
    newest = newest.join(was, "transaction_id").where(elsewhere).select(*arrived.columns).distinct()
    newest = keep(newest, "moved")
    return None if newest.isEmpty() else newest


# -- which rows matter ---------------------------------------------------------


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns of two tables."""
    return reduce(and_, [left[n].eqNullSafe(right[f"_{n}"]) for n in names])


def _renamed(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({c: f"_{c}" for c in rows.columns})


def _marked(rows: DataFrame, new: DataFrame) -> DataFrame:
    """``_new``: whether a row is to be scored, by its id."""
    ids = new.select("transaction_id").distinct().withColumn("_n", F.lit(True))
    rows = rows.join(ids, "transaction_id", "left").withColumn("_new", F.col("_n").isNotNull())
    return rows.drop("_n").withColumn("_carried", F.lit(False))


def _surroundings(
    txns: DataFrame, states: DataFrame, new: DataFrame, policy: HotKeyPolicy, rescore_later: bool, keep: Callable
) -> tuple[DataFrame, Heat]:
    """The rows that decide about the scores of new ones, and what those change.

    Read are, per customer with something new, its days with new rows, the day before
    each (counts look back over midnight), with ``rescore_later`` the next day on which
    the customer has rows, and undated rows. Where the customer's row before such a day
    is on none of these, it comes from the states (``_carried``).
    """
    mine = rows_with_keys(states.where(F.col("part") == "day"), "customer_id", new, keep, "mine")
    days = keep(customer_days(mine), "days")
    heat = heat_of(days.groupBy("customer_id").agg(F.sum("n").alias("n")), policy)

    # one row per customer and day; undated rows stand at the end
    by_day = Window.partitionBy("customer_id").orderBy(F.col("transaction_date").asc_nulls_last())
    known = days.select(
        "customer_id",
        "transaction_date",
        F.lag("transaction_date").over(by_day).alias("day_before"),
        F.lag("last").over(by_day).alias("last_before"),
        F.lead("transaction_date").over(by_day).alias("day_after"),
        F.max(F.col("transaction_date").isNull()).over(Window.partitionBy("customer_id")).alias("undated"),
    )
    fresh = _renamed(new.select("customer_id", "transaction_date").distinct())
    at_new = known.join(fresh, _same(known, fresh, "customer_id", "transaction_date"), "left_semi")
    day, before = F.col("transaction_date"), F.col("day_before")
    reach = [day, F.when(F.date_add(before, 1) == day, before)]
    if rescore_later:
        reach.append(F.col("day_after"))
    read = at_new.select("customer_id", F.explode(F.array_distinct(F.array(*reach))).alias("transaction_date"), day.isNull().alias("_null"))
    # a null in the array stands for nothing, but for rows that have no date themselves
    read = read.where(F.col("transaction_date").isNotNull() | F.col("_null"))
    if rescore_later:
        also = at_new.where("undated").select("customer_id", F.lit(None).cast("date").alias("transaction_date"))
        read = read.select("customer_id", "transaction_date").unionByName(also)
    read = keep(read.select("customer_id", "transaction_date").distinct(), "read")

    pairs = _renamed(read)
    rows = on_days(txns, "transaction_date", read.select("transaction_date").distinct())
    rows = _marked(rows.join(pairs, _same(rows, pairs, "customer_id", "transaction_date"), "left_semi"), new)
    here = known.join(pairs, _same(known, pairs, "customer_id", "transaction_date"), "left_semi")
    gone = here.where(F.col("last_before").isNotNull()).withColumnsRenamed({"transaction_date": "_of", "day_before": "transaction_date"})
    gone = gone.join(pairs, _same(gone, pairs, "customer_id", "transaction_date"), "left_anti")
    carried = gone.select("customer_id", "last_before.*", F.lit(False).alias("_new"), F.lit(True).alias("_carried")).distinct()
    return rows.unionByName(carried, allowMissingColumns=True), heat


_BURST = max(SCORE_BURSTS.values()) * MICROS


def _near_new(rows: DataFrame, new: DataFrame) -> DataFrame:
    """``_near``: whether a new row of the customer happened at the row's time or less
    than a burst before. Times are compared per stretch of the length of a burst: with
    the first new row of the row's own stretch and the last one of the stretch before."""
    at = epoch_micros(F.col("transaction_timestamp"))
    times = new.where(F.col("transaction_timestamp").isNotNull()).select("customer_id", at.alias("_t"), floor_div(at, _BURST).alias("_b"))
    stretch = times.groupBy("customer_id", "_b").agg(F.min("_t").alias("_min"), F.max("_t").alias("_max"))
    own = stretch.select("customer_id", "_b", F.col("_min").alias("_own"), F.lit(None).cast("long").alias("_last"))
    onward = stretch.select("customer_id", (F.col("_b") + 1).alias("_b"), F.lit(None).cast("long").alias("_own"), F.col("_max").alias("_last"))
    both = own.unionByName(onward).groupBy(F.col("customer_id").alias("_c"), "_b").agg(F.max("_own").alias("_own"), F.max("_last").alias("_last"))
    rows = rows.withColumn("_at", at).withColumn("_stretch", floor_div(F.col("_at"), _BURST))
    same = F.col("customer_id").eqNullSafe(F.col("_c")) & (F.col("_stretch") == F.col("_b"))
    near = (F.col("_own") <= F.col("_at")) | (F.col("_last") >= F.col("_at") - _BURST)
    rows = rows.join(both, same, "left").withColumn("_near", F.coalesce(near, F.lit(False)))
    return rows.drop("_at", "_stretch", "_c", "_b", "_own", "_last")
