"""The 90-day behavioural profile: one row per customer.

Ordinary customers: one shuffle on customer_id serves the burst windows, the
home-country window and a single aggregate. Hot customers: every statistic is
built from pre-aggregated pieces (value counts, value buckets, chunks of time), so
that no buffer or group holds all of their rows. Stored daily states give the same
profile without the rows.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.clock import as_ntz
from riskloom.functions.rules import is_night
from riskloom.operators.heat import Heat, Split, heat_of, measure_heat, split_by_heat
from riskloom.operators.history import PROFILE_BURSTS, plain_history, spread_history
from riskloom.operators.staging import lookback
from riskloom.operators.states import (
    KEY,
    QUANTILES,
    count_states,
    deviation,
    device_summary,
    geography_summary,
    merged_states,
    opening_day_alone,
    quantile_summary,
    spending_summary,
    spread_quantiles,
    timing_summary,
    velocity_summary,
)
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.schemas import BASELINE_COLUMNS
from riskloom.session import written

# Profile column -> burst column it is the maximum of.
BURST_RECORDS = {
    "historical_max_5min": "burst_5min",
    "historical_max_15min": "burst_15min",
    "historical_max_1hr": "burst_1hr",
}

SPENDING = (KEY, *BASELINE_COLUMNS[1:12])
GEOGRAPHY = (KEY, *BASELINE_COLUMNS[12:16])
TIMING = (KEY, *BASELINE_COLUMNS[16:18])
VELOCITY = (KEY, *BASELINE_COLUMNS[18:21])
DEVICES = (KEY, *BASELINE_COLUMNS[21:23])


# -- statistics that merge from small partial states, whatever the group size --


def _deviation(amount: Column) -> Column:
    squares = F.try_sum(F.try_multiply(amount, amount))
    return deviation(F.count(amount), F.sum(amount), squares, F.stddev_samp(amount.cast("double")))


def _moments(p: RiskParams) -> list[Column]:
    amount = F.col("amount")
    known = F.nullif(F.count(amount), F.lit(0))
    return [
        # from the exact decimal sum: does not depend on the order of the rows
        (F.sum(amount).cast("double") / known).alias("avg_amount"),
        _deviation(amount).alias("stddev_amount"),
        F.count("*").alias("txn_count_90d"),
        F.sum(amount).alias("total_spend_90d"),
        (F.count("*") / F.lit(float(p.baseline_lookback_days))).alias("avg_daily_txns"),
        F.max("transaction_date").alias("last_txn_date"),
    ]


def _night_rate(p: RiskParams) -> Column:
    return F.avg(F.when(is_night(F.col("transaction_timestamp"), p), 1.0).otherwise(0.0)).alias("late_night_rate")


# -- ordinary customers ------------------------------------------------------


def _with_home(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_home", F.mode("country", True).over(Window.partitionBy(KEY)))


def _distinct(name: str) -> Column:
    # count_distinct would add an exchange; the set of one customer is small
    return F.size(F.collect_set(name)).cast("long")


def _away_rate() -> Column:
    return F.avg(F.when(F.col("country") != F.col("_home"), 1.0).otherwise(0.0)).alias("cross_border_rate")


def _plain_spending(p: RiskParams) -> list[Column]:
    at = list(QUANTILES.values())
    return _moments(p) + [F.percentile(F.col("amount").cast("double"), at).alias("_quantiles")]


def _plain_geography(p: RiskParams) -> list[Column]:
    return [
        F.mode("country", True).alias("home_country"),
        F.mode("city", True).alias("home_city"),
        _distinct("country").alias("countries_visited"),
        _away_rate(),
    ]


def _plain_timing(p: RiskParams) -> list[Column]:
    return [F.mode(F.hour("transaction_timestamp"), True).alias("typical_hour"), _night_rate(p)]


def _plain_velocity(p: RiskParams) -> list[Column]:
    return [F.max(burst).alias(record) for record, burst in BURST_RECORDS.items()]


def _plain_devices(p: RiskParams) -> list[Column]:
    return [_distinct("device_id").alias("device_count_90d"), F.mode("device_id", True).alias("primary_device")]


def _unpack_quantiles(profile: DataFrame) -> DataFrame:
    if "_quantiles" not in profile.columns:
        return profile
    named = {name: F.col("_quantiles")[i] for i, name in enumerate(QUANTILES)}
    return profile.withColumns(named).drop("_quantiles")


def _plain(rows: DataFrame, p: RiskParams, parts) -> DataFrame:
    if _plain_velocity in parts:
        rows = plain_history(rows, PROFILE_BURSTS, previous=False)
    if _plain_geography in parts:
        rows = _with_home(rows)
    return _unpack_quantiles(rows.groupBy(KEY).agg(*[c for part in parts for c in part(p)]))


# -- hot customers -----------------------------------------------------------


def _same_customer(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join two tables with one row per hot customer, null-safe on the key."""
    other = right.withColumnRenamed(KEY, "_other")
    return left.join(other, F.col(KEY).eqNullSafe(F.col("_other")), "left").drop("_other")


def _spread_velocity(rows: DataFrame, heat: Heat) -> DataFrame:
    # simultaneous transactions have equal counts: keep one row per instant
    instants = rows.groupBy(KEY, "transaction_timestamp").agg(F.count("*").alias("_weight"))
    chunks = heat.chunks(1 + len(PROFILE_BURSTS))
    counted = spread_history(instants, PROFILE_BURSTS, False, chunks, heat.short, weight="_weight")
    return counted.groupBy(KEY).agg(*_plain_velocity(RiskParams()))


# What each part needs of the states: counted attributes, and the summary.
_FROM_STATES = {
    _plain_spending: (("amount",), spending_summary),
    _plain_geography: (("country", "city"), geography_summary),
    _plain_timing: (("hour",), timing_summary),
    _plain_devices: (("device",), device_summary),
}


def _spread(rows: DataFrame, p: RiskParams, parts, heat: Heat) -> DataFrame:
    """The source is read once for all counts and once for the bursts."""
    pieces = []
    counted = [_FROM_STATES[part] for part in parts if part in _FROM_STATES]
    if counted:
        attributes = tuple(a for names, _ in counted for a in names)
        counts = written(count_states(rows, p, (KEY,), attributes, n=heat.rows), "counts")
        pieces.append(counts.groupBy(KEY).agg(*[c for _, summary in counted for c in summary(p)]))
        if "amount" in attributes:
            pieces.append(spread_quantiles(counts))
    if _plain_velocity in parts:
        pieces.append(_spread_velocity(rows, heat))
    return reduce(_same_customer, pieces)


# -- public operators --------------------------------------------------------


def _profile(split: Split, p: RiskParams, columns, *parts) -> DataFrame:
    return split.map(
        lambda rows: _plain(rows, p, parts).select(*columns),
        lambda rows: _spread(rows, p, parts, split.heat).select(*columns),
    ).merged()


def _split(txns: DataFrame, heat: Heat | None) -> Split:
    return split_by_heat(txns, heat or measure_heat(txns))


def spending_profile(txns: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    return _profile(_split(txns, heat), p, SPENDING, _plain_spending)


def geography_profile(txns: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    return _profile(_split(txns, heat), p, GEOGRAPHY, _plain_geography)


def cross_border_rate(txns: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    """Share of a customer's transactions made outside the usual country."""
    return _profile(_split(txns, heat), p, (KEY, "home_country", "cross_border_rate"), _plain_geography)


def timing_profile(txns: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    return _profile(_split(txns, heat), p, TIMING, _plain_timing)


def velocity_profile(txns: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    return _profile(_split(txns, heat), p, VELOCITY, _plain_velocity)


def device_profile(txns: DataFrame, p: RiskParams = RiskParams(), heat: Heat | None = None) -> DataFrame:
    return _profile(_split(txns, heat), p, DEVICES, _plain_devices)


def customer_baseline(
    txns: DataFrame,
    as_of: dt.date,
    run_ts: dt.datetime,
    p: RiskParams = RiskParams(),
    heat: Heat | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Profiles of the look-back window that ends the day before ``as_of``.

    ``only`` restricts the work to the customers it lists (one row each).
    """
    window = lookback(txns, as_of, p.baseline_lookback_days)
    split = _split(window, heat)
    if only is not None:
        split = split.lookup(only, "left_semi")
    parts = (_plain_spending, _plain_geography, _plain_timing, _plain_velocity, _plain_devices)
    return _dated(_profile(split, p, BASELINE_COLUMNS[:-2], *parts), as_of, run_ts)


def _dated(profile: DataFrame, as_of: dt.date, run_ts: dt.datetime) -> DataFrame:
    # a profile is spending joined with the rest on customer_id, and a missing
    # customer never equals itself: such a row keeps its spending part only
    spending = set(SPENDING)
    return profile.select(
        *[c if c in spending else F.when(F.col(KEY).isNotNull(), F.col(c)).alias(c) for c in profile.columns],
        F.lit(as_of).alias("baseline_date"),
        as_ntz(run_ts).alias("computed_at"),
    )


def baseline_from_states(
    states: DataFrame,
    as_of: dt.date,
    run_ts: dt.datetime,
    p: RiskParams = RiskParams(),
    heat: Heat | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """``customer_baseline`` from daily states instead of rows, with the same result.

    States of one customer and day may stand in several rows. Without ``heat`` hot
    customers are those with many rows behind their states.
    """
    first = as_of - dt.timedelta(days=p.baseline_lookback_days)
    window = opening_day_alone(lookback(states, as_of, p.baseline_lookback_days), first).drop("last")
    split = split_by_heat(window, heat or heat_of(state_counts(window), HotKeyPolicy()))
    if only is not None:
        split = split.lookup(only, "left_semi", null_safe=True)
    summaries = (spending_summary, geography_summary, timing_summary, velocity_summary, device_summary)
    columns = [c for summary in summaries for c in summary(p)]

    def plain(rows: DataFrame) -> DataFrame:
        # one shuffle serves both steps
        merged = merged_states(rows.repartition(KEY), (KEY,))
        return _unpack_quantiles(merged.groupBy(KEY).agg(*columns, quantile_summary()))

    def spread(rows: DataFrame) -> DataFrame:
        merged = written(merged_states(rows, (KEY,)), "merged")
        return _same_customer(merged.groupBy(KEY).agg(*columns), spread_quantiles(merged))

    profile = split.map(
        lambda rows: plain(rows).select(*BASELINE_COLUMNS[:-2]), lambda rows: spread(rows).select(*BASELINE_COLUMNS[:-2])
    ).merged()
    return _dated(profile, as_of, run_ts)


def state_counts(states: DataFrame) -> DataFrame:
    """Rows (n) per customer."""
    return states.where(F.col("part") == "day").groupBy(KEY).agg(F.sum("n").alias("n"))
