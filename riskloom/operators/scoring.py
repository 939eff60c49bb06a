"""Score each transaction from 0 to 100 on five dimensions."""

from __future__ import annotations

import datetime as dt
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.clock import as_ntz, minutes_between
from riskloom.functions.geo import haversine_km
from riskloom.operators.heat import Heat, Split, measure_heat, split_by_heat
from riskloom.operators.history import SCORE_BURSTS, attach_history
from riskloom.params import RiskParams
from riskloom.schemas import MART_COLUMNS

PROFILE_COLUMNS = {
    "avg_amount": "baseline_avg",
    "stddev_amount": "baseline_std",
    "p99_amount": "p99_amount",
    "historical_max_5min": "historical_max_5min",
    "device_count_90d": "device_count_90d",
    "primary_device": "primary_device",
    "late_night_rate": "late_night_rate",
    "typical_hour": "typical_hour",
}


def enrich_with_baseline(txns: DataFrame, baseline: DataFrame, heat: Heat | None = None) -> DataFrame:
    """Left-join each transaction with its customer's profile, once."""
    return _enrich(split_by_heat(txns, heat or measure_heat(txns)), baseline).merged()


def _enrich(split: Split, baseline: DataFrame) -> Split:
    wanted = baseline.select("customer_id", *[F.col(old).alias(new) for old, new in PROFILE_COLUMNS.items()])
    return split.lookup(wanted, "left")


# Each part is a list of levels; a level may use the columns of the ones before.
# Parts are merged level by level, so that all of them cost a few projections.


def _amount(p: RiskParams) -> list[dict[str, Column]]:
    amount, std, zscore = F.col("amount"), F.col("baseline_std"), F.col("amount_zscore")
    return [
        {"amount_zscore": rules.amount_zscore(amount, F.col("baseline_avg"), std)},
        {"amount_score": rules.amount_score(amount, zscore, std, F.col("p99_amount"), p)},
    ]


def _velocity(p: RiskParams) -> list[dict[str, Column]]:
    return [{"velocity_score": rules.velocity_score(F.col("current_burst_5min"), F.col("historical_max_5min"), p)}]


def _travel(p: RiskParams) -> list[dict[str, Column]]:
    minutes = F.col("minutes_elapsed")
    return [
        {
            "distance_km": haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("latitude"), F.col("longitude")),
            "minutes_elapsed": minutes_between(F.col("prev_ts"), F.col("transaction_timestamp")),
        },
        {
            "hours_elapsed": minutes / F.lit(60.0),
            "_speed": rules.speed_kmh(F.col("distance_km"), minutes),
        },
        {"travel_speed_kmh": rules.travel_speed(F.col("_speed"))},
    ]


def _geo(p: RiskParams) -> list[dict[str, Column]]:
    minutes, here, before = F.col("minutes_elapsed"), F.col("country"), F.col("prev_country")
    return [{}, {}, {"geo_score": rules.geo_score(F.col("_speed"), minutes, here, before, p)}]


def _device(p: RiskParams) -> list[dict[str, Column]]:
    known, count = F.col("primary_device"), F.col("device_count_90d")
    return [{"device_score": rules.device_score(F.col("device_id"), known, count, p)}]


def _temporal(p: RiskParams) -> list[dict[str, Column]]:
    return [{"temporal_score": rules.temporal_score(F.col("transaction_timestamp"), F.col("late_night_rate"), p)}]


def _verdict(p: RiskParams) -> list[dict[str, Column]]:
    total = F.col("total_score")
    parts = ("amount_score", "velocity_score", "geo_score", "device_score", "temporal_score")
    return [
        {},
        {},
        {},
        {"total_score": sum((F.col(part) for part in parts[1:]), F.col(parts[0]))},
        {"risk_level": rules.risk_level(total, p), "recommended_action": rules.recommended_action(total, p)},
    ]


def _add(rows: DataFrame, p: RiskParams, *parts) -> DataFrame:
    for level in zip_longest(*[part(p) for part in parts], fillvalue={}):
        rows = rows.withColumns({name: column for columns in level for name, column in columns.items()})
    return rows


def add_amount_score(rows: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    return _add(rows, p, _amount)


def add_velocity_score(rows: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    return _add(rows, p, _velocity)


def add_travel(rows: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    """Distance, elapsed time and implied speed since the previous transaction."""
    return _add(rows, p, _travel)


def add_geo_score(rows: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    return _add(rows, p, _travel, _geo)


def add_device_score(rows: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    return _add(rows, p, _device)


def add_temporal_score(rows: DataFrame, p: RiskParams = RiskParams()) -> DataFrame:
    return _add(rows, p, _temporal)


def score_transactions(
    txns: DataFrame,
    baseline: DataFrame,
    run_ts: dt.datetime,
    p: RiskParams = RiskParams(),
    heat: Heat | None = None,
    only: Column | None = None,
    extra: tuple[str, ...] = (),
    more: dict[str, str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Score ``txns`` against ``baseline`` (one row per customer).

    Bursts and previous places are taken from all of ``txns``. ``only``
    (a boolean column) then selects the rows to return, so that rows of earlier
    runs can be passed along as context; it may use columns of the previous row that
    ``more`` names (new -> old). ``extra`` columns are kept at the end. ``buckets``:
    the profile is stored in so many, by customer; the transactions are then dealt the
    same way, once for windows and join.
    """
    split = split_by_heat(txns, heat or measure_heat(txns))
    if buckets:
        split = split.map(lambda rows: rows.repartition(buckets, "customer_id"), lambda rows: rows)
    split = attach_history(split, SCORE_BURSTS, previous=True, more=more)
    if only is not None:
        split = split.where(only)
    rows = _enrich(split, baseline).merged()
    rows = _add(rows, p, _amount, _velocity, _travel, _geo, _device, _temporal, _verdict)
    rows = rows.withColumn("scored_at", as_ntz(run_ts))
    return rows.select(*MART_COLUMNS, *extra)


def risk_level_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_level", "recommended_action").agg(
        F.count("*").alias("transactions"),
        F.sum("total_score").alias("score_points"),
        F.max("total_score").alias("highest_score"),
    )
