"""Scoring rules as pure column expressions.

Comparisons with NULL stay NULL and fall through to the next branch, so that a
customer without a profile, or a row without a place, scores nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.params import RiskParams


def amount_zscore(amount: Column, mean: Column, std: Column) -> Column:
    return F.when(std > 0, (amount.cast("double") - mean) / std).otherwise(0.0)


def amount_score(amount: Column, zscore: Column, std: Column, p99: Column, p: RiskParams) -> Column:
    spread_known = std > 0
    return (
        F.when(spread_known & (zscore > p.extreme_zscore), p.extreme_amount_points)
        .when(spread_known & (zscore > p.high_zscore), p.high_amount_points)
        .when(amount.cast("double") > p99, p.above_p99_points)
        .otherwise(0)
    )


def velocity_score(burst: Column, record: Column, p: RiskParams) -> Column:
    floor = F.lit(p.burst_floor)
    return (
        F.when(burst > F.greatest(F.coalesce(record, F.lit(0)), floor), p.record_burst_points)
        .when(burst > floor, p.burst_points)
        .otherwise(0)
    )


def speed_kmh(distance: Column, minutes: Column) -> Column:
    """Implied speed; NULL when no minute boundary was crossed."""
    return distance / F.nullif(minutes / F.lit(60.0), F.lit(0.0))


def travel_speed(speed: Column) -> Column:
    return F.when(speed > 0, speed).otherwise(0.0)


def geo_score(speed: Column, minutes: Column, country: Column, prev_country: Column, p: RiskParams) -> Column:
    abroad = country != prev_country
    return (
        F.when(speed > p.impossible_speed_kmh, p.impossible_travel_points)
        .when(abroad & (minutes < p.fast_border_minutes), p.fast_border_points)
        .when(abroad, p.border_points)
        .otherwise(0)
    )


def device_score(device: Column, primary: Column, device_count: Column, p: RiskParams) -> Column:
    unfamiliar = device != primary
    return (
        F.when(unfamiliar & (device_count < p.habitual_device_count), p.habitual_device_points)
        .when(unfamiliar, p.new_device_points)
        .otherwise(0)
    )


def is_night(ts: Column, p: RiskParams) -> Column:
    return F.hour(ts).between(p.night_first_hour, p.night_last_hour)


def temporal_score(ts: Column, late_night_rate: Column, p: RiskParams) -> Column:
    unusual = is_night(ts, p) & (late_night_rate < p.night_rate_limit)
    return F.when(unusual, p.night_points).otherwise(0)


def risk_level(total: Column, p: RiskParams) -> Column:
    return (
        F.when(total >= p.high_risk_threshold, "HIGH")
        .when(total >= p.medium_risk_threshold, "MEDIUM")
        .otherwise("LOW")
    )


def recommended_action(total: Column, p: RiskParams) -> Column:
    return (
        F.when(total >= p.high_risk_threshold, "BLOCK")
        .when(total >= p.medium_risk_threshold, "STEP_UP_AUTH")
        .otherwise("APPROVE")
    )
