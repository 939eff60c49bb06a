"""Tunable settings, passed explicitly to every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskParams:
    """Scoring rules. The defaults are fixed values: results depend on them."""

    baseline_lookback_days: int = 90
    high_risk_threshold: int = 60
    medium_risk_threshold: int = 40
    impossible_speed_kmh: float = 800.0

    extreme_zscore: float = 3.0
    extreme_amount_points: int = 30
    high_zscore: float = 2.0
    high_amount_points: int = 20
    above_p99_points: int = 15

    burst_floor: int = 3
    record_burst_points: int = 25
    burst_points: int = 15

    impossible_travel_points: int = 30
    fast_border_points: int = 20
    border_points: int = 10
    fast_border_minutes: int = 60

    habitual_device_count: int = 3
    habitual_device_points: int = 10
    new_device_points: int = 5

    night_first_hour: int = 0
    night_last_hour: int = 5
    night_rate_limit: float = 0.05
    night_points: int = 5

    urgent_alert_above: int = 100
    monitor_minutes: int = 5


@dataclass(frozen=True)
class HotKeyPolicy:
    """When a customer counts as hot, and how its rows are spread.

    A customer is hot when it owns more than ``min_rows`` rows, whatever the size
    of the table: so much fits into one task. The list of hot customers is broadcast
    while it has at most ``max_keys`` entries; a longer one is stored and joined by
    a shuffle.

    Rows of hot customers are ordered in chunks of about ``chunk_rows``.
    """

    max_keys: int = 100_000
    min_rows: int = 1_000_000
    chunk_rows: int = 1_000_000
