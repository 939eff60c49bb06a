"""Freshness of the raw table and routing of alerts, as one-row tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.clock import as_ntz
from riskloom.params import RiskParams

# Texts of the two alerts.
URGENT_TEXT = ":rotating_light: *URGENT* — %d HIGH risk transactions in last %d min. Immediate review needed."
STANDARD_TEXT = ":warning: %d HIGH risk transactions flagged in last %d min."


def _since(now: dt.datetime, p: RiskParams) -> Column:
    return as_ntz(now - dt.timedelta(minutes=p.monitor_minutes))


def freshness_check(raw: DataFrame, now: dt.datetime, p: RiskParams = RiskParams()) -> DataFrame:
    """Rows ingested lately; none gives a warning, which stops nothing."""
    recent = raw.where(F.col("ingested_at") >= _since(now, p)).agg(F.count("*").alias("recent_records"))
    count = F.col("recent_records")
    return recent.select(
        as_ntz(now).alias("checked_at"),
        count,
        F.when(count == 0, "WARNING").otherwise("OK").alias("status"),
        F.when(count == 0, f"no transactions in last {p.monitor_minutes} min, ingestion may be down")
        .otherwise(F.concat(F.format_number(count, 0), F.lit(f" transactions received in last {p.monitor_minutes} min")))
        .alias("message"),
    )


def high_risk_count(scored: DataFrame, now: dt.datetime, p: RiskParams = RiskParams()) -> DataFrame:
    recent = (F.col("risk_level") == "HIGH") & (F.col("scored_at") >= _since(now, p))
    return scored.where(recent).agg(F.count("*").alias("high_risk_count"))


def alert_route(scored: DataFrame, now: dt.datetime, p: RiskParams = RiskParams()) -> DataFrame:
    """Count of HIGH rows scored lately, the route they take and the text to send."""
    n = F.col("high_risk_count")
    minutes = F.lit(p.monitor_minutes)
    return high_risk_count(scored, now, p).select(
        as_ntz(now).alias("checked_at"),
        n,
        F.when(n > p.urgent_alert_above, "urgent").when(n > 0, "standard").otherwise("none").alias("route"),
        F.when(n > p.urgent_alert_above, F.format_string(URGENT_TEXT, n, minutes))
        .when(n > 0, F.format_string(STANDARD_TEXT, n, minutes))
        .alias("alert_text"),
    )
