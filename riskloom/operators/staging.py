"""Cleaned view of the raw table, and the row selections built on it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_transactions(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Cast, trim and rename raw transactions; rows without an id are dropped.

    ``strict`` keeps the ANSI behaviour: an unreadable timestamp ends the job.
    Otherwise it becomes NULL, to be caught by the quality checks. If the raw
    table carries its ``event_date`` layout column, that is the transaction date
    and day filters reach the files.
    """

    def cast(name: str, kind: str):
        return F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)

    laid_out = "event_date" in raw.columns
    day = F.col("event_date") if laid_out else cast("transaction_timestamp", "date")
    return raw.where(F.col("transaction_id").isNotNull()).select(
        "transaction_id",
        "customer_id",
        cast("amount", "decimal(18,2)").alias("amount"),
        F.upper(F.trim("currency")).alias("currency"),
        F.trim("merchant_name").alias("merchant_name"),
        F.lower(F.trim("merchant_category")).alias("merchant_category"),
        cast("transaction_timestamp", "timestamp_ntz").alias("transaction_timestamp"),
        day.alias("transaction_date"),
        F.upper(F.trim("country")).alias("country"),
        F.trim("city").alias("city"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "device_id",
        F.col("is_fraud").alias("actual_fraud_flag"),
        F.col("fraud_type").alias("actual_fraud_type"),
        F.col("ingested_at").alias("_ingested_at"),
    )


def quarantine(raw: DataFrame) -> DataFrame:
    """Raw rows that staging would drop or could not read, with the reason."""
    ts = F.col("transaction_timestamp")
    unreadable = ts.isNotNull() & ts.try_cast("timestamp_ntz").isNull()
    amount = F.col("amount")
    # NaN, or too large for the declared digits
    no_amount = amount.isNotNull() & amount.try_cast("decimal(18,2)").isNull()
    reason = F.when(F.col("transaction_id").isNull(), "no_id").when(unreadable, "unreadable_time").when(no_amount, "unreadable_amount")
    return raw.withColumn("reason", reason).where(F.col("reason").isNotNull())


def quarantine_report(raw: DataFrame) -> DataFrame:
    """Rows held back, by reason."""
    return quarantine(raw).groupBy("reason").agg(F.count("*").alias("rows"))


def lookback(txns: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Rows dated in ``[as_of - days, as_of)``; the running day is incomplete."""
    first = as_of - dt.timedelta(days=days)
    day = F.col("transaction_date")
    return txns.where((day >= F.lit(first)) & (day < F.lit(as_of)))


def active_customers(txns: DataFrame, since: dt.date | None) -> DataFrame:
    """Customers with a transaction dated ``since`` or later (None: everyone)."""
    recent = txns if since is None else txns.where(F.col("transaction_date") >= F.lit(since))
    return recent.select("customer_id").distinct()


def newer_than(txns: DataFrame, high_water: dt.datetime | None) -> DataFrame:
    """Rows after the high-water mark (None: an empty target, so all rows)."""
    if high_water is None:
        return txns
    return txns.where(F.col("transaction_timestamp") > F.lit(str(high_water)).cast("timestamp_ntz"))
