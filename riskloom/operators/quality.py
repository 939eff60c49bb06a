"""Declared data-quality checks, one report row per check."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # unique | not_null | accepted_range | accepted_values
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = ()

    def fails(self) -> Column:
        """True on a failing row; a NULL value passes all but not_null."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "accepted_range":
            return ~value.between(self.low, self.high)
        if self.kind == "accepted_values":
            return ~value.isin(*self.values)
        raise ValueError(f"{self.kind} is not a row check")


def unique(column: str) -> Check:
    return Check(column, "unique")


def not_null(column: str) -> Check:
    return Check(column, "not_null")


def accepted_range(column: str, low: float, high: float) -> Check:
    return Check(column, "accepted_range", low=low, high=high)


def accepted_values(column: str, *values: str) -> Check:
    return Check(column, "accepted_values", values=values)


# The checks declared for the four tables.
CHECKS = {
    "raw_transactions": (
        unique("transaction_id"),
        not_null("transaction_id"),
        not_null("customer_id"),
        not_null("amount"),
        not_null("transaction_timestamp"),
    ),
    "stg_transactions": (
        unique("transaction_id"),
        not_null("transaction_id"),
        not_null("amount"),
        accepted_range("amount", 0, 1_000_000),
    ),
    "int_customer_baseline": (
        unique("customer_id"),
        not_null("customer_id"),
        not_null("avg_amount"),
    ),
    "mart_fraud_detection": (
        unique("transaction_id"),
        not_null("transaction_id"),
        not_null("total_score"),
        accepted_range("total_score", 0, 100),
        not_null("risk_level"),
        accepted_values("risk_level", "LOW", "MEDIUM", "HIGH"),
        not_null("recommended_action"),
        accepted_values("recommended_action", "APPROVE", "STEP_UP_AUTH", "BLOCK"),
    ),
}


def duplicated_keys(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with the number of their copies."""
    copies = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("copies"))
    return copies.where(F.col("copies") > 1)


def failing_rows(rows: DataFrame, check: Check) -> DataFrame:
    return rows.where(check.fails())


def table_report(name: str, rows: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """(table_name, column_name, check_name, failures) for one table.

    All row checks share a single pass and aggregate; each unique check adds one
    shuffle of its key.
    """
    checks = tuple(checks)
    by_row = [c for c in checks if c.kind != "unique"]
    parts = []
    if by_row:
        counts = rows.agg(*[F.count_if(c.fails()).alias(f"_{i}") for i, c in enumerate(by_row)])
        lines = [_line(name, c, F.col(f"_{i}")) for i, c in enumerate(by_row)]
        parts.append(counts.select(F.inline(F.array(*lines))))
    for c in checks:
        if c.kind == "unique":
            found = duplicated_keys(rows, c.column).agg(F.count("*").alias("_n"))
            parts.append(found.select(F.inline(F.array(_line(name, c, F.col("_n"))))))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _line(name: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(name).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def quality_report(tables: dict[str, DataFrame], checks: dict[str, tuple[Check, ...]] = CHECKS) -> DataFrame:
    report = None
    for name, rows in tables.items():
        part = table_report(name, rows, checks[name])
        report = part if report is None else report.unionByName(part)
    return report
