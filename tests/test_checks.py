"""Quality checks, monitoring and evaluation."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import quality as q
from riskloom.operators.evaluation import detection_metrics
from riskloom.operators.monitoring import alert_route, freshness_check

NOW = dt.datetime(2024, 1, 2, 12)


def test_twenty_checks_are_declared():
    kinds = [c.kind for checks in q.CHECKS.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 4,
        "not_null": 12,
        "accepted_range": 2,
        "accepted_values": 2,
    }


def test_failures_are_counted(spark):
    rows = [("a", -0.01, "LOW"), ("a", 0.0, None), ("b", 1e6, "HIGH"), (None, 1_000_000.01, "ODD"), (None, None, "LOW")]
    df = spark.createDataFrame(rows, "k string, x double, level string")
    checks = (q.unique("k"), q.not_null("k"), q.not_null("x"), q.accepted_range("x", 0, 1_000_000), q.accepted_values("level", "LOW", "HIGH"))
    got = {(r["column_name"], r["check_name"]): r["failures"] for r in q.table_report("t", df, checks).collect()}
    assert got == {
        ("k", "unique"): 1,
        ("k", "not_null"): 2,
        ("x", "not_null"): 1,
        ("x", "accepted_range"): 2,
        ("level", "accepted_values"): 1,
    }
    assert [tuple(r) for r in q.duplicated_keys(df, "k").collect()] == [("a", 2)]
    assert [r["level"] for r in q.failing_rows(df, checks[4]).collect()] == ["ODD"]
    empty = q.table_report("t", df.limit(0), checks).collect()
    assert len(empty) == 5 and {r["failures"] for r in empty} == {0}


def test_freshness(spark):
    edge = NOW - dt.timedelta(minutes=5)
    df = spark.createDataFrame([(edge,), (edge - dt.timedelta(microseconds=1),)], "ingested_at timestamp_ntz")
    fresh = freshness_check(df, NOW).first()
    assert (fresh["recent_records"], fresh["status"]) == (1, "OK")
    stale = freshness_check(df, NOW + dt.timedelta(minutes=1)).first()
    assert (stale["recent_records"], stale["status"]) == (0, "WARNING")


@pytest.mark.parametrize("n, route", [(0, "none"), (1, "standard"), (100, "standard"), (101, "urgent")])
def test_alert_route(spark, n, route):
    edge = NOW - dt.timedelta(minutes=5)
    rows = [("HIGH", edge)] * n + [("HIGH", edge - dt.timedelta(seconds=1)), ("LOW", NOW)]
    got = alert_route(spark.createDataFrame(rows, "risk_level string, scored_at timestamp_ntz"), NOW).first()
    assert (got["high_risk_count"], got["route"]) == (n, route)
    assert (got["alert_text"] is None) == (n == 0) and (n == 0 or f" {n} HIGH risk" in got["alert_text"])


def test_detection_metrics(spark):
    rows = [(True, "geo", "HIGH", 70), (True, "geo", "LOW", 5), (True, None, "LOW", 0), (False, None, "MEDIUM", 40), (False, None, "LOW", 0), (None, None, "HIGH", 90)]
    df = spark.createDataFrame(rows, "actual_fraud_flag boolean, actual_fraud_type string, risk_level string, total_score int")
    rules = {"level": F.col("risk_level") != "LOW", "score": F.col("total_score") > 0}
    got = {(r["positive_rule"], r["fraud_type"]): (r["true_positive_rate"], r["false_positive_rate"]) for r in detection_metrics(df, rules).collect()}
    assert got == {
        ("level", "all"): (pytest.approx(1 / 3), 0.5),
        ("level", "geo"): (0.5, None),
        ("level", "none"): (0.0, 0.5),
        ("score", "all"): (pytest.approx(2 / 3), 0.5),
        ("score", "geo"): (1.0, None),
        ("score", "none"): (0.0, 0.5),
    }
