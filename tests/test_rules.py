from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.functions.clock import epoch_micros, minutes_between
from riskloom.functions.geo import haversine_km
from riskloom.params import RiskParams
from riskloom.schemas import BASELINE_COLUMNS, MART_COLUMNS, MART_SCHEMA
from riskloom.operators.profile import customer_baseline
from riskloom.operators.scoring import score_transactions
from tests.helpers import START, heats, random_rows, table, txn

P = RiskParams()


def one(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_amount_score(spark):
    rows = [
        (30.0, 10.0, 10.0, 99.0),  # z = 2 exactly: no points
        (30.01, 10.0, 10.0, 99.0),
        (40.0, 10.0, 10.0, 99.0),  # z = 3 exactly
        (40.01, 10.0, 10.0, 99.0),
        (21.0, 20.0, 0.0, 20.0),  # constant history: the quantile decides
        (20.0, 20.0, 0.0, 20.0),
        (21.0, 20.0, None, 20.0),  # a single transaction has no deviation
        (21.0, None, None, None),  # no profile
    ]
    z = rules.amount_zscore(F.col("a"), F.col("m"), F.col("s"))
    score = rules.amount_score(F.col("a"), z, F.col("s"), F.col("p"), P)
    assert one(spark, "a double, m double, s double, p double", rows, score) == [0, 20, 20, 30, 15, 0, 15, 0]
    assert one(spark, "a double, m double, s double, p double", rows, z)[4:] == [0.0] * 4


def test_velocity_score(spark):
    rows = [(b, h) for h in (None, 2, 3, 4, 9) for b in (3, 4, 5, 10)]
    got = one(spark, "b long, h long", rows, rules.velocity_score(F.col("b"), F.col("h"), P))
    assert got == [0, 25, 25, 25] * 3 + [0, 15, 25, 25] + [0, 15, 15, 25]


def test_geo_score_and_speed(spark):
    rows = [
        (None, None, "US", None),  # first transaction
        (5000.0, 0, "US", "GB"),  # same minute: no speed, fast border crossing
        (100.0, 59, "US", "GB"),
        (100.0, 60, "US", "GB"),
        (800.0, 60, "US", "US"),  # exactly the limit
        (800.01, 60, "US", "US"),
        (None, 10, None, "US"),  # unknown place
        (None, 10, "US", "GB"),
        (0.0, 10, "US", "US"),
    ]
    schema = "km double, minutes long, c string, pc string"
    speed = rules.speed_kmh(F.col("km"), F.col("minutes"))
    score = rules.geo_score(speed, F.col("minutes"), F.col("c"), F.col("pc"), P)
    assert one(spark, schema, rows, score) == [0, 20, 20, 10, 0, 30, 0, 20, 0]
    shown = one(spark, schema, rows, rules.travel_speed(speed))
    assert shown[:2] == [0.0, 0.0] and shown[4] == 800.0 and shown[6:] == [0.0, 0.0, 0.0]


def test_device_score(spark):
    rows = [("a", "a", 1), ("b", "a", 2), ("b", "a", 3), (None, "a", 1), ("b", None, None)]
    column = rules.device_score(F.col("d"), F.col("p"), F.col("n"), P)
    assert one(spark, "d string, p string, n long", rows, column) == [0, 10, 5, 0, 0]


def test_temporal_score(spark):
    hours = [(dt.datetime(2024, 1, 1, h, 59), r) for h, r in [(0, 0.0), (5, 0.049), (6, 0.0), (5, 0.05), (5, None)]]
    column = rules.temporal_score(F.col("t"), F.col("r"), P)
    assert one(spark, "t timestamp_ntz, r double", hours, column) == [5, 5, 0, 0, 0]


def test_levels(spark):
    rows = [(39,), (40,), (59,), (60,)]
    assert one(spark, "n int", rows, rules.risk_level(F.col("n"), P)) == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]
    want = ["APPROVE", "STEP_UP_AUTH", "STEP_UP_AUTH", "BLOCK"]
    assert one(spark, "n int", rows, rules.recommended_action(F.col("n"), P)) == want


def test_distance(spark):
    rows = [
        (0.0, 0.0, 0.0, 180.0),
        (10.0, 20.0, -10.0, -160.0),
        (52.52, 13.405, 52.52, 13.405),
        (None, 0.0, 0.0, 0.0),
        (51.5074, -0.1278, 40.7128, -74.0060),
    ]
    column = haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    got = one(spark, "a double, b double, c double, d double", rows, column)
    assert got[:3] == [pytest.approx(20015.087, abs=1e-3), pytest.approx(20015.087, abs=1e-3), 0.0]
    assert got[3] is None and got[4] == pytest.approx(5570.2, abs=0.1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minutes_are_boundaries_and_ignore_the_zone(spark, zone):
    t = dt.datetime
    rows = [
        (t(2024, 1, 1, 0, 0, 59), t(2024, 1, 1, 0, 1, 1)),
        (t(2024, 1, 1), t(2024, 1, 1, 0, 0, 59)),
        (t(2024, 3, 10, 1, 30), t(2024, 3, 10, 3, 30)),  # a clock change in New York
        (t(1969, 12, 31, 23, 59, 59), t(1970, 1, 1)),
        (None, t(2024, 1, 1)),
    ]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        schema = "a timestamp_ntz, b timestamp_ntz"
        assert one(spark, schema, rows, minutes_between(F.col("a"), F.col("b"))) == [1, 0, 120, 1, None]
        assert one(spark, schema, rows, epoch_micros(F.col("a")))[3] == -1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scored(spark, rows, heat_of=lambda t: None, **kw):
    txns = table(spark, rows)
    as_of = dt.date(2024, 1, 20)
    heat = heat_of(txns)
    base = customer_baseline(txns, as_of, START, heat=heat)
    return score_transactions(txns, base, START, heat=heat, **kw)


def test_routes_score_alike(spark):
    rows = random_rows(5, 400)
    want = None
    for label in ("plain", "some hot", "all hot"):
        got = scored(spark, rows, lambda t: heats(t)[label])
        assert tuple(got.columns) == MART_COLUMNS
        assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in MART_SCHEMA}
        result = {}
        for r in got.collect():
            result[r["transaction_id"]] = tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        assert len(result) == len(rows)
        want = want or result
        assert result == want, label


def test_scores_do_not_depend_on_order_or_strangers_or_whole_days(spark):
    rows = random_rows(6, 200)
    scores = ("amount_score", "velocity_score", "geo_score", "device_score", "temporal_score", "total_score")

    def points(rows):
        return {r["transaction_id"]: tuple(r[c] for c in scores) for r in scored(spark, rows).collect()}

    want = points(rows)
    assert points(list(reversed(rows))) == want
    strangers = [{**r, "transaction_id": "X" + r["transaction_id"], "customer_id": "X"} for r in rows]
    assert {k: v for k, v in points(rows + strangers).items() if not k.startswith("X")} == want
    day = dt.timedelta(days=2)
    moved = [
        r if r["transaction_timestamp"] is None else {**r, "transaction_timestamp": r["transaction_timestamp"] + day, "transaction_date": r["transaction_date"] + day}
        for r in rows
    ]
    assert points(moved) == want


def test_customer_without_profile(spark):
    late = dt.datetime(2024, 1, 21)  # after the profile's last day
    rows = [txn(f"T{i}", "NEW", late + dt.timedelta(seconds=i), amount="1000.00") for i in range(6)]
    got = {r["transaction_id"]: r for r in scored(spark, rows).collect()}
    assert [got[f"T{i}"]["velocity_score"] for i in range(6)] == [0, 0, 0, 0, 25, 25]
    assert all(r["amount_score"] == r["device_score"] == r["temporal_score"] == 0 for r in got.values())
    assert got["T0"]["distance_km"] is None and got["T0"]["travel_speed_kmh"] == 0.0
    assert len(BASELINE_COLUMNS) == 25 and len(MART_COLUMNS) == 30
