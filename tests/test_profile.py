from __future__ import annotations

import datetime as dt
import statistics

import pytest

from riskloom.operators.profile import customer_baseline, geography_profile, spending_profile
from riskloom.operators.states import QUANTILES
from riskloom.operators.staging import active_customers, lookback
from riskloom.schemas import BASELINE_COLUMNS
from tests.helpers import START, brute_bursts, heats, mode, quantile, random_rows, table, txn

AS_OF = dt.date(2024, 1, 20)
RUN = dt.datetime(2024, 1, 20, 1)


def expected(rows):
    first, groups = AS_OF - dt.timedelta(days=90), {}
    seen = [r for r in rows if r["transaction_date"] is not None and first <= r["transaction_date"] < AS_OF]
    for r in seen:
        groups.setdefault(r["customer_id"], []).append(r)
    bursts = {w: brute_bursts(seen, w) for w in (300, 900, 3600)}
    out = {}
    for customer, g in groups.items():
        amounts = [float(r["amount"]) for r in g if r["amount"] is not None]
        countries = [r["country"] for r in g]
        home = mode(countries)
        hours = [r["transaction_timestamp"].hour for r in g]
        devices = [r["device_id"] for r in g]
        e = {
            "avg_amount": statistics.fmean(amounts) if amounts else None,
            "stddev_amount": statistics.stdev(amounts) if len(amounts) > 1 else None,
            **{name: quantile(amounts, q) for name, q in QUANTILES.items()},
            "txn_count_90d": len(g),
            "total_spend_90d": sum(r["amount"] for r in g if r["amount"] is not None) if amounts else None,
            "avg_daily_txns": len(g) / 90,
            "last_txn_date": max(r["transaction_date"] for r in g),
        }
        rest = {
            "home_country": home,
            "home_city": mode([r["city"] for r in g]),
            "countries_visited": len(set(countries) - {None}),
            "cross_border_rate": sum(c is not None and c != home for c in countries) / len(g),
            "typical_hour": mode(hours),
            "late_night_rate": sum(h <= 5 for h in hours) / len(g),
            "historical_max_5min": max(bursts[300][r["transaction_id"]] for r in g),
            "historical_max_15min": max(bursts[900][r["transaction_id"]] for r in g),
            "historical_max_1hr": max(bursts[3600][r["transaction_id"]] for r in g),
            "device_count_90d": len(set(devices) - {None}),
            "primary_device": mode(devices),
        }
        # parts are joined on the customer, and a missing one matches nothing
        e.update(rest if customer is not None else dict.fromkeys(rest))
        out[customer] = e
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_every_route_matches_brute_force(spark, seed):
    rows = random_rows(seed) + [txn("ONE", "C9"), txn("NOAMOUNT", "C8", amount=None, country=None, device=None)]
    txns, want = table(spark, rows), expected(rows)
    for label, heat in heats(txns).items():
        if label in ("tiny chunks",):
            continue
        profile = customer_baseline(txns, AS_OF, RUN, heat=heat)
        assert tuple(profile.columns) == BASELINE_COLUMNS
        got = {r["customer_id"]: r.asDict() for r in profile.collect()}
        assert got.keys() == want.keys(), label
        for customer, e in want.items():
            for name, value in e.items():
                have = got[customer][name]
                if isinstance(value, float):
                    assert have == pytest.approx(value, rel=1e-12, abs=1e-12), (label, customer, name)
                else:
                    assert have == value, (label, customer, name)
            assert got[customer]["baseline_date"] == AS_OF and got[customer]["computed_at"] == RUN


def test_look_back_is_half_open(spark):
    days = [-91, -90, -1, 0, 1]
    midnight = dt.datetime.combine(AS_OF, dt.time())
    txns = table(spark, [txn(str(d), at=midnight + dt.timedelta(days=d)) for d in days])
    assert {r["transaction_id"] for r in lookback(txns, AS_OF, 90).collect()} == {"-90", "-1"}


def test_quantiles_of_negative_zero_and_large_amounts(spark):
    amounts = ["-5.00", "-5.00", "0.00", "0.01", "0.02", "999999.99", "1000000.00", "9999999999999999.99"]
    txns = table(spark, [txn(str(i), amount=a) for i, a in enumerate(amounts)])
    for label, heat in heats(txns).items():
        got = spending_profile(txns, heat=heat).first()
        for name, q in QUANTILES.items():
            assert got[name] == pytest.approx(quantile([float(a) for a in amounts], q)), (label, name)


def test_ties_go_to_the_lowest_value(spark):
    txns = table(spark, [txn("1", country="US"), txn("2", country="GB"), txn("3", country=None), txn("4", country=None)])
    for heat in heats(txns).values():
        got = geography_profile(txns, heat=heat).first()
        assert (got["home_country"], got["countries_visited"], got["cross_border_rate"]) == ("GB", 2, 0.25)


def test_active_customers(spark):
    txns = table(spark, [txn("1", "C1"), txn("2", "C1"), txn("3", "C2", at=START - dt.timedelta(days=1))])
    assert [r[0] for r in active_customers(txns, START.date()).collect()] == ["C1"]
    assert active_customers(txns, None).count() == 2
