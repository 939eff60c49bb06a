"""Small staged tables and plain-Python answers to compare with."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal

from pyspark.sql import types as T

from riskloom.operators.heat import Heat, measure_heat
from riskloom.params import HotKeyPolicy

STAGED = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("actual_fraud_flag", T.BooleanType()),
        T.StructField("actual_fraud_type", T.StringType()),
        T.StructField("_ingested_at", T.TimestampNTZType()),
    ]
)

START = dt.datetime(2024, 1, 10)


def txn(tid, customer="C1", at=START, amount="10.00", country="US", city="NYC", lat=40.0, lon=-74.0, device="d1", **more):
    row = {
        "transaction_id": tid,
        "customer_id": customer,
        "amount": None if amount is None else Decimal(amount),
        "currency": "USD",
        "merchant_name": "m",
        "merchant_category": "c",
        "transaction_timestamp": at,
        "transaction_date": None if at is None else at.date(),
        "country": country,
        "city": city,
        "latitude": lat,
        "longitude": lon,
        "device_id": device,
        "actual_fraud_flag": False,
        "actual_fraud_type": None,
        "_ingested_at": at,
    }
    row.update(more)
    return row


def table(spark, rows):
    return spark.createDataFrame([[r[f] for f in STAGED.fieldNames()] for r in rows], STAGED)


def random_rows(seed: int, n: int = 300) -> list[dict]:
    """Few customers (one missing, one owning most rows), bursts, ties, gaps, NULLs."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        customer = rnd.choice(["C1"] * 6 + ["C2", "C3", None])
        step = rnd.choice([0, 1, 59, 60, 300, 301, 899, 900, 3600, 3601, 86_400])
        at = START + dt.timedelta(seconds=step * rnd.randrange(4), microseconds=rnd.choice([0, 0, 1, 999_999]))
        if rnd.random() < 0.03:
            at = None
        somewhere = rnd.random() > 0.1
        country = rnd.choice(["US", "GB", "JP"]) if somewhere else None
        rows.append(
            txn(
                f"T{i:05d}",
                customer,
                at,
                None if rnd.random() < 0.03 else f"{rnd.choice([1, 20, 300])}.{rnd.randrange(100):02d}",
                country,
                rnd.choice(["a", "b", None]),
                rnd.uniform(-90, 90) if somewhere else None,
                rnd.uniform(-180, 180) if somewhere else None,
                rnd.choice(["d1", "d2", "d3", None]),
            )
        )
    rnd.shuffle(rows)
    return rows


def heats(rows) -> dict[str, Heat]:
    """No hot customer, some, and all, with chunks of several sizes."""
    return {
        "plain": measure_heat(rows),
        "some hot": measure_heat(rows, HotKeyPolicy(min_rows=60, max_keys=1_000_000)),
        "all hot": measure_heat(rows, HotKeyPolicy(min_rows=1, max_keys=1_000_000)),
        "small chunks": measure_heat(rows, HotKeyPolicy(min_rows=1, max_keys=1_000_000, chunk_rows=200)),
        "tiny chunks": measure_heat(rows, HotKeyPolicy(min_rows=1, max_keys=0, chunk_rows=40)),
    }


def _by_customer(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["customer_id"], []).append(r)
    return groups


def brute_bursts(rows, seconds):
    out = {}
    for group in _by_customer(rows).values():
        for r in group:
            t = r["transaction_timestamp"]
            if t is None:
                n = sum(o["transaction_timestamp"] is None for o in group)
            else:
                first = t - dt.timedelta(seconds=seconds)
                n = sum(o["transaction_timestamp"] is not None and first <= o["transaction_timestamp"] <= t for o in group)
            out[r["transaction_id"]] = n - 1
    return out


def brute_previous(rows):
    out = {}
    for group in _by_customer(rows).values():
        last = dt.datetime.max
        ordered = sorted(group, key=lambda r: (r["transaction_timestamp"] or last, r["transaction_id"]))
        for before, r in zip([None, *ordered], ordered):
            out[r["transaction_id"]] = before and (
                before["latitude"],
                before["longitude"],
                before["country"],
                before["transaction_timestamp"],
            )
    return out


def quantile(values, q):
    values = sorted(values)
    if not values:
        return None
    pos = q * (len(values) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return values[lo] + (values[hi] - values[lo]) * (pos - lo)


def mode(values):
    values = [v for v in values if v is not None]
    return min(set(values), key=lambda v: (-values.count(v), v)) if values else None
