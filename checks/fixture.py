"""Transactions derived from the ``events`` table.

The given tables hold no transactions, so each event becomes one: users are
customers, values are amounts, and modulo rules on the ids plant bursts, trips,
unknown devices, missing fields and customers without history. The same SQL text
serves Spark and DuckDB; only the few entries of ``_DIALECT`` differ.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2024, 1, 25)
RUN_TS = dt.datetime(2024, 1, 25)
SECOND_AS_OF = dt.date(2024, 1, 28)
SECOND_RUN_TS = dt.datetime(2024, 1, 28)

_DIALECT = {
    "spark": {
        "micros": "timestampdiff(MICROSECOND, timestamp_ntz'{start}', ts)",
        "plus": "timestampadd(MICROSECOND, {n}, timestamp_ntz'{start}')",
        "div": "div",
        "ts": "timestamp_ntz",
        "text": "string",
        "seconds": "ts + interval '{n}' second",
        "hours": "ts + interval '{n}' hour",
    },
    "duckdb": {
        "micros": "date_diff('microsecond', timestamp'{start}', ts)",
        "plus": "timestamp'{start}' + to_microseconds({n})",
        "div": "//",
        "ts": "timestamp",
        "text": "varchar",
        "seconds": "ts + interval '{n}' second",
        "hours": "ts + interval '{n}' hour",
    },
}


def raw_sql(dialect: str, events: str = "events", silent_days: int = 0, gap_days: int = 0) -> str:
    """SELECT that turns events into raw transactions (16 columns, event_id, event time).

    ``silent_days`` moves some customers' last rows so far back: they arrive late,
    and these customers are not active in a second run. ``gap_days`` moves other
    customers' first rows back and leaves a gap before the last ones.
    """
    d = _DIALECT[dialect]
    text = d["text"]

    def squeezed(start: str, into: str) -> str:
        micros = d["micros"].format(start=start)
        return d["plus"].format(n=f"({micros} {d['div']} 864)", start=into)

    def by_country(values: list[str], tail: str = "") -> str:
        arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
        return f"case when event_id % 101 = 0 then null else case cc {arms} end{tail} end"

    jitter = " + cast(event_id % 100 - 50 as double) / cast(1000 as double)"
    lat = [f"cast({v} as double)" for v in ("40.7128", "51.5074", "35.6762", "-33.8688", "52.5200")]
    lon = [f"cast({v} as double)" for v in ("-74.0060", "-0.1278", "139.6503", "151.2093", "13.4050")]
    as_of = f"{d['ts']}'2024-01-25 00:00:00'"
    return f"""
select
  case when event_id % 997 = 0 then null
       else concat('T', lpad(cast(event_id as {text}), 10, '0')) end as transaction_id,
  concat('C', lpad(cast(user_id as {text}), 6, '0')) as customer_id,
  case when user_id % 50 = 11 and ts < {as_of} then cast(20.0 as double)
       when event_id % 37 = 0 then value * 8 else value end as amount,
  case when event_id % 5 = 0 then ' usd ' else 'USD' end as currency,
  concat(' ', event_type, '_', cast(event_id % 20 as {text}), ' ') as merchant_name,
  case when event_id % 2 = 0 then upper(event_type) else concat(event_type, ' ') end as merchant_category,
  cast(shifted_ts as {text}) as transaction_timestamp,
  {by_country(["'us '", "'GB'", "'JP'", "'AU'", "'DE'"])} as country,
  {by_country(["'New York '", "'London'", "'Tokyo'", "'Sydney'", "'Berlin'"])} as city,
  {by_country(lat, jitter)} as latitude,
  {by_country(lon, jitter)} as longitude,
  case when event_id % 103 = 0 then null
       when event_id % 43 = 0 then concat('dev_unknown_', cast(event_id as {text}))
       when user_id % 7 = 0 then concat('dev_u', cast(user_id as {text}), '_', cast(event_id % 4 as {text}))
       else concat('dev_', cast(user_id as {text})) end as device_id,
  (event_id % 37 = 0 or event_id % 41 = 0 or event_id % 43 = 0) as is_fraud,
  case when event_id % 37 = 0 then 'amount_anomaly'
       when event_id % 41 = 0 then 'geo_anomaly'
       when event_id % 43 = 0 then 'device_anomaly' end as fraud_type,
  {d["seconds"].format(n=1)} as kafka_timestamp,
  {d["seconds"].format(n=5)} as ingested_at,
  event_id, user_id, ts as event_ts
from (
  select event_id, ts, user_id, event_type, value,
    case when event_id % 41 = 0 then (user_id + 1) % 5 else user_id % 5 end as cc,
    case when user_id % 50 in (12, 13) and ts < {as_of} then {d["hours"].format(n=25 * 24)}
         when {silent_days} > 0 and user_id % 50 = 14 and ts >= {as_of} then {d["hours"].format(n=-24 * silent_days)}
         when {gap_days} > 0 and user_id % 50 = 16 and ts < {as_of} then {d["hours"].format(n=-24 * gap_days)}
         when user_id % 10 in (3, 4) and ts >= {as_of}
           then {squeezed("2024-01-25 00:00:00", "2024-01-27 12:00:00")}
         when user_id % 10 = 4 and ts >= {d["ts"]}'2024-01-08 00:00:00' and ts < {d["ts"]}'2024-01-14 00:00:00'
           then {squeezed("2024-01-08 00:00:00", "2024-01-10 12:00:00")}
         when user_id % 3 = 0 and hour(ts) < 6 and event_id % 47 <> 0
           then {d["hours"].format(n=8)}
         else ts end as shifted_ts
  from {events}
) e"""


def raw_with_origin(spark: SparkSession, sf_dir: str, **moved: int) -> DataFrame:
    """Raw transactions plus the event columns they came from."""
    return spark.sql(raw_sql("spark", "{events}", **moved), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_with_origin(spark, sf_dir).drop("event_id", "user_id", "event_ts")
