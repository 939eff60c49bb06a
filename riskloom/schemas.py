"""Declared schemas and column orders of the five tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the message payload.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("transaction_timestamp", T.StringType(), False),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("fraud_type", T.StringType()),
    ]
)

# Stored fields are all nullable: decoding does not enforce the above.
RAW_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType) for f in MESSAGE_SCHEMA]
    + [
        T.StructField("kafka_timestamp", T.TimestampNTZType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
    ]
)

# Output columns of the profile and of the scored table, in order.
BASELINE_COLUMNS = (
    "customer_id",
    "avg_amount",
    "stddev_amount",
    "median_amount",
    "p25_amount",
    "p75_amount",
    "p95_amount",
    "p99_amount",
    "txn_count_90d",
    "total_spend_90d",
    "avg_daily_txns",
    "last_txn_date",
    "home_country",
    "home_city",
    "countries_visited",
    "cross_border_rate",
    "typical_hour",
    "late_night_rate",
    "historical_max_5min",
    "historical_max_15min",
    "historical_max_1hr",
    "device_count_90d",
    "primary_device",
    "baseline_date",
    "computed_at",
)

MART_COLUMNS = (
    "transaction_id",
    "customer_id",
    "transaction_date",
    "transaction_timestamp",
    "amount",
    "currency",
    "merchant_name",
    "merchant_category",
    "country",
    "city",
    "device_id",
    "amount_score",
    "velocity_score",
    "geo_score",
    "device_score",
    "temporal_score",
    "total_score",
    "risk_level",
    "recommended_action",
    "amount_zscore",
    "baseline_avg",
    "baseline_std",
    "distance_km",
    "travel_speed_kmh",
    "prev_country",
    "current_burst_5min",
    "historical_max_5min",
    "actual_fraud_flag",
    "actual_fraud_type",
    "scored_at",
)

_MART_TYPES = {
    "transaction_date": T.DateType(),
    "transaction_timestamp": T.TimestampNTZType(),
    "amount": T.DecimalType(18, 2),
    "amount_score": T.IntegerType(),
    "velocity_score": T.IntegerType(),
    "geo_score": T.IntegerType(),
    "device_score": T.IntegerType(),
    "temporal_score": T.IntegerType(),
    "total_score": T.IntegerType(),
    "amount_zscore": T.DoubleType(),
    "baseline_avg": T.DoubleType(),
    "baseline_std": T.DoubleType(),
    "distance_km": T.DoubleType(),
    "travel_speed_kmh": T.DoubleType(),
    "current_burst_5min": T.LongType(),
    "historical_max_5min": T.LongType(),
    "actual_fraud_flag": T.BooleanType(),
    "scored_at": T.TimestampNTZType(),
}

MART_SCHEMA = T.StructType([T.StructField(c, _MART_TYPES.get(c, T.StringType())) for c in MART_COLUMNS])
