"""Registered queries: every operator on transactions derived from the events.

Averages and ratios are rounded to 9 digits and results of trigonometry to 6, so
that engines which add in another order compare equal.
"""

from __future__ import annotations

import datetime as dt
import tempfile
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixture import AS_OF, RUN_TS, SECOND_AS_OF, SECOND_RUN_TS, raw_transactions, raw_with_origin
from riskloom.operators import evaluation, history, monitoring, profile, quality, scoring, staging
from riskloom.operators.heat import Heat, measure_heat
from riskloom.operators.states import daily_states
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.plans.cycle import Store, run_cycle
from riskloom.plans.refresh import new_states, refresh_baseline, refresh_scores, unscored
from riskloom.session import scratch, work_folder, written
from riskloom.sources import messages, tables
from riskloom.sources.batches import Span
from riskloom.streaming.ingest import DRAIN, ingest_stream
from riskloom.streaming.score import score_stream

P = RiskParams()
_TRIGONOMETRIC = ("distance_km", "travel_speed_kmh")


def _rounded(rows: DataFrame) -> DataFrame:
    doubles = [f.name for f in rows.schema if isinstance(f.dataType, T.DoubleType)]
    return rows.withColumns({c: F.round(c, 6 if c in _TRIGONOMETRIC else 9) for c in doubles})


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_transactions(raw_transactions(spark, sf_dir))


def _window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.lookback(_staged(spark, sf_dir), AS_OF, P.baseline_lookback_days)


def _profiled(txns: DataFrame) -> tuple[DataFrame, Heat]:
    heat = measure_heat(txns)
    return profile.customer_baseline(txns, AS_OF, RUN_TS, heat=heat), heat


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = _staged(spark, sf_dir)
    baseline, heat = _profiled(txns)
    return scoring.score_transactions(txns, baseline, RUN_TS, heat=heat)


# -- staging and selection ---------------------------------------------------


def stg_transactions(spark, sf_dir):
    return _staged(spark, sf_dir)


def baseline_window_filter(spark, sf_dir):
    # thirteen days, so that both ends of the window cut rows off
    rows = staging.lookback(_staged(spark, sf_dir), AS_OF, 13)
    return rows.select("transaction_id", "customer_id", "transaction_date")


def active_customers(spark, sf_dir):
    return staging.active_customers(_staged(spark, sf_dir), AS_OF)


def _first_run(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("ingested_at") < F.lit("2024-01-25").cast("timestamp_ntz"))


def new_transactions(spark, sf_dir):
    """Both selection modes against the rows of a first run."""
    raw = raw_transactions(spark, sf_dir)
    txns, scored = staging.stage_transactions(raw), staging.stage_transactions(_first_run(raw))
    modes = [
        unscored(txns, scored, mode).withColumn("mode", F.lit(mode)) for mode in ("missing", "high_water")
    ]
    return modes[0].unionByName(modes[1])


# -- messages ----------------------------------------------------------------


def _sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the raw rows; some are cut off or carry a wrong type."""
    raw = raw_with_origin(spark, sf_dir)
    value = F.to_json(F.struct(*messages.MESSAGE_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    broken = (
        F.when(F.col("event_id") % 89 == 0, F.substring(value, 1, 40))
        .when(F.col("event_id") % 83 == 0, F.regexp_replace(value, r'"amount":[^,]*,', '"amount":"x",'))
        .when(F.col("event_id") % 79 == 0, F.regexp_replace(value, r"^\{", '{"unknown_field":[1,2],'))
        .when(F.col("event_id") % 73 == 0, F.lit("{}"))
        .otherwise(value)
    )
    return raw.select(
        F.col("customer_id").alias("key"), broken.alias("value"), F.col("kafka_timestamp").cast("timestamp").alias("timestamp")
    )


def json_decode(spark, sf_dir):
    return messages.decode_messages(_sent(spark, sf_dir)).drop("ingested_at")


def json_encode_roundtrip(spark, sf_dir):
    sent = messages.encode_messages(raw_transactions(spark, sf_dir))
    keyed = sent.select("key", "value", "timestamp")
    decoded = F.from_json("value", messages.MESSAGE_SCHEMA)
    return keyed.select(
        F.col("key").alias("message_key"),
        # a missing type must be sent as an explicit null
        F.col("value").contains('"fraud_type":null').alias("explicit_null"),
        decoded.alias("d"),
    ).select("message_key", "explicit_null", "d.*")


def stream_ingest(spark, sf_dir):
    folder = work_folder(spark, "ingest")
    _sent(spark, sf_dir).repartition(4).write.parquet(f"{folder}/messages")
    source = messages.message_files(spark, f"{folder}/messages", files_per_batch=2)
    ingest_stream(source, f"{folder}/raw", f"{folder}/checkpoint", DRAIN).awaitTermination()
    return tables.read_raw(spark, f"{folder}/raw").drop("ingested_at", "ingest_batch")


# -- profile -----------------------------------------------------------------


def spending_profile(spark, sf_dir):
    return _rounded(profile.spending_profile(_window(spark, sf_dir)))


def geography_profile(spark, sf_dir):
    return _rounded(profile.geography_profile(_window(spark, sf_dir)))


def cross_border_rate(spark, sf_dir):
    return _rounded(profile.cross_border_rate(_window(spark, sf_dir)))


def timing_profile(spark, sf_dir):
    return _rounded(profile.timing_profile(_window(spark, sf_dir)))


def velocity_profile(spark, sf_dir):
    return profile.velocity_profile(_window(spark, sf_dir))


def device_profile(spark, sf_dir):
    return profile.device_profile(_window(spark, sf_dir))


def customer_baseline(spark, sf_dir):
    return _rounded(_profiled(_staged(spark, sf_dir))[0])


# -- behaviour and scores ----------------------------------------------------


def burst_counts(spark, sf_dir):
    rows = history.burst_counts(_staged(spark, sf_dir))
    return rows.select("transaction_id", "customer_id", "transaction_timestamp", *history.PROFILE_BURSTS)


def previous_transaction(spark, sf_dir):
    rows = history.previous_transaction(_staged(spark, sf_dir))
    return rows.select("transaction_id", "customer_id", "prev_lat", "prev_lon", "prev_country", "prev_ts")


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = _staged(spark, sf_dir)
    baseline, heat = _profiled(txns)
    return scoring.enrich_with_baseline(txns, baseline, heat)


def enrich_with_baseline(spark, sf_dir):
    columns = ("transaction_id", "customer_id", "amount", *scoring.PROFILE_COLUMNS.values())
    return _rounded(_enriched(spark, sf_dir).select(*columns))


def amount_zscore(spark, sf_dir):
    rows = scoring.add_amount_score(_enriched(spark, sf_dir))
    return _rounded(rows.select("transaction_id", "amount", "baseline_avg", "baseline_std", "amount_zscore"))


def amount_score(spark, sf_dir):
    rows = scoring.add_amount_score(_enriched(spark, sf_dir))
    return rows.select("transaction_id", "amount_score")


def velocity_score(spark, sf_dir):
    txns = _staged(spark, sf_dir)
    baseline, heat = _profiled(txns)
    rows = history.burst_counts(txns, history.SCORE_BURSTS, heat)
    rows = scoring.add_velocity_score(scoring.enrich_with_baseline(rows, baseline, heat))
    return rows.select("transaction_id", "current_burst_5min", "historical_max_5min", "velocity_score")


def _travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.add_travel(history.previous_transaction(_staged(spark, sf_dir)))


def haversine_distance(spark, sf_dir):
    return _rounded(_travel(spark, sf_dir).select("transaction_id", "distance_km"))


def elapsed_hours(spark, sf_dir):
    return _rounded(_travel(spark, sf_dir).select("transaction_id", "prev_ts", "hours_elapsed"))


def geo_score(spark, sf_dir):
    rows = scoring.add_geo_score(_travel(spark, sf_dir))
    return rows.select("transaction_id", "country", "prev_country", "geo_score")


def travel_speed(spark, sf_dir):
    return _rounded(_travel(spark, sf_dir).select("transaction_id", "travel_speed_kmh"))


def device_score(spark, sf_dir):
    rows = scoring.add_device_score(_enriched(spark, sf_dir))
    return rows.select("transaction_id", "device_id", "primary_device", "device_count_90d", "device_score")


def temporal_score(spark, sf_dir):
    rows = scoring.add_temporal_score(_enriched(spark, sf_dir))
    return _rounded(rows.select("transaction_id", "transaction_timestamp", "late_night_rate", "temporal_score"))


def mart_fraud_detection(spark, sf_dir):
    return _rounded(_scored(spark, sf_dir))


def risk_level_summary(spark, sf_dir):
    return scoring.risk_level_summary(_scored(spark, sf_dir))


# -- stored tables, two runs -------------------------------------------------


SILENT = {"silent_days": 25}  # some customers fall silent after the first run


def _land_in_two(spark: SparkSession, sf_dir: str, name: str, moved: dict[str, int] = SILENT) -> tuple[Store, DataFrame]:
    store = Store(spark, work_folder(spark, name))
    raw = raw_with_origin(spark, sf_dir, **moved).drop("event_id", "user_id", "event_ts")
    tables.land_batch(_first_run(raw), store.raw_path, 0)
    rest = raw.where(F.col("ingested_at") >= F.lit("2024-01-25").cast("timestamp_ntz"))
    return store, rest


def _states(store: Store, batch: str) -> tuple[DataFrame, DataFrame]:
    """All rows and all daily states, after those of a landed batch are written."""
    txns = staging.stage_transactions(store.raw())
    with scratch(store.spark) as keep:
        arrived = staging.stage_transactions(store.raw([batch]))
        store.states.write(new_states(arrived, txns, P, HotKeyPolicy(), keep), Span.of_batch(batch))
    return txns, store.states.read()


def _two_baselines(store: Store, rest: DataFrame, between: Callable = lambda txns, states, baseline: None) -> tuple:
    """Profiles merge from the daily states that each batch adds."""
    txns, states = _states(store, "batch-0")
    between(txns, states, refresh_baseline(states, store.baseline, AS_OF, RUN_TS))
    tables.land_batch(rest, store.raw_path, 1)
    txns, states = _states(store, "batch-1")
    return txns, states, refresh_baseline(states, store.baseline, SECOND_AS_OF, SECOND_RUN_TS)


def baseline_incremental(spark, sf_dir):
    store, rest = _land_in_two(spark, sf_dir, "baseline")
    return _rounded(_two_baselines(store, rest)[2])


def _two_marts(spark: SparkSession, sf_dir: str, moved: dict[str, int]) -> DataFrame:
    store, rest = _land_in_two(spark, sf_dir, "mart", moved)

    def score_first(txns, states, baseline):
        refresh_scores(txns, states, baseline, store.mart, AS_OF, RUN_TS)

    txns, states, baseline = _two_baselines(store, rest, score_first)
    arrived = staging.stage_transactions(store.raw(["batch-1"]))
    refresh_scores(txns, states, baseline, store.mart, SECOND_AS_OF, SECOND_RUN_TS, arrived=arrived)
    return _rounded(store.mart.read())


def mart_incremental(spark, sf_dir):
    return _two_marts(spark, sf_dir, SILENT)


def late_beyond_lookback(spark, sf_dir):
    """Rows that are older than the look-back when they arrive are scored too."""
    return _two_marts(spark, sf_dir, {"silent_days": 150})


def mart_incremental_gap(spark, sf_dir):
    """The row before a new one may be older than the look-back."""
    return _two_marts(spark, sf_dir, {"gap_days": 150})


def quarantine_report(spark, sf_dir):
    """What a run with unreadable times sets aside, by reason."""
    rows = raw_with_origin(spark, sf_dir)
    time = F.when(F.col("event_id") % 71 == 0, "soon").otherwise(F.col("transaction_timestamp"))
    store = Store(spark, work_folder(spark, "quarantine"))
    tables.land_batch(rows.withColumn("transaction_timestamp", time), store.raw_path, 0)
    run_cycle(store, AS_OF, RUN_TS)
    return spark.read.parquet(store.quarantine_path).groupBy("reason").agg(F.count("*").alias("rows"))


# -- hot customers: a low limit sends most rows over the second route ----------

FEW = HotKeyPolicy(min_rows=60)


def customer_baseline_hot(spark, sf_dir):
    txns = _staged(spark, sf_dir)
    return _rounded(profile.customer_baseline(txns, AS_OF, RUN_TS, heat=measure_heat(txns, FEW)))


def baseline_from_states(spark, sf_dir):
    """The profile of all rows, merged from their daily states."""
    states = written(daily_states(_staged(spark, sf_dir)), "states")
    return _rounded(profile.baseline_from_states(states, AS_OF, RUN_TS))


def baseline_from_states_hot(spark, sf_dir):
    txns = _staged(spark, sf_dir)
    heat = measure_heat(txns, FEW)
    states = written(daily_states(txns, heat=heat), "states")
    return _rounded(profile.baseline_from_states(states, AS_OF, RUN_TS, heat=heat))


def burst_counts_hot(spark, sf_dir):
    txns = _staged(spark, sf_dir)
    rows = history.burst_counts(txns, heat=measure_heat(txns, FEW))
    return rows.select("transaction_id", "customer_id", "transaction_timestamp", *history.PROFILE_BURSTS)


def mart_hot(spark, sf_dir):
    txns = _staged(spark, sf_dir)
    heat = measure_heat(txns, FEW)
    baseline = written(profile.customer_baseline(txns, AS_OF, RUN_TS, heat=heat), "baseline")
    return _rounded(scoring.score_transactions(txns, baseline, RUN_TS, heat=heat))


def schema_append(spark, sf_dir):
    """Profiles of a second run bring a new column; old rows get NULL in it."""
    txns = _staged(spark, sf_dir)
    old = profile.spending_profile(staging.lookback(txns, AS_OF, P.baseline_lookback_days))
    active = staging.active_customers(txns, SECOND_AS_OF)
    later = staging.lookback(txns, SECOND_AS_OF, P.baseline_lookback_days).join(active, "customer_id", "left_semi")
    new = profile.spending_profile(later).withColumn("spend_per_txn", F.col("total_spend_90d").cast("double") / F.col("txn_count_90d"))
    table = tables.VersionedTable(spark, work_folder(spark, "schema"))
    table.replace(old)
    return _rounded(table.upsert(new, "customer_id", on_change="append_new_columns"))


# -- quality -----------------------------------------------------------------


def _redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as an at-least-once broker delivers them: some twice or thrice."""
    rows = raw_with_origin(spark, sf_dir)
    copies = F.when(F.col("event_id") % 62 == 0, 3).when(F.col("event_id") % 31 == 0, 2).otherwise(1)
    repeated = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.drop("_copy", "event_id", "user_id", "event_ts")


def dq_unique(spark, sf_dir):
    return quality.duplicated_keys(_redelivered(spark, sf_dir), "transaction_id")


def _four_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = _redelivered(spark, sf_dir)
    txns = staging.stage_transactions(raw)
    baseline, heat = _profiled(txns)
    baseline = written(baseline, "baseline")
    scored = written(scoring.score_transactions(txns, baseline, RUN_TS, heat=heat), "mart")
    return {
        "raw_transactions": raw,
        "stg_transactions": txns,
        "int_customer_baseline": baseline,
        "mart_fraud_detection": scored,
    }


def dq_not_null(spark, sf_dir):
    wanted = {t: tuple(c for c in cs if c.kind == "not_null") for t, cs in quality.CHECKS.items()}
    return quality.quality_report(_four_tables(spark, sf_dir), wanted)


def dq_accepted_range(spark, sf_dir):
    """The two declared ranges find nothing here; two narrower ones do."""
    found = _four_tables(spark, sf_dir)
    narrow = {"stg_transactions": quality.accepted_range("amount", 5, 500), "mart_fraud_detection": quality.accepted_range("total_score", 0, 30)}
    declared = {t: tuple(c for c in quality.CHECKS[t] if c.kind == "accepted_range") for t in narrow}
    parts = [
        quality.table_report(t, found[t], checks).withColumn("bounds", F.lit(label))
        for t in narrow
        for label, checks in (("declared", declared[t]), ("narrow", (narrow[t],)))
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def dq_accepted_values(spark, sf_dir):
    """Rows whose level or action is outside a list that lacks one value each."""
    rows = _scored(spark, sf_dir)
    level = quality.accepted_values("risk_level", "LOW", "HIGH")
    action = quality.accepted_values("recommended_action", "APPROVE", "STEP_UP_AUTH")
    return rows.where(level.fails() | action.fails()).select("transaction_id", "risk_level", "recommended_action")


def dq_report(spark, sf_dir):
    return quality.quality_report(_four_tables(spark, sf_dir))


# -- monitoring --------------------------------------------------------------


def freshness_check(spark, sf_dir):
    raw = raw_transactions(spark, sf_dir)
    at = [dt.datetime(2024, 1, 25), dt.datetime(2024, 1, 27, 12), dt.datetime(2024, 2, 1)]
    checks = [monitoring.freshness_check(raw, now) for now in at]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


def alert_route(spark, sf_dir):
    """The usual rules now and an hour later, and a lower bar for urgent alerts."""
    scored = written(_scored(spark, sf_dir).select("risk_level", "scored_at"), "levels")
    eager = replace(P, urgent_alert_above=2)
    routes = [
        monitoring.alert_route(scored, RUN_TS, P),
        monitoring.alert_route(scored, RUN_TS + dt.timedelta(hours=1), P),
        monitoring.alert_route(scored, RUN_TS + dt.timedelta(minutes=5), eager),
    ]
    return routes[0].unionByName(routes[1]).unionByName(routes[2])


def _cycle_rows(store: Store, as_of: dt.date, now: dt.datetime) -> DataFrame:
    report = run_cycle(store, as_of, now)
    lines = report.quality.select(
        F.concat_ws(".", "table_name", "column_name", "check_name").alias("item"), F.col("failures").alias("value")
    )
    fresh = report.freshness.select(F.lit("recent_records").alias("item"), F.col("recent_records").alias("value"))
    lines = lines.unionByName(fresh)
    if report.alert is not None:
        high = report.alert.select(F.lit("high_risk_count").alias("item"), F.col("high_risk_count").alias("value"))
        lines = lines.unionByName(high)
    return lines.withColumn("as_of", F.lit(as_of))


def run_two_cycles(spark, sf_dir):
    # rows without id fail a check, which holds the alerts back
    store, rest = _land_in_two(spark, sf_dir, "cycle")
    first = written(_cycle_rows(store, AS_OF, RUN_TS), "cycle")
    tables.land_batch(rest, store.raw_path, 1)
    return first.unionByName(_cycle_rows(store, SECOND_AS_OF, SECOND_RUN_TS))


def stream_score(spark, sf_dir):
    """History is landed and profiled; later rows stream in by time of arrival."""
    store = Store(spark, work_folder(spark, "stream"))
    raw = raw_transactions(spark, sf_dir)
    is_history = F.col("transaction_timestamp") < "2024-01-25"
    tables.land_batch(raw.where(is_history), store.raw_path, 0)
    later = messages.encode_messages(raw.where(~is_history))
    inbox = f"{store.root}/inbox"
    noon = F.lit("2024-01-27 12:00:00").cast("timestamp")
    for slot in (F.col("timestamp") < noon, F.col("timestamp") >= noon):
        later.where(slot).write.mode("append").parquet(inbox)
        source = messages.message_files(spark, inbox)
        # the checkpoint knows what the query before has read
        score_stream(
            source, store, f"{store.root}/checkpoint", lambda: RUN_TS, trigger=DRAIN
        ).awaitTermination()
    return _rounded(store.mart.read())


def detection_metrics(spark, sf_dir):
    """Rates for two readings of "detected": not LOW, and any score at all."""
    rules = {"not_low": F.col("risk_level") != "LOW", "any_score": F.col("total_score") > 0}
    return _rounded(evaluation.detection_metrics(_scored(spark, sf_dir), rules))


def _with_work_folder(query: Callable) -> Callable:
    """Local sessions without a shared folder get one of this machine."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
        if unset and spark.sparkContext.master.startswith("local["):
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checks-"))
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_transactions": stg_transactions,
    "json_decode": json_decode,
    "json_encode_roundtrip": json_encode_roundtrip,
    "stream_ingest": stream_ingest,
    "baseline_window_filter": baseline_window_filter,
    "active_customers": active_customers,
    "new_transactions": new_transactions,
    "spending_profile": spending_profile,
    "geography_profile": geography_profile,
    "cross_border_rate": cross_border_rate,
    "timing_profile": timing_profile,
    "velocity_profile": velocity_profile,
    "device_profile": device_profile,
    "customer_baseline": customer_baseline,
    "enrich_with_baseline": enrich_with_baseline,
    "burst_counts": burst_counts,
    "previous_transaction": previous_transaction,
    "amount_zscore": amount_zscore,
    "amount_score": amount_score,
    "velocity_score": velocity_score,
    "haversine_distance": haversine_distance,
    "elapsed_hours": elapsed_hours,
    "geo_score": geo_score,
    "travel_speed": travel_speed,
    "device_score": device_score,
    "temporal_score": temporal_score,
    "mart_fraud_detection": mart_fraud_detection,
    "risk_level_summary": risk_level_summary,
    "baseline_incremental": baseline_incremental,
    "mart_incremental": mart_incremental,
    "late_beyond_lookback": late_beyond_lookback,
    "mart_incremental_gap": mart_incremental_gap,
    "quarantine_report": quarantine_report,
    "customer_baseline_hot": customer_baseline_hot,
    "baseline_from_states": baseline_from_states,
    "baseline_from_states_hot": baseline_from_states_hot,
    "burst_counts_hot": burst_counts_hot,
    "mart_hot": mart_hot,
    "schema_append": schema_append,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_accepted_range": dq_accepted_range,
    "dq_accepted_values": dq_accepted_values,
    "dq_report": dq_report,
    "freshness_check": freshness_check,
    "alert_route": alert_route,
    "run_cycle": run_two_cycles,
    "stream_score": stream_score,
    "detection_metrics": detection_metrics,
}
QUERIES = {name: _with_work_folder(query) for name, query in QUERIES.items()}
