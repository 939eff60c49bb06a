"""The same results in DuckDB SQL, written per rule rather than per plan."""

from __future__ import annotations

from checks.fixture import raw_sql
from riskloom.schemas import MESSAGE_SCHEMA

# spelled out here too, so that a column in the wrong place shows
BASELINE_COLUMNS = (
    "customer_id avg_amount stddev_amount median_amount p25_amount p75_amount p95_amount p99_amount txn_count_90d "
    "total_spend_90d avg_daily_txns last_txn_date home_country home_city countries_visited cross_border_rate typical_hour "
    "late_night_rate historical_max_5min historical_max_15min historical_max_1hr device_count_90d primary_device "
    "baseline_date computed_at"
).split()
MART_COLUMNS = (
    "transaction_id customer_id transaction_date transaction_timestamp amount currency merchant_name merchant_category "
    "country city device_id amount_score velocity_score geo_score device_score temporal_score total_score risk_level "
    "recommended_action amount_zscore baseline_avg baseline_std distance_km travel_speed_kmh prev_country "
    "current_burst_5min historical_max_5min actual_fraud_flag actual_fraud_type scored_at"
).split()

D1, D2 = "date '2024-01-25'", "date '2024-01-28'"
T1, T2 = "timestamp '2024-01-25 00:00:00'", "timestamp '2024-01-28 00:00:00'"

_ROUND9 = (
    "avg_amount", "stddev_amount", "median_amount", "p25_amount", "p75_amount", "p95_amount", "p99_amount", "avg_daily_txns",
    "cross_border_rate", "late_night_rate", "amount_zscore", "baseline_avg", "baseline_std",
)
_ROUND6 = ("distance_km", "travel_speed_kmh")


def _cols(names, alias: str = "") -> str:
    out = []
    for n in names:
        if n in _ROUND9 or n in _ROUND6:
            out.append(f"round({alias}{n}, {6 if n in _ROUND6 else 9}) as {n}")
        else:
            out.append(f"{alias}{n}")
    return ", ".join(out)


def _with(*ctes: str, select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


RAW = f"raw as ({raw_sql('duckdb')})"


def _arrivals(**moved: int) -> str:
    return f"arrivals as ({raw_sql('duckdb', **moved)})"


REDELIVERED = """redelivered as (
  select raw.* from raw, generate_series(1, case when event_id % 62 = 0 then 3 when event_id % 31 = 0 then 2 else 1 end) g)"""


def stg(name: str = "stg", source: str = "raw") -> str:
    return f"""{name} as (
  select transaction_id, customer_id, cast(amount as decimal(18, 2)) as amount,
    upper(trim(currency)) as currency, trim(merchant_name) as merchant_name,
    lower(trim(merchant_category)) as merchant_category,
    cast(transaction_timestamp as timestamp) as transaction_timestamp,
    cast(cast(transaction_timestamp as timestamp) as date) as transaction_date,
    upper(trim(country)) as country, trim(city) as city, latitude, longitude, device_id,
    is_fraud as actual_fraud_flag, fraud_type as actual_fraud_type, ingested_at as _ingested_at
  from {source} where transaction_id is not null)"""


def win(as_of: str, name: str = "win", source: str = "stg", days: int = 90) -> str:
    return f"""{name} as (
  select * from {source} where transaction_date >= {as_of} - {days} and transaction_date < {as_of})"""


def _mode(name: str, source: str, value: str, label: str) -> str:
    return f"""{name} as (
  select customer_id, v as {label} from (
    select customer_id, {value} as v, row_number() over (partition by customer_id order by count(*) desc, {value}) as place
    from {source} where {value} is not null group by customer_id, {value}) where place = 1)"""


def profile(prefix: str, source: str, as_of: str, run_ts: str) -> str:
    p = prefix
    q = ", ".join(
        f"quantile_cont(cast(amount as double), {f}) as {n}"
        for n, f in {"median_amount": 0.5, "p25_amount": 0.25, "p75_amount": 0.75, "p95_amount": 0.95, "p99_amount": 0.99}.items()
    )
    trailing = ", ".join(
        f"count(*) over (partition by customer_id order by transaction_timestamp range between interval '{m} minutes' preceding and current row) - 1 as b{m}"
        for m in (5, 15, 60)
    )
    return ",\n".join(
        [
            f"""{p}_spending as (
  select customer_id, avg(cast(amount as double)) as avg_amount, stddev_samp(cast(amount as double)) as stddev_amount, {q},
    count(*) as txn_count_90d, cast(sum(amount) as decimal(28, 2)) as total_spend_90d,
    count(*) / cast(90 as double) as avg_daily_txns, max(transaction_date) as last_txn_date
  from {source} group by customer_id)""",
            _mode(f"{p}_hc", source, "country", "home_country"),
            _mode(f"{p}_ht", source, "city", "home_city"),
            _mode(f"{p}_hh", source, "cast(hour(transaction_timestamp) as integer)", "typical_hour"),
            _mode(f"{p}_hd", source, "device_id", "primary_device"),
            f"""{p}_rates as (
  select t.customer_id, count(distinct country) as countries_visited, count(distinct device_id) as device_count_90d,
    avg(case when country <> home_country then cast(1 as double) else cast(0 as double) end) as cross_border_rate,
    avg(case when hour(transaction_timestamp) <= 5 then cast(1 as double) else cast(0 as double) end) as late_night_rate
  from {source} t left join {p}_hc using (customer_id) group by t.customer_id)""",
            f"""{p}_velocity as (
  select customer_id, max(b5) as historical_max_5min, max(b15) as historical_max_15min, max(b60) as historical_max_1hr
  from (select customer_id, {trailing} from {source}) group by customer_id)""",
            f"""{p} as (
  select {", ".join(BASELINE_COLUMNS[:-2])}, {as_of} as baseline_date, {run_ts} as computed_at
  from {p}_spending left join {p}_hc using (customer_id) left join {p}_ht using (customer_id)
    left join {p}_hh using (customer_id) left join {p}_hd using (customer_id)
    left join {p}_rates using (customer_id) left join {p}_velocity using (customer_id))""",
        ]
    )


def scored(prefix: str, source: str, baseline: str, run_ts: str) -> str:
    p = prefix
    before = "over (partition by customer_id order by transaction_timestamp, transaction_id)"
    h = (
        "pow(sin(radians((latitude - prev_lat) / 2)), 2) + cos(radians(prev_lat)) * cos(radians(latitude))"
        " * pow(sin(radians((longitude - prev_lon) / 2)), 2)"
    )
    return ",\n".join(
        [
            f"""{p}_hist as (
  select *, lag(latitude) {before} as prev_lat, lag(longitude) {before} as prev_lon,
    lag(country) {before} as prev_country, lag(transaction_timestamp) {before} as prev_ts,
    count(*) over (partition by customer_id order by transaction_timestamp
      range between interval '5 minutes' preceding and current row) - 1 as current_burst_5min
  from {source})""",
            f"""{p}_move as (
  select *, date_diff('minute', prev_ts, transaction_timestamp) as minutes_elapsed,
    date_diff('minute', prev_ts, transaction_timestamp) / cast(60 as double) as hours_elapsed,
    cast(12742 as double) * asin(sqrt(case when {h} > 1 then 1 else {h} end)) as distance_km
  from {p}_hist)""",
            f"""{p}_all as (
  select t.*, b.* exclude (customer_id), b.avg_amount as baseline_avg, b.stddev_amount as baseline_std,
    distance_km / nullif(hours_elapsed, 0) as speed,
    case when b.stddev_amount > 0 then (cast(amount as double) - b.avg_amount) / b.stddev_amount else cast(0 as double) end as amount_zscore
  from {p}_move t left join {baseline} b on t.customer_id = b.customer_id)""",
            f"""{p}_points as (
  select *, coalesce(case when speed > 0 then speed end, cast(0 as double)) as travel_speed_kmh,
    cast(case when baseline_std > 0 and amount_zscore > 3 then 30 when baseline_std > 0 and amount_zscore > 2 then 20
      when cast(amount as double) > p99_amount then 15 else 0 end as integer) as amount_score,
    cast(case when current_burst_5min <= 3 then 0 when current_burst_5min > coalesce(historical_max_5min, 0) then 25
      else 15 end as integer) as velocity_score,
    cast(case when speed > 800 then 30 when country <> prev_country and minutes_elapsed < 60 then 20
      when country <> prev_country then 10 else 0 end as integer) as geo_score,
    cast(case when device_id <> primary_device then case when device_count_90d < 3 then 10 else 5 end else 0 end as integer) as device_score,
    cast(case when hour(transaction_timestamp) <= 5 and late_night_rate < 0.05 then 5 else 0 end as integer) as temporal_score
  from {p}_all)""",
            f"""{p}_total as (
  select *, cast(amount_score + velocity_score + geo_score + device_score + temporal_score as integer) as total_score
  from {p}_points)""",
            f"""{p} as (
  select *, case when total_score >= 60 then 'HIGH' when total_score >= 40 then 'MEDIUM' else 'LOW' end as risk_level,
    case when total_score >= 60 then 'BLOCK' when total_score >= 40 then 'STEP_UP_AUTH' else 'APPROVE' end as recommended_action,
    {run_ts} as scored_at
  from {p}_total)""",
        ]
    )


BASE = (RAW, stg(), win(D1))
PROFILED = (*BASE, profile("base", "win", D1, T1))
SCORED = (*PROFILED, scored("mart", "stg", "base", T1))

TWO_RUNS = (
    stg(source="arrivals"),
    f"stg1 as (select * from stg where _ingested_at < {T1})",
    win(D1, "win1", "stg1"),
    profile("base1", "win1", D1, T1),
    win(D2, "win2_all", "stg"),
    f"win2 as (select * from win2_all where customer_id in (select customer_id from stg where transaction_date >= {D1}))",
    profile("base2", "win2", D2, T2),
    """base as (
  select * from base2
  union all select * from base1 where customer_id not in (select customer_id from base2))""",
)
SILENT = _arrivals(silent_days=25)
TWO_BASELINES = (SILENT, *TWO_RUNS)
MARTS = (
    *TWO_RUNS,
    scored("mart1", "stg1", "base1", T1),
    scored("mart2", "stg", "base", T2),
    f"""mart as (
  select {", ".join(MART_COLUMNS)} from mart1
  union all select {", ".join(MART_COLUMNS)} from mart2 where transaction_id not in (select transaction_id from mart1))""",
)
TWO_MARTS = (SILENT, *MARTS)

_FIELDS = MESSAGE_SCHEMA.fieldNames()


def _checks(raw: str, staged: str, base: str, mart: str) -> list[tuple[str, str, str, str]]:
    """(table, column, check, DuckDB expression counting the failures)."""

    def null(t, source, c):
        return (t, c, "not_null", f"(select count(*) from {source} where {c} is null)")

    def twice(t, source, c):
        return (t, c, "unique", f"(select count(*) from (select {c} from {source} where {c} is not null group by 1 having count(*) > 1))")

    def rows(t, source, c, kind, bad):
        return (t, c, kind, f"(select count(*) from {source} where {bad})")

    r, s, b, m = "raw_transactions", "stg_transactions", "int_customer_baseline", "mart_fraud_detection"
    return [
        twice(r, raw, "transaction_id"),
        *[null(r, raw, c) for c in ("transaction_id", "customer_id", "amount", "transaction_timestamp")],
        twice(s, staged, "transaction_id"),
        *[null(s, staged, c) for c in ("transaction_id", "amount")],
        rows(s, staged, "amount", "accepted_range", "amount < 0 or amount > 1000000"),
        twice(b, base, "customer_id"),
        *[null(b, base, c) for c in ("customer_id", "avg_amount")],
        twice(m, mart, "transaction_id"),
        *[null(m, mart, c) for c in ("transaction_id", "total_score", "risk_level", "recommended_action")],
        rows(m, mart, "total_score", "accepted_range", "total_score < 0 or total_score > 100"),
        rows(m, mart, "risk_level", "accepted_values", "risk_level not in ('LOW', 'MEDIUM', 'HIGH')"),
        rows(m, mart, "recommended_action", "accepted_values", "recommended_action not in ('APPROVE', 'STEP_UP_AUTH', 'BLOCK')"),
    ]


def _report(kinds: tuple[str, ...] = ()) -> str:
    lines = [
        f"select '{t}' as table_name, '{c}' as column_name, '{k}' as check_name, {n} as failures"
        for t, c, k, n in _checks("redelivered", "stg", "base", "mart")
        if not kinds or k in kinds
    ]
    return "\nunion all ".join(lines)


REDELIVERED_TABLES = (
    RAW,
    REDELIVERED,
    stg(source="redelivered"),
    win(D1),
    profile("base", "win", D1, T1),
    scored("mart", "stg", "base", T1),
)


def _freshness() -> str:
    one = """select timestamp '{now}' as checked_at, n as recent_records,
  case when n = 0 then 'WARNING' else 'OK' end as status,
  case when n = 0 then 'no transactions in last 5 min, ingestion may be down'
    else format('{{:,}}', n) || ' transactions received in last 5 min' end as message
from (select count(*) as n from raw where ingested_at >= timestamp '{now}' - interval '5 minutes')"""
    return "\nunion all ".join(one.format(now=t) for t in ("2024-01-25 00:00:00", "2024-01-27 12:00:00", "2024-02-01 00:00:00"))


def _alerts() -> str:
    one = """select {now} as checked_at, n as high_risk_count,
  case when n > {bar} then 'urgent' when n > 0 then 'standard' else 'none' end as route,
  case when n > {bar} then ':rotating_light: *URGENT* — ' || n || ' HIGH risk transactions in last 5 min. Immediate review needed.'
    when n > 0 then ':warning: ' || n || ' HIGH risk transactions flagged in last 5 min.' end as alert_text
from (select count(*) as n from mart where risk_level = 'HIGH' and scored_at >= {now} - interval '5 minutes')"""
    at = [("timestamp '2024-01-25 00:00:00'", 100), ("timestamp '2024-01-25 01:00:00'", 100), ("timestamp '2024-01-25 00:05:00'", 2)]
    return "\nunion all ".join(one.format(now=now, bar=bar) for now, bar in at)


def _cycles() -> str:
    parts = []
    for as_of, landed, staged, base, mart, now in (
        (D1, f"(select * from arrivals where ingested_at < {T1})", "stg1", "base1", "mart1", T1),
        (D2, "arrivals", "stg", "base", "mart", T2),
    ):
        for t, c, k, n in _checks(landed, staged, base, mart):
            parts.append(f"select '{t}.{c}.{k}' as item, {n} as value, {as_of} as as_of")
        parts.append(
            f"select 'recent_records', (select count(*) from {landed} where ingested_at >= {now} - interval '5 minutes'), {as_of}"
        )
        # rows without id fail a check in both runs, so no alert is routed
    return "\nunion all ".join(parts)


def _metrics() -> str:
    parts = []
    for rule, flagged in (("not_low", "risk_level <> 'LOW'"), ("any_score", "total_score > 0")):
        for scope, label in (("true", "'all'"), ("actual_fraud_flag", "actual_fraud_type")):
            parts.append(
                f"""select {label} as fraud_type, count(*) filter (actual_fraud_flag) as frauds,
  count(*) filter (actual_fraud_flag and {flagged}) as frauds_flagged,
  count(*) filter (not actual_fraud_flag) as legitimate,
  count(*) filter (not actual_fraud_flag and {flagged}) as legitimate_flagged, '{rule}' as positive_rule
from mart where {scope} group by {"actual_fraud_type" if label != "'all'" else "()"}"""
            )
    return f"""select *, round(frauds_flagged / cast(nullif(frauds, 0) as double), 9) as true_positive_rate,
  round(legitimate_flagged / cast(nullif(legitimate, 0) as double), 9) as false_positive_rate
from ({" union all ".join(parts)})"""


_SPENDING_COLUMNS = (*BASELINE_COLUMNS[:12],)
_ENRICHED = (
    "transaction_id, t.customer_id, amount, round(avg_amount, 9) as baseline_avg, round(stddev_amount, 9) as baseline_std, "
    "round(p99_amount, 9) as p99_amount, historical_max_5min, device_count_90d, primary_device, "
    "round(late_night_rate, 9) as late_night_rate, typical_hour from stg t left join base b on t.customer_id = b.customer_id"
)


def _decoded(null_payload: str, null_amount: str) -> str:
    def field(f: str) -> str:
        lost = f"{null_payload} or {null_amount}" if f == "amount" else null_payload
        return f"case when {lost} then null else {f} end as {f}"

    return ", ".join(field(f) for f in _FIELDS)


_LOST = "event_id % 89 = 0 or (event_id % 73 = 0 and event_id % 83 <> 0 and event_id % 79 <> 0)"
_NO_AMOUNT = "event_id % 83 = 0"

_BURSTS = _with(
    RAW,
    stg(),
    select="select transaction_id, customer_id, transaction_timestamp, "
    + ", ".join(
        f"count(*) over (partition by customer_id order by transaction_timestamp range between interval '{m} minutes' preceding and current row) - 1 as {n}"
        for m, n in ((5, "burst_5min"), (15, "burst_15min"), (60, "burst_1hr"))
    )
    + " from stg",
)

ORACLES: dict[str, str] = {
    "stg_transactions": _with(RAW, stg(), select="select * from stg"),
    "json_decode": _with(RAW, select=f"select {_decoded(_LOST, _NO_AMOUNT)}, kafka_timestamp from raw"),
    "json_encode_roundtrip": _with(
        RAW,
        select=f"select customer_id as message_key, fraud_type is null as explicit_null, {', '.join(_FIELDS)} from raw",
    ),
    "stream_ingest": _with(
        RAW,
        select=f"""select {_decoded(_LOST, _NO_AMOUNT)}, kafka_timestamp,
  case when {_LOST} then null else cast(cast(transaction_timestamp as timestamp) as date) end as event_date from raw""",
    ),
    "baseline_window_filter": _with(
        RAW, stg(), win(D1, days=13), select="select transaction_id, customer_id, transaction_date from win"
    ),
    "active_customers": _with(RAW, stg(), select=f"select distinct customer_id from stg where transaction_date >= {D1}"),
    "new_transactions": _with(
        RAW,
        stg(),
        f"done as (select * from stg where _ingested_at < {T1})",
        select="""select transaction_id, customer_id, transaction_timestamp, transaction_date, 'missing' as mode
from stg where transaction_id not in (select transaction_id from done)
union all select transaction_id, customer_id, transaction_timestamp, transaction_date, 'high_water'
from stg where transaction_timestamp > (select max(transaction_timestamp) from done)""",
    ),
    "spending_profile": _with(*PROFILED, select=f"select {_cols(_SPENDING_COLUMNS)} from base"),
    "geography_profile": _with(*PROFILED, select=f"select customer_id, {_cols(BASELINE_COLUMNS[12:16])} from base"),
    "cross_border_rate": _with(*PROFILED, select=f"select {_cols(('customer_id', 'home_country', 'cross_border_rate'))} from base"),
    "timing_profile": _with(*PROFILED, select=f"select customer_id, {_cols(BASELINE_COLUMNS[16:18])} from base"),
    "velocity_profile": _with(*PROFILED, select=f"select customer_id, {_cols(BASELINE_COLUMNS[18:21])} from base"),
    "device_profile": _with(*PROFILED, select=f"select customer_id, {_cols(BASELINE_COLUMNS[21:23])} from base"),
    "customer_baseline": _with(*PROFILED, select=f"select {_cols(BASELINE_COLUMNS)} from base"),
    "enrich_with_baseline": _with(*PROFILED, select=f"select {_ENRICHED}"),
    "burst_counts": _BURSTS,
    "previous_transaction": _with(
        *SCORED, select="select transaction_id, customer_id, prev_lat, prev_lon, prev_country, prev_ts from mart"
    ),
    "amount_zscore": _with(
        *SCORED, select=f"select {_cols(('transaction_id', 'amount', 'baseline_avg', 'baseline_std', 'amount_zscore'))} from mart"
    ),
    "amount_score": _with(*SCORED, select="select transaction_id, amount_score from mart"),
    "velocity_score": _with(
        *SCORED, select="select transaction_id, current_burst_5min, historical_max_5min, velocity_score from mart"
    ),
    "haversine_distance": _with(*SCORED, select=f"select {_cols(('transaction_id', 'distance_km'))} from mart"),
    "elapsed_hours": _with(*SCORED, select="select transaction_id, prev_ts, round(hours_elapsed, 9) as hours_elapsed from mart"),
    "geo_score": _with(*SCORED, select="select transaction_id, country, prev_country, geo_score from mart"),
    "travel_speed": _with(*SCORED, select=f"select {_cols(('transaction_id', 'travel_speed_kmh'))} from mart"),
    "device_score": _with(
        *SCORED, select="select transaction_id, device_id, primary_device, device_count_90d, device_score from mart"
    ),
    "temporal_score": _with(
        *SCORED,
        select=f"select {_cols(('transaction_id', 'transaction_timestamp', 'late_night_rate', 'temporal_score'))} from mart",
    ),
    "mart_fraud_detection": _with(*SCORED, select=f"select {_cols(MART_COLUMNS)} from mart"),
    "risk_level_summary": _with(
        *SCORED,
        select="""select risk_level, recommended_action, count(*) as transactions,
  cast(sum(total_score) as bigint) as score_points, max(total_score) as highest_score
from mart group by risk_level, recommended_action""",
    ),
    "baseline_incremental": _with(*TWO_BASELINES, select=f"select {_cols(BASELINE_COLUMNS)} from base"),
    "mart_incremental": _with(*TWO_MARTS, select=f"select {_cols(MART_COLUMNS)} from mart"),
    "late_beyond_lookback": _with(_arrivals(silent_days=150), *MARTS, select=f"select {_cols(MART_COLUMNS)} from mart"),
    "mart_incremental_gap": _with(_arrivals(gap_days=150), *MARTS, select=f"select {_cols(MART_COLUMNS)} from mart"),
    "quarantine_report": _with(
        RAW,
        select="""select case when transaction_id is null then 'no_id' else 'unreadable_time' end as reason, count(*) as rows
from raw where transaction_id is null or event_id % 71 = 0 group by 1""",
    ),
    "customer_baseline_hot": _with(*PROFILED, select=f"select {_cols(BASELINE_COLUMNS)} from base"),
    "baseline_from_states": _with(*PROFILED, select=f"select {_cols(BASELINE_COLUMNS)} from base"),
    "baseline_from_states_hot": _with(*PROFILED, select=f"select {_cols(BASELINE_COLUMNS)} from base"),
    "burst_counts_hot": _BURSTS,
    "mart_hot": _with(*SCORED, select=f"select {_cols(MART_COLUMNS)} from mart"),
    "schema_append": _with(
        RAW,
        stg(),
        win(D1, "win1"),
        profile("base1", "win1", D1, T1),
        win(D2, "win2_all"),
        f"win2 as (select * from win2_all where customer_id in (select customer_id from stg where transaction_date >= {D2}))",
        profile("base2", "win2", D2, T2),
        select=f"""select {_cols(_SPENDING_COLUMNS)}, round(cast(total_spend_90d as double) / txn_count_90d, 9) as spend_per_txn from base2
union all select {_cols(_SPENDING_COLUMNS)}, null from base1 where customer_id not in (select customer_id from base2)""",
    ),
    "dq_unique": _with(
        RAW,
        REDELIVERED,
        select="""select transaction_id, count(*) as copies from redelivered
where transaction_id is not null group by 1 having count(*) > 1""",
    ),
    "dq_not_null": _with(*REDELIVERED_TABLES, select=_report(("not_null",))),
    "dq_accepted_range": _with(
        *REDELIVERED_TABLES,
        select="\nunion all ".join(
            f"""select '{t}' as table_name, '{c}' as column_name, 'accepted_range' as check_name,
  (select count(*) from {source} where {c} < {low} or {c} > {high}) as failures, '{label}' as bounds"""
            for t, source, c, low, high, label in (
                ("stg_transactions", "stg", "amount", 0, 1000000, "declared"),
                ("stg_transactions", "stg", "amount", 5, 500, "narrow"),
                ("mart_fraud_detection", "mart", "total_score", 0, 100, "declared"),
                ("mart_fraud_detection", "mart", "total_score", 0, 30, "narrow"),
            )
        ),
    ),
    "dq_accepted_values": _with(
        *SCORED,
        select="""select transaction_id, risk_level, recommended_action from mart
where risk_level not in ('LOW', 'HIGH') or recommended_action not in ('APPROVE', 'STEP_UP_AUTH')""",
    ),
    "dq_report": _with(*REDELIVERED_TABLES, select=_report()),
    "freshness_check": _with(RAW, select=_freshness()),
    "alert_route": _with(*SCORED, select=_alerts()),
    "run_cycle": _with(*TWO_MARTS, select=_cycles()),
    "stream_score": _with(*SCORED, select=f"select {_cols(MART_COLUMNS)} from mart"),
    "detection_metrics": _with(*SCORED, select=_metrics()),
}
