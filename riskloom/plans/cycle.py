"""One run over all steps, in order."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.monitoring import alert_route, freshness_check
from riskloom.operators.quality import quality_report
from riskloom.operators.staging import quarantine, stage_transactions
from riskloom.operators.states import STATE_SCHEMA, combined_states
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.plans.checklog import CheckLog, check_run
from riskloom.plans.refresh import new_states, refresh_baseline, refresh_scores
from riskloom.schemas import MART_SCHEMA
from riskloom.session import scratch
from riskloom.sources.batches import BatchedTable, Ledger, Span, without
from riskloom.sources.tables import DailyTable, VersionedTable, bloom_options, on_days, raw_table, read_raw


@dataclass(frozen=True)
class Store:
    """Where the tables of one deployment live."""

    spark: SparkSession
    root: str
    buckets: int = 64  # of the profile; stays the same for the life of a store

    @property
    def raw_path(self) -> str:
        return f"{self.root}/raw_transactions"

    def raw(self, batches: list[str] | None = None) -> DataFrame:
        return read_raw(self.spark, self.raw_path, batches)

    @property
    def states(self) -> BatchedTable:
        """Daily states of customers, in folders of the batches they come from."""
        return BatchedTable(
            self.spark,
            f"{self.root}/customer_states",
            STATE_SCHEMA,
            "transaction_date",
            combine=combined_states,
            sort_by=("part", "customer_id"),
            options=bloom_options("customer_id"),
        )

    @property
    def scored_batches(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/scored_batches")

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    def pending(self) -> list[Span]:
        """Landed batches that were not scored yet."""
        return without(raw_table(self.spark, self.raw_path).spans(), self.scored_batches.spans())

    @property
    def checks(self) -> CheckLog:
        return CheckLog(self.spark, f"{self.root}/checks")

    def merge(self, owner: str) -> None:
        """Merge small folders of batches that an owner has landed and that were scored."""
        raw_table(self.spark, self.raw_path).merge(owner)
        if not any(s.owner == owner for s in self.pending()):
            self.states.merge(owner)

    @property
    def baseline(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/int_customer_baseline", "customer_id", self.buckets)

    @property
    def mart(self) -> DailyTable:
        return DailyTable(
            self.spark,
            f"{self.root}/mart_fraud_detection",
            MART_SCHEMA,
            key="transaction_id",
            day="transaction_date",
            sort_by="risk_level",
        )


@dataclass(frozen=True)
class CycleReport:
    freshness: DataFrame
    quality: DataFrame
    alert: DataFrame | None
    quarantined: int = 0


def set_aside(store: Store, raw: DataFrame, batches: list[str]) -> int:
    """Write rows of the batches that staging cannot use beside the tables; their number."""
    held = quarantine(raw)
    n = held.count()
    if n:
        # again after a run that broke off: the same folder
        folder = hashlib.sha256("|".join(sorted(batches)).encode()).hexdigest()[:16]
        held.write.mode("overwrite").parquet(f"{store.quarantine_path}/part={folder}")
    return n


def refresh(
    store: Store,
    as_of: dt.date,
    now: dt.datetime,
    p: RiskParams,
    policy: HotKeyPolicy,
    strict: bool = False,
    checks: bool = False,
    **scoring,
) -> int:
    """Bring profile and scores up to the landed batches; number of rows set aside.

    The batches that are not in the ledger of scored ones drive the work. They enter
    it last, so a run that broke off is repeated. With ``checks`` what the run has read
    and written is checked and noted in the log.
    """
    spans, done = store.pending(), store.scored_batches.spans()
    batches = [name for s in spans for name in s.names()]
    arrived = store.raw(batches)
    held = 0 if strict else set_aside(store, arrived, batches)
    txns = stage_transactions(store.raw(), strict)
    for span in spans:
        # a span that was written before a run broke off is part of the one written now
        with scratch(store.spark) as keep:
            rows = stage_transactions(store.raw(span.names()), strict)
            store.states.write(new_states(rows, txns, p, policy, keep), span)
    states, new = store.states.read(), stage_transactions(arrived, strict)
    profiles = store.baseline.newest()
    baseline = refresh_baseline(states, store.baseline, as_of, now, p, policy, arrived=new)
    days = refresh_scores(txns, states, baseline, store.mart, as_of, now, p, policy, arrived=new, buckets=store.buckets, **scoring)
    if checks:
        changed = baseline if store.baseline.newest() != profiles else None
        days = days.unionByName(new.select("transaction_date").distinct())
        earlier = read_spans(store, done)
        check_run(store.checks, arrived, new, earlier, spans, changed, store.mart.read(), days.distinct(), now, done)
    store.scored_batches.add(batches)
    return held


def read_spans(store: Store, spans: list[Span]) -> DataFrame:
    return store.raw([name for s in spans for name in s.names()])


def run_cycle(
    store: Store,
    as_of: dt.date,
    now: dt.datetime,
    p: RiskParams = RiskParams(),
    policy: HotKeyPolicy = HotKeyPolicy(),
    strict: bool = False,
    full_checks: bool = False,
    **scoring,
) -> CycleReport:
    """Freshness, profile, scores, quality checks, alert route.

    A stale raw table is reported and stops nothing. Rows that cannot be read are
    set aside and counted; with ``strict`` they end the run. Failed quality checks
    hold the alert back: ``alert`` is None then. Checked is what the run has written,
    and added to the results for the rest; ``full_checks`` reads all tables instead.
    ``scoring`` goes to ``refresh_scores``.
    """
    since = now - dt.timedelta(minutes=p.monitor_minutes)
    lately = without([*store.pending(), *store.checks.batches_since(since)], [])
    freshness = freshness_check(read_spans(store, lately), now, p)
    # before the run changes what it reads
    freshness = store.spark.createDataFrame(freshness.collect(), freshness.schema)
    held = refresh(store, as_of, now, p, policy, strict, checks=not full_checks, **scoring)
    scored = store.mart.read()
    if full_checks:
        raw = store.raw()
        quality = quality_report(
            {
                "raw_transactions": raw,
                "stg_transactions": stage_transactions(raw, strict),
                "int_customer_baseline": store.baseline.read(),
                "mart_fraud_detection": scored,
            }
        )
    else:
        quality = store.checks.report()
        scored = on_days(scored, "transaction_date", store.checks.days_since(since))
    # a handful of lines, one per declared check
    lines = quality.collect()
    quality = store.spark.createDataFrame(lines, quality.schema)
    failed = any(line["failures"] for line in lines)
    return CycleReport(freshness, quality, None if failed else alert_route(scored, now, p), held)
