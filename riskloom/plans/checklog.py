"""Results of the quality checks, kept per piece of a table, so that a run checks only
the pieces it has written.

A piece is a set of landed batches (raw and staged rows), a day (scored rows) or the
whole table (profiles, which are rewritten as a whole). Sums over the pieces are the
results for the tables. The counts are aggregates over stored rows, not metrics
observed on the way: those count a task twice that is repeated for a lost executor.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.clock import as_ntz
from riskloom.operators.quality import CHECKS, duplicated_keys
from riskloom.session import scratch
from riskloom.sources.batches import Span, without
from riskloom.sources.tables import VersionedTable, on_days, rows_with_keys

WHOLE = "whole"
FOLD_AFTER = dt.timedelta(days=1)  # older pieces of raw and staged rows are added up
_LINE = ("table_name", "column_name", "check_name")
_SCHEMA = "table_name string, column_name string, check_name string, piece string, at timestamp_ntz, failures long"


def _piece(spans: list[Span]) -> str:
    return ";".join(s.folder for s in sorted(spans))


def _spans(piece: str) -> list[Span]:
    return [Span.of_folder(f) for f in piece.split(";")]


def row_checks(name: str, rows: DataFrame, piece, at) -> DataFrame:
    """Failures of all checks of single rows, one aggregate per piece."""
    checks = [c for c in CHECKS[name] if c.kind != "unique"]
    counted = rows.groupBy(piece.alias("piece")).agg(at.alias("at"), *[F.count_if(c.fails()).alias(f"_{i}") for i, c in enumerate(checks)])
    lines = [F.struct(F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check_name"), F.col(f"_{i}").alias("failures")) for i, c in enumerate(checks)]
    return counted.select(F.lit(name).alias("table_name"), "piece", "at", F.inline(F.array(*lines))).select(*[n.split()[0] for n in _SCHEMA.split(", ")])


def _unique_line(spark: SparkSession, name: str, piece: str, at: dt.datetime | None, failures: int) -> DataFrame:
    (check,) = (c for c in CHECKS[name] if c.kind == "unique")
    return spark.createDataFrame([(name, check.column, check.kind, piece, at, failures)], _SCHEMA)


def newly_repeated(arrived: DataFrame, earlier: DataFrame, key: str, keep: Callable) -> int:
    """Keys that occur more than once now and did not before. Only rows with an arriving
    key are read of the earlier ones."""
    ids = keep(arrived.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.count("*").alias("_now")), "arriving")
    found = rows_with_keys(earlier.select(key), key, ids.select(F.col("_id").alias(key)), keep, "met_again")
    before = found.groupBy(key).agg(F.count("*").alias("_before"))
    both = ids.join(before, F.col("_id") == F.col(key), "left").withColumn("_before", F.coalesce("_before", F.lit(0)))
    return both.where((F.col("_before") < 2) & (F.col("_before") + F.col("_now") > 1)).count()


@dataclass(frozen=True)
class CheckLog:
    """One line per check and piece."""

    spark: SparkSession
    path: str

    @property
    def _table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.path, schema=_SCHEMA)

    def lines(self) -> DataFrame:
        found = self._table.read()
        return self.spark.createDataFrame([], _SCHEMA) if found is None else found

    def report(self) -> DataFrame:
        """(table_name, column_name, check_name, failures) for all checks of all tables."""
        declared = [(t, c.column, c.kind) for t, checks in CHECKS.items() for c in checks]
        wanted = self.spark.createDataFrame(declared, "table_name string, column_name string, check_name string")
        sums = self.lines().groupBy(*_LINE).agg(F.sum("failures").alias("failures"))
        return wanted.join(F.broadcast(sums), list(_LINE), "left").select(*_LINE, F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))

    def record(self, new: DataFrame, now: dt.datetime, done: list[Span]) -> None:
        """Lines of new pieces replace those of the same pieces. Batches that are not
        ``done`` were noted by a run that broke off: their lines go."""
        pieces = [r["piece"] for r in self.lines().where(F.col("piece").startswith("batches=")).select("piece").distinct().collect()]
        left = [p for p in pieces if without(_spans(p), done)]
        old = self.lines().where(~F.col("piece").isin(left)).join(new.select("table_name", "piece").distinct(), ["table_name", "piece"], "left_anti")
        both = old.select(*new.columns).unionByName(new)
        aged = F.col("piece").startswith("batches=") & (F.coalesce("at", as_ntz(dt.datetime.min)) < as_ntz(now - FOLD_AFTER))
        folded = both.withColumn("piece", F.when(aged, "older").otherwise(F.col("piece")))
        folded = folded.groupBy(*_LINE, "piece").agg(F.max("at").alias("at"), F.sum("failures").alias("failures"))
        self._table.replace(folded.select(*new.columns).coalesce(1))
        self._table.forget_old_versions()

    def batches_since(self, moment: dt.datetime) -> list[Span]:
        """Batches that may hold rows that came in at ``moment`` or later, among those noted."""
        recent = (F.col("table_name") == "raw_transactions") & (F.col("at") >= as_ntz(moment))
        pieces = self.lines().where(recent & F.col("piece").startswith("batches=")).select("piece").distinct().collect()
        return [s for r in pieces for s in _spans(r["piece"])]

    def days_since(self, moment: dt.datetime) -> DataFrame:
        """Days of the scored table that were written at ``moment`` or later."""
        recent = (F.col("table_name") == "mart_fraud_detection") & (F.col("at") >= as_ntz(moment)) & (F.col("piece") != WHOLE)
        return self.lines().where(recent).select(F.when(F.col("piece") != "undated", F.col("piece").cast("date")).alias("transaction_date")).distinct()


def check_run(
    log: CheckLog,
    raw: DataFrame,
    staged: DataFrame,
    earlier: DataFrame,
    spans: list[Span],
    baseline: DataFrame | None,
    mart: DataFrame | None,
    days: DataFrame,
    now: dt.datetime,
    done: list[Span],
) -> None:
    """Check what a run has read and written: its batches (``earlier`` are the raw rows
    of the batches before), the profile if it is new, and the ``days`` of the scored
    table it wrote."""
    spark, new = log.spark, []
    with scratch(spark) as keep:
        if spans:
            piece = _piece(spans)
            newest = F.max("ingested_at")
            repeated = newly_repeated(raw, earlier, "transaction_id", keep)
            lines = row_checks("raw_transactions", raw, F.lit(piece), newest).unionByName(row_checks("stg_transactions", staged, F.lit(piece), F.max("_ingested_at")))
            new += [lines, *[_unique_line(spark, t, piece, None, repeated) for t in ("raw_transactions", "stg_transactions")]]
        if baseline is not None:
            new.append(row_checks("int_customer_baseline", baseline, F.lit(WHOLE), F.lit(now).cast("timestamp_ntz")))
            new.append(_unique_line(spark, "int_customer_baseline", WHOLE, now, duplicated_keys(baseline, "customer_id").count()))
        if mart is not None:
            written_days = on_days(mart, "transaction_date", days)
            day = F.coalesce(F.col("transaction_date").cast("string"), F.lit("undated"))
            new.append(row_checks("mart_fraud_detection", written_days, day, F.max("scored_at")))
            # the key of a row is in one day only, so copies would be beside each other
            new.append(_unique_line(spark, "mart_fraud_detection", WHOLE, now, duplicated_keys(written_days, "transaction_id").count()))
        if new:
            lines = new[0]
            for part in new[1:]:
                lines = lines.unionByName(part)
            log.record(keep(lines, "lines"), now, done)
