"""Hot customers: find them, and keep their rows apart from the ordinary ones.

Windows and exact percentiles need all rows of a group in one task. That is
fine for ordinary customers but not for one that owns a large share of the
table, so every per-customer operator takes two routes: the plain one, with a
single shuffle on ``customer_id``, and a spread one in which no task sees more
than one chunk of time (or value bucket) of a hot customer. Both are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.params import HotKeyPolicy
from riskloom.session import written

_HOT_ID = "hot_customer_id"
_HOT_SCHEMA = T.StructType([T.StructField(_HOT_ID, T.StringType())])


@dataclass(frozen=True)
class Heat:
    """The hot customers of a table; ``keys`` is None when there are none."""

    policy: HotKeyPolicy
    keys: DataFrame | None = None
    short: bool = True  # the list has at most max_keys entries
    rows: int = 0  # of hot customers, at most

    def chunks(self, copies: int) -> int:
        """So many pieces keep each one near the policy's size, if rows come ``copies`` times."""
        return max(1, -(-self.rows * copies // self.policy.chunk_rows))

    def small(self, rows: DataFrame) -> DataFrame:
        """Mark rows, one per hot customer, for broadcast if the list is short."""
        return F.broadcast(rows) if self.short else rows


def measure_heat(rows: DataFrame, policy: HotKeyPolicy | None = None) -> Heat:
    """Find the hot customers of ``rows`` (customer_id only is read).

    At most ``policy.max_keys + 1`` ids are brought to the driver; a longer list is
    written to the work folder instead.
    """
    counts = rows.groupBy("customer_id").agg(F.count("*").alias("n"))
    return heat_of(counts, policy or HotKeyPolicy())


def heat_of(counts: DataFrame, policy: HotKeyPolicy) -> Heat:
    """The hot ones among customers whose rows (n) were counted before."""
    hot = counts.where(F.col("n") > policy.min_rows).select(F.col("customer_id").alias(_HOT_ID), "n")
    found = hot.limit(policy.max_keys + 1).collect()
    if not found:
        return Heat(policy)
    if len(found) > policy.max_keys:
        stored = written(hot, "hot")
        return Heat(policy, stored.select(_HOT_ID), short=False, rows=stored.agg(F.sum("n")).first()[0])
    keys = counts.sparkSession.createDataFrame([r[:1] for r in found], _HOT_SCHEMA)
    return Heat(policy, keys, rows=sum(r["n"] for r in found))


@dataclass(frozen=True)
class Split:
    """Rows of ordinary customers and, if any, rows of hot ones."""

    ordinary: DataFrame
    hot: DataFrame | None
    heat: Heat

    def lookup(self, other: DataFrame, how: str, null_safe: bool = False) -> Split:
        """Join on customer_id with a table of at most one row per customer.

        The hot side meets one such row per hot customer, so broadcasting them is
        bounded while the list is short and keeps the hot rows where they are. ``null_safe``
        lets rows without a customer find each other.
        """

        def joined(rows: DataFrame, found: DataFrame) -> DataFrame:
            if not null_safe:
                return rows.join(found, "customer_id", how)
            found = found.withColumnRenamed("customer_id", "_found")
            return rows.join(found, F.col("customer_id").eqNullSafe(F.col("_found")), how).drop("_found")

        return self.map(
            lambda rows: joined(rows, other),
            lambda rows: joined(rows, self.heat.small(_only_hot(other, self.heat, "left_semi"))),
        )

    def where(self, condition) -> Split:
        return self.map(lambda rows: rows.where(condition), lambda rows: rows.where(condition))

    def map(self, plain, spread) -> Split:
        hot = None if self.hot is None else spread(self.hot)
        return Split(plain(self.ordinary), hot, self.heat)

    def merged(self) -> DataFrame:
        return self.ordinary if self.hot is None else self.ordinary.unionByName(self.hot)


def split_by_heat(rows: DataFrame, heat: Heat) -> Split:
    if heat.keys is None:
        return Split(rows, None, heat)
    return Split(_only_hot(rows, heat, "left_anti"), _only_hot(rows, heat, "left_semi"), heat)


def _only_hot(rows: DataFrame, heat: Heat, how: str) -> DataFrame:
    # null-safe: rows without a customer form a group too, and it can be hot
    same = F.col("customer_id").eqNullSafe(F.col(_HOT_ID))
    return rows.join(heat.small(heat.keys), same, how)
