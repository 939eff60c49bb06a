"""Stored tables: raw landing zone, upserts, schema policy and layout.

Plain Parquet folders. A table with ACID upserts of its own can replace these
classes without touching the operators.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.quality import duplicated_keys
from riskloom.schemas import RAW_SCHEMA
from riskloom.session import exists, files, read_text, scratch, write_text
from riskloom.sources.batches import BATCH, BatchedTable, BatchExists, Span, batch_name

LANDED_SCHEMA = T.StructType(
    RAW_SCHEMA.fields + [T.StructField("event_date", T.DateType()), T.StructField(BATCH, T.StringType())]
)


# -- raw ---------------------------------------------------------------------


def with_event_date(raw: DataFrame) -> DataFrame:
    """Add the typed day by which the raw table is laid out.

    A filter on the text timestamp cannot reach the files; this column can.
    """
    return raw.withColumn("event_date", F.col("transaction_timestamp").try_cast("date"))


def raw_table(spark: SparkSession, path: str) -> BatchedTable:
    return BatchedTable(spark, path, LANDED_SCHEMA, "event_date", options=bloom_options("transaction_id"))


def land_batch(raw: DataFrame, path: str, batch_id: int, owner: str = "batch", replay: bool = False) -> str:
    """Add one batch to the raw table, which never changes landed rows; returns its name.

    ``owner`` tells who numbers the batches (a streaming query's id). A name that was
    landed before is refused, or skipped with ``replay``: a restarted stream sends
    its last batch again. A landing that broke off is repeated as a whole.
    """
    table, name = raw_table(raw.sparkSession, path), batch_name(batch_id, owner)
    if table.has(name):
        if replay:
            return name
        raise BatchExists(name)
    rows = with_event_date(raw.select(*RAW_SCHEMA.fieldNames())).withColumn(BATCH, F.lit(name))
    table.write(rows, Span(owner, batch_id, batch_id))
    return name


def read_raw(spark: SparkSession, path: str, batches: list[str] | None = None) -> DataFrame:
    """The raw table, or the rows of some batches (whose folders alone are read)."""
    return raw_table(spark, path).read(batches)


# -- upsert building blocks --------------------------------------------------


class SchemaChanged(ValueError):
    """The new rows do not have the columns of the stored table."""


def align_schema(existing: DataFrame, updates: DataFrame, on_change: str) -> tuple[DataFrame, DataFrame]:
    """Give both sides the same columns.

    ``fail``: any difference in names or types is an error.
    ``append_new_columns``: new columns go to the end of the table, NULL in old
    rows; columns missing from the updates are NULL in them.
    """
    have = {f.name: f.dataType for f in existing.schema}
    come = {f.name: f.dataType for f in updates.schema}
    retyped = sorted(n for n in have.keys() & come.keys() if have[n] != come[n])
    if on_change == "fail":
        if have != come:
            raise SchemaChanged(f"added {sorted(come - have.keys())}, missing {sorted(have - come.keys())}, retyped {retyped}")
    elif on_change == "append_new_columns":
        if retyped:
            raise SchemaChanged(f"retyped {retyped}")
    else:
        raise ValueError(f"unknown schema policy {on_change!r}")
    columns = list(have) + [n for n in come if n not in have]
    kinds = come | have

    def padded(side: DataFrame, own: dict) -> DataFrame:
        return side.select(*[F.col(n) if n in own else F.lit(None).cast(kinds[n]).alias(n) for n in columns])

    return padded(existing, have), padded(updates, come)


def latest_per_key(rows: DataFrame, key: str, newest_by: str | None = None) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, then by all columns.

    A maximum over structs is pre-aggregated before the shuffle, so many copies
    of one key do not meet in one task. Rows without a key are all kept. Meant
    for the few keys that have copies; see ``without_copies``.
    """
    order = [newest_by] if newest_by else []
    order += [c for c in rows.columns if c not in (key, newest_by)]
    best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order)).alias("_best"))
    picked = best.select(*[F.col(c) if c == key else F.col("_best")[c].alias(c) for c in rows.columns])
    return picked.unionByName(rows.where(F.col(key).isNull()))


def without_copies(rows: DataFrame, keys: DataFrame, key: str, newest_by: str, keep: Callable) -> DataFrame:
    """``rows`` with one row per key; ``keys`` holds their keys, with repetition.

    Usually nothing is repeated: then finding that out costs one shuffle of the
    key column, and the rows themselves are not moved. ``keep`` stores
    intermediate tables (``written`` or what ``scratch`` gives).
    """
    repeated = keep(duplicated_keys(keys.select(key), key).select(key), "repeated")
    if repeated.isEmpty():
        return rows
    rows = keep(rows, "with_copies")
    return rows.join(repeated, key, "left_anti").unionByName(
        latest_per_key(rows.join(repeated, key, "left_semi"), key, newest_by)
    )


def merged(existing: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Existing rows without an update, plus the updates (one row per key)."""
    return existing.join(updates.select(key), key, "left_anti").select(*updates.columns).unionByName(updates)


# -- look-ups by key ---------------------------------------------------------

FEW_KEYS = 20_000  # so many are looked up by value, more of them by a join
_SLICE = 500  # values of one list, well below the depth that nested conditions may have
_IN_LISTS = "spark.sql.parquet.pushdown.inFilterThreshold"


def bloom_options(key: str) -> dict[str, str]:
    """Writer options: a Bloom filter on ``key`` in each row group, as large as its keys
    need. One in 100,000 row groups is read in vain per key looked up. Without a
    dictionary, which each row group would be asked for once per key as well."""
    return {
        f"parquet.enable.dictionary#{key}": "false",
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.fpp#{key}": "0.00001",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.candidates.number": "9",
        "parquet.bloom.filter.max.bytes": str(1 << 20),
    }


@contextmanager
def _long_in_lists(spark: SparkSession) -> Iterator[None]:
    """Lists of values reach the files as such; beyond a limit they would be a range."""
    before = spark.conf.get(_IN_LISTS)
    spark.conf.set(_IN_LISTS, str(_SLICE))
    try:
        yield
    finally:
        spark.conf.set(_IN_LISTS, before)


def one_of(key: str, values: list) -> Column:
    """``key`` is one of the values, in lists that stay lists on their way to the files."""
    lists = [F.col(key).isin(values[i : i + _SLICE]) for i in range(0, len(values), _SLICE)]
    return reduce(or_, lists, F.lit(False))


def on_days(rows: DataFrame, day: str, days: DataFrame) -> DataFrame:
    """Rows of some days (null finds null): the list, one entry per day, reaches the folders."""
    listed = [r[0] for r in days.collect()]
    found = one_of(day, sorted(d for d in listed if d is not None))
    return rows.where(found | F.col(day).isNull() if None in listed else found)


def rows_with_keys(rows: DataFrame, key: str, keys: DataFrame, keep: Callable, name: str = "looked_up", most: int = FEW_KEYS) -> DataFrame:
    """The stored ``rows`` whose key is in ``keys`` (null finds null), kept as a table.

    At most ``most`` keys are brought to the driver and pushed down to the files, where
    Bloom filters skip the row groups that have none of them; more keys are joined.
    """
    keys = keys.select(F.col(key).alias("_key")).distinct()
    few = [r[0] for r in keys.limit(most + 1).collect()]
    if len(few) > most:
        return keep(rows.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi"), name)
    found = rows.where(one_of(key, sorted(k for k in few if k is not None)))
    if None in few:
        # apart: beside other conditions a Bloom filter cannot tell that there are no nulls
        found = found.unionByName(rows.where(F.col(key).isNull()))
    with _long_in_lists(rows.sparkSession):
        return keep(found, name)


# -- tables ------------------------------------------------------------------


@dataclass(frozen=True)
class VersionedTable:
    """A table rewritten as a whole into a new folder per version.

    The newest folder that carries the job's success marker is the table, so a
    failed write changes nothing and readers of older versions go on unharmed.

    With ``buckets`` rows are dealt by a hash of ``layout_by`` and sorted within, and
    read through a table of the session's catalog that says so: a join on that column
    with rows dealt into as many partitions needs no shuffle of the table. Any session
    can declare it again from the files.
    """

    spark: SparkSession
    path: str
    layout_by: str | None = None
    buckets: int = 0
    schema: str | None = None  # if it never changes: spares looking it up in the files

    def _versions(self) -> list[int]:
        fs, p = files(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
        return [n for n in numbers if exists(self.spark, f"{self.path}/v={n}/_SUCCESS")]

    def newest(self) -> int | None:
        versions = self._versions()
        return versions[-1] if versions else None

    def read(self) -> DataFrame | None:
        newest = self.newest()
        if newest is None:
            return None
        if not self.buckets:
            reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
            return reader.parquet(f"{self.path}/v={newest}")
        name = self._name(newest)
        if not self.spark.catalog.tableExists(name):
            by = f"clustered by ({self.layout_by}) sorted by ({self.layout_by}) into {self.buckets} buckets"
            columns = read_text(self.spark, f"{self.path}/v={newest}.columns")
            self.spark.sql(f"create table if not exists {name} ({columns}) using parquet {by} location '{self.path}/v={newest}'")
        return self.spark.table(name)

    def _name(self, version: int) -> str:
        return f"riskloom_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{version}"

    def replace(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """Write ``rows`` as the next version, or under a higher number of one's own."""
        newest = self.newest()
        version = version if version is not None else 0 if newest is None else newest + 1
        path = f"{self.path}/v={version}"
        if self.buckets:
            # beside the files, of which an empty table has none
            write_text(self.spark, f"{path}.columns", rows._jdf.schema().toDDL())
            # one file per bucket
            rows = rows.repartition(self.buckets, self.layout_by)
            writer = rows.write.bucketBy(self.buckets, self.layout_by).sortBy(self.layout_by).options(**bloom_options(self.layout_by))
            writer.mode("overwrite").option("path", path).saveAsTable(self._name(version))
            return self.read()
        if self.layout_by:
            # the last join or aggregate has hashed rows by key already; a range
            # partitioning would compute them a second time to sample its bounds
            rows = rows.sortWithinPartitions(self.layout_by)
        rows.write.mode("overwrite").parquet(path)
        return self.read()

    def upsert(self, updates: DataFrame, key: str, on_change: str = "append_new_columns") -> DataFrame:
        """``updates`` hold one row per key."""
        existing = self.read()
        if existing is None:
            return self.replace(updates)
        old, new = align_schema(existing, updates, on_change)
        return self.replace(merged(old, new, key))

    def forget_old_versions(self, keep: int = 2) -> None:
        for n in self._versions()[:-keep]:
            if self.buckets:
                self.spark.sql(f"drop table if exists {self._name(n)}")
            for name in (f"v={n}", f"v={n}.columns"):
                fs, p = files(self.spark, f"{self.path}/{name}")
                fs.delete(p, True)


@dataclass(frozen=True)
class DailyTable:
    """A table in one folder per day, of which an upsert rewrites only some."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    day: str
    sort_by: str | None = None

    def read(self) -> DataFrame | None:
        if not exists(self.spark, self.path):
            return None
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.select(*self.schema.fieldNames())

    def _write(self, rows: DataFrame, mode: str) -> None:
        if self.sort_by:
            # AQE splits a day that is too large for one task
            rows = rows.hint("rebalance", self.day).sortWithinPartitions(self.day, self.sort_by)
        (
            rows.write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .options(**bloom_options(self.key))
            .partitionBy(self.day)
            .parquet(self.path)
        )

    def append(self, rows: DataFrame) -> None:
        """Add rows whose keys are known to be new."""
        self._check(rows)
        self.recover()
        self._write(rows, "append")

    def find(self, keys: DataFrame, keep: Callable, name: str = "found") -> DataFrame:
        """(key, day) of the stored rows with one of the keys."""
        stored = self.read()
        if stored is None:
            stored = self.spark.createDataFrame([], self.schema)
        return rows_with_keys(stored.select(self.key, self.day), self.key, keys, keep, name)

    def upsert(self, updates: DataFrame) -> list:
        """Replace rows by key; only days that lose or gain rows are rewritten, and
        returned, a row each.

        The new content of those days is first written completely beside the
        table and then swapped in. A swap that broke off is repeated before the
        next write (``recover``), which is safe any number of times.
        """
        self._check(updates)
        self.recover()
        existing = self.read()
        if existing is None:
            self._write(updates, "append")
            return self.read().select(self.day).distinct().collect()
        with scratch(self.spark) as keep:
            updates = keep(updates, "updates")
            days = self.find(updates, keep).select(self.day).union(updates.select(self.day)).distinct()
            days = keep(days.withColumnRenamed(self.day, "touched"), "days")
            swaps = self._swaps()
            version = (swaps.newest() or 0) + 1
            days.write.mode("overwrite").parquet(f"{swaps.path}_days/{version}")
            swaps.replace(merged(on_days(existing, self.day, days), updates, self.key), version)
            touched = days.collect()
        self.recover()
        return touched

    def recover(self) -> None:
        """Swap in the newest complete set of days unless that was done."""
        swaps = self._swaps()
        done = f"{swaps.path}_done"
        version = swaps.newest()
        if version is None or exists(self.spark, f"{done}/{version}"):
            return
        content = swaps.read()
        touched = {r[0] for r in self.spark.read.parquet(f"{swaps.path}_days/{version}").collect()}
        for d in touched - {r[0] for r in content.select(self.day).distinct().collect()}:
            # every row of this day has moved to another one
            fs, p = files(self.spark, f"{self.path}/{self.day}={d or '__HIVE_DEFAULT_PARTITION__'}")
            fs.delete(p, True)
        self._write(content, "overwrite")
        fs, p = files(self.spark, f"{done}/{version}")
        fs.mkdirs(p)
        swaps.forget_old_versions(1)

    def _swaps(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}_swaps")

    def _check(self, rows: DataFrame) -> None:
        want = {f.name: f.dataType for f in self.schema}
        have = {f.name: f.dataType for f in rows.schema}
        if want != have:
            raise SchemaChanged(f"expected {want}, got {have}")
