"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import work_folder

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def store(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared work folder and read them back.

    Later reads do not depend on the executors that made them. In local mode
    without ``spark.checkpoint.dir`` a folder of this machine is set.
    """
    spark = rows.sparkSession
    ensure_work_folder(spark)
    path = work_folder(spark, name)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def ensure_work_folder(spark: SparkSession) -> None:
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if unset and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="llm-"))


BROADCAST_ROWS = 500_000  # of a key and a hash


def small_side(stored: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows by count; else both sides are shuffled."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ascii_lower(data: bytes) -> bytes:
    """Lower-case A-Z only."""
    return data.lower()


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).data)


def table(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    """All batches of one partition, or None if it has no rows."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def rows_of(batches: Iterable[pa.RecordBatch], columns: Iterable[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)
