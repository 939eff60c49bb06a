"""Session advice and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are tuned for. They are advice: operators give the same
# results without them (dates and hours come from zone-free timestamps).
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no stack inspection per column expression: plans are built faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables under ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


def files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = files(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; it shows when it is whole."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = files(spark, f"{folder}/.{name}.tmp")
    stream = fs.create(hidden, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    _, target = files(spark, path)
    fs.delete(target, False)
    fs.rename(hidden, target)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = files(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def written(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the work folder and read them back.

    This cuts the lineage: after the loss of an executor files are read again
    and nothing is recomputed. The files stay; see ``scratch``.
    """
    return _stored(rows, work_folder(rows.sparkSession, name))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Like ``written`` for tables that are no longer needed at the end."""
    folder = work_folder(spark, "scratch")
    try:
        yield lambda rows, name: _stored(rows, f"{folder}/{name}")
    finally:
        fs, p = files(spark, folder)
        fs.delete(p, True)
