"""Tables that grow by numbered batches, and the record of which batches are done.

A batch lands as a folder named after its owner and number. Folders of neighbouring
numbers are merged in levels; a merged folder is named after the range it holds, so
its success marker alone switches readers over and no list of merges is needed.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import exists, files, read_text, write_text

BATCH = "ingest_batch"
_PART = "batches"
FAN = 8  # so many neighbours of one level become one folder of the next
GRACE_SECONDS = 3600.0  # that merged folders are kept for readers that began before


class BatchExists(ValueError):
    """Another batch has been landed under this name."""


def batch_name(batch_id: int, owner: str) -> str:
    """Batches are numbered per owner: a new or lost checkpoint starts again at 0."""
    return f"{owner}-{batch_id}"


@dataclass(frozen=True, order=True)
class Span:
    """Batches ``first`` to ``last`` of an owner."""

    owner: str
    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"{_PART}={self.owner}~{self.first}~{self.last}"

    @staticmethod
    def of_folder(name: str) -> Span:
        owner, first, last = name.removeprefix(f"{_PART}=").rsplit("~", 2)
        return Span(owner, int(first), int(last))

    @staticmethod
    def of_batch(name: str) -> Span:
        owner, number = name.rsplit("-", 1)
        return Span(owner, int(number), int(number))

    @property
    def size(self) -> int:
        return self.last - self.first + 1

    def names(self) -> list[str]:
        return [batch_name(n, self.owner) for n in range(self.first, self.last + 1)]

    def covers(self, other: Span) -> bool:
        return self.owner == other.owner and self.first <= other.first and other.last <= self.last


def joined(spans: Iterable[Span]) -> list[Span]:
    """The same batches in as few spans as possible."""
    out: list[Span] = []
    for s in sorted(spans):
        if out and out[-1].owner == s.owner and s.first <= out[-1].last + 1:
            out[-1] = Span(s.owner, out[-1].first, max(out[-1].last, s.last))
        else:
            out.append(s)
    return out


def without(spans: Iterable[Span], done: Iterable[Span]) -> list[Span]:
    """The batches of ``spans`` that are not in ``done``."""
    done, out = joined(done), []
    for s in joined(spans):
        at = s.first
        for d in done:
            if d.owner == s.owner and d.last >= at and d.first <= s.last:
                if d.first > at:
                    out.append(Span(s.owner, at, d.first - 1))
                at = d.last + 1
        if at <= s.last:
            out.append(Span(s.owner, at, s.last))
    return out


def live(spans: Iterable[Span]) -> list[Span]:
    """Those that are not part of a merged one."""
    out: list[Span] = []
    for s in sorted(spans, key=lambda s: (s.owner, s.first, -s.last)):
        if not (out and out[-1].covers(s)):
            out.append(s)
    return out


def next_merge(spans: list[Span], fan: int) -> Span | None:
    """``fan`` neighbours of one level as one span: a level holds fan times the batches
    of the one below, so a batch is merged a logarithmic number of times."""

    def level(s: Span) -> int:
        n, size = 0, s.size
        while size >= fan:
            n, size = n + 1, size // fan
        return n

    run: list[Span] = []
    for s in sorted(spans):
        if run and (run[-1].owner != s.owner or run[-1].last + 1 != s.first or level(run[-1]) != level(s)):
            run = []
        run.append(s)
        if len(run) == fan:
            return Span(s.owner, run[0].first, s.last)
    return None


@dataclass(frozen=True)
class BatchedTable:
    """Rows in one folder per batch or merged range, within it one folder per day.

    ``schema`` has the day and, where single batches of merged folders are read, their
    name (``ingest_batch``). ``combine`` may shrink the rows of a merged folder instead.
    Batches that were landed are never changed. An owner's folders are merged by the
    owner alone, so there is one merger for each.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    day: str
    combine: Callable[[DataFrame], DataFrame] | None = None
    sort_by: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)  # of the writer

    def spans(self) -> list[Span]:
        """What readers see."""
        return live(self._folders())

    def _folders(self) -> list[Span]:
        fs, p = files(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        spans = [Span.of_folder(n) for n in names if n.startswith(f"{_PART}=")]
        return [s for s in spans if exists(self.spark, f"{self.path}/{s.folder}/_SUCCESS")]

    def has(self, name: str) -> bool:
        return any(s.covers(Span.of_batch(name)) for s in self._folders())

    def write(self, rows: DataFrame, span: Span) -> None:
        """Once more after a write that broke off: the same folder."""
        # one or a few files per day instead of one per task and day
        rows = rows.select(*self.schema.fieldNames()).hint("rebalance", self.day)
        if self.sort_by:
            rows = rows.sortWithinPartitions(self.day, *self.sort_by)
        rows.write.mode("overwrite").options(**self.options).partitionBy(self.day).parquet(f"{self.path}/{span.folder}")

    def read(self, batches: list[str] | None = None) -> DataFrame:
        """All rows, or those of some batches (whose folders alone are read)."""
        spans = self.spans()
        wanted = None if batches is None else [Span.of_batch(n) for n in batches]
        if wanted is not None:
            spans = [s for s in spans if any(s.covers(w) for w in wanted)]
        rows = self._read(spans)
        if wanted is None or not without(spans, wanted):
            return rows
        return rows.where(F.col(BATCH).isin(batches))

    def _read(self, spans: list[Span]) -> DataFrame:
        if not spans:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/{s.folder}" for s in spans]
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
        return rows.select(*self.schema.fieldNames())

    def merge(self, owner: str, fan: int = FAN, grace: float = GRACE_SECONDS) -> None:
        """Merge neighbouring folders of an owner, level by level. Merged folders stay
        for ``grace`` seconds, as long as a reader that found them may need them."""
        folders = [s for s in self._folders() if s.owner == owner]
        spans = live(folders)
        while span := next_merge(spans, fan):
            parts = [s for s in spans if span.covers(s)]
            rows = self._read(parts)
            self.write(self.combine(rows) if self.combine else rows, span)
            spans = [s for s in spans if s not in parts] + [span]
            folders.append(span)
        now = time.time()
        for s in set(folders) - set(spans):
            into = next(m for m in spans if m.covers(s))
            fs, p = files(self.spark, f"{self.path}/{into.folder}/_SUCCESS")
            if now - fs.getFileStatus(p).getModificationTime() / 1000 >= grace:
                fs, p = files(self.spark, f"{self.path}/{s.folder}")
                fs.delete(p, True)


@dataclass(frozen=True)
class Ledger:
    """Batches that are done: per owner the spans of their numbers, usually a single
    one, in one small file per version. One writer at a time."""

    spark: SparkSession
    path: str

    def spans(self) -> list[Span]:
        newest = max(self._versions(), default=None)
        if newest is None:
            return []
        return [Span(*s) for s in json.loads(read_text(self.spark, f"{self.path}/{newest}.json"))]

    def add(self, names: list[str]) -> None:
        if not names:
            return
        spans = joined([*self.spans(), *map(Span.of_batch, names)])
        versions = self._versions()
        text = json.dumps([[s.owner, s.first, s.last] for s in spans])
        write_text(self.spark, f"{self.path}/{max(versions, default=-1) + 1}.json", text)
        for old in sorted(versions)[:-1]:
            fs, p = files(self.spark, f"{self.path}/{old}.json")
            fs.delete(p, False)

    def _versions(self) -> list[int]:
        fs, p = files(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
