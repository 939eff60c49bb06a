"""Packing of token sequences into windows of one length, by minimum bin slack.

Only a histogram of remainder lengths (fewer rows than the window has tokens)
reaches the driver. It is turned into a plan of repeated window patterns; tasks
look up where each document's remainder goes from its rank among equal lengths.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskloom.llm.common import crc, store, text_or_empty
from riskloom.llm.vocabulary import definition, encoder


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """A multiset of the given lengths with the largest sum up to ``capacity``.

    Subset sums are bits of one integer; each length is added in powers of two of
    its count, longest first, until the capacity is reached. Walking the kept
    integers backwards gives how often each length is used.
    """
    reach, steps = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        left, block = min(counts[length], capacity // length), 1
        while left and not reach >> capacity & 1:
            use = min(block, left)
            steps.append((length, use, reach))
            reach |= reach << length * use & mask
            left, block = left - use, block * 2
        if reach >> capacity & 1:
            break
    total, chosen = reach.bit_length() - 1, defaultdict(int)
    for length, use, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += use
            total -= length * use
    return dict(chosen)


class Plan:
    """Windows made of remainders. ``rows``: length of the whole remainder, first
    and last rank (exclusive), cut (tokens of the remainder before this piece),
    piece length, first window, pieces of this kind per window, index of the first
    piece among its kind, offset of the first piece in a window."""

    def __init__(self, histogram: dict[int, int], window: int):
        # for each length what is left of it: (whole length, first rank, end, cut)
        stock = {n: [(n, 0, c, 0)] for n, c in histogram.items() if c}
        counts = {n: c for n, c in histogram.items() if c}
        self.rows: list[tuple[int, ...]] = []
        self.windows = 0
        while counts:
            longest = max(counts)
            rest = dict(counts)
            rest[longest] -= 1
            pattern = fill({k: v for k, v in rest.items() if v}, window - longest)
            pattern[longest] = pattern.get(longest, 0) + 1
            slack = window - sum(k * v for k, v in pattern.items())
            times = min(counts[k] // v for k, v in pattern.items())
            others = {k: counts[k] - pattern.get(k, 0) for k in counts if counts[k] > pattern.get(k, 0)}
            cut = 0
            if slack and others:  # nothing fits: the shortest of the rest is cut
                cut = min(others)
                times = min(times, counts[cut] // (pattern.get(cut, 0) + 1))
            offset = 0
            for length in sorted(pattern, reverse=True):
                self._place(stock, counts, length, times, pattern[length], offset, length)
                offset += length * pattern[length]
            if cut:
                self._place(stock, counts, cut, times, 1, offset, slack)
            self.windows += times
        self.rows.sort()

    def _place(self, stock, counts, length, times, each, offset, piece) -> None:
        need, index = times * each, 0
        counts[length] -= need
        if not counts[length]:
            del counts[length]
        while need:
            whole, lo, hi, cut = stock[length].pop()
            take = min(need, hi - lo)
            if take < hi - lo:
                stock[length].append((whole, lo + take, hi, cut))
            self.rows.append((whole, lo, lo + take, cut, piece, self.windows, each, index, offset))
            if piece < length:
                stock.setdefault(length - piece, []).append((whole, lo, lo + take, cut + piece))
                counts[length - piece] = counts.get(length - piece, 0) + take
            need, index = need - take, index + take

    def arrays(self) -> dict[int, list[np.ndarray]]:
        """Rows by whole length and cut level; ranks of one level do not overlap."""
        out: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for row in self.rows:
            out[row[0]][row[3]].append(row)
        return {n: [np.array(rows, dtype=np.int64) for rows in by.values()] for n, by in out.items()}


PIECES = "k {kind}, start long, length long, ids_crc32 long, doc_tokens long, rest boolean, part int, rank long, ids binary"
BROADCAST = 100_000  # rows of some ten numbers each
PLACED = ("cut", "n", "sequence_id", "offset")


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2, *, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents and where they lie: key, start, length, ids_crc32,
    doc_tokens, sequence_id, offset; ``with_ids`` adds the ids as little-endian
    32-bit integers.

    A document's ids plus ``end_id`` are cut into whole windows and a remainder.
    Remainders fill further windows by minimum bin slack; where no multiset of
    remainders fills a window, one more remainder is cut, so only the last window
    can be short. Sequence ids are dense from 0: windows of remainders first. Null
    text counts as empty (one piece: the end id); null and repeated keys are packed
    like others; an empty table gives no piece; other columns are ignored.
    """
    source = definition(tokenizer_path)
    kind = docs.schema[key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(source), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)  # rows of this task by remainder length; 0: whole windows
        for b in batches:
            rows = []
            for i, found in enumerate(encode.many(b.column(1).to_pylist())):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    n = len(piece) % window
                    rows.append((i, start, len(piece), crc(piece), len(ids), n > 0, part, seen[n], piece.tobytes()))
                    seen[n] += 1
            at, *columns = zip(*rows, strict=True) if rows else [[]] * 9
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            names = ["k", "start", "length", "ids_crc32", "doc_tokens", "rest", "part", "rank", "ids"]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *columns], names=names)

    rows = docs.select(F.col(key).alias("k"), text_or_empty(text).alias("t"))
    pieces = store(rows.mapInArrow(split, PIECES.format(kind=kind)), "pieces")
    pieces = pieces.withColumn("group", F.when(F.col("rest"), F.col("length")).otherwise(0))
    # ranks in the task become ranks in the table: add the counts of earlier tasks
    per_task = pieces.groupBy("group", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("group").orderBy("part")
    per_task = store(per_task.withColumn("before", F.sum("n").over(earlier) - F.col("n")), "ranks")
    # at most one row per length below the window
    histogram = {r["group"]: r["n"] for r in per_task.groupBy("group").agg(F.sum("n").alias("n")).collect()}
    histogram.pop(0, None)
    plan = Plan(histogram, window)
    lookup, first_whole = plan.arrays(), plan.windows

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {c: b.column(i) for i, c in enumerate(b.schema.names)}
            length, group = (col[c].to_numpy(zero_copy_only=False) for c in ("length", "group"))
            rank = col["rank"].to_numpy() + col["before"].to_numpy()
            whole, none = np.flatnonzero(group == 0), np.zeros(int((group == 0).sum()), np.int64)
            took = [(whole, none, length[whole], first_whole + rank[whole], none)]
            for n in np.unique(group[group > 0]).tolist():
                at = np.flatnonzero(group == n)
                for level in lookup[n]:
                    row = level[np.clip(np.searchsorted(level[:, 1], rank[at], "right") - 1, 0, None)]
                    inside = (row[:, 1] <= rank[at]) & (rank[at] < row[:, 2])
                    row, hit = row[inside], at[inside]
                    index = row[:, 7] + rank[hit] - row[:, 1]
                    took.append((hit, row[:, 3], row[:, 4], row[:, 5] + index // row[:, 6], row[:, 8] + index % row[:, 6] * row[:, 4]))
            at, *found = (np.concatenate(x) for x in zip(*took, strict=True))
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(at)).columns, *map(pa.array, found)], names=[*col, *PLACED])

    ranked = pieces.drop("ids", "rest").join(per_task.drop("n"), ["group", "part"])
    fields = StructType([*ranked.schema.fields, *(StructField(name, LongType()) for name in PLACED)])
    placed = ranked.mapInArrow(place, fields)
    identity = ["group", "part", "rank"]
    ids = pieces.select(*identity, "ids")
    if not with_ids:  # only pieces that were cut need their ids again
        placed = store(placed, "placed")
        cut = placed.where(F.col("n") < F.col("length"))
        placed = placed.where(F.col("n") == F.col("length")).withColumn("ids", F.lit(None).cast("binary"))
        few = cut.count() <= BROADCAST  # else both sides are shuffled
        placed = placed.unionByName((F.broadcast(cut) if few else cut).join(ids, identity))
    else:
        placed = placed.join(ids, identity)
    part_of = F.substring("ids", (4 * F.col("cut") + 1).cast("int"), (4 * F.col("n")).cast("int"))
    return placed.select(
        F.col("k").alias(key),
        (F.col("start") + F.col("cut")).alias("start"),
        F.col("n").alias("length"),
        F.when(F.col("n") == F.col("length"), F.col("ids_crc32")).otherwise(F.crc32(part_of)).alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        *([part_of.alias("ids")] if with_ids else []),
    )
