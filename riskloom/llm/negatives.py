"""Hard negatives of anchor vectors by a secondary sort.

Scores of rows with anchors become records keyed by (anchor, falling score, id); the
shuffle deals them by anchor and sorts them, and one pass over the sorted stream opens
a window at each positive and hands out negatives to the windows they fall into.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import shuffle_partitions, store

SCALE = 256
_LONG = np.iinfo(np.int64)
_EXACT = float(1 << 53)  # doubles hold integers up to here


def _wanted(vectors: DataFrame, key: str, vector: str, label: str, moved: int, labels: int) -> DataFrame:
    """(id, label, q): rows that take part, components as whole doubles."""
    x = F.col(vector).cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), x.alias("x"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(~F.exists("x", bad))
    return rows.select(
        "id",
        F.when(F.col("id") % moved == 0, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label")).alias("label"),
        # beyond the range of long the product stands as it is: it is whole already
        F.transform("x", lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v * SCALE).cast("double")).otherwise(v * SCALE)).alias("q"),
    )


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of lists; shorter ones end with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(lengths) and (lengths == lengths[0]).all():
        return flat.reshape(len(lengths), lengths[0])
    out = np.zeros((len(lengths), lengths.max(initial=0)))
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as exact 64-bit integers, cut to their range."""
    dims = min(a.shape[1], b.shape[1])
    a, b = a[:, :dims], b[:, :dims]
    if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(1, dims) < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    out = np.dot(whole(a), whole(b).T) if dims else np.zeros((len(a), len(b)), object)
    return np.clip(out, _LONG.min, _LONG.max).astype(np.int64)


@dataclass(frozen=True)
class Anchors:
    """A block of anchors: number, id, label, components."""

    number: np.ndarray
    id: np.ndarray
    label: np.ndarray
    q: np.ndarray

    @staticmethod
    def of(rows: list, first: int) -> Anchors:
        return Anchors(
            np.arange(first, first + len(rows)),
            np.array([r["id"] for r in rows], np.int64),
            np.array([r["label"] for r in rows], np.int64),
            _matrix(pa.array([r["q"] for r in rows], pa.list_(pa.float64()))),
        )


_PAIR = "anchor long, falling long, negative boolean, id long"
Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]  # anchor (position in its block), score, id
_NONE: Pairs = (np.zeros(0, np.int64),) * 3


def _first(parts: list[Pairs], most: int) -> Pairs:
    """The first pairs of each anchor by falling score and id, equal pairs once."""
    anchor, score, ids = (np.concatenate(column) for column in zip(*parts, strict=True))
    # ~ turns the order around without overflow
    anchor, falling, ids = _sorted_set(anchor, ~score, ids)
    keep = np.arange(len(anchor)) - np.searchsorted(anchor, anchor, "left") < most
    return anchor[keep], ~falling[keep], ids[keep]


def _sorted_set(*columns: np.ndarray) -> Pairs:
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return tuple(c[new] for c in columns)


def _lowest(pairs: Pairs, anchors: Anchors, most: int, otherwise: np.ndarray) -> np.ndarray:
    """The score that a further pair of each anchor must reach: that of the last of its
    ``most`` pairs, or ``otherwise`` while there are fewer."""
    full = np.bincount(pairs[0], minlength=len(anchors.id)) == most
    lowest = np.full(len(anchors.id), _LONG.max)
    np.minimum.at(lowest, pairs[0], pairs[1])
    return np.where(full, lowest, otherwise)


def _scored(batches: Iterator[pa.RecordBatch], anchors: Anchors, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, scores (rows by anchors), which pairs share the label and which do not; a
    row with the anchor's id is neither."""
    step = max(1, cells // max(1, len(anchors.id)))
    for b in batches:
        for start in range(0, b.num_rows, step):
            part = b.slice(start, step)
            ids = part.column(0).to_numpy()
            same = part.column(1).to_numpy()[:, None] == anchors.label
            others = ids[:, None] != anchors.id
            yield ids, products(_matrix(part.column(2)), anchors.q), same & others, ~same & others


def _emit(pairs: Pairs, anchors: Anchors, negative: bool) -> Iterator[pa.RecordBatch]:
    anchor, score, ids = pairs
    if len(anchor):
        columns = [pa.array(anchors.number[anchor]), pa.array(~score), pa.array(np.full(len(ids), negative)), pa.array(ids)]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "falling", "negative", "id"])


def _positives(rows: DataFrame, anchors: Anchors, most: int, cells: int) -> DataFrame:
    """Each task's first same-label rows of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, anything = _NONE, np.full(len(anchors.id), _LONG.min)
        least = anything
        for ids, score, same, _ in _scored(batches, anchors, cells):
            row, anchor = np.nonzero(same & (score >= least))
            best = _first([best, (anchor, score[row, anchor], ids[row])], most)
            least = _lowest(best, anchors, most, anything)
        yield from _emit(best, anchors, False)

    return rows.mapInArrow(run, _PAIR)


def least_score(positive: np.ndarray, share: int) -> np.ndarray:
    """The smallest whole score s with share * positive <= 100 * s."""
    whole, rest = np.divmod(positive, 100)
    return whole * share - (-rest * share) // 100


def _negatives(rows: DataFrame, anchors: Anchors, windows: np.ndarray, most: int, share: int, cells: int) -> DataFrame:
    """Each task's first rows of other labels in every window. ``windows`` has the
    positive scores of each anchor in its row, padded with -1: windows below zero are
    empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = least_score(windows, share).T
        kept, least = [_NONE] * len(low), list(low)
        for ids, score, _, other in _scored(batches, anchors, cells):
            for w, high in enumerate(windows.T):
                row, anchor = np.nonzero(other & (score <= high) & (score >= least[w]))
                kept[w] = _first([kept[w], (anchor, score[row, anchor], ids[row])], most)
                least[w] = _lowest(kept[w], anchors, most, low[w])
        # neighbouring windows share rows
        yield from _emit(_sorted_set(*(np.concatenate(column) for column in zip(_NONE, *kept, strict=True))), anchors, True)

    return rows.mapInArrow(run, _PAIR)


def open_windows(batches: Iterator[pa.RecordBatch], positives: int, negatives: int, share: int) -> Iterator[pa.RecordBatch]:
    """One pass over records sorted by anchor, falling score, positives first, id.

    A positive opens a window; each negative goes to the open windows it still falls
    into. Only the windows of one anchor are held.
    """
    current, last, windows = None, None, []  # a window: id, score, least score, negatives so far
    for b in batches:
        out = []
        for record in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            anchor, falling, negative, row = record
            if record == last:
                continue
            last, score = record, ~falling
            if anchor != current:
                current, windows = anchor, []
            if not negative:
                if len(windows) < positives:
                    windows.append([row, score, -((-score * share) // 100), 0])
                continue
            for window in windows:
                if window[3] < negatives and window[2] <= score <= window[1]:
                    window[3] += 1
                    out.append((anchor, window[0], window[3], row, window[1], score))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


_FOUND = "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    share: int = 80,
    *,
    moved: int = 7,
    labels: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block_values: int = 2_000_000,
    cells: int = 1_000_000,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows whose key is divisible by ``every`` are anchors. A row's score is the integer
    inner product of both vectors, components taken as floor(256 * x). The first
    ``positives`` rows of the anchor's label (highest score, then smallest key) are its
    positives; each gets the first ``negatives`` rows of other labels whose score is
    between ``share`` percent and all of its own. Where the key is divisible by
    ``moved``, the label is (label + 1) modulo ``labels``.

    Rows with a null key, label, vector or component or with a component that is not
    finite take no part. Vectors of different lengths meet on the components both have.
    A row that repeats the anchor's key is the anchor; rows that repeat another key with
    the same score and side count once; anchors that share a key but differ have rows
    each, equal ones once. Scores are exact and end at the range of 64 bits. Other
    columns are ignored; an empty table gives an empty one.

    Anchors go to the rows in blocks of about ``block_values`` components (or one
    anchor). A task returns only the pairs that can be among the answers: its first
    positives of an anchor, then, as the positive scores are known, its first negatives
    of each window. These few pairs take the secondary sort: ``repartition`` by anchor
    and ``sortWithinPartitions`` are the DataFrame's repartitionAndSortWithinPartitions.
    """
    spark = vectors.sparkSession
    rows = _wanted(vectors, key, vector, label, moved, labels)
    anchors = store(rows.where(F.col("id") % every == 0).distinct(), "anchors")
    size = anchors.agg(F.sum(F.size("q") + 2)).first()[0] or 0
    blocks = max(1, -(-2 * size // block_values))
    parts, so_far = [], 0
    for n in range(blocks):
        found = anchors.where(F.pmod(F.xxhash64("id", "label", "q"), F.lit(blocks)) == n).orderBy("id", "label", "q").collect()
        if not found:
            continue
        block = Anchors.of(found, so_far)
        pairs = store(_positives(rows, block, positives, cells), "positives")
        place = F.row_number().over(Window.partitionBy("anchor").orderBy("falling", "id"))
        pairs = pairs.distinct().withColumn("place", place).where(F.col("place") <= positives)
        windows = np.full((len(found), positives), -1, np.int64)
        first = pairs.collect()  # the positives of one block
        for r in first:
            windows[r["anchor"] - so_far, r["place"] - 1] = ~r["falling"]
        pairs = spark.createDataFrame([(r["anchor"], r["falling"], False, r["id"]) for r in first], _PAIR)
        pairs = pairs.unionByName(_negatives(rows, block, windows, negatives, share, cells))
        stream = pairs.repartition(shuffle_partitions(spark), "anchor").sortWithinPartitions("anchor", "falling", "negative", "id")
        mined = stream.mapInArrow(lambda batches: open_windows(batches, positives, negatives, share), _FOUND)
        names = spark.createDataFrame([(so_far + i, r["id"]) for i, r in enumerate(found)], "anchor long, anchor_id long")
        parts.append(store(mined.join(F.broadcast(names), "anchor").drop("anchor"), "negatives"))
        so_far += len(found)
    empty = spark.createDataFrame([], f"{_FOUND}, anchor_id long").drop("anchor")
    out = reduce(DataFrame.unionByName, parts, empty) if len(parts) != 1 else parts[0]
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
