"""Ranked search of all documents for the terms of all items, without an index.

The terms of the items form one Aho-Corasick automaton, which travels to the
documents and counts its terms straight from their texts. Two scans: the first
counts in how many documents each term is, the second scores and keeps the best
documents of each item.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import store, text_or_empty

# Fixed values of the ranking: saturation and length share in thousandths.
SCALE, GAIN, LENGTH_WEIGHT, LENGTH_SHARE = 1_000_000_000, 1_000, 8, 75

SPACE = 32
_INSIDE = [b for b in range(256) if b >= 0x80 or chr(b).isalnum()]
# bytes of terms as they are, A-Z in lower case, everything else as the guard
_TABLE = bytes(ord(chr(b).lower()) if b < 0x80 and b in _INSIDE else b if b in _INSIDE else SPACE for b in range(256))
PIECE = 1 << 20  # bytes that are scanned at once, cut between terms
CELLS = 2_000_000  # scores of documents times items that are held at once

_built: dict[bytes, ahocorasick.Automaton] = {}


def normal(text: bytes) -> bytes:
    """UTF-8 text with one guard in place of each byte outside of terms."""
    return text.translate(_TABLE)


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds the terms between guards; the last one built stays in the worker."""
    name = hashlib.blake2b(b" ".join(terms)).digest()
    if name not in _built:
        _built.clear()
        found = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            found.add_word(f" {term.decode('latin-1')} ", i)
        found.make_automaton()
        _built[name] = found
    return _built[name]


def _pieces(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Normalised texts in groups of about PIECE bytes, with the numbers of their
    texts; long texts in several pieces, never cut inside a term."""
    numbers, group, size = [], [], 0
    for i, text in enumerate(texts):
        text, start = normal(text), 0
        while True:
            cut = -1 if len(text) - start <= PIECE else text.find(b" ", start + PIECE)
            piece = text[start:] if cut < 0 else text[start:cut]
            numbers.append(i), group.append(piece)
            size += len(piece)
            if size >= PIECE:
                yield numbers, group
                numbers, group, size = [], [], 0
            if cut < 0:
                break
            start = cut
    if group:
        yield numbers, group


@dataclass(frozen=True)
class Counts:
    """Terms of a batch of texts: n per text, and (text, term, tf) in rows."""

    n: np.ndarray
    text: np.ndarray
    term: np.ndarray
    tf: np.ndarray


def count_terms(texts: list[bytes], terms: list[bytes]) -> Counts:
    find = automaton(terms).iter if terms else None
    n, keys = np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)]
    for numbers, group in _pieces(texts):
        joined = b" " + b" ".join(group) + b" "
        starts = np.cumsum([0] + [len(p) + 1 for p in group[:-1]])  # of the guard before each piece
        inside = np.frombuffer(joined, np.uint8) != SPACE
        begins = np.zeros(len(joined), np.int64)
        begins[:-1] = inside[1:] & ~inside[:-1]  # counted at the guard before the term
        np.add.at(n, numbers, np.add.reduceat(begins, starts))
        if find is not None:
            hits = np.fromiter(chain.from_iterable(find(joined.decode("latin-1"))), np.int64)
            piece = np.searchsorted(starts, hits[::2], "left") - 1  # the closing guard may be the next piece's
            keys.append(np.asarray(numbers, np.int64)[piece] * len(terms) + hits[1::2])
    found, tf = np.unique(np.concatenate(keys), return_counts=True)
    return Counts(n, found // max(1, len(terms)), found % max(1, len(terms)), tf.astype(np.int64))


@dataclass(frozen=True)
class Items:
    """The terms of a block of items, and the items and repeats behind each term."""

    terms: list[bytes]
    start: np.ndarray  # of each term in the two below
    item: np.ndarray
    repeats: np.ndarray
    size: int

    @staticmethod
    def of(texts: list[bytes]) -> Items:
        behind: dict[bytes, list[tuple[int, int]]] = {}
        for i, text in enumerate(texts):
            for term, c in Counter(normal(text).split()).items():
                behind.setdefault(term, []).append((i, c))
        terms = sorted(behind)
        pairs = np.array([p for t in terms for p in behind[t]], np.int64).reshape(-1, 2)
        start = np.cumsum([0] + [len(behind[t]) for t in terms])
        return Items(terms, start, pairs[:, 0], pairs[:, 1], len(texts))

    def scores(self, counts: Counts, first: int, last: int, weight: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Texts first to last by items, in 64-bit integers."""
        here = slice(*np.searchsorted(counts.text, [first, last]))
        text, term, tf = counts.text[here], counts.term[here], counts.tf[here]
        gain = weight[term] * ((SCALE * tf) // (GAIN * tf + LENGTH_WEIGHT * m[text]))
        out = np.zeros((last - first) * self.size, np.int64)
        many = self.start[term + 1] - self.start[term]
        # in steps, as one term may stand for many items
        steps = np.flatnonzero(np.diff(np.cumsum(many) // CELLS, prepend=-1))
        for a, b in pairwise([*steps, len(term)]):
            reach = many[a:b]
            at = np.repeat(self.start[term[a:b]] - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
            cell = np.repeat((text[a:b] - first) * self.size, reach) + self.item[at]
            np.add.at(out, cell, np.repeat(gain[a:b], reach) * self.repeats[at])
        return out.reshape(last - first, self.size)


def _best(rows: pa.Table, top: int) -> pa.Table:
    """The first rows of each item: highest score, then smallest key, null last."""
    rows = rows.sort_by([("item", "ascending"), ("score", "descending"), ("key", "ascending")])
    item = rows.column("item").to_numpy()
    first = np.searchsorted(item, item, "left")
    return rows.filter(pa.array(np.arange(len(item)) - first < top))


def _survey(docs: DataFrame, items: Items) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all terms with repeats, and documents per term of the block."""
    terms = items.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, total, df = 0, 0, np.zeros(len(terms), np.int64)
        for b in batches:
            counts = count_terms(b.column(1).to_pylist(), terms)
            some, total = some + int((counts.n > 0).sum()), total + int(counts.n.sum())
            df += np.bincount(counts.term, minlength=len(terms))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], seen])), pa.array(np.concatenate([[some, total], df[seen]]))], names=["term", "n"])

    sums = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in sums}
    df = np.array([found.get(i, 0) for i in range(len(terms))], np.int64)
    return found.get(-2, 0), found.get(-1, 0), df


def _ranked(docs: DataFrame, items: Items, total: int, length: int, weight: np.ndarray, top: int, kind: str) -> DataFrame:
    """(item, key, score): the best documents of each item and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, least = None, np.ones(items.size, np.int64)  # what a score must reach
        for b in batches:
            counts = count_terms(b.column(1).to_pylist(), items.terms)
            m = 100 - LENGTH_SHARE + LENGTH_SHARE * counts.n * total // length
            step = max(1, CELLS // items.size)
            for first in range(0, b.num_rows, step):
                last = min(first + step, b.num_rows)
                scores = items.scores(counts, first, last, weight, m)
                text, item = np.nonzero(scores >= least)
                if not len(text):
                    continue
                new = pa.table({"item": item, "key": b.column(0).take(pa.array(text + first)), "score": scores[text, item]})
                best = _best(new if best is None else pa.concat_tables([best, new]), top)
                full = np.bincount(best.column("item").to_numpy(), minlength=items.size) == top
                lowest = np.full(items.size, np.iinfo(np.int64).max)
                np.minimum.at(lowest, best.column("item").to_numpy(), best.column("score").to_numpy())
                least = np.where(full, lowest, 1)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return docs.mapInArrow(run, f"item long, key {kind}, score long")


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    top: int = 10,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    block_chars: int = 4_000_000,
) -> DataFrame:
    """item, rank, key, score: the best documents of each item, by falling score and
    rising key, score above 0.

    Terms are runs of letters and digits of ASCII and of all characters beyond it, A-Z
    in lower case. Null and empty texts have no terms: such items find nothing, such
    documents are not found. Rows of documents that repeat are ranked each; null keys
    come last among equal scores. Items that repeat with the same text count once; texts
    that share an item are ranked each on their own. Other columns are ignored; empty
    tables give an empty one.

    Items go to the documents in blocks of about ``block_chars`` characters (or one
    item), so what travels is bounded; documents are scanned twice per block and never
    move. What a task returns is bounded by ``top`` rows per item.
    """
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    queries = store(benchmark.select(F.col(item).alias("i"), text_or_empty(text).cast("binary").alias("t")).distinct(), "items")
    blocks = max(1, -(-2 * (queries.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_chars))
    rows = docs.select(F.col(key).alias("k"), text_or_empty(text).cast("binary").alias("t"))
    parts = []
    for block in range(blocks):
        found = queries.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).orderBy("i", "t").collect()
        items = Items.of([bytes(r["t"]) for r in found])
        if not items.terms:
            continue
        total, length, df = _survey(rows, items)
        if not total:
            break
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        ranked = _ranked(rows, items, total, length, weight, top, kind)
        names = rows.sparkSession.createDataFrame([(n, r["i"]) for n, r in enumerate(found)], f"item long, name {item_kind}")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        parts.append(store(ranked.join(F.broadcast(names), "item").select(F.col("name").alias(item), "rank", F.col("key").alias(key), "score"), "ranked"))
    if not parts:
        return queries.select(F.col("i").alias(item), F.lit(0).alias("rank"), F.lit(None).cast(kind).alias(key), F.lit(0).cast("long").alias("score")).where("false")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
