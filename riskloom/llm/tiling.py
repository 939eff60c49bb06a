"""Benchmark passages in documents by greedy string tiling."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix, store, text_or_empty

TOKEN = re.compile(r"\w+")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
KEPT = 300_000
_words: dict[str, int] = {}


def token_hashes(text: str) -> np.ndarray:
    """Lower-cased runs of letters, digits and underscores as 64-bit values."""
    words = TOKEN.findall(text.lower())
    try:
        return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(_words) > KEPT:
            _words.clear()
        for w in words:
            if w not in _words:
                _words[w] = struct.unpack("<Q", hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest())[0]
        return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def running_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` tokens, scrambled."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if size <= 8:
        out = np.zeros(n, np.uint64)
        for k in range(size):
            out = out * BASE + tokens[k : k + n]
        return mix(out)
    powers, inverse = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(tokens), b)])) for b in (BASE, INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens * powers[:-1])])
    return mix((sums[size:] - sums[:n]) * inverse[:n])


def tile(pattern: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (pattern start, text start, length) of the tiles.

    The longest common run of unmarked tokens is found by bisection over its length
    (a run of s tokens contains one of s - 1), with Karp-Rabin hashes of the unmarked
    windows of both sides at each length; matches of that length are marked from left
    to right, and the search goes on until no run of ``least`` tokens is left.
    """
    used_p, used_t = np.zeros(len(pattern), bool), np.zeros(len(text), bool)
    tiles: list[tuple[int, int, int]] = []

    def windows(tokens: np.ndarray, used: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        marked = np.concatenate([[0], np.cumsum(used)])
        free = np.flatnonzero(marked[size:] == marked[: len(marked) - size])
        return free, running_hashes(tokens, size)[free]

    def meet(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        if size > min(len(pattern), len(text)):
            return None
        p, hp = windows(pattern, used_p, size)
        t, ht = windows(text, used_t, size)
        hits = np.isin(ht, hp)
        return (p, hp, t[hits], ht[hits]) if hits.any() else None

    longest = min(len(pattern), len(text))
    while longest >= least:
        low, high = least - 1, longest
        if meet(longest):
            low = longest
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if meet(mid) else (low, mid - 1)
        found = meet(low) if low >= least else None
        if found is None:
            break
        p, hp, t, ht = found
        places: dict[int, list[int]] = {}
        for at, h in zip(t.tolist(), ht.tolist(), strict=True):
            places.setdefault(h, []).append(at)
        for a, h in zip(p.tolist(), hp.tolist(), strict=True):
            if used_p[a : a + low].any():
                continue
            for b in places.get(h, ()):
                if not used_t[b : b + low].any() and (pattern[a : a + low] == text[b : b + low]).all():
                    used_p[a : a + low] = used_t[b : b + low] = True
                    tiles.append((a, b, low))
                    break
        longest = low
        if not tiles or tiles[-1][2] != low:  # only hash collisions at this length
            longest = low - 1
    return tiles


class Items:
    """Benchmark items of one block, indexed by the hashes of their seeds."""

    def __init__(self, texts: list[str], least: int):
        self.tokens = [token_hashes(t) for t in texts]
        self.least = [min(least, len(t)) for t in self.tokens]
        self.sizes = sorted({s for s in self.least if s})
        self.seeds: dict[int, tuple[np.ndarray, ...]] = {}
        for size in self.sizes:
            grams, items, places = [], [], []
            for i, t in enumerate(self.tokens):
                if self.least[i] == size:
                    h = running_hashes(t, size)
                    grams.append(h), items.append(np.full(len(h), i)), places.append(np.arange(len(h)))
            g, i, p = (np.concatenate(x) for x in (grams, items, places))
            order = np.argsort(g, kind="stable")
            self.seeds[size] = g[order], i[order], p[order]

    def matches(self, tokens: np.ndarray, threshold: float) -> list[tuple[int, float, int]]:
        """(item, share of its tokens in tiles, number of tiles) at or above the threshold."""
        out = []
        for size in self.sizes:
            grams, items, places = self.seeds[size]
            h = running_hashes(tokens, size)
            at = np.searchsorted(grams, h)
            hit = np.flatnonzero(grams[np.minimum(at, len(grams) - 1)] == h)
            if not len(hit):
                continue
            # every seed of every item that the hit windows stand for
            first, last = at[hit], np.searchsorted(grams, h[hit], "right")
            count = last - first
            row = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            where, item, place = np.repeat(hit, count), items[row], places[row]
            for i in np.unique(item).tolist():
                mine = item == i
                pattern = self.tokens[i]
                # no tiling covers more than all its seeds do
                reach = np.zeros(len(pattern) + 1, np.int64)
                starts = np.unique(place[mine])
                np.add.at(reach, starts, 1), np.add.at(reach, starts + size, -1)
                if (np.cumsum(reach)[:-1] > 0).sum() < threshold * len(pattern):
                    continue
                starts = np.unique(where[mine])
                inside = np.zeros(len(tokens) + 1, np.int64)
                np.add.at(inside, starts, 1), np.add.at(inside, starts + size, -1)
                inside = np.cumsum(inside)[:-1] > 0
                # only the text around seeds, with a strange token between the parts
                keep = np.flatnonzero(inside)
                parts = np.split(tokens[keep], np.flatnonzero(np.diff(keep) > 1) + 1)
                gap = mix(np.array([len(tokens)], np.uint64) ^ BASE)
                text = np.concatenate([x for part in parts for x in (part, gap)])
                tiles = tile(pattern, text, size)
                share = sum(n for *_, n in tiles) / len(pattern)
                if share >= threshold:
                    out.append((i, share, len(tiles)))
        return out


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = 0.5,
    least: int = 5,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    block_tokens: int = 2_000_000,
) -> DataFrame:
    """(key, text_hash, item, coverage, n_tiles): documents that hold benchmark items.

    Coverage is the share of the item's tokens that greedy tiles of at least ``least``
    tokens (all tokens for shorter items) find in the document, so moved sentences
    still count. Documents are read once per block of items; a block has at most
    ``block_tokens`` tokens (or one item) and travels to the tasks, documents never
    move. Null or empty documents and items match nothing; rows that repeat key and
    text give one row per item; items that repeat give a row each; other columns are
    ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    item_kind = benchmark.schema[item].dataType.simpleString()
    # items in blocks by their length in characters, an upper bound of their tokens
    sizes = benchmark.select(F.length(text_or_empty(text)).cast("long").alias("n"))
    blocks = max(1, -(-2 * (sizes.agg(F.sum("n")).first()[0] or 0) // block_tokens))
    numbered = benchmark.select(F.col(item).alias("i"), text_or_empty(text).alias("t")).withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text_or_empty(text)).alias("h"), text_or_empty(text).alias("t"))
    out = None
    for block in range(blocks):
        part = numbered.where(F.col("b") == block).orderBy("i", "t").collect()
        if not part:
            continue
        names, texts = [r["i"] for r in part], [r["t"] for r in part]

        def run(batches: Iterator[pa.RecordBatch], names=names, texts=texts) -> Iterator[pa.RecordBatch]:
            items = Items(texts, least)
            for b in batches:
                at, found = [], []
                for i, t in enumerate(b.column(2).to_pylist()):
                    for hit in items.matches(token_hashes(t), threshold):
                        at.append(i), found.append(hit)
                take = pa.array(at, pa.int64())
                schema_type = pa.array(names).type
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array([names[i] for i, *_ in found], schema_type), pa.array([c for _, c, _ in found], pa.float64()), pa.array([n for *_, n in found], pa.int32())],
                    names=["k", "h", "i", "coverage", "n_tiles"],
                )

        hits = rows.mapInArrow(run, f"k {kind}, h long, i {item_kind}, coverage double, n_tiles int")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = rows.select("k", "h", F.lit(None).cast(item_kind).alias("i"), F.lit(0.0).alias("coverage"), F.lit(0).alias("n_tiles")).where("false")
    out = out.dropDuplicates(["k", "h", "i", "coverage", "n_tiles"])
    return out.select(F.col("k").alias(key), F.col("h").alias("text_hash"), F.col("i").alias(item), "coverage", "n_tiles")


def contamination_report(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", **options) -> DataFrame:
    """Per row of docs: key, n_items, best_item, coverage (of the best item; smallest
    item on ties), items (sorted) and contaminated."""
    hits = store(contamination(docs, benchmark, key=key, text=text, item=item, **options), "hits")
    best = F.min_by(item, F.struct(-F.col("coverage"), F.col(item)))
    found = hits.groupBy(F.col(key).alias("_k"), F.col("text_hash").alias("_h")).agg(
        F.countDistinct(item).alias("n_items"), best.alias("best_item"), F.max("coverage").alias("coverage"), F.sort_array(F.collect_set(item)).alias("items")
    )
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text_or_empty(text)).alias("h"))
    out = rows.join(found, F.col("k").eqNullSafe(F.col("_k")) & (F.col("h") == F.col("_h")), "left")
    return out.select(
        F.col("k").alias(key),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "best_item",
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        "items",
        F.col("_h").isNotNull().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of docs that hold no benchmark item (see ``contamination``)."""
    hits = contamination(docs, benchmark, key=key, text=text, **options)
    hits = store(hits.select(F.col(key).alias("_k"), F.col("text_hash").alias("_h")).distinct(), "leaks")
    return docs.join(hits, docs[key].eqNullSafe(hits["_k"]) & (F.xxhash64(text_or_empty(text)) == hits["_h"]), "left_anti")
