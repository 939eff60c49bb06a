"""A hierarchical Pitman-Yor language model of words, sampled in parallel.

Every word that occurs in training is a context with a restaurant of its own; all of
them share one parent restaurant, whose base is uniform over the vocabulary and one
unknown word. In a sweep the customers of a dish are seated again one after the other,
given the tables of the other dishes as the sweep before left them.

A dish with one customer has one table whatever else happens, so only pairs of words
that were seen twice or more are sampled; the others enter by subtraction. Texts are
read once and stored as places in a list of their block's distinct words. Blocks ask
for words and pairs by buckets of their hashes and get the answers back by position,
so that keys travel once and no restaurant has to fit into one task.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, mix, shuffle_partitions, small_side, store, text_or_empty

END = np.uint64(0)  # the end token, and the context of first words; word hashes are odd
TOKENS = 1_500_000  # of a block; a longer text is a block of its own
ROWS = 250_000  # seated at a time
SALT = np.uint64(60)  # a context's pairs are spread by the first bits of the word
KEPT = 300_000
_words: dict[bytes, int] = {}


def _hashes(text: str) -> np.ndarray:
    """Words of a text and its end as 64-bit values."""
    words = ascii_lower(text.encode()).split()
    if len(_words) > KEPT:
        _words.clear()
    for w in set(words).difference(_words):
        _words[w] = struct.unpack("<Q", hashlib.blake2b(w, digest_size=8).digest())[0] | 1
    out = np.zeros(len(words) + 1, np.uint64)
    out[:-1] = list(map(_words.__getitem__, words))
    return out


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on key and step alone, so any task can repeat them."""
    return (mix(key + np.uint64((0x9E3779B97F4A7C15 * (step + 1)) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _rise(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """log Gamma(x + by) - log Gamma(x) for x of 16 or more."""
    y = x + by
    series = lambda z: (1 / 12 - (1 / 360 - 1 / (1260 * z * z)) / (z * z)) / z
    return (x - 0.5) * np.log1p(by / x) + by * np.log(y) - by + series(y) - series(x)


def seat(customers: np.ndarray, strength: float, discount: float, others: np.ndarray, above: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Tables of dishes after their customers have come in one by one.

    Customer k of a dish with t tables opens one with probability o / (o + k -
    discount * t), o = (strength + discount * (others + t)) * above; ``others`` counts
    the tables of the restaurant's other dishes and ``above`` is the probability of
    the dish in the parent. The first one always does. From some customers on, the
    next one to open a table is drawn directly: as the tables stay the same until
    then, the probability that m customers join is a quotient of gamma functions.
    """
    tables = (customers > 0).astype(np.float64)
    k, step = np.ones(len(customers)), 0
    busy = np.flatnonzero(customers > 1)
    while len(busy):
        t, at = tables[busy], k[busy]
        opening, joining = (strength + discount * (others[busy] + t)) * above[busy], at - discount * t
        u = _uniform(key[busy], step)
        opens, moved = u < opening / (opening + joining), np.ones(len(busy))
        far = np.flatnonzero(~opens & (joining >= 16))
        if len(far):
            x, o, left = joining[far], opening[far], customers[busy[far]] - at[far]
            target = np.log1p(-u[far])
            stays = lambda m: _rise(x, o) - _rise(x + m, o)  # log probability that m customers join
            last = stays(left) > target
            # the quotient is nearly a power: look around where that one ends first
            y = x + (o - 1) / 2
            guess = np.clip(np.floor(y * np.expm1(np.minimum(-target / o, 700.0))), 1, left)
            lo, hi = np.ones(len(far)), left.copy()
            for m in (np.maximum(guess - 1 - np.floor(guess / 1000), 1), np.minimum(guess + 2 + np.floor(guess / 1000), left)):
                more = stays(m) > target
                lo, hi = np.where(more, np.maximum(lo, m), lo), np.where(more, hi, np.minimum(hi, m))
            lo = np.where(last, left, lo)
            while np.any(hi - lo > 1):
                mid = np.floor((lo + hi) / 2)
                more = stays(mid) > target
                lo, hi = np.where(more, mid, lo), np.where(more, hi, mid)
            moved[far] = np.where(last, left, np.minimum(lo + 1, left))
            opens[far] = ~last
        tables[busy] += opens
        k[busy] += moved
        step += 1
        busy = busy[customers[busy] > k[busy]]
    return tables


class Sampler:
    """Sweeps over dishes, given the tables of the sweep before."""

    def __init__(self, vocabulary: int, discounts: tuple[float, float], strengths: tuple[float, float], seed: int):
        self.base = 1.0 / (vocabulary + 1)
        (self.d0, self.d1), (self.s0, self.s1), self.seed = discounts, strengths, seed
        self.customers: list[float] = []  # of the parent restaurant, per sweep
        self.tables: list[float] = []

    def above(self, customers, tables, i: int):
        """Predictive probability of words in the parent restaurant after sweep i (arrays or columns)."""
        return (customers - self.d0 * tables + (self.s0 + self.d0 * self.tables[i]) * self.base) / (self.s0 + self.customers[i])

    def left(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Share of a context's probability that goes through the parent."""
        return (self.s1 + self.d1 * tables) / (self.s1 + customers)

    def salt(self, i: int) -> np.uint64:
        return mix(np.array([self.seed * 1000 + i], np.uint64))[0]

    def dishes(self, u: np.ndarray, w: np.ndarray, count: np.ndarray, tables: np.ndarray, above: np.ndarray) -> list[np.ndarray]:
        """Tables of pairs after each sweep that the histories allow, and one more.

        Rows of ``tables`` (of the context) and ``above`` (probability of the word in
        the parent) are pairs, columns are sweeps. Sweep 0 opens one table.
        """
        key, found = mix(w ^ mix(u)), [np.ones(len(count))]
        for i in range(tables.shape[1]):
            found.append(seat(count, self.s1, self.d1, tables[:, i] - found[-1], above[:, i], key ^ self.salt(i + 1)))
        return found

    def parent(self, w: np.ndarray, customers: np.ndarray, before: np.ndarray | None, i: int) -> np.ndarray:
        """Tables of words in the parent after sweep i."""
        if before is None:
            return (customers > 0).astype(np.float64)
        return seat(customers, self.s0, self.d0, self.tables[i - 1] - before, np.full(len(w), self.base), mix(w) ^ self.salt(i))


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value, column after column."""
    data = [np.ascontiguousarray(a).tobytes() for a in arrays]
    raw = b"".join(data)
    return struct.pack(f"<{len(data) + 1}q", len(data), *map(len, data)) + pa.compress(raw, "zstd", asbytes=True)


def _unzip(value: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<q", value)
    sizes = struct.unpack_from(f"<{n}q", value, 8)
    raw = pa.decompress(memoryview(value)[8 + 8 * n :], sum(sizes), "zstd", asbytes=True)
    ends = np.cumsum([0, *sizes]).tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=_names(schema))


def _row(schema: str, *values) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return _batch(schema, *(pa.array([v], kinds[f.split()[1]]) for v, f in zip(values, schema.split(", "), strict=True)))


BLOCK = "block long, keys array<{kind}>, held array<boolean>, size long, data binary"


def encode(docs: DataFrame, key: str, text: str, held_out) -> DataFrame:
    """One row per block of neighbouring documents: their keys and whether they are
    held out, the number of tokens, and as data where each document ends, all tokens
    as places in the block's sorted list of distinct words, and these words."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        keys, held, tokens, total = [], [], [], 0

        def block() -> pa.RecordBatch:
            words, place = np.unique(np.concatenate(tokens), return_inverse=True)
            ends = np.cumsum([len(t) for t in tokens], dtype="<i8")
            lists = [pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), pa.concat_arrays(x)) for x in (keys, held)]
            return _batch(BLOCK, [part << 32 | number], *lists, [total], pa.array([_zip(ends, place.astype("<i4"), words)], pa.binary()))

        for b in batches:
            at = 0
            for i, t in enumerate(b.column(2)):
                tokens.append(_hashes(t.as_py()))
                total += len(tokens[-1])
                if total >= TOKENS or i == b.num_rows - 1:
                    keys.append(b.column(0).slice(at, i + 1 - at)), held.append(b.column(1).slice(at, i + 1 - at))
                    at = i + 1
                if total >= TOKENS:
                    yield block()
                    keys, held, tokens, total, number = [], [], [], 0, number + 1
        if tokens:
            yield block()

    rows = docs.select(F.col(key).alias("k"), held_out.alias("held"), text_or_empty(text).alias("t"))
    return rows.mapInArrow(run, BLOCK.format(kind=kind))


class Block:
    """Tokens of a block, its distinct words and pairs, and the buckets that know them."""

    def __init__(self, data: bytes, buckets: int):
        ends, place, words = _unzip(data)
        self.bounds = np.concatenate([[0], np.frombuffer(ends, "<i8")])
        self.place, self.words = np.frombuffer(place, "<i4").astype(np.int64), np.frombuffer(words, np.uint64)
        self.before = np.concatenate([[0], self.place[:-1]])  # the end is the first of the words
        self.before[self.bounds[:-1]] = 0
        codes, self.pair = np.unique(self.before << 32 | self.place, return_inverse=True)
        self.u, self.w = self.words[codes >> 32], self.words[codes & 0xFFFFFFFF]
        n = np.uint64(buckets)
        self.of_word = (mix(self.words) % n).astype(np.int64)
        self.of_pair = (mix(self.u + (self.w >> SALT)) % n).astype(np.int64) + buckets

    @staticmethod
    def parts(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Bucket and the places of what it knows, in order."""
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for at in np.split(order, cuts):
            if len(at):
                yield int(bucket[at[0]]), at


ASKED = "bucket long, block long, data binary"


def _asked(blocks: DataFrame, buckets: int) -> DataFrame:
    """What blocks ask: words with training counts in the first buckets, pairs in the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = Block(b.column(2)[i].as_py(), buckets)
                seen = np.repeat(~np.array(b.column(1)[i].as_py(), dtype=bool), np.diff(block.bounds))
                words = np.bincount(block.place[seen], minlength=len(block.words))
                pairs = np.bincount(block.pair[seen], minlength=len(block.u))
                for bucket, at in Block.parts(block.of_word):
                    yield _row(ASKED, bucket, b.column(0)[i].as_py(), _zip(block.words[at], words[at].astype("<u4")))
                for bucket, at in Block.parts(block.of_pair):
                    steps = np.diff(block.u[at], prepend=np.uint64(0))  # zero where a context goes on
                    yield _row(ASKED, bucket, b.column(0)[i].as_py(), _zip(steps, block.w[at], pairs[at].astype("<u4")))

    return blocks.select("block", "held", "data").mapInArrow(run, ASKED)


def _by(rows: DataFrame, partitions: int, *columns: str) -> DataFrame:
    return rows.repartition(partitions, columns[0]).sortWithinPartitions(*columns)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list]]]:
    """Runs of rows with the same first value."""
    known, rows = None, []
    for b in batches:
        for i in range(b.num_rows):
            row = [c[i].as_py() for c in b.columns]
            if rows and row[0] != known:
                yield known, rows
                rows = []
            known = row[0]
            rows.append(row)
    if rows:
        yield known, rows


LISTED = -1  # instead of a block: what the bucket knows


def _indexed(asked: DataFrame, buckets: int, partitions: int) -> DataFrame:
    """Per bucket its distinct words or pairs with their counts in all of training,
    and per block that asked, the places of what it asked for among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _groups(batches):
            parts = [_unzip(r[2]) for r in rows]
            sizes = [len(p[-1]) // 4 for p in parts]
            count = np.concatenate([np.frombuffer(p[-1], "<u4") for p in parts]).astype(np.int64)
            w = np.concatenate([np.frombuffer(p[-2], np.uint64) for p in parts])
            if bucket < buckets:
                u, order = np.zeros(0, np.uint64), np.argsort(w, kind="stable")
                new = np.diff(w[order]) != 0
            else:
                u = np.concatenate([np.cumsum(np.frombuffer(p[0], np.uint64)) for p in parts])
                order = np.lexsort((w, u))
                new = (np.diff(w[order]) != 0) | (np.diff(u[order]) != 0)
            first = np.concatenate([[True], new])
            place = np.empty(len(w), np.int64)
            place[order] = np.cumsum(first) - 1
            total = np.bincount(place, count).astype(np.int64)
            names = w[order][first]
            if bucket < buckets:
                yield _row(ASKED, bucket, LISTED, _zip(names, total))
            else:  # what was seen once or never has no draw
                some = total > 1
                yield _row(ASKED, bucket, LISTED, _zip(u[order][first][some], names[some], total))
            for r, part in zip(rows, np.split(place, np.cumsum(sizes)[:-1]), strict=True):
                yield _row(ASKED, bucket, r[1], _zip(np.diff(part, prepend=0).astype("<u4")))

    return _by(asked, partitions, "bucket", "block").mapInArrow(run, ASKED)


WORD = "w long, bucket long, i int, c long"
PAIR = "u long, w long, bucket long, i int, c long"


def _listed(index: DataFrame, pairs: bool, buckets: int) -> DataFrame:
    """Words of training, or its pairs that were seen twice or more, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                *names, total = _unzip(b.column(1)[i].as_py())
                count = np.frombuffer(total, np.int64)
                at = np.flatnonzero(count > (1 if pairs else 0))
                names = [np.frombuffer(x, np.int64) for x in names]
                if not pairs:
                    names = [x[at] for x in names]
                yield _batch(PAIR if pairs else WORD, *names, np.full(len(at), b.column(0)[i].as_py()), at.astype(np.int32), count[at])

    kind = F.col("bucket") >= buckets if pairs else F.col("bucket") < buckets
    return index.where((F.col("block") == LISTED) & kind).select("bucket", "data").mapInArrow(run, PAIR if pairs else WORD)


def _counts_of_counts(index: DataFrame, buckets: int) -> tuple[int, ...]:
    """Training tokens and distinct words; words, then pairs, seen once and twice."""
    schema = "tokens long, words long, once long, twice long, once_after long, twice_after long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                count, word = np.frombuffer(_unzip(b.column(1)[i].as_py())[-1], np.int64), b.column(0)[i].as_py() < buckets
                seen = [int((count == n).sum()) for n in (1, 2)]
                values = (int(count.sum()), int((count > 0).sum()), *seen, 0, 0) if word else (0, 0, 0, 0, *seen)
                yield _row(schema, *values)

    rows = index.where(F.col("block") == LISTED).select("bucket", "data").mapInArrow(run, schema)
    return tuple(rows.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in _names(schema))).first())


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.float64)


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches: a sweep takes steps for its largest dish, whatever the rows."""
    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


HISTORY = "tables array<long>, customers array<long>, parents array<long>"


def train(index: DataFrame, buckets: int, sweeps: int, strengths: tuple[float, float], seed: int) -> tuple[Sampler, DataFrame, DataFrame, int]:
    """Sampler, words with their histories (tables as context, customers and tables in
    the parent after each sweep), pairs with those of their words, and training tokens."""
    tokens, vocabulary, *seen = _counts_of_counts(index, buckets)
    discount = lambda x, y: min(0.95, max(0.1, x / (x + 2 * y))) if x + y else 0.5
    sampler = Sampler(vocabulary, (discount(*seen[:2]), discount(*seen[2:])), strengths, seed)
    words, pairs = _listed(index, False, buckets), _listed(index, True, buckets)

    # customers of a word's pairs that are sampled: with it as context, and after another word
    ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("c").alias("n"), F.lit(0).alias("m")), F.struct(F.col("w").alias("x"), F.lit(0).alias("n"), F.col("c").alias("m")))).alias("e"))
    active = store(ends.groupBy("e.x").agg(F.sum("e.n").alias("su"), F.sum("e.m").alias("sw")), "sampled")
    state = words.join(small_side(active), F.col("w") == F.col("x"), "left").drop("x")
    none = F.array().cast("array<long>")
    state = state.withColumns({"tables": none, "customers": none, "parents": none})

    def with_histories(state: DataFrame, *columns: str) -> DataFrame:
        above = [sampler.above(F.col("customers")[i], F.col("parents")[i], i) for i in range(len(sampler.tables))]
        known = small_side(store(state.where("su is not null").select("w", "tables", F.array(*above).alias("above")), "histories"))
        u, w = known.select(F.col("w").alias("u"), "tables"), known.select("w", "above")
        return pairs.select("u", "w", "c", *columns).join(u, "u").join(w, "w").select("u", "w", "c", "tables", "above", *columns)

    for i in range(sweeps):
        if i:

            def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in _large(batches):
                    u, w = _unsigned(b.column(0)), _unsigned(b.column(1))
                    t = sampler.dishes(u, w, b.column(2).to_numpy().astype(np.float64), *(_matrix(b.column(c), b.num_rows) for c in (3, 4)))[-1]
                    x, at = np.unique(np.concatenate([u, w]), return_inverse=True)
                    n = len(u)
                    sums = [np.bincount(part, t, len(x)).astype(np.int64) for part in (at[:n], at[n:])]
                    yield _batch("x long, tu long, tw long", x.view(np.int64), *sums)

            sums = with_histories(state).mapInArrow(tables, "x long, tu long, tw long")
        else:  # one table for each pair
            sums = ends.select("e.x", F.when(F.col("e.n") > 0, 1).otherwise(0).alias("tu"), F.when(F.col("e.m") > 0, 1).otherwise(0).alias("tw"))
        sums = store(sums.groupBy("x").agg(F.sum("tu").alias("tu"), F.sum("tw").alias("tw")), "tables")
        rest = lambda s, t: F.col("c") - F.coalesce(s, F.lit(0)) + F.coalesce(t, F.lit(0))
        after = state.join(small_side(sums), F.col("w") == F.col("x"), "left").select(
            *_names(WORD), "su", "sw", F.concat("tables", F.array(rest("su", "tu"))).alias("tables"), F.concat("customers", F.array(rest("sw", "tw"))).alias("customers"), "parents"
        )

        def parents(batches: Iterator[pa.RecordBatch], i: int = i) -> Iterator[pa.RecordBatch]:
            for b in _large(batches):
                customers, before = _matrix(b.column(7), b.num_rows), _matrix(b.column(8), b.num_rows)
                now = sampler.parent(_unsigned(b.column(0)), customers[:, i], before[:, -1] if i else None, i)
                grown = np.column_stack([before, now]).astype(np.int64)
                bounds = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (i + 1))
                yield _batch(schema, *b.columns[:8], pa.ListArray.from_arrays(bounds, pa.array(grown.ravel())))

        schema = f"{WORD}, su long, sw long, {HISTORY}"
        state = store(after.mapInArrow(parents, schema), "words")
        found = state.agg(*(F.coalesce(F.sum(F.element_at(c, -1)), F.lit(0)).cast("double") for c in ("customers", "parents"))).first()
        sampler.customers.append(found[0]), sampler.tables.append(found[1])
    return sampler, state, with_histories(state, "bucket", "i"), tokens


def _answered(index: DataFrame, sampler: Sampler, words: DataFrame, pairs: DataFrame, burn_in: int, buckets: int, partitions: int) -> DataFrame:
    """(block, bucket, data): what the buckets know, in the order in which blocks asked.

    Of words: training count, and per averaged sweep the probability in the parent
    and the share a context leaves to it. Of pairs: customers less discounts.
    """
    sweeps = len(sampler.tables)
    averaged, samples = range(burn_in, sweeps), sweeps - burn_in

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            count = b.column(2).to_numpy().astype(np.float64)
            tables, customers, parents = (_matrix(b.column(c), b.num_rows) for c in (3, 4, 5))
            above = [sampler.above(customers[:, i], parents[:, i], i) for i in averaged]
            left = [sampler.left(count, tables[:, i]) for i in averaged]
            values = np.column_stack([*above, *left]).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * (2 * samples)), pa.array(values.ravel()))
            yield _batch("bucket, i, x", *b.columns[:2], lists)

    def of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _large(batches):
            count = b.column(2).to_numpy().astype(np.float64)
            # the last sweep's tables follow from the histories before it
            history = [_matrix(b.column(c), b.num_rows)[:, :-1] for c in (3, 4)]
            tables = sampler.dishes(_unsigned(b.column(0)), _unsigned(b.column(1)), count, *history)
            value = count - sampler.d1 * np.mean(tables[burn_in:], axis=0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32)), pa.array(value.astype(np.float32)))
            yield _batch("bucket, i, x", b.column(5), b.column(6), lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = [sampler.above(np.zeros(1), np.zeros(1), i)[0] for i in averaged]
        bucket, at, values, table = None, [], [], None
        for b in batches:  # values of a bucket come first, then its list, then the places
            late = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], np.diff(b.column(0).to_numpy()) != 0, [True]])).tolist() if b.num_rows else [0]
            for lo, hi in zip(starts, starts[1:], strict=False):
                if b.column(0)[lo].as_py() != bucket:
                    bucket, at, values, table = b.column(0)[lo].as_py(), [], [], None
                word = bucket < buckets
                cut = lo + int(np.count_nonzero(~late[lo:hi]))
                if cut > lo:
                    part = b.slice(lo, cut - lo)
                    at.append(part.column(3).to_numpy()), values.append(_matrix(part.column(4), cut - lo))
                for r in range(cut, hi):
                    block, parts = b.column(1)[r].as_py(), _unzip(b.column(2)[r].as_py())
                    if block == LISTED:
                        total = np.frombuffer(parts[-1], np.int64)
                        if word:
                            table = np.tile([*unknown, *[1.0] * samples], (len(total), 1))
                        else:
                            table = np.where(total == 1, 1 - sampler.d1, 0.0)[:, None]
                        if at:
                            table[np.concatenate(at)] = np.concatenate(values)
                        at, values = [], []
                        continue
                    place = np.cumsum(np.frombuffer(parts[0], "<u4").astype(np.int64))
                    columns = [table[place, c].astype("<f4") for c in range(table.shape[1])]
                    yield _row("block long, bucket long, data binary", block, bucket, _zip(*([total[place]] if word else []), *columns))

    known = words.select("bucket", "i", "c", *_names(HISTORY)).mapInArrow(of_words, "bucket long, i int, x array<float>")
    known = known.unionByName(pairs.mapInArrow(of_pairs, "bucket long, i int, x array<float>"))
    known = known.select("bucket", F.lit(None).cast("long").alias("block"), F.lit(None).cast("binary").alias("data"), "i", "x")
    asked = index.select("bucket", "block", "data", F.lit(None).cast("int").alias("i"), F.lit(None).cast("array<float>").alias("x"))
    return _by(known.unionByName(asked), partitions, "bucket", "block").mapInArrow(run, "block long, bucket long, data binary")


def score(
    docs: DataFrame,
    held_out,
    *,
    key: str = "doc_id",
    text: str = "text",
    sweeps: int = 4,
    burn_in: int = 1,
    strengths: tuple[float, float] = (1.0, 1.0),
    seed: int = 1,
) -> DataFrame:
    """One row per row of docs: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased (A-Z) words and one end per text. The model learns from
    rows for which ``held_out`` (a column, null counts as false) is false; ``score`` is
    the sum of log10 of the probability, averaged over the sweeps after ``burn_in``, of
    each token after the one before. ``base_score`` is the add-one unigram score.

    Null and empty texts have the end alone. Null and repeated keys are scored by
    their own text. Without training rows the probability is uniform. An empty table
    gives an empty table; other columns are ignored.
    """
    if not 0 <= burn_in < sweeps:
        raise ValueError("burn_in must be below sweeps")
    blocks = store(encode(docs, key, text, F.coalesce(held_out, F.lit(False))), "blocks")
    size, n_blocks = blocks.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    least = shuffle_partitions(docs.sparkSession)
    buckets = max(least, size // TOKENS)  # so that a bucket is about as large as a block
    index = store(_indexed(_asked(blocks, buckets), buckets, buckets), "index")
    sampler, words, pairs, tokens = train(index, buckets, sweeps, strengths, seed)
    answers = _answered(index, sampler, words, pairs, burn_in, buckets, buckets)
    total, samples = tokens + int(round(1 / sampler.base)), sweeps - burn_in
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    results = "k, held_out, n_tokens, n_known, base_score, score"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = None, {}
        for b in batches:
            for r in range(b.num_rows):
                number, bucket, data = (b.column(c)[r].as_py() for c in range(3))
                if number != known:
                    known, found = number, {}
                if bucket is not None:  # a block comes after its answers
                    found[bucket] = data
                    continue
                block = Block(data, buckets)
                count, terms = np.zeros(len(block.words), np.int64), np.zeros((len(block.words), 2 * samples), np.float32)
                for bucket, at in Block.parts(block.of_word):
                    c, *columns = _unzip(found.pop(bucket))
                    count[at] = np.frombuffer(c, np.int64)
                    terms[at] = np.column_stack([np.frombuffer(x, "<f4") for x in columns])
                own = np.zeros(len(block.u))
                for bucket, at in Block.parts(block.of_pair):
                    own[at] = np.frombuffer(_unzip(found.pop(bucket))[0], "<f4")
                # per distinct pair, then per token
                u, w = (np.searchsorted(block.words, x) for x in (block.u, block.w))
                p = own / (sampler.s1 + count[u])
                for i in range(samples):
                    p += terms[w, i].astype(np.float64) * terms[u, samples + i] / samples
                starts = block.bounds[:-1]
                value = np.add.reduceat(np.log10(p)[block.pair], starts)
                base = np.add.reduceat(np.log10((count + 1) / total)[block.place], starts)
                seen = np.add.reduceat((count > 0).astype(np.int64)[block.place], starts)
                yield _batch(results, b.column(3)[r].values, b.column(4)[r].values, np.diff(block.bounds), seen, base, value)
                found = {}

    nothing = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in ("keys", "held")]
    texts = blocks.select("block", F.lit(None).cast("long").alias("bucket"), "data", "keys", "held")
    together = texts.unionByName(answers.select("block", "bucket", "data", *nothing))
    together = together.repartition(max(least, n_blocks), "block").sortWithinPartitions("block", F.col("bucket").asc_nulls_last())
    scored = together.mapInArrow(run, f"k {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("k").alias(key), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def held_out_by_checksum(key: str = "doc_id", parts: int = 7, part: int = 2):
    """Rows whose crc32 of the key as text leaves this remainder."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts == part


def perplexity(scored: DataFrame) -> pd.DataFrame:
    """Per held_out value: tokens, and perplexities of the base and of the model."""
    rate = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("tokens"), rate("base_score").alias("base"), rate("score").alias("model")).toPandas()
