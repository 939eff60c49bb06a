"""Token ids on disk as wavelet matrices, one per shard of consecutive documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import crc, shuffle_partitions, text_or_empty
from riskloom.llm.vocabulary import definition, encoder

BLOCK = 512  # bits per entry of the rank directory


class WaveletMatrix:
    """Bit planes of a sequence, highest bit first; each plane orders the next one.

    ``access``, ``rank``, ``count`` and ``select`` touch one bit per plane, with
    the number of ones before each block stored beside the planes.
    """

    def __init__(self, n: int, bits: int, planes: np.ndarray, zeros: list[int]):
        self.n, self.bits, self.planes, self.zeros = n, bits, planes, zeros
        per = BLOCK // 8
        ones = np.bitwise_count(planes).astype(np.int64)
        pad = -planes.shape[1] % per
        blocks = np.pad(ones, ((0, 0), (0, pad))).reshape(bits, -1, per).sum(axis=2)
        self.before = np.concatenate([np.zeros((bits, 1), np.int64), np.cumsum(blocks, axis=1)], axis=1)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        kind = np.uint16 if bits <= 16 else np.uint32
        x = np.asarray(ids).astype(kind)
        planes, zeros = np.zeros((bits, (len(x) + 7) // 8), np.uint8), []
        for level in range(bits):
            ones = (x & kind(1 << (bits - 1 - level))).astype(bool)
            planes[level] = np.packbits(ones)
            zeros.append(len(x) - int(np.count_nonzero(ones)))
            x = np.concatenate([x.compress(~ones), x.compress(ones)])
        return cls(len(x), bits, planes, zeros)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.bits, *self.zeros], dtype="<i8")
        return head.tobytes() + self.planes.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, bits = np.frombuffer(data, "<i8", 2).tolist()
        zeros = np.frombuffer(data, "<i8", bits, 16).tolist()
        planes = np.frombuffer(data, np.uint8, offset=16 + 8 * bits).reshape(bits, (n + 7) // 8)
        return cls(n, bits, planes, zeros)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        lo, hi = block * BLOCK // 8, i >> 3
        total = int(self.before[level, block]) + int(np.bitwise_count(self.planes[level, lo:hi]).sum())
        return total + (int(self.planes[level, hi]) >> (8 - (i & 7))).bit_count() if i & 7 else total

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        lo, hi = 0, end
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token before position ``end``."""
        if token >> self.bits:
            return 0
        lo, hi = self._range(token, min(max(end, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0); IndexError beyond the last."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, self.n)[0] + k
        for level in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - level) & 1
            want = at - self.zeros[level] if bit else at
            lo, hi = 0, self.n
            while lo < hi:  # first position whose prefix holds want + 1 such bits
                mid = (lo + hi) // 2
                ones = self._ones(level, mid + 1)
                if (ones if bit else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            at = lo
        return at

    def decode(self) -> np.ndarray:
        """The whole sequence: planes are undone from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for level in reversed(range(self.bits)):
            ones = np.unpackbits(self.planes[level], count=self.n).astype(bool)
            up = np.empty_like(values)
            up[np.flatnonzero(~ones)] = values[: self.zeros[level]]
            up[np.flatnonzero(ones)] = values[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            values = up
        return values


SHARDS = "part int, shard int, before long, doc_ids array<{kind}>, lengths array<long>, matrix binary"


def write_shards(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, *, key: str = "doc_id", text: str = "text", shard_tokens: int = 1 << 20
) -> None:
    """Encode all texts, in ascending key order, into shard files under ``path``.

    Rows are range-partitioned by key, so files follow the order of keys. A shard
    closes after the document that reaches ``shard_tokens``; it holds its
    documents' keys and lengths and one wavelet matrix with all ids. Spark's
    writer commits the files, so a task that runs twice leaves one copy. Null text
    counts as empty (the end id alone); null keys come first; rows with equal keys
    are ordered by the hash of their text; an empty table writes no shard.
    """
    source = definition(tokenizer_path)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(source), TaskContext.get().partitionId()
        bits = max(encode.bits, int(end_id).bit_length())
        shard, before, held, ids, keys, lengths, schema = 0, 0, 0, [], [], [], None

        def close() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(ids), bits).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([keys], pa.list_(schema)), pa.array([lengths], pa.list_(pa.int64())), pa.array([matrix], pa.binary())],
                names=["part", "shard", "before", "doc_ids", "lengths", "matrix"],
            )

        for b in batches:
            schema = b.schema.field(0).type
            for k, found in zip(b.column(0).to_pylist(), encode.many(b.column(1).to_pylist()), strict=True):
                ids += [found, np.array([end_id], "<u4")]
                keys.append(k)
                lengths.append(len(found) + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield close()
                    shard, before, held, ids, keys, lengths = shard + 1, before + held, 0, [], [], []
        if keys:
            yield close()

    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), text_or_empty(text).alias("t")).repartitionByRange(n, "k")
    rows = rows.sortWithinPartitions("k", F.xxhash64("t"))
    rows.mapInArrow(run, SHARDS.format(kind=kind)).write.option("compression", "zstd").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """The shard rows: part, shard, before (ids earlier in the part), doc_ids, lengths, matrix (see ``WaveletMatrix``)."""
    return spark.read.parquet(path)


def documents_of(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read shards back: key, start (ids of all documents before it), n_tokens, ids_crc32.

    A shard knows the ids before it in its range partition; the partitions' totals
    (one row per partition of the writing job, so few) are added up and broadcast.
    """
    n = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = shards.groupBy("part").agg(F.sum(n).alias("total"))
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids = WaveletMatrix.from_bytes(b.column(3)[i].as_py()).decode()
                lengths = np.array(b.column(2)[i].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                begins = ends - lengths
                sums = [crc(ids[s:e]) for s, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                keys = b.column(1)[i].values
                first = b.column(0)[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(begins + first), pa.array(lengths), pa.array(sums, pa.int64())], names=["k", "start", "n_tokens", "ids_crc32"]
                )

    rows = shards.join(F.broadcast(parts), "part").select((F.col("base") + F.col("before")).alias("first"), "doc_ids", "lengths", "matrix")
    return rows.mapInArrow(run, f"k {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("k", key)

