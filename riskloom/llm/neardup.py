"""Near-duplicate documents by banded SetSketch registers, confirmed on full sets."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, mix, small_side, store, text_or_empty
from riskloom.llm.components import components
from riskloom.llm.sketch import SetSketch

KEPT = 300_000
ROWS = 4  # registers per band
BANDS = 28
MARGIN = 0.25  # about six standard deviations of the likelihood estimate
SLICE = 500  # documents per result batch
_words: dict[bytes, int] = {}


class Shingler:
    """Distinct word n-grams of a text as sorted 64-bit values."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, text: str) -> np.ndarray:
        words = ascii_lower(text.encode()).split()
        if not words:
            return np.zeros(0, np.uint64)
        try:
            ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(_words) > KEPT:
                _words.clear()
            for w in words:
                if w not in _words:
                    _words[w] = struct.unpack("<Q", hashlib.blake2b(w, digest_size=8).digest())[0]
            ids = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(ids))
        out = np.full(len(ids) - n + 1, n, np.uint64)
        for i in range(n):
            out = mix(out ^ ids[i : len(ids) - n + 1 + i])
        return np.unique(out)


def _binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


def sketches(docs: DataFrame, size: int, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: k, h (hash of the text), n (distinct shingles), class (digest of the set), registers, bands."""
    kind = docs.schema[key].dataType.simpleString()
    shingle, sketch = Shingler(size), SetSketch(ROWS * BANDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                n, digests, registers, bands = [], [], [], []
                for t in b.column(2).to_pylist():
                    s = shingle(t)
                    n.append(len(s))
                    if not len(s):
                        digests.append(None), registers.append(None), bands.append(None)
                        continue
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    r = sketch.registers(s)
                    registers.append(r.tobytes())
                    folded = np.arange(BANDS, dtype=np.uint64) << np.uint64(32)
                    for part in r.astype(np.uint64).reshape(BANDS, ROWS).T:
                        folded = mix(folded ^ part)
                    bands.append(folded.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n, pa.int64()), _binary(digests), _binary(registers), pa.array(bands, pa.list_(pa.int64()))],
                    names=["k", "h", "n", "class", "registers", "bands"],
                )

    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text_or_empty(text)).alias("h"), text_or_empty(text).alias("t"))
    return rows.mapInArrow(run, f"k {kind}, h long, n long, class binary, registers binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """(class, shingles) of the wanted classes, from the text of each class's first document."""
    shingle = Shingler(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                sets = [shingle(t) for t in b.column(1).to_pylist()]
                same = [len(s) > 0 and hashlib.blake2b(s.tobytes(), digest_size=16).digest() == c for s, c in zip(sets, b.column(0).to_pylist(), strict=True)]
                out = [s.tobytes() if ok else None for s, ok in zip(sets, same, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), _binary(out)], names=["class", "shingles"])

    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text_or_empty(text)).alias("h"), text_or_empty(text).alias("t"))
    # by key and text, so that null and repeated keys do not meet all of their rows
    same = F.col("k").eqNullSafe(F.col("first")) & (F.col("h") == F.col("first_h"))
    rows = rows.join(wanted.select("class", "first", "first_h"), same).select("class", "t")
    # equal hashes can bring another text; repeated rows bring the same set twice
    return rows.mapInArrow(run, "class binary, shingles binary").where("shingles is not null").groupBy("class").agg(F.first("shingles").alias("shingles"))


def _estimated(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs whose estimated similarity reaches ``least``."""
    sketch = SetSketch(ROWS * BANDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            a, c = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(b.num_rows, -1) for i in (2, 3))
            sizes = [b.column(i).to_numpy().astype(float) for i in (4, 5)]
            keep = pa.array(sketch.similarity(a, c, *sizes) >= least)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    side = classes.select("class", "registers", "n")
    a, b = (side.select(F.col("class").alias(x), F.col("registers").alias(f"r{x}"), F.col("n").alias(f"n{x}")) for x in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ra", "rb", "na", "nb").mapInArrow(run, "a binary, b binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs with whole * intersection >= part * union, on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(whole * common >= part * (len(p) + len(q) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["a", "b"])

    a, b = (sets.select(F.col("class").alias(x), F.col("shingles").alias(f"s{x}")) for x in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _exploded(rows: DataFrame) -> DataFrame:
    """(g, c, s): one row per shingle of rows (g, c, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, SLICE):
                b = whole_batch.slice(at, SLICE)
                found = [np.frombuffer(s.as_buffer(), np.int64) for s in b.column(2)]
                if not found:
                    continue
                times = [len(s) for s in found]
                g, c = (pa.array(np.repeat(b.column(i).to_numpy(), times)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([g, c, pa.array(np.concatenate(found))], names=["g", "c", "s"])

    return rows.mapInArrow(run, "g long, c long, s long")


def _differences(rows: DataFrame) -> DataFrame:
    """(c, size, s, times) per row (c, size, shingles, core, times): how many shingles
    are in the row's set or the core but not in both, and the core's shingles that the
    set lacks, with the number of sets that lack them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, SLICE):
                b = whole_batch.slice(at, SLICE)
                apart, lacking, lacked = [], [], []
                for i in range(b.num_rows):
                    own, core = np.frombuffer(b.column(2)[i].as_buffer(), np.int64), b.column(3)[i].values.to_numpy()
                    there = np.isin(core, own)
                    apart.append(len(own) + len(core) - 2 * int(there.sum()))
                    lacking.append(core[~there])
                    lacked.append(b.column(1)[i].as_py() - b.column(4)[i].values.to_numpy()[~there])
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (lacking, lacked)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(apart, pa.int64()), *lists], names=["c", "apart", "s", "times"])

    return rows.mapInArrow(run, "c long, apart long, s array<long>, times array<long>")


GROUP_PART = 256  # classes of a group that meet one copy of its core


def _apart(left: DataFrame, classes: DataFrame, sets: DataFrame, part: int, whole: int) -> tuple[DataFrame, DataFrame]:
    """What decides about pairs within a group of classes: (class, center) and
    (class, g, s, t, at, m). ``left`` has the buckets (band, class, label) that are not
    connected; the classes of a bucket are all in one group, a class can be in several.

    A group's core are the shingles of more than half of its sets. With d the number of
    shingles in a set or the core but not in both, and o the number of these that two
    sets have in common, the sets differ in d + d' - 2 o shingles. So they are similar
    if and only if 2 (whole + part) o >= t + t', with t = (whole + part) d - (whole -
    part) n. Where the right side is at most 0, both sets are similar to the one with
    the smallest t, the group's center. Else o is 1 or more, and as many of the rarest
    differences (s) of each set as leave less than the least o that could do meet in
    one of them; ``at`` counts them from 1, rarest first, of ``m`` that some other set
    has too.
    """
    # named by the component that most classes of a bucket are in, so that buckets of one
    # group name it alike, and a chance bucket joins few classes of another one to it
    most = left.groupBy("band", "label").agg(F.count("*").alias("times")).groupBy("band").agg(F.max(F.struct("times", "label"))["label"].alias("group"))
    groups = left.join(most, "band").select("class", F.xxhash64("group").alias("g")).distinct()
    number = F.xxhash64("class", "g").alias("c")
    members = groups.join(sets, "class").join(classes.select("class", "n"), "class").select("class", number, "g", "n", "shingles")
    members = store(members, "members")
    shingles = _exploded(members.select("g", "c", "shingles"))
    sizes = store(members.groupBy("g").agg(F.count("*").alias("size")), "groups")
    times = shingles.groupBy("g", "s").agg(F.count("*").alias("times")).where("times > 1")
    times = store(times.join(small_side(sizes), "g"), "times")
    in_core = F.col("times") * 2 > F.col("size")
    # the core goes to parts of bounded size, so that no task meets a whole large group
    parts = F.ceil(F.col("size") / GROUP_PART).cast("long")
    core = times.where(in_core).groupBy("g").agg(F.collect_list(F.struct("s", "times")).alias("core"))
    core = sizes.join(core, "g", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    nothing = F.array().cast("array<struct<s:bigint,times:bigint>>")
    core = core.select("g", "part", "size", F.coalesce("core", nothing).alias("core"))
    dealt = members.join(small_side(sizes), "g").withColumn("part", F.pmod("c", parts)).drop("size")
    met = dealt.join(core, ["g", "part"]).select("c", "size", "shingles", F.col("core.s").alias("core"), F.col("core.times").alias("times"))
    # the order of the columns is that of the reader
    apart = store(_differences(met.select("c", "size", "shingles", "core", "times")), "apart")
    t = (whole + part) * F.col("apart") - (whole - part) * F.col("n")
    named = store(members.drop("shingles").join(apart.select("c", "apart"), "c").select("class", "c", "g", t.alias("t")), "named")
    centers = named.groupBy("g").agg(F.min("t").alias("least"), F.min_by("class", F.struct("t", "class")).alias("center"))
    named = store(named.join(small_side(store(centers, "centers")), "g"), "centered")

    lacks = apart.select("c", F.explode(F.arrays_zip("s", "times")).alias("e")).select("c", "e.s", "e.times").where("times > 1")
    rare = times.where(~in_core).select("g", "s", "times")
    has = shingles.join(rare, ["g", "s"]).select("c", "s", "times")
    rows = lacks.unionByName(has).withColumn("at", F.row_number().over(Window.partitionBy("c").orderBy("times", "s")))
    rows = rows.withColumn("m", F.count("*").over(Window.partitionBy("c")))
    rows = rows.join(named, "c")
    fewest = F.greatest(F.lit(1), F.ceil((F.col("t") + F.col("least")) / (2 * (whole + part))))
    rows = rows.where(F.col("at") <= F.col("m") - fewest + 1).select("class", "g", "s", "t", "at", "m")
    return named.select("class", "center"), store(rows, "differences")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``label`` of each row's class: its component so far, or the class itself."""
    return rows.join(labels, rows["class"] == labels["node"], "left").withColumn("label", F.coalesce("label", "class"))


def _linked(docs: DataFrame, size: int, part: int, whole: int, key: str, text: str) -> DataFrame:
    """Per row: k, h, n, class, label (of its component; null without shingles) and low, the component's smallest key.

    Pairs are taken in steps: every class with one class of its largest bucket, then
    with one class of each bucket; where a bucket is not connected by then, with the
    center of its group, then with the classes that share one of its rarest differences
    from the group's core and that it may still be similar to (see ``_apart``). All but the first and third step are only between classes that are
    not connected yet.
    """
    rows = store(sketches(docs, size, key=key, text=text), "sketches")
    order = F.struct(F.col("k").isNull(), F.col("k").alias("first"), F.col("h").alias("first_h"))
    classes = rows.where("class is not null").groupBy("class").agg(
        F.min(order).alias("o"), F.first("n").alias("n"), F.first("registers").alias("registers"), F.first("bands").alias("bands")
    )
    classes = store(classes.select("class", "o.first", "o.first_h", "n", "registers", "bands"), "classes")
    members = classes.select("class", F.explode("bands").alias("band"))
    # one class of each bucket, a different one in each band
    spread = F.struct(F.xxhash64("class", "band"), F.col("class"))
    buckets = members.groupBy("band").agg(F.count("*").alias("size"), F.min(spread)["class"].alias("pivot")).where("size > 1")
    members = store(members.join(buckets, "band"), "buckets")
    wanted = members.select("class").distinct().join(classes, "class").select("class", "first", "first_h")
    sets = store(_sets(docs, wanted, size, key, text), "sets")

    links, labels = None, None
    for step in ("one bucket", "one class of each bucket", "center", "differences"):
        if step == "one bucket":
            pairs = members.groupBy("class").agg(F.max_by("pivot", F.struct("size", "band")).alias("pivot"))
            pairs = pairs.select(F.col("class").alias("x"), F.col("pivot").alias("y"))
        elif step == "one class of each bucket":
            named = _labelled(members, labels).select("band", "class", "pivot", "label")
            at = labels.select(F.col("node").alias("pivot"), F.col("label").alias("other"))
            pairs = named.join(at, "pivot", "left").where(F.col("label") != F.coalesce("other", "pivot")).select(F.col("class").alias("x"), F.col("pivot").alias("y"))
        elif step == "center":
            named = _labelled(members, labels).select("band", "class", "label")
            open_bands = named.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
            left = store(named.join(open_bands, "band").select("band", "class", "label"), "open")
            if left.isEmpty():
                break
            centers, differences = _apart(left, classes, sets, part, whole)
            pairs = centers.select(F.col("class").alias("x"), F.col("center").alias("y"))
        else:
            left = _labelled(differences, labels).select("g", "s", "class", "label", "t", "at", "m")
            right = left.select("g", "s", *(F.col(c).alias(f"{c}_y") for c in ("class", "label", "t", "at", "m")))
            common = F.least(F.col("m") - F.col("at"), F.col("m_y") - F.col("at_y")) + 1
            wanted = (F.col("label") < F.col("label_y")) & (2 * (whole + part) * common >= F.col("t") + F.col("t_y"))
            pairs = left.join(right, ["g", "s"]).where(wanted).select(F.col("class").alias("x"), F.col("class_y").alias("y"))
        pairs = pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        found = store(_confirmed(_estimated(pairs, classes, part / whole - MARGIN), sets, part, whole), "links")
        links = found if links is None else links.unionByName(found)
        labels = components(links)

    names = classes.select("class", "first").join(labels, F.col("class") == F.col("node"), "left").select("class", "first", F.coalesce("label", "class").alias("label"))
    lowest = names.groupBy("label").agg(F.min("first").alias("low"))
    result = names.join(lowest, "label").select("class", "label", "low")
    return rows.select("k", "h", "n", "class").join(result, "class", "left")


def near_duplicates(
    docs: DataFrame, size: int = 5, part: int = 80, whole: int = 100, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id, kept.

    Documents with equal shingle sets form a class. Classes that share a band of
    registers are candidates: a likelihood estimate from both sketches drops clear
    misses and the full sets decide (whole * intersection >= part * union). A large
    group of copies costs a few pairs per class, and no candidate pair between
    components is left untested.

    component_id is the smallest key reachable, kept says that it is the row's own.
    Empty and null texts have no shingles and stand alone. Rows that repeat a key
    are linked by their own texts; null keys are never the smallest unless a
    component has no other key (component_id null, kept true); an empty table gives
    an empty table; other columns are ignored.
    """
    component = F.when(F.col("class").isNull(), F.col("k")).otherwise(F.col("low"))
    out = _linked(docs, size, part, whole, key, text)
    out = out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, part: int = 80, whole: int = 100, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of docs without near copies: of each component one row with the smallest
    key stays (among rows that repeat this key, one with the smallest text hash).
    Rows without shingles all stay. See ``near_duplicates`` for the other cases."""
    found = _linked(docs, size, part, whole, key, text).where("label is not null")
    order = F.struct(F.col("k").isNull(), F.col("k"), F.col("h"))
    stays = found.groupBy("label").agg(F.min(order).alias("o")).select("o.k", "o.h", F.lit(1).alias("stay"))
    decided = found.groupBy("k", "h").agg(F.count("*").alias("times")).alias("f").join(
        stays.alias("s"), F.expr("f.k <=> s.k and f.h = s.h"), "left"
    ).select(F.col("f.k").alias("_k"), F.col("f.h").alias("_h"), F.col("s.stay").alias("_stay"), F.col("times").alias("_times"))
    decided = store(decided, "stays")
    here = F.xxhash64(text_or_empty(text))
    def at(rows: DataFrame):
        return docs[key].eqNullSafe(rows["_k"]) & (here == rows["_h"])

    gone, again = decided.where("_stay is null or _times > 1"), decided.where("_stay = 1 and _times > 1")
    once = docs.join(small_side(again), at(again), "left_semi").dropDuplicates([key, text])
    return docs.join(small_side(gone), at(gone), "left_anti").unionByName(once)
