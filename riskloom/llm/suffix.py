"""Repeated byte strings by a suffix sort whose comparisons use prefix hashes.

Equal windows of ``length`` bytes choose the same anchor in them: the leftmost of
the smallest hashes of ``GRAM`` bytes. So only suffixes that pass through an anchor
that occurs more than once need to be compared. Around each such anchor the bytes
that its windows can reach are cut out; the snippets are sorted from the anchor on
by mergesort, the sort is led to the left one byte at a time, and neighbours in it
that share ``length`` bytes are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from riskloom.llm.common import mix, shuffle_partitions, store, table, text_or_empty

GRAM = 32
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers have inverses modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LETTER = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x5EED))
PIECE = 1 << 22  # bytes of text hashed at a time
TOGETHER = 1 << 19  # bytes of short texts hashed together
LAST = (1 << 63) - 1  # the order of rows without key
HOT = 50_000  # anchors with one gram beyond which windows are dealt instead of grams
FEW = 4096  # snippets sorted together (more if one anchor has more)


_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; the longest table is kept."""
    key = int(base)
    if key not in _tables or len(_tables[key]) < n:
        out = np.full(max(n, 1 << 12), base, np.uint64)
        out[0] = 1
        _tables[key] = np.multiply.accumulate(out)
    return _tables[key][:n]


def _prefix(data: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes (along the last axis) modulo 2^64."""
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum(LETTER[data] * powers[: data.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _window_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` keys, by running minima within blocks."""
    pad = -len(keys) % width
    blocks = np.pad(keys, (0, pad), constant_values=np.iinfo(keys.dtype).max).reshape(-1, width)
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end (text i is data[bounds[i]:bounds[i + 1]]): number of
    the text, anchor, first and last window start that choose it (all within the
    text), hash of the anchor's bytes, hash of all bytes of these windows and the
    anchor's place in them."""
    counts = np.maximum(np.diff(bounds) - length + 1, 0)
    total, n = int(counts.sum()), len(data)
    if not total:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    text = np.repeat(np.arange(len(counts)), counts)
    windows = np.arange(total) + np.repeat(bounds[:-1] - (np.cumsum(counts) - counts), counts)
    powers, inverse = _powers(BASE, n + 1), _powers(INVERSE, n + 1)
    prefix = _prefix(data, powers)
    grams = mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[: n - GRAM + 1])
    best, width = [], length - GRAM + 1
    for at in range(0, n - length + 1, PIECE):  # places fit into 24 bits
        g = grams[at : at + PIECE + width - 1]
        keys = g >> np.uint64(24) << np.uint64(24) | np.arange(len(g), dtype=np.uint64)
        best.append((_window_minimum(keys, width)[:PIECE] & np.uint64(0xFFFFFF)).astype(np.int64) + at)
    chosen = np.concatenate(best)[windows]
    head = np.flatnonzero(np.concatenate([[True], (np.diff(chosen) != 0) | (np.diff(text) != 0)]))
    first, last = windows[head], windows[np.append(head[1:], total) - 1]
    anchor, text = chosen[head], text[head]
    whole = (prefix[last + length] - prefix[first]) * inverse[first]
    around = mix(whole ^ mix((anchor - first).astype(np.uint64) << np.uint64(20) | (last - first).astype(np.uint64)))
    base = bounds[text]
    return text, anchor - base, first - base, last - base, grams[anchor], around


def merged(start: np.ndarray, end: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of intervals within each group: group, start, end."""
    if not len(start):
        return group, start, end
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], end[order]
    # ends of earlier groups must not reach into later ones
    _, number = np.unique(group, return_inverse=True)
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * step)
    new = np.concatenate([[True], (start + number * step)[1:] > reach[:-1]])
    new[1:] |= number[1:] != number[:-1]
    at = np.flatnonzero(new)
    return group[at], start[at], np.maximum.reduceat(end, at)


def _common(prefix: np.ndarray, i: np.ndarray, j: np.ndarray, ends: np.ndarray, at: int) -> np.ndarray:
    """Length of the common extension of snippets i and j from column ``at``, by
    binary search over prefix hashes."""
    low, high = np.zeros(len(i), np.int64), np.minimum(ends[i], ends[j]) - at
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = prefix[i, at + mid] - prefix[i, at] == prefix[j, at + mid] - prefix[j, at]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_sort(data: np.ndarray, prefix: np.ndarray, ends: np.ndarray, at: int, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes that start in column ``at``, within runs of equal group.

    Bottom-up mergesort: each suffix finds its place in the neighbouring run by
    binary search, and each comparison is a binary search for the common extension.
    All runs of all groups advance together.
    """
    n = len(group)
    order = np.arange(n)
    begin = np.maximum.accumulate(np.where(np.diff(group, prepend=group[:1]) != 0, np.arange(n), 0))
    size = np.zeros(n, np.int64)
    if n:
        heads = np.unique(begin)
        sizes = np.diff(np.append(heads, n))
        size = np.repeat(sizes, sizes)
    place, width = np.arange(n) - begin, 1
    while n and width < size.max():
        run = place // width
        other = run ^ 1
        lo = other * width
        hi = np.minimum(lo + width, size)
        moved = place.copy()
        busy = np.flatnonzero(lo < size)
        left = run[busy] % 2 == 0
        low, high = lo[busy].copy(), hi[busy].copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            rows = busy[open_]
            mid = (low[open_] + high[open_]) // 2
            mine, theirs = order[rows], order[begin[rows] + mid]
            shared = _common(prefix, mine, theirs, ends, at)
            a, b = ends[mine] - at, ends[theirs] - at
            col = at + np.minimum(shared, data.shape[1] - 1 - at)
            a_byte = np.where(shared < a, data[mine, col].astype(np.int64), -1)
            b_byte = np.where(shared < b, data[theirs, col].astype(np.int64), -1)
            # equal suffixes keep the order of their runs
            before = np.where(left[open_], b_byte < a_byte, b_byte <= a_byte)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        moved[busy] = np.minimum(run[busy], other[busy]) * width + (place[busy] - run[busy] * width) + (low - lo[busy])
        fresh = np.empty_like(order)
        fresh[begin + moved] = order
        order, width = fresh, width * 2
    return order


def repeats(group, doc, anchor, left, right, data, length: int) -> np.ndarray:
    """Which windows start earlier elsewhere: a matrix (snippet, bytes before the anchor).

    Rows of ``data`` hold a snippet with its anchor in column length - GRAM; ``left``
    bytes before and ``right`` bytes from the anchor on are valid. Rows must be
    ordered by group. Order of starts: (doc, anchor).
    """
    middle = length - GRAM
    powers = _powers(BASE, data.shape[1] + 1)
    prefix = _prefix(data, powers)
    ends = middle + right
    order = suffix_sort(data, prefix, ends, middle, group)
    # groups stay in place, so a number per group keeps them together in later sorts
    number = np.cumsum(np.diff(group, prepend=group[:1]) != 0)
    when = np.empty(len(group), np.int64)
    rank = np.lexsort((anchor, doc))
    new = np.concatenate([[0], np.cumsum((np.diff(doc[rank]) != 0) | (np.diff(anchor[rank]) != 0))]) if len(rank) else rank
    when[rank] = new
    found = np.zeros((len(group), middle + 1), bool)
    for back in range(middle + 1):
        start = middle - back
        if back:  # one byte to the left: a stable sort by it continues the suffix order
            key = number[order].astype(np.int64) << 8 | data[order, start]
            order = order[np.argsort(key, kind="stable")]
        rows = order[(left[order] >= back) & (right[order] >= length - back)]
        if len(rows) < 2:
            continue
        a, b = rows[:-1], rows[1:]
        same = group[a] == group[b]
        same &= prefix[a, start + length] - prefix[a, start] == prefix[b, start + length] - prefix[b, start]
        at = np.flatnonzero(same)
        same[at] = (data[a[at], start : start + length] == data[b[at], start : start + length]).all(axis=1)  # against collisions
        heads = np.flatnonzero(np.concatenate([[True], ~same]))
        earliest = np.minimum.reduceat(when[rows], heads)
        sizes = np.diff(np.append(heads, len(rows)))
        found[rows, back] = when[rows] > np.repeat(earliest, sizes)
    return found


def _spans(doc, key, start, end) -> tuple[np.ndarray, ...]:
    """Merged intervals of each document: doc, key, start, end."""
    _, first, group = np.unique(np.stack([doc, key], axis=1), axis=0, return_index=True, return_inverse=True) if len(doc) else (None, doc, doc)
    g, s, e = merged(start, end, group.ravel())
    return doc[first][g], key[first][g], s, e


SPANS = "doc long, key long, start long, end long"
CANDIDATES = f"{SPANS}, gram long, around long, anchor long"
WINDOWS = f"{SPANS}, a long, b long, whole long"  # whole: 1 for a window, 0 for a span


def _batch(names: str, **columns) -> pa.RecordBatch:
    fields = [f.split()[0] for f in names.split(", ")]
    n = len(columns["doc"])
    empty = np.zeros(n, np.int64)
    arrays = [pa.array(np.ascontiguousarray(columns.get(f, empty)).view(np.int64)) for f in fields]
    return pa.RecordBatch.from_arrays(arrays, names=fields)


def _find_anchors(length: int, hot: np.ndarray, windows: bool = False):
    """Rows of texts to anchors (gram, around, anchor, and windows start..end); an
    anchor with the same surroundings as an earlier one of the batch is a repeat at
    once and leaves as a span with anchor -1, dealt by its document. Anchors with a
    hot gram are left out; with ``windows`` only they are taken, and each of their
    windows is a row with the hash of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, key = (b.column(i).to_numpy() for i in (0, 1))
            parts, held, size, begin = [], [], 0, 0
            for i, t in enumerate(b.column(2).to_pylist()):
                held.append(t)
                size += len(t)
                if size >= TOGETHER or i == b.num_rows - 1:
                    bounds = np.cumsum([0, *map(len, held)])
                    text, *found = anchors(np.frombuffer(b"".join(held), np.uint8), bounds, length)
                    parts.append((text + begin, *found))
                    held, size, begin = [], 0, i + 1
            if not parts:
                continue
            row, anchor, first, last, gram, around = (np.concatenate(x) for x in zip(*parts, strict=True))
            if len(hot):
                mine = np.isin(gram, hot) == windows
                row, anchor, first, last, gram, around = (x[mine] for x in (row, anchor, first, last, gram, around))
            texts = row
            doc, key = doc[row], key[row]
            order = np.lexsort((anchor, doc, around, gram))
            same = (np.diff(gram[order]) == 0) & (np.diff(around[order]) == 0)
            earlier = (np.diff(doc[order]) != 0) | (np.diff(anchor[order]) != 0)
            heads = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
            # a row is later than its group's first if any step since then moved on
            steps = np.concatenate([[0], np.cumsum(same & earlier)]) if len(order) else order
            base = np.repeat(steps[heads], np.diff(np.append(np.flatnonzero(heads), len(order))))
            again = np.zeros(len(order), bool)
            again[order] = steps > base
            new = ~again
            if windows:
                for lo in range(0, int(new.sum()), FEW):
                    at = np.flatnonzero(new)[lo : lo + FEW]
                    many = last[at] - first[at] + 1
                    of = np.repeat(at, many)
                    start = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                    data = {i: b.column(2)[i].as_buffer().to_pybytes() for i in np.unique(texts[at]).tolist()}
                    digests = (hashlib.blake2b(data[i][x : x + length], digest_size=16).digest() for i, x in zip(texts[of].tolist(), start.tolist(), strict=True))
                    h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    yield _batch(WINDOWS, doc=doc[of], key=key[of], start=start, end=start + length, a=h[:, 0], b=h[:, 1], whole=np.ones(len(of), np.int64))
                yield _batch(WINDOWS, **dict(zip(("doc", "key", "start", "end"), _spans(doc[again], key[again], first[again], last[again] + length), strict=True)))
                continue
            yield _batch(CANDIDATES, doc=doc[new], key=key[new], start=first[new], end=last[new] + length, gram=gram[new], around=around[new], anchor=anchor[new])
            d, k, s, e = _spans(doc[again], key[again], first[again], last[again] + length)
            yield _batch(CANDIDATES, doc=d, key=k, start=s, end=e, gram=mix(d.view(np.uint64) ^ k.view(np.uint64)), anchor=np.full(len(d), -1))

    return run


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        d, k, s, e = _spans(*(c.to_numpy() for c in b.columns))
        yield _batch(SPANS, doc=d, key=k, start=s, end=e)


def _hot_spans(texts: DataFrame, length: int, hot: np.ndarray) -> DataFrame:
    """Repeated spans around anchors with hot grams. Equal windows have equal anchors,
    so all of them are here; the earliest start per window is pre-aggregated. Windows
    are told apart by 128-bit hashes."""
    rows = store(texts.mapInArrow(_find_anchors(length, hot, True), WINDOWS), "windows")
    at = F.struct("doc", "start")
    least = rows.where("whole = 1").groupBy("a", "b").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first < last")
    late = rows.where("whole = 1").join(least.select("a", "b", "first"), ["a", "b"]).where(at > F.col("first")).select("doc", "key", "start", "end")
    return late.unionByName(rows.where("whole = 0").select("doc", "key", "start", "end")).mapInArrow(_merge_spans, SPANS)


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All anchors with the same gram are here: repeats with equal surroundings
    become spans (anchor -1); what has the gram in common but not the surroundings
    stays; anchors that occur once go."""
    rows = table(batches)
    if rows is None:
        return
    c = {n: rows.column(n).to_numpy() for n in rows.column_names}
    known = c["anchor"] < 0
    old = {n: v[known] for n, v in c.items()}
    c = {n: v[~known] for n, v in c.items()}
    order = np.lexsort((c["anchor"], c["doc"], c["around"], c["gram"]))
    c = {n: v[order] for n, v in c.items()}
    n = len(order)
    if n:
        gram_head = np.concatenate([[True], np.diff(c["gram"]) != 0])
        head = gram_head | np.concatenate([[True], np.diff(c["around"]) != 0])
        heads = np.flatnonzero(head)
        first = np.repeat(heads, np.diff(np.append(heads, n)))
        later = (c["doc"] != c["doc"][first]) | (c["anchor"] != c["anchor"][first])
        number = np.cumsum(gram_head) - 1
        kinds = np.bincount(number, weights=head) if n else number
        open_ = ~later & (kinds[number] > 1)
    else:
        later = open_ = np.zeros(0, bool)
    d, k, s, e = _spans(*(np.concatenate([old[x], c[x][later]]) for x in ("doc", "key", "start", "end")))
    yield _batch(CANDIDATES, doc=d, key=k, start=s, end=e, anchor=np.full(len(d), -1))
    yield _batch(CANDIDATES, **{x: v[open_] for x, v in c.items()})


SNIPPETS = "doc long, key long, gram long, anchor long, left int, right int, snippet binary"


def _cut(length: int):
    """Documents with the list of their open anchors to one row per snippet."""
    middle = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, key, t, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                data = t.as_buffer().to_pybytes()
                for p in at:
                    anchor, start, end = p["anchor"], p["start"], p["end"]
                    snippet = data[start:end].rjust(end - anchor + middle, b"\0").ljust(length + middle, b"\0")
                    rows.append((doc, key, p["gram"], anchor, anchor - start, end - anchor, snippet))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in SNIPPETS.split(", ")])

    return run


def _sort_snippets(length: int):
    """Snippets in order of their gram to spans; some thousand at a time, whole grams only."""
    middle = length - GRAM

    def spans_of(t: pa.Table) -> pa.RecordBatch:
        c = {n: t.column(n).to_numpy() for n in ("doc", "key", "gram", "anchor", "left", "right")}
        data = np.frombuffer(b"".join(t.column("snippet").to_pylist()), np.uint8).reshape(t.num_rows, length + middle)
        found = repeats(c["gram"].view(np.uint64), c["doc"], c["anchor"], c["left"].astype(np.int64), c["right"].astype(np.int64), data, length)
        row, back = np.nonzero(found)
        start = c["anchor"][row] - back
        d, k, s, e = _spans(c["doc"][row], c["key"][row], start, start + length)
        return _batch(SPANS, doc=d, key=k, start=s, end=e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < FEW:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            gram = t.column("gram").to_numpy()
            whole = int(np.searchsorted(gram, gram[-1], "left"))  # the last gram may go on
            while whole >= FEW:
                cut = int(np.searchsorted(gram, gram[FEW - 1], "right"))
                cut = min(cut, whole)
                yield spans_of(t.slice(0, cut))
                t, gram, whole = t.slice(cut), gram[cut:], whole - cut
            held = t.combine_chunks().to_batches()
        if held:
            yield spans_of(pa.Table.from_batches(held).combine_chunks())

    return run


def repeated_spans(docs: DataFrame, length: int = 100, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, key, spans): for each text with repeats its maximal repeated byte ranges.

    ``doc`` is the row's key (a large number if null), ``key`` the hash of its text.
    A byte is repeated if a window of ``length`` bytes over it also starts earlier:
    in a row with a smaller key, or earlier in the same row. Rows without key come
    after all others. Rows that repeat key and text are the same document; windows
    at the same place of two texts under one key do not count as earlier than each
    other.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    n = shuffle_partitions(docs.sparkSession)
    order = F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc")
    texts = docs.select(order, F.xxhash64(text_or_empty(text)).alias("key"), text_or_empty(text).cast("binary").alias("t"))
    long_enough = texts.where(F.length("t") >= length)
    # at most one gram per HOT anchors reaches the driver
    seen = long_enough.mapInArrow(_find_anchors(length, np.zeros(0, np.uint64)), CANDIDATES).where("anchor >= 0").groupBy("gram").count()
    hot = np.array([r["gram"] for r in seen.where(F.col("count") > HOT).select("gram").collect()], np.int64).view(np.uint64)
    found = long_enough.mapInArrow(_find_anchors(length, hot), CANDIDATES)
    found = store(found.repartition(n, "gram").mapInArrow(_classify, CANDIDATES), "anchors")
    known = found.where("anchor < 0").select("doc", "key", "start", "end")
    places = found.where("anchor >= 0").groupBy("doc", "key").agg(F.collect_list(F.struct("gram", "anchor", "start", "end")).alias("at"))
    snippets = texts.join(places, ["doc", "key"]).select("doc", "key", "t", "at").dropDuplicates(["doc", "key"]).mapInArrow(_cut(length), SNIPPETS)
    snippets = snippets.repartition(n, "gram").sortWithinPartitions("gram")
    spans = known.unionByName(snippets.mapInArrow(_sort_snippets(length), SPANS))
    if len(hot):
        spans = spans.unionByName(_hot_spans(long_enough, length, hot))
    return store(spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")


def remove_repeats(
    docs: DataFrame, length: int = 100, *, key: str = "doc_id", text: str = "text", whole_characters: bool = False
) -> DataFrame:
    """Rows of docs with kept (remaining bytes), n_removed and n_spans added, and without ``text``.

    See ``repeated_spans`` for what goes; with ``whole_characters`` a character goes
    only if all its bytes do, so that what is left is text. Null text counts as empty; an empty table
    gives an empty table; other columns stay.
    """
    others = [c for c in docs.columns if c != text]
    return _without_repeats(docs, others, length, key, text, whole_characters).toDF(*others, "kept", "n_removed", "n_spans")


def _without_repeats(docs: DataFrame, others: list[str], length: int, key: str, text: str, whole_characters: bool) -> DataFrame:
    """The other columns under hidden names (_0, _1, ...), kept, n_removed, n_spans."""
    spans = repeated_spans(docs, length, key=key, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, removed, count = [], [], []
            for t, found in zip(b.column(b.num_columns - 2), b.column(b.num_columns - 1).to_pylist(), strict=True):
                data = t.as_buffer()
                if not found:
                    kept.append(t.as_py()), removed.append(0), count.append(0)
                    continue
                start, end = (np.array([s[x] for s in found], dtype=np.int64) for x in ("start", "end"))
                _, start, end = merged(start, end, np.zeros(len(start), np.int64))
                if whole_characters:  # continuation bytes are 10xxxxxx
                    inner = np.concatenate([np.frombuffer(data, np.uint8) & 0xC0 == 0x80, [False]])
                    while inner[start].any():
                        start = start + inner[start]
                    while inner[end].any():
                        end = end - inner[end]
                    end = np.maximum(start, end)
                view, at, out = memoryview(data), 0, []
                for s, e in zip(start.tolist(), end.tolist(), strict=True):
                    out.append(view[at:s])
                    at = e
                kept.append(b"".join([*out, view[at:]])), removed.append(int((end - start).sum())), count.append(len(start))
            columns = [*b.columns[:-2], pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(count, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in out_schema])

    hidden = [f"_{i}" for i in range(len(others))]
    rows = docs.select(
        *(F.col(c).alias(h) for c, h in zip(others, hidden, strict=True)),
        F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(text_or_empty(text)).alias("key"),
        text_or_empty(text).cast("binary").alias("t"),
    )
    joined = rows.join(spans, ["doc", "key"], "left").select(*hidden, "t", "spans")
    out_schema = StructType([*joined.schema.fields[:-2], StructField("kept", BinaryType()), StructField("n_removed", LongType()), StructField("n_spans", LongType())])
    return joined.mapInArrow(run, out_schema)


def drop_repeats(docs: DataFrame, length: int = 100, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Docs with all texts freed of repeated whole characters; all rows and columns stay,
    whatever the columns are called."""
    others = [c for c in docs.columns if c != text]
    left = _without_repeats(docs, others, length, key, text, whole_characters=True)
    kept = F.col("kept").cast("string").alias(text)
    return left.select(*[kept if c == text else F.col(f"_{others.index(c)}").alias(c) for c in docs.columns])
