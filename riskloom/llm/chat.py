"""Roles of transcript turns by a hidden Markov model, and their canonical form.

A block is a piece of a row's text that begins with the row or with a speaker marker
at the start of a line. Hidden states are the roles; a block shows its marker and
features of its lines. The model is counted on rows with known roles, and Viterbi
recovers the roles of all blocks. A conversation may be of any length: its rows, dealt
by ranges of their order, are cut into segments of bounded rows and bytes whatever their
turn numbers are, each segment gives a matrix of its best paths, the matrices are
chained, and each segment is decoded between the states that the chain fixes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import shuffle_partitions, store, text_or_empty

ROLES = ("system", "user", "assistant")
# speakers' names at the start of a line, by role
NAMES = {
    "system": ("system", "system prompt", "instruction", "instructions"),
    "user": ("user", "human", "customer", "question", "prompter", "q", "me", "you"),
    "assistant": ("assistant", "ai", "bot", "chatbot", "agent", "model", "answer", "a", "gpt"),
}
ROLE_OF = {name: ROLES.index(role) for role, names in NAMES.items() for name in names}
MARKER = re.compile(
    r"^[ \t]*(?:[#*\[<|(]{1,4}[ \t]*)?(" + "|".join(sorted(map(re.escape, ROLE_OF), key=len, reverse=True)) + r")[ \t]*(?:[\])>|*#]{1,4}[ \t]*:?|:)[ \t]*\**[ \t]*",
    re.IGNORECASE | re.MULTILINE,
)
SEGMENT = 16_384  # rows
SEGMENT_BYTES = 1 << 25  # of text, a row more at most
START, END = "<|im_start|>", "<|im_end|>"
FEATURES = (4, 8, 6, 2, 2)  # marker, length, lines, question, list or code


def blocks_of(text: str) -> list[tuple[int, str]]:
    """(marked role or -1, content) of each block; a text has at least one."""
    found = list(MARKER.finditer(text))
    out = [] if found and not text[: found[0].start()].strip() else [(-1, text[: found[0].start()] if found else text)]
    for i, m in enumerate(found):
        end = found[i + 1].start() if i + 1 < len(found) else len(text)
        out.append((ROLE_OF[m[1].lower()], text[m.end() : end]))
    return [(role, content.strip()) for role, content in out]


def observe(marker: int, content: str) -> int:
    """Number of the block's combination of features."""
    lines = content.count("\n") + 1
    values = (
        marker + 1,
        min(max(len(content), 1).bit_length() // 2, FEATURES[1] - 1),
        min(lines.bit_length() - 1, FEATURES[2] - 1),
        int(content.endswith("?")),
        int("```" in content or "\n- " in content or "\n1. " in content),
    )
    out = 0
    for v, size in zip(values, FEATURES, strict=True):
        out = out * size + v
    return out


def render(role: int, content: str) -> str:
    """One turn; the marks of turns inside a content are broken up."""
    for mark in (START, END):
        content = content.replace(mark, mark.replace("<|", "<| "))
    return f"{START}{ROLES[role]}\n{content}{END}\n"


class Model:
    """Log probabilities with one added to each count; features are taken as independent given the role."""

    def __init__(self, first: np.ndarray, moves: np.ndarray, shown: np.ndarray):
        k = len(ROLES)
        self.first = np.log((first + 1) / (first.sum() + k))
        self.moves = np.log((moves + 1) / (moves.sum(axis=1, keepdims=True) + k))
        shown = shown.reshape(k, *FEATURES)
        logs = np.zeros_like(shown, dtype=float)
        for axis, size in enumerate(FEATURES, 1):
            others = tuple(a for a in range(1, len(FEATURES) + 1) if a != axis)
            count = shown.sum(axis=others, keepdims=True)
            logs = logs + np.log((count + 1) / (count.sum(axis=axis, keepdims=True) + size))
        self.shown = logs.reshape(k, -1)

    def paths(self, seen: list[int]) -> np.ndarray:
        """Best log probability from each state before the segment (last row: from the
        start of a conversation) to each state of its last block."""
        begin = np.vstack([self.moves, self.first]) + self.shown[:, seen[0]]
        for o in seen[1:]:
            begin = (begin[:, :, None] + self.moves[None]).max(axis=1) + self.shown[:, o]
        return begin

    def decode(self, seen: list[int], before: int, last: int) -> list[int]:
        """The best states of a segment's blocks, given the state before it (-1: none) and its last one."""
        value = (self.first if before < 0 else self.moves[before]) + self.shown[:, seen[0]]
        back = []
        for o in seen[1:]:
            step = value[:, None] + self.moves
            back.append(step.argmax(axis=0))
            value = step.max(axis=0) + self.shown[:, o]
        out = [last]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def chain(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, last state) of each segment on the best path through all of them."""
    value, back = matrices[0][-1], []
    for m in matrices[1:]:
        step = value[:, None] + m[:-1]
        back.append(step.argmax(axis=0))
        value = step.max(axis=0)
    ends = [int(value.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    return list(zip([-1, *ends[:-1]], ends, strict=True))


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal first ``size`` columns, which are sorted."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and row[:size] != held[-1][:size]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _cut(segment: int):
    """Rows in order of their conversation (hash and null mark of the key first, number
    of the range last) to the same rows with segment and place instead of these.

    Places count the rows of a conversation within a range; a segment has at most
    ``segment`` rows, and SEGMENT_BYTES of text besides its last row. Segments of a
    conversation grow from range to range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = None, 0, 0  # of the conversation that the last batch ended in
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            k, null = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            new = np.concatenate([[held != (k[0], null[0])], (k[1:] != k[:-1]) | (null[1:] != null[:-1])])
            heads = np.flatnonzero(np.concatenate([[True], new[1:]]))
            begin = np.repeat(heads, np.diff(np.append(heads, n)))
            total = np.concatenate([[0], np.cumsum(pc.binary_length(b.column("t")).to_numpy().astype(np.int64))])
            place, before = np.arange(n) - begin, total[:-1] - total[begin]
            if not new[0]:
                place[begin == 0] += rows
                before[begin == 0] += size
            held, rows, size = (k[-1], null[-1]), int(place[-1]) + 1, int(before[-1] + total[-1] - total[-2])
            cut = place // segment + before // SEGMENT_BYTES
            part = b.column(b.num_columns - 1).to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[2:-1], pa.array(part << 40 | cut), pa.array(place)], names=[*b.schema.names[2:-1], "segment", "place"]
            )

    return run


def format_chats(turns: DataFrame, labelled=None, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row per block: key, turn, block (from 0 in its row), role (recovered),
    given (the row's role), marked (role of the speaker marker), content, rendered.

    ``labelled`` (a column; default: all rows) says which rows' roles may be learned
    from; other rows' roles are never looked at. Turns follow their number, null first;
    rows with the same key and number follow their text. Rows without key are one
    conversation. Roles other than the three teach nothing; moves between segments are
    not counted. Null text is an empty block; an empty table gives an empty table;
    other columns are ignored. Conversations that go on in
    another range lose one move each to the counts.
    """
    kinds = [f"{n} {turns.schema[c].dataType.simpleString()}" for n, c in (("k", key), ("turn", turn))]
    known = F.when(F.lit(True) if labelled is None else labelled, F.lower(F.trim(F.col(role))))
    state = F.coalesce(*(F.when(known == r, F.lit(i)) for i, r in enumerate(ROLES)), F.lit(-1))
    rows = turns.select(F.col(key).alias("k"), F.col(turn).alias("turn"), text_or_empty(text).alias("t"), state.alias("state"), F.col(role).cast("string").alias("given"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    n = shuffle_partitions(turns.sparkSession)
    # the last column parts equal rows too
    order = ("k", "turn", "text_hash", "row")
    rows = rows.withColumns({"text_hash": F.xxhash64("t"), "row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = rows.select(F.xxhash64("k"), F.col("k").isNull(), "k", "turn", "t", "state", "given", F.spark_partition_id())
    rows = store(rows.mapInArrow(_cut(segment), f"{columns}, segment long, place long"), "turns")
    ordered = rows.repartition(n, "k", "segment").sortWithinPartitions("k", "segment", "place")
    roles, combinations = len(ROLES), int(np.prod(FEATURES))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, shown = np.zeros((roles, roles)), np.zeros((roles, combinations))
        for run in _segments(batches, 2):
            before = None
            for *_, t, s in run:
                for marker, content in blocks_of(t):
                    now = marker if marker >= 0 and s >= 0 else s
                    if now >= 0:
                        shown[now, observe(marker, content)] += 1
                        if before is not None and before >= 0:
                            moves[before, now] += 1
                    before = now
        x = np.concatenate([moves.ravel(), shown.ravel()])
        at = np.flatnonzero(x)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(x[at])], names=["i", "x"])

    def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marked = [blocks_of(t)[0][0] for t in b.column(2).to_pylist()]
            now = [m if m >= 0 and s >= 0 else s for m, s in zip(marked, b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(now, pa.int32())], names=["k", "segment", "now"])

    # of each conversation the role it begins with
    begun = rows.where("place = 0").select("k", "segment", "t", "state").mapInArrow(opening, f"{kinds[0]}, segment long, now int")
    begun = begun.groupBy("k").agg(F.min_by("now", "segment").alias("now")).where("now >= 0").groupBy("now").count()
    first, counts = np.zeros(roles), np.zeros(roles**2 + roles * combinations)
    for r in begun.collect():
        first[r["now"]] = r["count"]
    # at most one number per parameter of the model
    for r in ordered.select("k", "segment", "turn", "t", "state").mapInArrow(count, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        counts[r["i"]] = r["x"]
    model = Model(first, counts[: roles**2].reshape(roles, roles), counts[roles**2 :].reshape(roles, -1))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for run in _segments(batches, 2):
                seen = [observe(*x) for r in run for x in blocks_of(r[3])]
                yield [*run[0][:2], model.paths(seen).ravel().tolist()]

        yield from _results(found(), field)

    turn_field = pa.field("turn", _arrow(turns, turn))
    field = [pa.field("k", _arrow(turns, key)), pa.field("segment", pa.int64()), pa.field("m", pa.list_(pa.float64()))]
    paths = ordered.select("k", "segment", "turn", "t").mapInArrow(matrices, f"{kinds[0]}, segment long, m array<double>")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for run in _segments(batches, 1):
                for (k, s, _), (before, last) in zip(run, chain([np.array(r[2]).reshape(roles + 1, roles) for r in run]), strict=True):
                    yield [k, s, before, last]

        yield from _results(found(), [*field[:2], pa.field("before", pa.int32()), pa.field("last", pa.int32())])

    # one small row per segment
    fixed = paths.repartition(n, "k").sortWithinPartitions("k", "segment").mapInArrow(chained, f"{kinds[0]}, segment long, before int, last int")
    fixed = store(fixed.withColumnsRenamed({"k": "k2", "segment": "segment2"}), "ends")

    def recovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for run in _segments(batches, 2):
                blocks = [(r, i, *x) for r in run for i, x in enumerate(blocks_of(r[3]))]
                states = model.decode([observe(m, c) for *_, m, c in blocks], run[0][5], run[0][6])
                for (r, i, marker, content), s in zip(blocks, states, strict=True):
                    yield [r[0], r[2], i, ROLES[s], r[4], ROLES[marker] if marker >= 0 else None, content, render(s, content)]

        text_fields = [pa.field(c, pa.string()) for c in ("role", "given", "marked", "content", "rendered")]
        yield from _results(found(), [field[0], turn_field, pa.field("block", pa.int32()), *text_fields])

    joined = rows.join(fixed, rows["k"].eqNullSafe(fixed["k2"]) & (rows["segment"] == fixed["segment2"])).select("k", "segment", "turn", "t", "given", "before", "last", "place")
    joined = joined.repartition(n, "k", "segment").sortWithinPartitions("k", "segment", "place")
    out = joined.mapInArrow(recovered, f"{', '.join(kinds)}, block int, role string, given string, marked string, content string, rendered string")
    return out.select(F.col("k").alias(key), F.col("turn").alias(turn), "block", "role", "given", "marked", "content", "rendered")


def _arrow(rows: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[column].dataType)


def _results(rows: Iterator[list], fields: list[pa.Field], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    schema = pa.schema(fields)
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), fields, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), fields, strict=True)], schema=schema)
