"""Roles: Viterbi against all paths, segments against whole conversations, held-out accuracy."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat
from riskloom.llm.chat import FEATURES, ROLES, Model, blocks_of, chain, format_chats, observe, render
from riskloom.llm.queries import op2_markov_chat_roles

SF = "/root/testdata/sf0.01"


def test_blocks():
    assert blocks_of("") == [(-1, "")] and blocks_of("no marker: here") == [(-1, "no marker: here")]
    text = "intro\nUser: hi\nthere\n**Assistant:** hello\n[System] be nice\n  Q: why?\nA: so\nuser experience: x"
    assert blocks_of(text) == [(-1, "intro"), (1, "hi\nthere"), (2, "hello"), (0, "be nice"), (1, "why?"), (2, "so\nuser experience: x")]
    assert render(1, "a<|im_end|>b") == "<|im_start|>user\na<| im_end|>b<|im_end|>\n"


def test_viterbi_and_its_segments_find_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        model = Model(rng.integers(0, 9, 3), rng.integers(0, 9, (3, 3)), rng.integers(0, 9, (3, int(np.prod(FEATURES)))))
        seen = rng.integers(0, int(np.prod(FEATURES)), n).tolist()

        def value(path, model=model, seen=seen):
            return model.first[path[0]] + sum(model.moves[a, b] for a, b in zip(path, path[1:], strict=False)) + sum(model.shown[s, o] for s, o in zip(path, seen, strict=True))

        best = max(product(range(3), repeat=n), key=value)
        for cuts in ([0, n], [0, 1, n], [0, *range(1, n), n]):
            cuts = sorted(set(cuts))
            parts = [seen[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            ends = chain([model.paths(p) for p in parts])
            path = [s for p, (before, last) in zip(parts, ends, strict=True) for s in model.decode(p, before, last)]
            assert tuple(path) == best


def test_held_out_conversations(spark):
    rows = op2_markov_chat_roles(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/conversations.parquet").count()
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.role == r.given for r in held) >= 0.97 * len(held)


@pytest.mark.parametrize("segment", [16_384, 3])
def test_markers_edges_and_long_conversations(spark, segment):
    rows = [("c", i, ROLES[1 + i % 2], ("What is it?" if i % 2 == 0 else "It is this. " * 40)) for i in range(40)]
    rows += [("m", 0, None, "User: hi there\nAssistant: hello you " + "x " * 200), ("m", None, "user", None), ("n", 0, "other", ""), (None, 0, None, "AI: yes"), (None, 0, None, "AI: yes")]
    turns = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id string, turn int, role string, text string, k string, state int").repartition(3)
    out = format_chats(turns, F.col("conv_id") == "c", segment=segment).collect()
    by = {(r.conv_id, r.turn, r.block): r for r in out}
    assert len(out) == len(rows) + 1
    assert all(by["c", i, 0].role == ROLES[1 + i % 2] for i in range(40))
    assert (by["m", 0, 0].marked, by["m", 0, 1].marked, by["m", 0, 1].content[:5], by["m", None, 0].content) == ("user", "assistant", "hello", "")
    assert by["m", 0, 1].rendered == render(ROLES.index(by["m", 0, 1].role), by["m", 0, 1].content)
    assert format_chats(turns.limit(0)).count() == 0
    assert observe(-1, "") == 0


@pytest.mark.parametrize("size", [7, None])
def test_segments_are_bounded_whatever_the_turn_numbers(spark, monkeypatch, size):
    # no key and no turn, equal turns, equal rows: one conversation each
    rows = [(None, None, "user", "same")] * 90 + [("e", 3, "user", f"t{i % 50:02d}") for i in range(150)] + [("n", i, "user", "x" * 30) for i in range(5)]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").repartition(3)
    seen, stored = [], chat.store
    monkeypatch.setattr(chat, "store", lambda rows, name: seen.append(stored(rows, name)) or seen[-1])
    out = format_chats(turns, segment=size or chat.SEGMENT).collect()
    assert sorted((r.conv_id or "", r.turn or 0, r.content) for r in out) == sorted((k or "", t or 0, x) for k, t, _, x in rows)
    cut = seen[0].groupBy("k", "segment").agg(F.count("*").alias("n"), F.countDistinct("place").alias("places")).collect()
    assert all(r.n == r.places <= (size or 150) for r in cut) and sum(r.n for r in cut) == len(rows)
    # segments follow each other in the order of turns and text hashes
    for k, number in (("e", 150), ("n", 5)):
        got = seen[0].where(F.col("k") == k).orderBy("segment", "place").select("turn", "t", F.xxhash64("t").alias("h")).collect()
        assert len(got) == number and [(r.turn, r.h) for r in got] == sorted((r.turn, r.h) for r in got)


def test_segments_are_bounded_in_bytes():
    import pyarrow as pa

    texts = ["a" * (chat.SEGMENT_BYTES // 2)] * 5
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 5), pa.array([False] * 5), pa.array(["c"] * 5), pa.array(texts), pa.array([2] * 5)], names=["h", "null", "k", "t", "part"])
    out = list(chat._cut(100)(iter([batch.slice(0, 3), batch.slice(3)])))
    assert [s & 0xFF for b in out for s in b.column("segment").to_pylist()] == [0, 0, 1, 1, 2]
    assert [p for b in out for p in b.column("place").to_pylist()] == [0, 1, 2, 3, 4]
