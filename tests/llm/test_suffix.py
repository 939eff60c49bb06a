"""Repeated byte strings against the definition."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from riskloom.llm import suffix
from riskloom.llm.suffix import _prefix, _powers, drop_repeats, merged, remove_repeats, suffix_sort


def brute(rows, length):
    """Per row of (id, text): kept bytes, removed bytes, spans."""
    first: dict[bytes, tuple] = {}
    data = [(k if k is not None else suffix.LAST, (t or "").encode()) for k, t in rows]
    for k, t in data:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            first[w] = min(first.get(w, (k, i)), (k, i))
    out = []
    for (name, _), (k, t) in zip(rows, data, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < (k, i):
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((str(name), bytes(b for b, g in zip(t, gone, strict=False) if not g), int(gone.sum()), spans))
    return sorted(out)


def corpus():
    rng = random.Random(5)
    words = [f"{rng.choice('abcdeéß')}{rng.randrange(60)}" for _ in range(80)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(n) for n in (20, 40, 60, 90, 15)]
    rows = [(None, shared[1]), (0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "ab" * 200), (6, "short"), (7, shared[3] * 3)]
    for i in range(10, 60):
        parts = [text(rng.randrange(1, 40))]
        for _ in range(rng.randrange(4)):
            parts += [rng.choice(shared), text(rng.randrange(30))]
        rows.append((i, " ".join(parts)))
    base = text(200).split()
    for i in range(100, 130):  # near copies: each breaks its windows elsewhere
        copy = list(base)
        for _ in range(5):
            copy[rng.randrange(200)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, rows[20][1]) for i in range(5)] + [rows[20], rows[20]] + [(20, "other " + shared[2])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("length", "few", "together"), [(100, 4096, 1 << 19), (64, 50, 200)])
def test_removed_bytes(spark, monkeypatch, length, few, together):
    monkeypatch.setattr(suffix, "FEW", few)
    monkeypatch.setattr(suffix, "TOGETHER", together)
    rows = corpus()
    docs = spark.createDataFrame([(k, t, 1, "s") for k, t in rows], "doc_id long, text string, key int, doc string").repartition(5)
    out = remove_repeats(docs, length)
    assert out.columns == ["doc_id", "key", "doc", "kept", "n_removed", "n_spans"]
    assert sorted((str(r.doc_id), bytes(r.kept), r.n_removed, r.n_spans) for r in out.collect()) == brute(rows, length)
    assert remove_repeats(docs.limit(0), length).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.text("ab", max_size=9)), max_size=40))
def test_suffix_sort(rows):
    rows.sort(key=lambda r: r[0])
    data = np.zeros((len(rows), 12), np.uint8)
    for i, (_, t) in enumerate(rows):
        data[i, 3 : 3 + len(t)] = list(t.encode())
    ends = np.array([3 + len(t) for _, t in rows], dtype=np.int64)
    order = suffix_sort(data, _prefix(data, _powers(suffix.BASE, 13)), ends, 3, np.array([g for g, _ in rows], dtype=np.uint64))
    assert [rows[i] for i in order] == sorted(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(1, 8)), max_size=20))
def test_merged_intervals(found):
    group, start, n = (np.array(x, dtype=np.int64) for x in (zip(*found, strict=True) if found else ([], [], [])))
    g, s, e = merged(start, start + n, group)
    covered = {(a, i) for a, b, c in found for i in range(b, b + c)}
    assert {(a, i) for a, b, c in zip(g.tolist(), s.tolist(), e.tolist(), strict=True) for i in range(b, c)} == covered
    assert len(set(zip(g.tolist(), s.tolist(), strict=True)) & set(zip(g.tolist(), e.tolist(), strict=True))) == 0


@pytest.mark.parametrize("length", [100, 64])
def test_hot_anchors_are_dealt_by_window(spark, monkeypatch, length):
    """No gram with more than HOT anchors reaches the sort, and the result stays the same."""
    rng, stored, store = random.Random(7), {}, suffix.store
    monkeypatch.setattr(suffix, "HOT", 8, raising=False)
    monkeypatch.setattr(suffix, "store", lambda rows, name: stored.setdefault(name, store(rows, name)))
    phrase = "all rights reserved, printed in the usual place, see below "
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    around = [" ".join(word() for _ in range(12)) for _ in range(6)]
    rows = corpus() + [(1000 + i, f"{word()} {rng.choice(around)} {phrase}{rng.choice(around)} {word()}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = remove_repeats(docs, length).collect()
    assert sorted((str(r.doc_id), bytes(r.kept), r.n_removed, r.n_spans) for r in out) == brute(rows, length)
    most = stored["anchors"].where("anchor >= 0").groupBy("gram").count().agg({"count": "max"}).first()[0]
    assert most <= 8 and stored["windows"].where("whole = 1").count() > 8


def test_columns_named_like_results_stay(spark):
    names = ["kept", "n_removed", "n_spans", "doc", "key", "t", "spans", "_0"]
    passage = "a passage of more than one hundred characters that two documents share, word for word, without any change at all. "
    docs = spark.createDataFrame([(1, f"first {passage}"), (2, f"second {passage}"), (3, None)], "doc_id long, text string")
    wide = docs.select("doc_id", *[F.lit(i).alias(n) for i, n in enumerate(names)], "text")
    out = drop_repeats(wide)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == wide.columns and all(r[n] == i for r in got.values() for i, n in enumerate(names))
    assert [got[i]["text"].strip() for i in (1, 2, 3)] == [f"first {passage}".strip(), "second", ""]
