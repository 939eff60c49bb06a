"""Greedy string tiling against a plain version."""

from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm.tiling import contamination, contamination_report, decontaminate, running_hashes, tile


def brute_tiles(pattern, text, least):
    used_p, used_t, tiles = set(), set(), []
    while True:
        best, length = [], least - 1
        for a in range(len(pattern)):
            for b in range(len(text)):
                n = 0
                while a + n < len(pattern) and b + n < len(text) and pattern[a + n] == text[b + n] and a + n not in used_p and b + n not in used_t:
                    n += 1
                if n > length:
                    best, length = [], n
                if n == length and n >= least:
                    best.append((a, b))
        if length < least:
            return tiles
        for a, b in best:
            if not used_p & set(range(a, a + length)) and not used_t & set(range(b, b + length)):
                used_p |= set(range(a, a + length))
                used_t |= set(range(b, b + length))
                tiles.append((a, b, length))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=25), st.lists(st.integers(0, 3), max_size=40), st.integers(1, 4))
def test_tiles(pattern, text, least):
    got = tile(np.array(pattern, dtype=np.uint64), np.array(text, dtype=np.uint64), least)
    assert sorted(got) == sorted(brute_tiles(pattern, text, least))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 14))
def test_equal_windows_have_equal_hashes(tokens, size):
    h = running_hashes(np.array(tokens, dtype=np.uint64), size).tolist()
    windows = [tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]
    assert len(h) == max(0, len(windows)) and len(set(zip(h, windows, strict=True))) == len(set(h)) == len(set(windows))


def corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice((15, 30, 60))))) for i in range(20)] + [(20, "Two Words"), (21, ""), (22, None), (3, "again once more this item here")]
    docs = [(0, None), (1, ""), (None, "a two, words b"), (2, "two then words")]
    for d in range(10, 90):
        body = text(rng.randrange(5, 120))
        kind = d % 4
        passage = (items[d % 20][1]).split()
        if kind == 1:
            body = body[:3] + [w.upper() + "," for w in passage] + body[3:]
        if kind == 2:  # sentences in another order
            cuts = [passage[i : i + 7] for i in range(0, len(passage), 7)]
            rng.shuffle(cuts)
            body = [w for c in cuts for w in (*c, rng.choice(words))] + body
        if kind == 3:
            body += passage[: len(passage) // 3]
        docs.append((d, " ".join(body)))
    return items, docs + docs[5:8]


def test_covered_items(spark):
    items, docs = corpus()
    tokens = lambda t: re.findall(r"\w+", (t or "").lower())
    want = set()
    for k, t in docs:
        for i, b in items:
            p = tokens(b)
            found = brute_tiles(p, tokens(t), min(5, len(p))) if p else []
            share = sum(n for *_, n in found) / len(p) if p else 0
            if p and share >= 0.5:
                want.add((str(k), i, round(share, 9), len(found)))
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, item_id string, i int").repartition(4)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    for options in ({}, {"block_tokens": 500}):
        got = [(str(r.doc_id), r.item_id, round(r.coverage, 9), r.n_tiles) for r in contamination(d, b, **options).collect()]
        assert sorted(got) == sorted(want)
    report = contamination_report(d, b).collect()
    assert len(report) == len(docs)
    leaks = {k for k, *_ in want}
    assert all(r.contaminated == (str(r.doc_id) in leaks) == (r.n_items > 0) for r in report)
    clean = decontaminate(d, b)
    assert clean.columns == d.columns and sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(k) for k, _ in docs if str(k) not in leaks)
    assert contamination_report(d.limit(0), b).count() == 0
    assert contamination_report(d, b.limit(0)).where("contaminated").count() == 0
