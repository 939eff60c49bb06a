from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import search as module
from riskloom.llm.search import count_terms, normal, search

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text: str | None) -> list[str]:
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def plain(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    counted = [(k, Counter(terms(t))) for k, t in docs]
    total = sum(bool(c) for _, c in counted)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for i, text in set(items):
        found = []
        for k, c in counted:
            m = 100 - 75 + 75 * sum(c.values()) * total // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, k is None, k or 0, k))
        out += [(i, r, k, -s) for r, (s, _, _, k) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **options) -> list[tuple]:
    out = search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


WORDS = ["a", "A", "ab", "abc", "b", "bc", "c", "Zürich", "zürich", "ZÜRICH", "日本", "日", "x1", "1", "été", "\x7f", "_", "-"]


def text(rng: random.Random, most: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", "  ", ",", "\n", "\x00", "'"]) for _ in range(rng.randint(0, most)))


@pytest.mark.parametrize("block_chars", [4_000_000, 60])
def test_random_texts(spark, block_chars):
    rng = random.Random(block_chars)
    docs = [(i, text(rng, 30)) for i in range(80)]
    items = [(i, text(rng, 8)) for i in range(25)]
    assert found(spark, docs, items, block_chars=block_chars) == plain(docs, items)


def test_nulls_repeats_and_ties(spark):
    docs = [(5, "red fox"), (3, "red fox"), (3, "red fox"), (None, "red fox"), (8, None), (9, ""), (7, "- - -"), (6, "grey fox den"), (None, "red")]
    items = [(1, "red"), (1, "red"), (1, "fox fox"), (2, None), (3, ""), (None, "red fox"), (4, "owl"), (5, "--")]
    got = found(spark, docs, items)
    assert got == plain(docs, items)
    assert [r[2] for r in got if r[:1] == (None,)][:4] == [3, 3, 5, None]
    for some, none in ((docs, []), ([], items), ([], [])):
        assert found(spark, some, none) == []


def test_more_documents_than_ranks(spark):
    docs = [(i, "same words here") for i in range(500)] + [(1000, "same")]
    assert found(spark, docs, [(0, "same words")], top=3) == plain(docs, [(0, "same words")], 3)


def test_clashing_columns(spark):
    names = ["k", "t", "i", "rank", "score", "term", "key", "item", "n"]
    docs, items = [(1, "red fox"), (2, "fox")], [(1, "red")]
    wide = spark.createDataFrame(docs, DOCS).select("*", *[F.lit(1).alias(n) for n in names])
    asked = spark.createDataFrame(items, ITEMS).select("*", *[F.lit(1).alias(n) for n in names])
    assert [tuple(r) for r in search(wide, asked).collect()] == plain(docs, items)


def test_keys_of_text(spark):
    docs = spark.createDataFrame([("b", "fox"), ("a", "fox")], "doc_id string, text string")
    out = search(docs, spark.createDataFrame([("q", "fox")], "item_id string, text string"))
    assert [r["doc_id"] for r in out.orderBy("rank").collect()] == ["a", "b"]


def test_long_texts_are_cut_between_terms(monkeypatch):
    """Pieces of any size give the same counts, and a term longer than a piece is kept."""
    rng = random.Random(3)
    texts = [text(rng, 200).encode() for _ in range(20)] + [b"", b"abc" * 100 + b" abc", "é".encode() * 50]
    asked = sorted({t.encode() for t in map(str.lower, WORDS) if normal(t.encode()).strip()})
    want = [Counter(terms(t.decode())) for t in texts]
    for piece in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(module, "PIECE", piece)
        counts = count_terms(texts, asked)
        assert counts.n.tolist() == [sum(c.values()) for c in want]
        got = {(int(d), asked[t]): int(f) for d, t, f in zip(counts.text, counts.term, counts.tf)}
        assert got == {(d, t.encode()): n for d, c in enumerate(want) for t, n in c.items() if t.encode() in asked}


def test_many_cells_in_steps(monkeypatch):
    monkeypatch.setattr(module, "CELLS", 5)
    rng = random.Random(8)
    raw = [text(rng, 20).encode() for _ in range(30)]
    items = module.Items.of([text(rng, 10).encode() for _ in range(12)])
    counts = count_terms(raw, items.terms)
    weight, m = np.arange(1, len(items.terms) + 1), np.arange(1, len(raw) + 1)
    whole = items.scores(counts, 0, len(raw), weight, m)
    monkeypatch.setattr(module, "CELLS", 1 << 20)
    assert (whole == items.scores(counts, 0, len(raw), weight, m)).all()
