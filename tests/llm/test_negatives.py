from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm.negatives import hard_negatives, least_score, open_windows, products

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows: list[tuple], every: int = 100, positives: int = 5, negatives: int = 5, share: int = 80) -> list[tuple]:
    part = set()
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for a, label, q in sorted(r for r in part if r[0] % every == 0):
        pairs = {(-sum(x * y for x, y in zip(q, r)), i, y == label) for i, y, r in part if i != a}
        ranked = sorted(pairs)
        for s, p, _ in [x for x in ranked if x[2]][:positives]:
            hits = [x for x in ranked if not x[2] and share * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            out += [(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(hits, 1)]
    return sorted(out)


def found(spark, rows, **options) -> list[tuple]:
    out = hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(rng: random.Random, n: int, dims: int = 4, labels: int = 3) -> list[tuple]:
    # few different values, so that many scores are equal
    return [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"cells": 40, "block_values": 30}, {"every": 10, "positives": 2, "negatives": 9, "share": 50}])
def test_random_vectors(spark, options):
    rows = vectors(random.Random(2), 400)
    inner = {k: v for k, v in options.items() if k in ("every", "positives", "negatives", "share")}
    want = plain(rows, **inner)
    assert len(want) > 20 and found(spark, rows, **options) == want


def test_who_takes_part(spark):
    rng = random.Random(4)
    nan, inf = float("nan"), float("inf")
    odd = [(0, [1.0, 0.5], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, 1.0], None), (3, [1.0, None], 1), (4, [nan, 1.0], 1), (5, [1.0, -inf], 2), (6, [], 1), (8, [1.0], 2), (9, [0.5, 0.25, 4.0], 1), (100, [], 1), (200, None, 1), (300, [1.0, 1.0], None)]
    rows = odd + [(i, [rng.random(), rng.random()], rng.randrange(3)) for i in range(10, 60)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == found(spark, [(1, [1.0], 1)]) == found(spark, [(100, [1.0], 1)]) == []


def test_repeated_rows_and_anchors(spark):
    rng = random.Random(6)
    rows = vectors(rng, 60)
    rows += rows[:20] + [(0, [1.0, 1.0, 1.0, 1.0], 2)] + [(i, v, 1) for i, v, _ in rows[30:50]]
    assert found(spark, rows) == plain(rows)


def test_one_vector_for_a_third_of_the_rows(spark):
    rng = random.Random(7)
    rows = vectors(rng, 300) + [(1000 + i, [1.0, 1.0, 1.0, 1.0], i % 2) for i in range(150)]
    assert found(spark, rows) == plain(rows)


def test_clashing_columns(spark):
    rows = vectors(random.Random(9), 120)
    docs = spark.createDataFrame(rows, SCHEMA)
    wide = docs.select(*docs.columns, *[F.lit(1).alias(n) for n in ("id", "q", "x", "anchor", "anchor_id", "negative", "rank")])
    assert sorted(tuple(r) for r in hard_negatives(wide).collect()) == plain(rows)


def test_exact_products():
    big = np.array([[2.0**40, 3.0], [-(2.0**70), 1.0], [5.0, 7.0]])
    want = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(a, b)))) for b in big] for a in big]
    assert products(big, big).tolist() == want
    assert products(np.zeros((2, 0)), big).tolist() == [[0] * 3] * 2


def test_least_score():
    for share in (1, 50, 80, 100):
        for p in [*range(-250, 250), 2**63 - 1, -(2**63) + 1]:
            s = int(least_score(np.array([p], np.int64), share)[0])
            assert share * p <= 100 * s and share * p > 100 * (s - 1)


def test_stream_in_batches_of_one():
    """Windows stay open over batches and close with their anchor."""
    records = [(1, ~90, False, 4), (1, ~90, True, 2), (1, ~90, True, 2), (1, ~80, False, 9), (1, ~75, True, 3), (1, ~70, True, 5), (2, ~90, True, 1), (2, ~50, False, 6), (2, ~40, True, 7)]
    names = ["anchor", "falling", "negative", "id"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r))]) for r in records]
    out = [tuple(r.values()) for b in open_windows(iter(batches), 5, 5, 80) for r in b.to_pylist()]
    assert out == [(1, 4, 1, 2, 90, 90), (1, 4, 2, 3, 90, 75), (1, 9, 1, 3, 80, 75), (1, 9, 2, 5, 80, 70), (2, 6, 1, 7, 50, 40)]
