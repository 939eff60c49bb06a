"""Near duplicates against all pairs, sketches against their definition."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import neardup
from riskloom.llm.components import components
from riskloom.llm.neardup import drop_near_duplicates, near_duplicates
from riskloom.llm.sketch import SetSketch


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(rows, size, part, whole):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and whole * len(a & b) >= part * len(a | b):
                label[root(i)] = root(j)
    low: dict = {}
    for i, (k, _) in enumerate(rows):
        r = root(i)
        low[r] = k if low.get(r) is None else min(low[r], k if k is not None else low[r])
    out = []
    for i, (k, _) in enumerate(rows):
        c = k if not sets[i] else low[root(i)]
        out.append((str(k), len(sets[i]), str(c), k == c))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"W{i}" for i in range(400)]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "Äpfel one two three"), (7, "äpfel one two three"), (None, "one two"), (5, "one two")]
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((30, 120, 300)))]
        for c in range(rng.choice((1, 3, 14))):
            words = list(base)
            for _ in range(len(base) * rng.choice((0, 1, 2, 4)) // 100):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append((100 * g + c + 10, " ".join(words)))
    return out


@pytest.mark.parametrize(("size", "part"), [(3, 85), (5, 80)])
def test_all_links_are_found(spark, rows, size, part):
    docs = spark.createDataFrame([(k, t, 1, b"") for k, t in rows], "doc_id long, text string, n long, class binary").repartition(5)
    got = near_duplicates(docs, size, part).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == brute(rows, size, part, 100)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, label long").repartition(5)
    kept = [(r.doc_id, r.text) for r in drop_near_duplicates(docs).collect()]
    want = brute(rows, 5, 80, 100)
    groups = {c for k, n, c, _ in want if n}
    assert sorted(str(k) for k, t in kept if shingles(t, 5)) == sorted(groups)
    assert sum(not shingles(t, 5) for _, t in kept) == sum(not n for _, n, *_ in want)


def test_null_and_repeated_keys_do_not_multiply(spark, monkeypatch):
    """300 rows without a key, and 300 of one key: each text is fetched for its own class only."""
    texts = [" ".join(f"w{i % 150}x{j}" for j in range(20)) + f" end {i}" for i in range(300)]
    rows = [(None, t) for t in texts] + [(5, t + " more") for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fetched = []
    kept = neardup._sets

    def watched(*args):
        found = kept(*args)
        fetched.append(found.count())
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "first_h" in plan
        return found

    monkeypatch.setattr(neardup, "_sets", watched)
    got = near_duplicates(docs, 3, 85).collect()
    assert fetched[0] <= 600 and len(got) == 600
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == brute(rows, 3, 85, 100)


@pytest.mark.parametrize(("size", "part", "changes"), [(3, 85, 4), (5, 80, 3)])
def test_copies_that_differ_too_much_take_few_pairs(spark, monkeypatch, size, part, changes):
    """One text with some words changed in each copy: all share buckets, most pairs are below the threshold."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for k in range(300):
        words = list(base)
        for at in rng.sample(range(10, 140), changes if k % 3 else rng.randrange(1, 9)):
            words[at] = f"x{rng.randrange(10 if k % 5 else 10**9)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tested, kept = [], neardup._estimated

    def watched(pairs, *args):
        tested.append(pairs.count())
        return kept(pairs, *args)

    monkeypatch.setattr(neardup, "_estimated", watched)
    got = near_duplicates(docs, size, part).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == brute(rows, size, part, 100)
    assert sum(tested[2:]) < 20 * len(rows), tested


@settings(max_examples=25, deadline=None)
@given(st.sets(st.integers(0, 2**63), min_size=1, max_size=60), st.sets(st.integers(0, 2**63), min_size=1, max_size=60))
def test_sketches_merge(a, b):
    s = SetSketch(64)
    x, y, z = (s.registers(np.array(sorted(v), dtype=np.uint64)) for v in (a, b, a | b))
    assert (SetSketch.merge(x, y) == z).all()


def test_likelihood_estimate_is_near_the_similarity():
    rng, s = np.random.default_rng(1), SetSketch(112)
    for share in (0.0, 0.3, 0.6, 0.85, 1.0):
        errors = []
        for _ in range(30):
            pool = rng.integers(0, 2**63, 1600, dtype=np.uint64)
            same = int(800 * share)
            a, b = pool[:800], np.concatenate([pool[:same], pool[800 : 1600 - same]])
            got = s.similarity(s.registers(a)[None], s.registers(b)[None], np.array([800.0]), np.array([800.0]))[0]
            errors.append(got - same / (1600 - same))
        assert abs(np.mean(errors)) < 0.04 and np.abs(errors).max() < 0.22


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
