"""Base scores by definition; the model is a distribution and beats the base on held-out rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import language_model
from riskloom.llm.common import mix
from riskloom.llm.language_model import _hashes, held_out_by_checksum, perplexity, score, seat


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    follow = {w: [rng.choice(vocabulary) for _ in range(4)] for w in vocabulary}  # words depend on the one before
    out = [(None, "one two"), (7001, None), (7002, ""), (7003, "A\x0bB c  À"), (5, "again and again"), (7004, "w1 " * 20000)]
    for d in range(600):
        w, words = rng.choice(vocabulary), []
        for _ in range(rng.randrange(60)):
            words.append(w)
            w = rng.choice(follow[w]) if rng.random() < 0.8 else rng.choice(vocabulary)
        out.append((d, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(k, t, 0.0, "x") for k, t in rows], "doc_id long, text string, score double, block string").repartition(4)


def words(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), ""]


def test_base_columns(rows, docs):
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    counts = Counter(w for k, t in rows if not held(k) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(k), held(k), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for k, t in rows)
    got = score(docs, held_out_by_checksum()).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    again = score(docs.repartition(3), held_out_by_checksum()).collect()
    close = lambda rows: sorted((str(r.doc_id), r.n_tokens, round(r.score, 4)) for r in rows)
    assert close(got) == close(again)  # draws depend on words, not on tasks


def test_held_out_perplexity(docs):
    by = perplexity(score(docs.where("doc_id < 7000"), held_out_by_checksum())).set_index("held_out")
    assert by.loc[True, "model"] < 0.6 * by.loc[True, "base"]


def test_frequent_contexts_are_likelier(spark):
    rows = [(0, "a b a b a c"), (1, "b b c d a")]
    vocabulary = ["a", "b", "c", "d", ""]  # the empty text is the end
    probes = [(100 + i, f"{u} {w}".strip()) for i, (u, w) in enumerate((u, w) for u in ("a", "zzz") for w in (*vocabulary[:4], "unseen"))] + [(200, "a"), (201, "zzz"), (300, "")]
    docs = spark.createDataFrame(rows + probes, "doc_id long, text string")
    got = {r.doc_id: 10**r.score for r in score(docs, F.col("doc_id") >= 100).collect()}
    assert all(0 < p < 1 for p in got.values()) and got[200] > got[201]


def test_no_training_rows_and_empty_table(spark, docs):
    got = score(docs.where("doc_id < 3"), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score) < 1e-9 for r in got) and len(got) == 3
    assert score(docs.limit(0), F.lit(False)).count() == 0


def test_seating_follows_the_restaurant():
    """Mean tables over many dishes against the process simulated customer by customer."""
    rng, n = random.Random(2), 4000
    for customers, strength, discount, others, above in ((2, 1.0, 0.5, 10, 0.05), (20, 1.0, 0.7, 3, 0.5), (200, 0.5, 0.3, 100, 0.02), (3000, 2.0, 0.1, 0, 0.3)):
        got = seat(np.full(n, float(customers)), strength, discount, np.full(n, float(others)), np.full(n, above), np.arange(n, dtype=np.uint64)).mean()
        total, runs = 0, 1500 if customers < 1000 else 200
        for _ in range(runs):
            t = 1
            for k in range(1, customers):
                o = (strength + discount * (others + t)) * above
                t += rng.random() < o / (o + k - discount * t)
            total += t
        assert abs(got - total / runs) < 0.06 * total / runs
    assert seat(np.array([0.0, 1.0]), 1.0, 0.5, np.zeros(2), np.ones(2), np.arange(2, dtype=np.uint64)).tolist() == [0, 1]


def plain_scores(rows, held, sweeps=4, burn_in=1, strength=1.0, seed=1):
    """The model with dictionaries, one dish after the other, with the draws of ``seat``."""
    pairs, words = Counter(), Counter()
    for k, t in rows:
        if not held(k):
            tokens = _hashes(t or "").tolist()
            pairs.update(zip([0, *tokens], tokens, strict=False))
            words.update(tokens)
    base = 1 / (len(words) + 1)
    rate = lambda c: min(0.95, max(0.1, c[1] / (c[1] + 2 * c[2]))) if c[1] + c[2] else 0.5
    d0, d1 = rate(Counter(words.values())), rate(Counter(pairs.values()))
    one = lambda x: np.array([x], np.uint64)
    draw = lambda c, d, others, p, key: seat(np.array([float(c)]), strength, d, np.array([float(others)]), np.array([p]), key)[0]

    tables, parents, samples = {}, {}, []
    for i in range(sweeps):
        salt = mix(one(seed * 1000 + i))
        if i == 0:
            tables = dict.fromkeys(pairs, 1)
        else:
            before, in_context, p = tables, Counter(), samples[-1][0]
            for (u, _), t in before.items():
                in_context[u] += t
            tables = {(u, w): draw(c, d1, in_context[u] - before[u, w], p(w), mix(one(w) ^ mix(one(u))) ^ salt) for (u, w), c in pairs.items()}
        customers, in_context = Counter(), Counter()
        for (u, w), t in tables.items():
            customers[w] += t
            in_context[u] += t
        everyone = sum(parents.values())
        parents = {w: draw(customers[w], d0, everyone - parents[w], base, mix(one(w)) ^ salt) if i else 1 for w in words}

        def p(w, customers=customers, parents=parents, n=sum(customers.values()), t=sum(parents.values())):
            return (customers[w] - d0 * parents.get(w, 0) + (strength + d0 * t) * base) / (strength + n)

        def probability(u, w, tables=tables, in_context=in_context, p=p):
            own = pairs[u, w] - d1 * tables[u, w] if (u, w) in pairs else 0
            return (own + (strength + d1 * in_context[u]) * p(w)) / (strength + words[u])

        samples.append((p, probability))
    result = []
    for k, t in rows:
        tokens = _hashes(t or "").tolist()
        each = [sum(f(u, w) for _, f in samples[burn_in:]) / (sweeps - burn_in) for u, w in zip([0, *tokens], tokens, strict=False)]
        result.append((str(k), len(tokens), round(sum(map(math.log10, each)), 3)))
    return sorted(result), [*words], samples[-1][1]


def test_scores_against_a_plain_model(spark, rows, docs, monkeypatch):
    """All scores, with blocks of a few documents, joins by shuffle and more buckets than blocks."""
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    want, words_of_model, probability = plain_scores(rows, held)
    for u in (0, *words_of_model[:5], 12345):  # each context has a distribution
        assert abs(sum(probability(u, w) for w in (*words_of_model, 2)) - 1) < 1e-9
    got = [score(docs, held_out_by_checksum()).collect()]
    monkeypatch.setattr(language_model, "TOKENS", 700)
    monkeypatch.setattr(language_model, "small_side", lambda rows: rows)
    got.append(score(docs, held_out_by_checksum()).collect())
    for result in got:
        close = sorted((str(r.doc_id), r.n_tokens, r.score) for r in result)
        assert [x[:2] for x in close] == [x[:2] for x in want]
        assert all(abs(a[2] - b[2]) < 1e-3 + 1e-6 * abs(b[2]) for a, b in zip(close, want, strict=True))
