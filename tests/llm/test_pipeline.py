"""The stages in turn against their plain versions."""

from __future__ import annotations

import random
import re

import corpus_pipeline
import numpy as np
import pytest

from tests.llm.test_neardup import shingles
from tests.llm.test_quality import brute as counts
from tests.llm.test_tiling import brute_tiles
from tests.llm.test_tokens import checksum, ids_of


def plain(docs, items):
    """What is left of (id, text) rows after the first four stages; few labels give no cutoffs."""
    docs = [(k, t) for k, t in docs if not counts(t)[5]]
    sets = {k: shingles(t, 5) for k, t in docs}
    group = {k: k for k in sets}
    for _ in docs:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    docs = sorted((k, t.encode()) for k, t in docs if group[k] == k)
    seen, left = set(), []
    for _, t in docs:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 99):
            if t[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(t[i : i + 100])
        left.append(gone)
    texts = []
    for (k, t), gone in zip(docs, left, strict=True):
        out, at = [], 0
        for c in t.decode():
            n = len(c.encode())
            out += [] if gone[at : at + n].all() else [c]
            at += n
        texts.append((k, "".join(out)))
    tokens = lambda t: re.findall(r"\w+", t.lower())
    share = lambda i, t: sum(n for *_, n in brute_tiles(tokens(i), tokens(t), 5)) / len(tokens(i))
    return [(k, t) for k, t in texts if all(share(i, t) < 0.5 for i in items)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(6)
    words = ["".join(rng.choice("aeéintrslß") for _ in range(rng.randrange(2, 8))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items, passages = [text(25) for _ in range(3)], [text(60) for _ in range(3)]
    docs = []
    for k in range(60):
        body = text(rng.randrange(5, 90))
        if k % 5 == 1:
            body += " " + rng.choice(passages) + " " + text(5)
        if k % 11 == 2:
            body = f"{body[:40]} {rng.choice(items)} {body[40:]}"
        if k % 13 == 3:
            body = "same words again " * 20
        if k > 40 and k % 4 == 0:
            body = docs[k // 3][1] + " end"
        docs.append((k, body))
    path = tmp_path_factory.mktemp("pipeline")
    rows = [(k, t, "en", "s", len(t)) for k, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, items


def test_stages_and_rows(spark, folder):
    path, docs, items = folder
    want = plain(docs, items)
    assert 20 < len(want) < 50
    rows = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        columns, rows = rows.columns, stage(spark, rows, path)
        assert rows.columns == columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in rows.collect()) == sorted((k, t, len(t)) for k, t in want)
    pieces = corpus_pipeline.run(spark, path).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in pieces if r.length == r.doc_tokens) == sorted(
        (k, 0, len(ids_of(t)), checksum(ids_of(t))) for k, t in want
    )
    assert sum(r.length for r in pieces) == sum(len(ids_of(t)) for _, t in want) and {r.sequence_id for r in pieces} == set(range(-(-sum(r.length for r in pieces) // 4096)))
