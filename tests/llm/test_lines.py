from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from riskloom.llm.lines import SPACES, deduplicate_lines, drop_repeated_lines, shared_lines

DOCS = "doc_id long, text string"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain(rows: list[tuple], least_docs: int = 2, least_chars: int = 10) -> list[tuple]:
    """(key, lines, dropped, kept) of each row, in order."""

    def rank(k):
        return (k is None, k or 0)

    holders = defaultdict(set)
    split = [(k, (t or "").split("\n")) for k, t in rows]
    for k, lines in split:
        for line in lines:
            holders[line.strip(SPACES).translate(UPPER)].add(rank(k))
    out = []
    for k, lines in split:
        kept = []
        for line in lines:
            who = holders[line.strip(SPACES).translate(UPPER)]
            long = len(line.strip(SPACES)) >= least_chars
            if not (long and len(who) >= least_docs and min(who) != rank(k)):
                kept.append(line)
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def found(spark, rows, **options) -> list[tuple]:
    out = deduplicate_lines(spark.createDataFrame(rows, DOCS), **options)
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    return [tuple(r) for r in out.collect()]


def same(spark, rows, **options) -> None:
    assert sorted(map(repr, found(spark, rows, **options))) == sorted(map(repr, plain(rows, **options)))


def test_random_texts(spark):
    rng = random.Random(5)
    lines = ["", " ", "short", "exactly 10", "EXACTLY 10\t", " a shared line of words ", "A Shared Line of Words", "ÄÖÜ äöü ÄÖÜ x", "äöü äöü äöü x", "\x0bother line of words\r", "x" * 40]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    same(spark, rows)
    same(spark, rows, least_docs=12, least_chars=3)


def test_nulls_repeats_and_empty(spark):
    line = "a line that many hold"
    rows = [(7, line), (7, line), (7, f"{line}\nb"), (None, line), (None, f"{line}\n{line}"), (9, None), (10, ""), (11, f"\n{line}\n"), (3, "unlike any other line")]
    same(spark, rows)
    # one document only: nothing goes, however often it holds the line
    same(spark, [(5, f"{line}\n{line}"), (5, line)])
    same(spark, [(None, line), (None, f"x\n{line}")])
    assert found(spark, []) == []


def test_only_ascii_changes_case(spark):
    same(spark, [(1, "ÉCOLE PUBLIQUE"), (2, "école publique"), (3, "École Publique"), (4, "ÉCOLE publique")])


def test_very_long_texts(spark):
    long = "\n".join(f"line number {i} of a long text" for i in range(30_000))
    rows = [(1, "line number 29999 of a long text"), (2, long), (3, "y" * 2_000_000), (4, "y" * 2_000_000)]
    same(spark, rows)


def test_one_line_in_most_documents(spark):
    """A hot line, which goes by broadcast, beside rare shared ones."""
    rows = [(i, f"the one line everywhere\nof document {i // 2} alone\n") for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    lines, shared = shared_lines(docs)
    assert {r["n_docs"]: r["n"] for r in shared.groupBy("n_docs").agg(F.count("*").alias("n")).collect()} == {400: 1, 2: 200}
    same(spark, rows)


def test_clashing_columns(spark):
    names = ["k", "at", "t1", "h1", "lost", "lines", "row", "n_lines", "n_dropped", "kept", "line"]
    rows = [(1, "a line that two hold\nx"), (2, "y\na line that two hold"), (3, None)]
    docs = spark.createDataFrame(rows, DOCS).select("doc_id", *[F.lit(i).alias(n) for i, n in enumerate(names)], "text")
    out = drop_repeated_lines(docs)
    assert out.schema.fieldNames() == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert {k: r["text"] for k, r in got.items()} == {1: "a line that two hold\nx", 2: "y", 3: None}
    assert all(r[n] == i for r in got.values() for i, n in enumerate(names))
    counts = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in deduplicate_lines(docs).collect()}
    assert counts == {1: (2, 0), 2: (2, 1), 3: (1, 0)}


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a line that two hold"), (2, "a line that two hold")], DOCS)
    plan = deduplicate_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
