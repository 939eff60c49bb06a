"""Quality counts by definition; cutoffs keep good rows and catch bad ones."""

from __future__ import annotations

import random
import re

import pytest

from riskloom.llm.quality import CUTOFFS, certified, keep_good, quality_rules, rules, tail

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    clean = lambda n=60: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8))) for _ in range(n)) + "."
    out, labels = [], []
    for i in range(3000):
        lang, kind = ("en", "de")[i % 2], rng.random()
        text, good, toxic = clean(), 1, 0
        if kind < 0.1:
            text, good = text.upper(), 0
        elif kind < 0.2:
            text, good = text.replace(" ", "%% "), 0
        elif kind < 0.3:
            text, toxic = text + " you vile wretched knave", 1
        out.append((i, text, lang, 5))
        labels += [(i, good, toxic)] if i % 5 else []
    out += [(9000, None, "en", 0), (9001, "", None, 0), (9002, "a b\na b\n \n \nc", "xx", 0), (None, clean(), None, 0), (5, "x y z " * 30, "en", 0)]
    out += [(9003, "one two three four five six seven eight nine ten one two three four five", "en", 0), (9004, "é ü\x85 a " * 4, "fr", 0), (9005, "ab c " * 3000, "de", 0)]
    out += [(9006, " ".join(f"w{i}" for i in range(4)), "en", 0), (9007, "t " * 5, "en", 0), (9008, "t " * 6, "en", 0)]
    labels += [(None, 1, 0), (9000, None, 1), (7, 0, 0), (7, 1, 0), (77777, 1, 0)]
    return out, labels


@pytest.fixture(scope="module")
def tables(spark, rows):
    docs = spark.createDataFrame(rows[0], "doc_id long, text string, lang string, n_words int").repartition(4)
    return docs, spark.createDataFrame(rows[1], "doc_id long, quality int, toxic int")


def test_counts_and_verdict(rows, tables):
    got = quality_rules(*tables).collect()
    base = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert base == sorted((str(k), *brute(t)) for k, t, *_ in rows[0])
    text = {k: t for k, t, *_ in rows[0] if k is not None and k < 3000}
    once = {r.doc_id: r for r in got if r.doc_id in text and r.doc_id != 5}
    bad = [k for k in once if text[k].isupper() or "%%" in text[k] or "knave" in text[k]]
    assert not any(once[k].kept for k in bad)
    assert sum(once[k].kept for k in once if k not in set(bad)) >= 0.99 * (len(once) - len(bad))
    assert all(not r.kept for r in got if r.base_failed)


def test_stage_drops_rejected_rows(tables):
    docs, labels = tables
    verdict = quality_rules(docs, labels).where("kept").count()
    kept = keep_good(docs, labels)
    assert kept.count() == verdict and kept.columns == docs.columns
    assert keep_good(docs.limit(0), labels).count() == 0
    # without labels only the base rules hold
    assert quality_rules(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_no_python_in_the_plan(tables):
    plan = quality_rules(*tables)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_binomial_tail():
    from math import comb

    for n, k, p in ((10, 0, 0.1), (50, 3, 0.2), (200, 30, 0.1), (7, 7, 0.3), (1000, 0, 0.01)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail(n, k, p) - want) < 1e-12


def test_false_rejection_is_rarely_above_the_risk():
    """Over many drawn holdouts the chosen cutoff loses more good rows than allowed at most as often as the level says."""
    rng, broken = random.Random(4), 0
    name = "upper_share"
    for _ in range(200):
        values = [rng.random() ** 3 for _ in range(400)]  # P(value > c) = 1 - c ** (1/3)
        tested = [(400, sum(v > c for v in values)) for c in CUTOFFS[name]]
        cutoff = CUTOFFS[name][certified(tested, 0.2, 0.1)]
        broken += 1 - cutoff ** (1 / 3) > 0.2
    assert broken <= 30
    assert certified([(0, 0)], 0.2, 0.1) == 0 and certified([(400, 0), (400, 1), (400, 399)], 0.2, 0.1) == 1


def test_rules_grow_stricter_and_stop_where_good_rows_are_lost():
    none = {name: [(100, 0)] * len(c) for name, c in CUTOFFS.items()}
    found = rules(none, 0.1)
    assert found[0] == {} and found[-1] == {name: c[-1] for name, c in CUTOFFS.items()}
    assert all(a.items() <= b.items() or all(b[n] <= v for n, v in a.items()) for a, b in zip(found, found[1:], strict=False))
    lost = none | {"upper_share": [(100, 0)] * 3 + [(100, 9)] * (len(CUTOFFS["upper_share"]) - 3)}
    assert rules(lost, 0.1)[-1]["upper_share"] == CUTOFFS["upper_share"][2]
    assert rules({name: [(0, 0)] * len(c) for name, c in CUTOFFS.items()}, 0.1) == [{}]


def test_words_are_certified_where_shapes_are_not_and_in_pooled_strata(spark):
    """Good holdout rows of en have symbols that fit rows do not show; a, b and c are too small alone."""
    rng = random.Random(5)
    fit = {r.id for r in spark.range(1200).where("pmod(xxhash64(id, 'part'), 10) < 3").collect()}
    docs, labels = [], []
    for i in range(1200):
        lang, toxic = ("en" if i < 900 else "abc"[i % 3]), int(i % 4 == 0)
        text = " ".join("".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(40))
        text += " you vile knave" if toxic else ""
        if lang == "en" and not toxic and i not in fit and i % 5 == 1:
            text = text.replace(" ", " %%% ")
        docs.append((i, text, lang))
        labels.append((i, 1, toxic))
    tables = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality_rules(*tables).where("kept").collect()}
    assert kept == {i for i in range(1200) if i % 4}
