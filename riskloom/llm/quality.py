"""Quality rules whose cutoffs come from labelled rows, with a bound on false rejections.

Built-in expressions only: one pass over the texts gives all counts, a second,
narrow one tests cutoffs on labelled rows.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_side, store, text_or_empty

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Higher is worse; cutoffs from lenient to strict, a row is rejected above the cutoff.
SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02)
CUTOFFS = {
    "symbol_share": SHARES,
    "upper_share": SHARES,
    "repeat_share": SHARES,
    "dup_line_share": SHARES,
    "marked_words": (9.0, 7.0, 5.0, 4.0, 3.0, 2.0, 1.0, 0.0),
}


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def measures(rows: DataFrame, marked: list[str], text: str = "_text", prefix: str = "_") -> DataFrame:
    """Rows with the counts of the texts in columns named with the prefix; no shuffle.

    Five-word windows are compared by 64-bit hashes. Only texts that repeat one are
    sorted by (hash, place) to find which words the repeated windows cover.
    """
    t, p = F.col(text), prefix
    words = F.col(f"{p}words")
    n = F.size(words)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW)))
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window))
    rows = rows.withColumn(f"{p}words", _words(t)).withColumns({f"{p}grams": grams, f"{p}lines": lines})
    g = F.col(f"{p}grams")
    again = F.size(F.array_distinct(g)) < F.size(g)
    rows = rows.withColumn(f"{p}sorted", F.when(again, F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))))
    s = F.col(f"{p}sorted")
    rest = F.slice(s, 2, F.greatest(F.size(s), F.lit(1)))
    pairs = F.zip_with(s, rest, lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    rows = rows.withColumn(f"{p}places", places)
    at = F.col(f"{p}places")
    steps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(steps, F.lit(0), lambda total, x: total + x), F.lit(0))
    plain = F.split(F.lower(t), r"[^\p{L}]+")
    found = F.size(F.array_intersect(plain, F.array(*map(F.lit, marked)))) if marked else F.lit(0)
    rows = rows.withColumns(
        {
            f"{p}n_words": n.cast("long"),
            f"{p}word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
            f"{p}n_symbols": _count_of(t, SYMBOLS).cast("long"),
            f"{p}n_dup_lines": (F.size(f"{p}lines") - F.size(F.array_distinct(f"{p}lines"))).cast("long"),
            f"{p}n_repeat_words": covered.cast("long"),
            f"{p}n_lines": F.size(f"{p}lines").cast("long"),
            f"{p}n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
            f"{p}marked_words": found.cast("double"),
        }
    )
    return rows.drop(*(f"{p}{c}" for c in ("words", "grams", "lines", "sorted", "places")))


def signals(prefix: str = "_") -> dict[str, Column]:
    col = lambda c: F.col(prefix + c)
    share = lambda a, b: F.when(col(b) > 0, col(a) / col(b)).otherwise(0.0)
    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "marked_words": col("marked_words"),
    }


def tail(n: int, k: int, rate: float) -> float:
    """Exact P(Binomial(n, rate) <= k)."""
    if k >= n:
        return 1.0
    log_of = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate)
    total, top = 0.0, log_of(k)
    for i in range(k, -1, -1):
        term = math.exp(log_of(i) - top)
        total += term
        if i < n * rate and term < total * 1e-17:  # terms fall from here on
            break
    return min(1.0, math.exp(top) * total)


ORDERS = 3  # sequences of rules per stratum
STEPS = 3  # cutoffs of a signal on the way to its strictest one


def _steps(counts: dict[str, list[tuple[int, int]]], risk: float) -> list[tuple[str, float]]:
    out = []
    for name, tested in counts.items():
        fits = [i for i, (n, k) in enumerate(tested) if n and k * 2 * len(counts) <= n * risk]
        last = next((i for i in range(len(tested)) if i not in fits), len(tested)) - 1
        steps = range(last + 1) if name == "marked_words" else sorted({last * (i + 1) // STEPS for i in range(STEPS)} if last >= 0 else ())
        out += [(name, CUTOFFS[name][i]) for i in steps]
    return out


def _sequence(steps: list[tuple[str, float]]) -> list[dict[str, float]]:
    return list(itertools.accumulate(({name: c} for name, c in steps), lambda rule, step: rule | step, initial={}))


def rules(counts: dict[str, list[tuple[int, int]]], risk: float) -> list[dict[str, float]]:
    """Rules from none to strict: each adds or tightens the cutoff of one signal.

    ``counts`` has (good rows, good rows rejected) per signal and cutoff on the fit
    rows, lenient first. A signal goes as far as its share of half the risk allows
    there. Signals come in a fixed order, the learned words last.
    """
    return _sequence(_steps(counts, risk))


def orders(counts: dict[str, list[tuple[int, int]]], risk: float) -> list[list[dict[str, float]]]:
    """Sequences like ``rules`` in which the learned words come last, first, or first
    but for their strictest cutoff, so that neither they nor the other signals end
    the only sequence before the others are tried."""
    steps = _steps(counts, risk)
    words, shapes = ([x for x in steps if (x[0] == "marked_words") == w] for w in (True, False))
    first = sorted({0, max(len(words) - 1, 0), len(words)}) if shapes else [0]
    return [_sequence(words[:n] + shapes + words[n:]) for n in first]


def certified(tested: list[tuple[int, int]], risk: float, level: float) -> int:
    """How far down a sequence of rules the exact binomial test holds.

    ``tested`` has (good rows, good rows rejected) of each rule on the holdout. The
    sequence was fixed before; testing stops at the first failure, so that the whole
    sequence costs one test's level.
    """
    for i, (n, k) in enumerate(tested):
        if n == 0 or tail(n, k, risk) > level:
            return max(i - 1, 0)
    return len(tested) - 1


def marked_vocabulary(docs: DataFrame, labels: DataFrame, key: str, text: str, fit_rows: int, least: int, terms: int) -> list[str]:
    """Words that occur in at least ``least`` toxic rows of the fit part and in no
    other row of it, most frequent first, at most ``terms``. The fit part has at most
    ``fit_rows`` rows (those with the smallest hashes)."""
    chosen = labels.where(F.col("_fit")).orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    rows = docs.select(F.col(key).alias("_id"), text_or_empty(text).alias("_text")).join(chosen, "_id")
    words = rows.select("_toxic", F.explode(F.array_distinct(F.split(F.lower("_text"), r"[^\p{L}]+"))).alias("word")).where("word <> ''")
    seen = words.groupBy("word").agg(F.sum(F.col("_toxic").cast("int")).alias("toxic"), F.count("*").alias("n"))
    return [r["word"] for r in seen.where((F.col("toxic") == F.col("n")) & (F.col("n") >= least)).orderBy(F.desc("n"), "word").limit(terms).collect()]


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    risk: float = 0.05,
    level: float = 0.05,
    fit_rows: int = 20_000,
    least: int = 5,
    terms: int = 1_000,
) -> DataFrame:
    """Per row of docs: key, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, the signals and the hash of the text.

    ``labels`` has key, quality and toxic (0/1); a row is good with quality 1 and
    toxic 0. Three tenths of the labelled rows (by hash of the key) find words that
    only toxic rows use, and per stratum up to three sequences of ever stricter rules
    (``orders``); the others are the holdout. Each sequence ends at the last rule down
    to which the exact binomial test shows, at the level divided by the numbers of
    strata and of the stratum's sequences (Bonferroni), that the whole rule rejects at
    most ``risk`` of good rows. All these rules hold together; a stratum takes the one
    that rejects most bad or toxic holdout rows. Strata whose good holdout rows are too
    few for any rule are one stratum, the pool. So with probability 1 - level no stratum,
    and not the pool as a whole, loses more than ``risk`` of its good rows to the cutoffs.
    A stratum without good holdout rows, and a pool without enough, keep what passes the
    base rules.

    Null text has no words (base_failed). Null strata are a stratum. Null and
    repeated keys are judged by their own text; labels of repeated keys count as bad
    if any is; rows without label teach nothing. The strata (languages) must be few:
    one row each reaches the driver. Empty tables give empty results.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col(key).alias("_id")).agg((F.min("quality") > 0).alias("_good"), (F.max("toxic") > 0).alias("_toxic"))
    fit = F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(10)) < 3
    known = known.withColumn("_fit", fit)
    marked = marked_vocabulary(docs, known, key, text, fit_rows, least, terms)

    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"), text_or_empty(text).alias("_text"))
    rows = measures(rows.withColumn("_hash", F.xxhash64("_text")), marked).drop("_text")
    failed = (F.col("_n_words") < 10) | (100 * F.col("_n_repeat_words") > 20 * F.col("_n_words"))
    rows = rows.withColumns({k: v for k, v in signals().items() if k not in rows.columns}).withColumn("_failed", failed)
    rows = store(rows, "measures")

    labelled = rows.join(known.select("_id", "_fit", (F.col("_good") & ~F.col("_toxic")).alias("_fine")), "_id")
    number = lambda condition: F.coalesce(F.sum(condition.cast("int")), F.lit(0))
    fine, fitted = F.col("_fine"), F.col("_fit")
    tested = [number(fitted & (F.col(name) > c)).alias(f"{name}:{c}") for name, cutoffs in CUTOFFS.items() for c in cutoffs]
    found = labelled.where(fine).groupBy("_stratum").agg(number(fitted).alias("n"), number(~fitted).alias("held"), *tested).collect()
    found = [r for r in found if r["held"]]
    few = {r["_stratum"] for r in found if tail(r["held"], 0, risk) * len(found) * ORDERS > level}
    pool_of = {r["_stratum"]: None if r["_stratum"] in few else r["_stratum"] for r in found}
    pools = set(pool_of.values())
    sequences = {}
    for g in pools:
        mine = [r for r in found if pool_of[r["_stratum"]] == g]
        sequences[g] = orders({name: [(sum(r["n"] for r in mine), sum(r[f"{name}:{c}"] for r in mine)) for c in cutoffs] for name, cutoffs in CUTOFFS.items()}, risk)

    def above(rule: dict[str, float]) -> Column:
        return functools.reduce(lambda x, y: x | y, (F.col(name) > c for name, c in rule.items()), F.lit(False))

    def rejecting(chosen: dict[str | None, dict[str, float]]) -> Column:
        one = ((F.col("_stratum") == s) & above(chosen[g]) for s, g in pool_of.items() if chosen.get(g))
        return functools.reduce(lambda x, y: x | y, one, F.lit(False))

    # all rules of a pool's sequences, one after the other
    listed = {g: [rule for q in qs for rule in q] for g, qs in sequences.items()}
    steps = max(map(len, listed.values()), default=0)
    by_step = [rejecting({g: q[i] for g, q in listed.items() if i < len(q)}) for i in range(steps)]
    lost = [number(c & fine).alias(f"k{i}") for i, c in enumerate(by_step)]
    caught = [number(c & ~fine & ~F.col("_failed")).alias(f"b{i}") for i, c in enumerate(by_step)]
    counted = labelled.where(~fitted).groupBy("_stratum").agg(number(fine).alias("n"), *lost, *caught).collect() if steps else []
    chosen = {}
    for g, qs in sequences.items():
        mine = [r for r in counted if r["_stratum"] in pool_of and pool_of[r["_stratum"]] == g]
        total = lambda c, mine=mine: sum(r[c] for r in mine)
        begin, ends = 0, []
        for q in qs:
            held = [(total("n"), total(f"k{begin + i}")) for i in range(len(q))]
            ends.append(begin + certified(held, risk, level / (len(pools) * len(qs))))
            begin += len(q)
        chosen[g] = listed[g][max(ends, key=lambda i: total(f"b{i}"))]
    rejected = rejecting(chosen)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        F.col("_id").alias(key),
        *(F.col(f"_{c}").alias(c) for c in base),
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & ~rejected).alias("kept"),
        *CUTOFFS,
        F.col("_hash").alias("text_hash"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of docs that pass ``quality_rules``."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    bad = quality_rules(docs, labels, **options).where(~F.col("kept")).select(F.col(key).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    bad = small_side(store(bad, "rejected"))
    return docs.join(bad, docs[key].eqNullSafe(bad["_id"]) & (F.xxhash64(text_or_empty(text)) == bad["_hash"]), "left_anti")
