"""Lines that several documents share, dropped except in the first of them.

Built-in functions only. Lines travel as hashes; texts move once, to meet the
positions of the lines they lose.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import store

SPACES = " \t\n\x0b\x0c\r"
# A line that makes up this share of all lines is joined by broadcast: there are at
# most as many such lines as the share's inverse.
HOT_SHARE = 1 / 10_000


def _normal(text: Column) -> Column:
    """A-Z in lower case, nothing else; ``lower`` does the same and is faster on ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(name: str, value: Column) -> list[Column]:
    """Two 64-bit hashes of different seeds."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(11), value).alias(f"{name}2")]


def shared_lines(docs: DataFrame, least_docs: int = 2, least_chars: int = 10, *, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All long enough lines of the documents, and those that enough documents share.

    The first table has a row per line: k (key), t1, t2 (hashes of the whole text),
    at (position), h1, h2 (hashes of the normalised line). The second has a row per
    shared line: h1, h2, n_docs, n_lines, first (the smallest key that holds it, null
    last).
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("k"), value.alias("t"))
    rows = rows.select("k", *_hashes("t", F.col("t")), F.posexplode(F.split(_normal(F.col("t")), "\n", -1)).alias("at", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(SPACES))).where(F.length("line") >= least_chars)
    lines = store(rows.select("k", "t1", "t2", "at", *_hashes("h", F.col("line"))), "lines")
    # structs, so that a null key counts as a document
    shared = lines.groupBy("h1", "h2").agg(
        F.count_distinct(F.struct("k")).alias("n_docs"),
        F.count("*").alias("n_lines"),
        F.min(F.struct(F.col("k").isNull().alias("none"), "k")).alias("first"),
    )
    return lines, store(shared.where(F.col("n_docs") >= least_docs), "shared")


def _lost(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """(k, t1, t2, lost): positions that each text loses; a row per key and text."""
    heavy = F.lit(HOT_SHARE * lines.count())
    hot = F.broadcast(shared.where(F.col("n_lines") > heavy).select("h1", "h2", "first"))
    others = shared.where(F.col("n_lines") <= heavy).select("h1", "h2", "first")
    on = ["h1", "h2"]
    found = lines.join(hot, on).unionByName(lines.join(hot, on, "left_anti").join(others, on))
    elsewhere = ~F.struct(F.col("k").isNull().alias("none"), "k").eqNullSafe(F.col("first"))
    return found.where(elsewhere).groupBy("k", "t1", "t2").agg(F.collect_set("at").alias("lost"))


def _reassembled(docs: DataFrame, least_docs: int, least_chars: int, key: str, text: str) -> DataFrame:
    """row (all columns of docs), n_lines, n_dropped, kept (lines)."""
    lost = _lost(*shared_lines(docs, least_docs, least_chars, key=key, text=text))
    lost = lost.withColumnsRenamed({"k": "lk", "t1": "l1", "t2": "l2"})
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # the text travels as its lines
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(F.col(text).isNull().alias(text), *others).alias("row"), F.col(key).alias("k"), *_hashes("t", value), F.split(value, "\n", -1).alias("lines")
    )
    same = F.col("k").eqNullSafe(F.col("lk")) & (F.col("t1") == F.col("l1")) & (F.col("t2") == F.col("l2"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.col("lines")[i]))
    return rows.join(lost, same, "left").select(
        "row",
        "k",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


def deduplicate_lines(docs: DataFrame, least_docs: int = 2, least_chars: int = 10, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, n_lines (before dropping), n_dropped, kept (the text left).

    A line's key is the line without white space at both ends, A-Z in lower case. Keys
    of at least ``least_chars`` code points found in at least ``least_docs`` documents
    lose all their lines except in the document with the smallest key that holds them.
    A null or empty text is one empty line. Rows that repeat a key are one document for
    counting and each keep their own text; rows without a key are together one document
    that comes last. Shorter lines, empty ones included, always stay. Other columns are
    ignored; an empty table gives an empty one.
    """
    rows = _reassembled(docs, least_docs, least_chars, key, text)
    return rows.select(F.col("k").alias(key), "n_lines", "n_dropped", "kept")


def drop_repeated_lines(docs: DataFrame, least_docs: int = 2, least_chars: int = 10, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the text that ``deduplicate_lines`` leaves; a null text stays null,
    other columns stay as they are, whatever their names."""
    rows = _reassembled(docs, least_docs, least_chars, key, text)
    left = F.when(~F.col("row")[text], F.col("kept")).alias(text)
    return rows.select(*[left if c == text else F.col("row")[c].alias(c) for c in docs.columns])
