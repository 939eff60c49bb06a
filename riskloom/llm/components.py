"""Connected components of a graph stored as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for each node of the edges; label is the smallest node of its component.

    Alternates two steps until each node is a root or has a root as its only neighbour:
    each node's larger neighbours are linked to its smallest neighbour, then the same for
    smaller ones. Each round is written to the shared folder; the number of rounds is
    logarithmic in practice. A node with very many neighbours is aggregated before the
    shuffle.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = store(pairs, "edges")
    while not _is_star_forest(pairs):
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: u and its smaller neighbours go to the smallest of them
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).where("u <> v").distinct()
        pairs = store(small, "star")
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("node", F.col("node").alias("label")))


def _is_star_forest(pairs: DataFrame) -> bool:
    """Whether no node has two edges to smaller nodes, or edges to both smaller and larger ones."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(pairs.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).agg(F.count("*")).first()[0] == 0
