"""Detection rates against ground truth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def detection_metrics(scored: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """True and false positive rates, overall and per fraud type.

    ``rules`` names one or more readings of "detected" (default: not LOW); all
    are counted in one pass. Rows without a ground-truth flag are left out.
    Legitimate rows have no type and appear in the overall line only.
    """
    rules = rules or {"not_low": F.col("risk_level") != "LOW"}
    fraud = F.col("actual_fraud_flag")
    counts = {"frauds": F.count_if(fraud), "legitimate": F.count_if(~fraud)}
    for i, flagged in enumerate(rules.values()):
        counts[f"_hit_{i}"] = F.count_if(fraud & F.coalesce(flagged, F.lit(False)))
        counts[f"_false_{i}"] = F.count_if(~fraud & F.coalesce(flagged, F.lit(False)))
    kind = F.coalesce("actual_fraud_type", F.lit("none")).alias("fraud_type")
    by_type = scored.where(fraud.isNotNull()).groupBy(kind).agg(*[c.alias(n) for n, c in counts.items()])
    # one row per fraud type: cheap to add up again
    overall = by_type.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts])
    lines = overall.select(F.lit("all").alias("fraud_type"), *counts).unionByName(by_type.where("frauds > 0"))
    per_rule = F.array(
        *[
            F.struct(
                F.lit(name).alias("positive_rule"),
                F.col(f"_hit_{i}").alias("frauds_flagged"),
                F.col(f"_false_{i}").alias("legitimate_flagged"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return lines.select("fraud_type", "frauds", "legitimate", F.inline(per_rule)).select(
        "*",
        (F.col("frauds_flagged") / F.nullif("frauds", F.lit(0))).alias("true_positive_rate"),
        (F.col("legitimate_flagged") / F.nullif("legitimate", F.lit(0))).alias("false_positive_rate"),
    )
