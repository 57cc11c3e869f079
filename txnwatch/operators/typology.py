"""The first typology that fits a scored row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def typology(threshold: float = 0.75) -> Column:
    is_set = lambda name: F.col(name) == 1
    amount = F.col("amount")
    steps = [
        ("STRUCTURING", is_set("near_threshold_flag") & (F.col("txn_count_same_day") >= 3)),
        ("MULE_ACCOUNT", is_set("rapid_pass_through") & (F.col("distinct_senders") >= 2)),
        ("LAYERING", is_set("rapid_pass_through")),
        ("DORMANT_SPIKE", is_set("dormant_flag") & (amount > 50000)),
        ("WATCHLIST_HIT", is_set("watchlist_hit") & (amount > 5000)),
        ("PEP_LARGE_TXN", is_set("pep_numeric") & (amount > 100000)),
        ("SMURFING", (F.col("cash_dep_count_48h") >= 7) & is_set("is_cash")),
        ("CASH_INTENSIVE", is_set("is_cash") & is_set("is_night") & (amount > 25000)),
        ("HIGH_VELOCITY", F.col("txn_count_1h") > 5),
        ("UNKNOWN_SUSPICIOUS", F.col("final_risk_score") > threshold),
    ]
    label, *rest = steps
    out = F.when(label[1], label[0])
    for name, condition in rest:
        out = out.when(condition, name)
    return out.otherwise("CLEAN")


def typology_label(scored: DataFrame) -> DataFrame:
    return scored.withColumn("fraud_type", typology())


def coarse_type(score: Column, threshold: float = 0.75) -> Column:
    """What a micro-batch says before the full typology runs."""
    return F.when(score > threshold, "UNKNOWN_SUSPICIOUS").otherwise("CLEAN")
