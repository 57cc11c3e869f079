"""Flag rows from scores and from circular flows. Ids are stable and appends skip what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import severity_band, stable_id
from ..schemas import FLAG_COLUMNS
from .circular import circular_out_legs


def _now(at) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def _score_flags(scored: DataFrame, existing: DataFrame | None, threshold, prefix, source, notes, at) -> DataFrame:
    hot = scored.filter(F.col("final_risk_score") > threshold)
    if existing is not None:
        hot = hot.join(existing.select("txn_id").distinct(), "txn_id", "left_anti")
    built = {
        "flag_id": stable_id(prefix, F.lit("RULE-010"), F.col("txn_id")),
        "pattern_type": F.col("fraud_type"),
        "rule_id": F.lit("RULE-010"),
        "ml_score": F.col("final_risk_score"),
        "detection_source": F.lit(source),
        "severity": severity_band(F.col("final_risk_score")),
        "analyst_decision": F.lit("PENDING"),
        "created_at": _now(at),
        "notes": notes,
    }
    return hot.select(*[built.get(n, F.col(n)).alias(n) for n in FLAG_COLUMNS])


def ml_flags(scored: DataFrame, f: DataFrame | None = None, threshold: float = 0.75, at=None) -> DataFrame:
    """Flags of a full scoring run for transactions without a flag yet."""
    notes = F.format_string("ML score %.3f | typology %s", "final_risk_score", "fraud_type")
    return _score_flags(scored, f, threshold, "FLAG-ML-", "ML_NOTEBOOK", notes, at)


def rt_flags(scored: DataFrame, f: DataFrame | None = None, threshold: float = 0.75, at=None) -> DataFrame:
    """Flags of a micro-batch."""
    notes = F.format_string("Real-time ML score %.3f", "final_risk_score")
    return _score_flags(scored, f, threshold, "FLAG-RT-", "ML_REALTIME", notes, at)


def circular_flags(g: DataFrame, f: DataFrame | None = None, critical=1000000, at=None, **params) -> DataFrame:
    """One flag per outgoing leg of a circular flow."""
    legs = circular_out_legs(g, **params).select(
        F.col("out_txn_id").alias("txn_id"), F.col("sender").alias("account_id"),
        F.col("sender_cust").alias("customer_id"), F.col("out_amount").alias("amount"))
    if f is not None:
        stored = f.filter(F.col("rule_id") == "RULE-011").select("txn_id").distinct()
        legs = legs.join(stored, "txn_id", "left_anti")
    built = {
        "flag_id": stable_id("FLAG-CIRC-", F.lit("RULE-011"), F.col("txn_id")),
        "pattern_type": F.lit("CIRCULAR_FLOW"),
        "rule_id": F.lit("RULE-011"),
        "ml_score": F.lit(0.95),
        "detection_source": F.lit("ML_NOTEBOOK"),
        "severity": F.when(F.col("amount") > critical, "CRITICAL").otherwise("HIGH"),
        "analyst_decision": F.lit("PENDING"),
        "created_at": _now(at),
        "notes": F.lit("Circular flow: money returned to sender within 1 year, different customer"),
    }
    return legs.select(*[built.get(n, F.col(n)).alias(n) for n in FLAG_COLUMNS])


def flag_summary(f: DataFrame) -> DataFrame:
    counts = f.groupBy("pattern_type", "severity").agg(F.count(F.lit(1)).alias("flag_count"))
    return counts.orderBy("severity", F.desc("flag_count"), "pattern_type")
