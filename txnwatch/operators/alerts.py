"""Alert and case tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import fraud_label, stable_id
from ..schemas import TABLES

# How each severity reaches an analyst.
CHANNELS = {"CRITICAL": "IMMEDIATE", "HIGH": "QUEUE_5_MIN", "MEDIUM": "DAILY_REPORT"}


def alert_enrich(f: DataFrame, h: DataFrame, c: DataFrame, m: DataFrame) -> DataFrame:
    """Flags with prior cases of the account, the customer's watchlist match and the model's score."""
    cases = h.groupBy("account_id").agg(F.count(F.lit(1)).alias("prior_cases"))
    scores = m.select("txn_id", "final_risk_score")
    people = c.select("customer_id", "watchlist_match")
    return (
        f.join(cases, "account_id", "left").join(people, "customer_id", "left").join(scores, "txn_id", "left")
        .withColumns({
            "prior_cases": F.coalesce("prior_cases", F.lit(0)),
            "watchlist_match": F.coalesce("watchlist_match", F.lit("NONE")),
        })
        .select("flag_id", "txn_id", "account_id", "customer_id", "pattern_type", "rule_id", "severity", "ml_score",
                "prior_cases", "watchlist_match", "final_risk_score")
    )


def alert_route(f: DataFrame) -> DataFrame:
    """Undecided flags with their channel; write it partitioned by ``channel``."""
    channel = F.coalesce(*[F.when(F.col("severity") == s, c) for s, c in CHANNELS.items()], F.lit("DAILY_REPORT"))
    return f.filter(F.col("analyst_decision") == "PENDING").select(
        "flag_id", "txn_id", "account_id", "severity", "ml_score", "created_at", channel.alias("channel"))


def case_open(f: DataFrame, h: DataFrame, t: DataFrame) -> DataFrame:
    """A new case for each critical flag whose account has no open case and that has none itself."""
    case_id = stable_id("CASE-", F.col("flag_id"))
    open_cases = h.filter(F.col("outcome") == "OPEN").select("account_id").distinct()
    new = (
        f.filter(F.col("severity") == "CRITICAL")
        .join(open_cases, "account_id", "left_anti")
        .withColumn("case_id", case_id)
        .join(h.select("case_id"), "case_id", "left_anti")
        .join(t.select("txn_id", "amount"), "txn_id", "left")
    )
    built = {
        "total_amount": F.col("amount"), "num_txns": F.lit(1), "investigation_days": F.lit(None).cast("int"),
        "outcome": F.lit("OPEN"), "sar_filed": F.lit("N"), "close_date": F.lit(None).cast("date"),
    }
    return new.select(*[built.get(n, F.col(n)).alias(n) for n in TABLES["historical_cases"].names])


def case_open_by_account(f: DataFrame, h: DataFrame, t: DataFrame) -> DataFrame:
    """One new case for each account that has critical flags and no open case, over all its flagged transactions.

    A transaction flagged more than once is counted once; one that is not in ``t`` counts but adds no amount. Customer and
    pattern are those of the best scored flag. The id follows from the account and how many cases it had, so a run that is
    repeated gives the same cases, and with its cases in ``h`` gives none. Flags without an account open no case.
    """
    open_cases = h.filter(F.col("outcome") == "OPEN").select("account_id").distinct()
    critical = f.filter((F.col("severity") == "CRITICAL") & F.col("account_id").isNotNull()).join(
        open_cases, "account_id", "left_anti")
    moved = critical.select("account_id", "txn_id").distinct().join(t.select("txn_id", "amount"), "txn_id", "left").groupBy(
        "account_id").agg(F.sum("amount").alias("total_amount"), F.count("txn_id").cast("int").alias("num_txns"))
    best = critical.groupBy("account_id").agg(F.min_by(
        F.struct("customer_id", "pattern_type"), F.struct(-F.coalesce("ml_score", F.lit(0.0)), "flag_id")).alias("best"))
    prior = h.groupBy("account_id").agg(F.count(F.lit(1)).alias("prior"))
    rows = moved.join(best, "account_id").join(prior, "account_id", "left").select("*", "best.*")
    built = {
        "case_id": stable_id("CASE-", F.col("account_id"), F.lit("/"), F.coalesce("prior", F.lit(0)).cast("string")),
        "investigation_days": F.lit(None).cast("int"), "outcome": F.lit("OPEN"), "sar_filed": F.lit("N"),
        "close_date": F.lit(None).cast("date"),
    }
    return rows.select(*[built.get(n, F.col(n)).alias(n) for n in TABLES["historical_cases"].names])


def label_feedback(t: DataFrame, f: DataFrame) -> DataFrame:
    """Training labels where an analyst's decision overrides the delivered one; a confirmation outweighs."""
    decided = F.when(F.col("analyst_decision") == "CONFIRMED", 1).when(
        F.col("analyst_decision") == "FALSE_POSITIVE", 0)
    decisions = f.groupBy("txn_id").agg(F.max(decided).alias("decision"))
    return t.join(decisions, "txn_id", "left").select(
        "txn_id", "pattern_label", F.coalesce("decision", fraud_label(F.col("pattern_label"))).alias("is_fraud"))
