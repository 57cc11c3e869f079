"""Headline measures and report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import ratio_or_zero


def _rows() -> Column:
    return F.count(F.lit(1))


def _slice(f: DataFrame, severity=None, pattern_type=None) -> DataFrame:
    if severity is not None:
        f = f.filter(F.col("severity") == severity)
    if pattern_type is not None:
        f = f.filter(F.col("pattern_type") == pattern_type)
    return f


def kpi_total_transactions(t: DataFrame) -> DataFrame:
    return t.agg(_rows().alias("total_transactions"))


def kpi_total_flagged(f: DataFrame) -> DataFrame:
    return f.agg(_rows().alias("total_flagged"))


def kpi_fraud_rate(t: DataFrame, f: DataFrame) -> DataFrame:
    total = t.agg(_rows().alias("n")).scalar()
    return f.agg(_rows().alias("flagged")).select(ratio_or_zero(F.col("flagged"), total).alias("fraud_rate"))


def kpi_critical(f: DataFrame) -> DataFrame:
    return f.agg(F.count_if(F.col("severity") == "CRITICAL").alias("critical_flags"))


def kpi_pending(f: DataFrame) -> DataFrame:
    return f.agg(F.count_if(F.col("analyst_decision") == "PENDING").alias("pending_flags"))


def kpi_confirmed(f: DataFrame) -> DataFrame:
    return f.agg(F.count_if(F.col("analyst_decision") == "CONFIRMED").alias("confirmed_flags"))


def flagged_amount_once(t: DataFrame, f: DataFrame) -> DataFrame:
    """Transactions with at least one flag, once each."""
    return t.join(f.select("txn_id"), "txn_id", "left_semi")


def kpi_flagged_amount(t: DataFrame, f: DataFrame) -> DataFrame:
    return flagged_amount_once(t, f).agg(F.sum("amount").alias("flagged_amount"))


def kpi_avg_ml_score(m: DataFrame) -> DataFrame:
    return m.agg(F.avg("final_risk_score").alias("avg_ml_score"))


def kpi_false_positive_rate(f: DataFrame) -> DataFrame:
    wrong = F.count_if(F.col("analyst_decision") == "FALSE_POSITIVE")
    return f.agg(wrong.alias("wrong"), _rows().alias("n")).select(
        ratio_or_zero(F.col("wrong"), F.col("n")).alias("false_positive_rate"))


def kpi_avg_investigation_days(h: DataFrame) -> DataFrame:
    return h.agg(F.avg("investigation_days").alias("avg_investigation_days"))


def kpi_all(t: DataFrame, f: DataFrame, m: DataFrame, h: DataFrame, severity=None, pattern_type=None) -> DataFrame:
    """The ten measures as one row. Slicers act on flags, and through them on the flagged amount."""
    f = _slice(f, severity, pattern_type)
    total = t.agg(_rows().alias("n")).scalar()
    flags = f.agg(
        _rows().alias("total_flagged"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_flags"),
        F.count_if(F.col("analyst_decision") == "PENDING").alias("pending_flags"),
        F.count_if(F.col("analyst_decision") == "CONFIRMED").alias("confirmed_flags"),
        F.count_if(F.col("analyst_decision") == "FALSE_POSITIVE").alias("wrong"),
    )
    return flags.select(
        total.alias("total_transactions"),
        "total_flagged",
        ratio_or_zero(F.col("total_flagged"), total).alias("fraud_rate"),
        "critical_flags", "pending_flags", "confirmed_flags",
        kpi_flagged_amount(t, f).scalar().alias("flagged_amount"),
        kpi_avg_ml_score(m).scalar().alias("avg_ml_score"),
        ratio_or_zero(F.col("wrong"), F.col("total_flagged")).alias("false_positive_rate"),
        kpi_avg_investigation_days(h).scalar().alias("avg_investigation_days"),
    )


def account_country(a: DataFrame, c: DataFrame) -> DataFrame:
    """The country a report shows for an account: its customer's, or none."""
    countries = c.select("customer_id", "country")
    return a.select("account_id", "customer_id").join(countries, "customer_id", "left").select("account_id", "country")


def _by_country(per_account: DataFrame, a: DataFrame, c: DataFrame, value: Column) -> DataFrame:
    """Join countries to rows already reduced per account; rows without a value are hidden."""
    joined = per_account.join(account_country(a, c), "account_id", "left")
    out = joined.groupBy("country").agg(value.alias("value")).filter(F.col("value").isNotNull())
    return out.orderBy(F.desc("value"), "country")


def _flags_per_account(f: DataFrame, t: DataFrame) -> DataFrame:
    """Flag counts per account of the flagged transaction (not of the flag's own customer)."""
    flags = f.groupBy("txn_id").agg(
        _rows().alias("flags"), F.count_if(F.col("analyst_decision") == "PENDING").alias("pending"))
    joined = flags.join(t.select("txn_id", "account_id", "amount"), "txn_id", "left")
    return joined.groupBy("account_id").agg(
        F.sum("flags").alias("flags"), F.sum("pending").alias("pending"), F.sum("amount").alias("amount"))


def country_total_flagged(f: DataFrame, t: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    return _by_country(_flags_per_account(f, t), a, c, F.sum("flags"))


def country_flagged_amount(f: DataFrame, t: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    return _by_country(_flags_per_account(f, t), a, c, F.sum("amount"))


def country_pending(f: DataFrame, t: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    waiting = f.filter(F.col("analyst_decision") == "PENDING")
    return _by_country(_flags_per_account(waiting, t), a, c, F.sum("pending"))


def country_avg_investigation_days(h: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    per_account = h.groupBy("account_id").agg(
        F.sum("investigation_days").alias("days"), F.count("investigation_days").alias("cases"))
    return _by_country(per_account, a, c, F.try_divide(F.sum("days"), F.sum("cases")))


def flags_by_pattern(f: DataFrame) -> DataFrame:
    known = f.filter(F.col("flag_id").isNotNull() & (F.col("flag_id") != ""))
    return known.groupBy("pattern_type").agg(_rows().alias("flag_count")).orderBy(F.desc("flag_count"), "pattern_type")


def flags_over_time(f: DataFrame) -> DataFrame:
    return f.groupBy("created_at").agg(_rows().alias("total_flagged")).orderBy("created_at")


def alert_queue(f: DataFrame, t: DataFrame, r: DataFrame) -> DataFrame:
    """Flags whose transaction and rule exist, best scored first."""
    queue = f.join(t.select("txn_id", "amount"), "txn_id").join(r.select("rule_id"), "rule_id", "left_semi")
    return queue.select(
        "flag_id", "txn_id", "account_id", "amount", "pattern_type", "rule_id", "severity", "ml_score",
        "analyst_decision",
    ).orderBy(F.desc("ml_score"), "flag_id")


def ingestion_per_hour(t: DataFrame, column: str = "ingest_ts") -> DataFrame:
    """Rows by the hour they came in; rows without that time are left out, as ``window`` leaves them."""
    bins = t.groupBy(F.window(column, "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("ingestion_count"))
    return bins.select(F.col("w.start").alias("ingest_hour"), "ingestion_count")
