"""Column expressions shared by the operators. All of them run inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def floor_div(value: Column, width: int) -> Column:
    """Integer division rounding down, also for values before 1970."""
    return F.floor(value / F.lit(width)).cast("long")


def minute_number(ts: Column) -> Column:
    """Minutes since the epoch; the difference of two counts the minute boundaries between them."""
    return floor_div(F.unix_seconds(ts), 60)


def interval(text: str) -> Column:
    return F.expr(f"interval {text}")


def as_of_column(df: DataFrame, ts: str, as_of=None) -> Column:
    """The instant a look-back counts from: a given one, or the newest event of the table."""
    if as_of is None:
        return df.agg(F.max(ts).alias("as_of")).scalar()
    return F.lit(as_of).cast("timestamp")


def recent(df: DataFrame, lookback: str | None = None, as_of=None, ts: str = "timestamp") -> DataFrame:
    """Rows strictly newer than ``as_of - lookback``; all rows where no look-back is asked for."""
    if lookback is None:
        return df
    since = as_of_column(df, ts, as_of) - interval(lookback)
    kept = df.filter(F.col(ts) > since)
    if "txn_date" in df.columns and ts in ("timestamp", "txn_timestamp"):
        kept = kept.filter(F.col("txn_date") >= F.to_date(since))  # prunes date partitions
    return kept


def is_night(hour: Column, start: int = 22, end: int = 5) -> Column:
    return (hour >= start) | (hour <= end)


def severity_band(score: Column) -> Column:
    return F.when(score > 0.95, "CRITICAL").when(score > 0.85, "HIGH").otherwise("MEDIUM")


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "CRITICAL", 1).when(severity == "HIGH", 2).when(severity == "MEDIUM", 3).otherwise(4)


def blend(anomaly: Column, probability: Column) -> Column:
    """0.4 anomaly + 0.6 probability, held within 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), anomaly * 0.4 + probability * 0.6))


def stable_id(prefix: str, *parts: Column) -> Column:
    """An id that a retried job writes again unchanged."""
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat(*parts)), 1, 10))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def fraud_label(pattern: Column) -> Column:
    return (
        F.when(pattern == "CLEAN", F.lit(0))
        .when(pattern == "PENDING", F.lit(None).cast("int"))
        .otherwise(F.lit(1))
    )


def txn_number(txn_id: Column) -> Column:
    """The digits a transaction id ends in: one value for an id and its re-delivered form."""
    return F.regexp_extract(txn_id, r"(\d+)$", 1)
