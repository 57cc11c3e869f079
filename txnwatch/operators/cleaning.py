"""Bronze to silver: quarantine, de-duplication and derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed import DEFAULT_CURRENCY, HIGH_RISK_COUNTRIES
from ..functions.columns import as_of_column, interval, is_night

NEAR_THRESHOLD = (8000, 9999)


def valid_transaction() -> Column:
    """True for usable rows and false, never null, for the rest."""
    return F.coalesce(
        (F.col("amount") > 0)
        & F.col("account_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("timestamp").isNotNull(),
        F.lit(False),
    )


def quarantine_transactions(bronze: DataFrame, at=None) -> DataFrame:
    """Unusable rows, with the time they were set aside. A null amount is unusable too."""
    when = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return bronze.filter(~valid_transaction()).withColumn("quarantined_at", when)


def cast_bronze(raw: DataFrame) -> DataFrame:
    """Text to timestamp and double; what does not parse becomes null and is quarantined."""
    return raw.withColumns({
        "timestamp": F.col("timestamp").try_cast("timestamp"),
        "amount": F.col("amount").try_cast("double"),
    })


def dedupe_transactions(t: DataFrame) -> DataFrame:
    """The earliest delivery of each txn_id. Spark applies the `= 1` limit before the shuffle as well, so
    a map task sends one row per id however many copies it read."""
    first = Window.partitionBy("txn_id").orderBy("timestamp", F.xxhash64(*[F.col(c) for c in t.columns]))
    return t.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def silver_columns(t: DataFrame) -> DataFrame:
    """The derived columns, row by row."""
    hour = F.hour("timestamp")
    weekday = F.dayofweek("timestamp")
    amount = F.col("amount")
    return t.withColumns({
        "currency": F.coalesce("currency", F.lit(DEFAULT_CURRENCY)),
        "txn_timestamp": F.col("timestamp"),
        "txn_date": F.to_date("timestamp"),
        "txn_hour": hour,
        "txn_dayofweek": weekday,
        "is_weekend": weekday.isin(1, 7).cast("int"),
        "is_night": is_night(hour).cast("int"),
        "country_risk": F.coalesce(F.col("country").isin(HIGH_RISK_COUNTRIES), F.lit(False)).cast("int"),
        "amount_bucket": F.when(amount.between(*NEAR_THRESHOLD), "NEAR_THRESHOLD")
        .when(amount > 100000, "VERY_LARGE").when(amount > 10000, "LARGE").otherwise("NORMAL"),
        "is_cash": F.coalesce(F.col("txn_type") == "CASH_DEP", F.lit(False)).cast("int"),
    })


def silver_transactions(bronze: DataFrame) -> DataFrame:
    return silver_columns(dedupe_transactions(bronze.filter(valid_transaction())))


def label_distribution(t: DataFrame) -> DataFrame:
    counts = t.groupBy("pattern_label").agg(F.count(F.lit(1)).alias("txn_count"))
    return counts.orderBy(F.desc("txn_count"), "pattern_label")


def retention_prune(t: DataFrame, days: int = 90, as_of=None) -> DataFrame:
    """Keep the rows inside the retention window."""
    return t.filter(F.col("timestamp") > as_of_column(t, "timestamp", as_of) - interval(f"{days} days"))
