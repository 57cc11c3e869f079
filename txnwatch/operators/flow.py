"""Money-flow features per account."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed import MONEY_IN, MONEY_OUT

IN_SIDE = ["total_in", "last_in", "distinct_senders"]
OUT_SIDE = ["total_out", "first_out_after", "distinct_receivers"]
ZERO_IF_NONE = ["total_in", "total_out", "distinct_senders", "distinct_receivers"]


PARTY = ["account_id", "incoming", "counterparty_account"]


def party_totals(t: DataFrame) -> DataFrame:
    """One row per (account, direction, counterparty). Totals of parts of a table merge into those of the whole."""
    incoming = F.col("txn_type").isin(MONEY_IN)
    return t.filter(F.col("txn_type").isin(MONEY_IN + MONEY_OUT)).groupBy(
        "account_id", incoming.alias("incoming"), "counterparty_account").agg(
        F.sum("amount").alias("amount"), F.max("txn_timestamp").alias("last"), F.min("txn_timestamp").alias("first"))


def merge_party_totals(totals: DataFrame, *more) -> DataFrame:
    return totals.groupBy(*PARTY).agg(
        F.sum("amount").alias("amount"), F.max("last").alias("last"), F.min("first").alias("first"), *more)


def _sides(totals: DataFrame) -> DataFrame:
    """Both directions, and whether an account has any, from one row per (account, direction, counterparty): distinct counts
    are plain counts, and a busy account stays spread over many tasks until then."""
    into, out, party = F.col("incoming"), ~F.col("incoming"), F.col("counterparty_account").isNotNull()
    return totals.groupBy("account_id").agg(
        F.sum(F.when(into, F.col("amount"))).alias("total_in"),
        F.max(F.when(into, F.col("last"))).alias("last_in"),
        F.count_if(into & party).alias("distinct_senders"),
        F.sum(F.when(out, F.col("amount"))).alias("total_out"),
        F.min(F.when(out, F.col("first"))).alias("first_out_after"),
        F.count_if(out & party).alias("distinct_receivers"),
        F.bool_or(into).alias("receives"), F.bool_or(out).alias("sends"),
    )


def _per_account(t: DataFrame) -> DataFrame:
    return _sides(party_totals(t))


def flow_inflow(t: DataFrame) -> DataFrame:
    """What came in, for accounts that received anything."""
    return _per_account(t).filter("receives").select("account_id", *IN_SIDE)


def flow_outflow(t: DataFrame) -> DataFrame:
    """What went out, for accounts that sent anything."""
    return _per_account(t).filter("sends").select("account_id", *OUT_SIDE)


def flow_join(t: DataFrame) -> DataFrame:
    """Both sides of every account that has one; missing sums and counts are 0."""
    return _joined(_per_account(t))


def _joined(sides: DataFrame) -> DataFrame:
    return sides.select("account_id", *IN_SIDE, *OUT_SIDE).na.fill(0, ZERO_IF_NONE)


def _flow_ratios(flow: DataFrame) -> DataFrame:
    gap = F.unix_seconds("first_out_after") - F.unix_seconds("last_in")
    return flow.withColumns({
        "pass_through_ratio": F.when(F.col("total_in") > 0, F.col("total_out") / F.col("total_in")).otherwise(0.0),
        "in_out_gap_min": gap / 60,
    })


def flow_features(t: DataFrame) -> DataFrame:
    return _flow_ratios(flow_join(t))


def flow_from_totals(totals: DataFrame) -> DataFrame:
    """``flow_features`` from stored totals of parts of the history, however it was cut."""
    return _flow_ratios(_joined(_sides(merge_party_totals(totals))))


def sender_sketches(t: DataFrame, lg_size: int = 12) -> DataFrame:
    """A mergeable sketch of the distinct senders of each (account, day), to be stored; its size is bounded by ``lg_size``."""
    return t.filter(F.col("txn_type").isin(MONEY_IN)).groupBy("account_id", "txn_date").agg(
        F.hll_sketch_agg("counterparty_account", lg_size).alias("senders"))


def merge_senders(sketches: DataFrame) -> DataFrame:
    """Distinct senders per account over the days that ``sketches`` holds; select days for any look-back."""
    return sketches.groupBy("account_id").agg(F.hll_sketch_estimate(F.hll_union_agg("senders")).alias("senders"))


def approx_senders(t: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Distinct senders per account by sketch: one shuffle of fixed-size states instead of two of values."""
    return t.filter(F.col("txn_type").isin(MONEY_IN)).groupBy("account_id").agg(
        F.approx_count_distinct("counterparty_account", rsd).alias("senders")
    )
