"""Layering and mule accounts: money in, then out again within two hours.

The rule looks at all (in, out) pairs of an account up to 120 minute boundaries apart, but what it reports
are sums, maxima and counts over the pairs. Those follow from how many outs each in meets, which in each out
is met by, and the nearest out, so no pair is ever formed: counts per (account, minute) are looked up
over the minutes around, in day-long blocks, and legs within one minute are ordered by their exact time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..fixed import MONEY_IN, MONEY_OUT
from ..functions.blocks import spread_over_blocks
from ..functions.columns import minute_number, recent

MINUTES_PER_DAY = 1440


def matched_legs(t: DataFrame, max_gap_min: int = 120, as_of=None, lookback=None) -> DataFrame:
    """Every leg with ``matches`` (legs it pairs with) and, for ins, ``gap_min`` to the nearest out."""
    legs = recent(t, lookback, as_of).filter(F.col("txn_type").isin(MONEY_IN + MONEY_OUT)).select(
        "account_id", "amount", "counterparty_account",
        minute_number(F.col("timestamp")).alias("minute"),
        F.unix_micros("timestamp").alias("at"),
        F.col("txn_type").isin(MONEY_IN).alias("incoming"),
    )
    per_minute = legs.groupBy("account_id", "minute").agg(
        F.count_if("incoming").alias("ins"), F.count_if(~F.col("incoming")).alias("outs"))
    spread = spread_over_blocks(per_minute, "minute", MINUTES_PER_DAY, before=max_gap_min, after=max_gap_min)
    by_minute = Window.partitionBy("account_id", "block").orderBy("minute")
    ahead, behind = by_minute.rangeBetween(1, max_gap_min), by_minute.rangeBetween(-max_gap_min, -1)
    around = spread.select(
        "account_id", "minute", "own",
        F.coalesce(F.sum("outs").over(ahead), F.lit(0)).alias("outs_ahead"),
        F.min(F.when(F.col("outs") > 0, F.col("minute"))).over(ahead).alias("next_out"),
        F.coalesce(F.sum("ins").over(behind), F.lit(0)).alias("ins_behind"),
    ).filter("own").drop("own")

    # running counts only: a frame that ends at the partition's end would be counted anew for every leg
    same_minute = Window.partitionBy("account_id", "minute")
    by_time = same_minute.orderBy("at")
    until_now, before = by_time.rangeBetween(Window.unboundedPreceding, 0), by_time.rangeBetween(Window.unboundedPreceding, -1)
    incoming, outgoing = F.col("incoming").cast("int"), (~F.col("incoming")).cast("int")
    legs = legs.withColumns({
        "outs_now": F.sum(outgoing).over(same_minute) - F.sum(outgoing).over(until_now),
        "ins_now": F.coalesce(F.sum(incoming).over(before), F.lit(0)),
    })
    met = legs.join(around, ["account_id", "minute"])
    into = F.col("incoming")
    return met.select(
        "account_id", "amount", "counterparty_account", "incoming",
        F.when(into, F.col("outs_now") + F.col("outs_ahead"))
        .otherwise(F.col("ins_now") + F.col("ins_behind")).alias("matches"),
        F.when(into & (F.col("outs_now") > 0), F.lit(0))
        .when(into, F.col("next_out") - F.col("minute")).alias("gap_min"),
    ).filter("matches > 0")


def rule_layering_mule(
    t: DataFrame, max_gap_min=120, min_ratio=0.90, mule_senders=2, dedup=False, as_of=None, lookback=None
) -> DataFrame:
    """``total_in`` counts an in once per out it meets, as the rule is defined; ``dedup=True`` counts it once."""
    legs = matched_legs(t, max_gap_min, as_of, lookback)
    into = F.col("incoming")
    weight = F.lit(1) if dedup else F.col("matches")
    per_party = legs.groupBy("account_id", "incoming", "counterparty_account").agg(
        F.sum(F.col("amount") * weight).alias("weighted"), F.max("amount").alias("largest"),
        F.min("gap_min").alias("gap_min"))
    found = per_party.groupBy("account_id").agg(
        F.sum(F.when(into, F.col("weighted"))).alias("total_in"),
        F.max(F.when(~into, F.col("largest"))).alias("total_out"),
        F.count_if(into & F.col("counterparty_account").isNotNull()).alias("senders"),
        F.min("gap_min").alias("min_gap_min"),
    ).filter(F.try_divide("total_out", "total_in") > min_ratio)
    mule = F.col("senders") >= mule_senders
    percent = F.round(F.try_divide(F.col("total_out") * 100.0, "total_in"), 1)
    return found.select(
        "account_id", "total_in", "total_out", percent.alias("pass_through_pct"), "senders", "min_gap_min",
        F.when(mule, "MULE_ACCOUNT").otherwise("LAYERING").alias("pattern_type"),
        F.when(mule, "RULE-003").otherwise("RULE-002").alias("rule_id"),
        F.lit("CRITICAL").alias("severity"),
        F.format_string("%s: %s pass-through %.1f%%", F.when(mule, "MULE").otherwise("LAYERING"),
                        F.col("account_id"), percent).alias("alert_msg"),
    )
