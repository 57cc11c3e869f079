"""Rows that came too late for a windowed rule on a stream, and the nightly job that makes good for them.

A watermark closes a bin and turns away what arrives for it afterwards. ``keep_late`` stores, batch by batch, the account and
time of every row older than the watermark of its arrival: all that a rule may have turned away, however its own batches were
cut. ``repair`` takes the bins that have ended by then, evaluates the rule on their live rows anew, and stores one answer per
bin, also where nothing is found now. ``repaired`` puts those answers in place of what the stream had said of the bins. Bins are as
many as late rows may be, and files of them are far smaller than their rows, so joins with them are told not to broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.columns import interval
from ..operators import cleaning, rules
from .store import BatchStore

LATE = StructType([StructField("account_id", StringType()), StructField("timestamp", TimestampType()),
                   StructField("watermark", TimestampType())])
KEY = ("account_id", "bin_start")


@dataclass(frozen=True)
class BinnedRule:
    """A rule over the bins of an account, and the column of its hits that tells the bin."""

    rule: Callable[..., DataFrame]
    bin: str
    at: str

    def bin_of(self, ts: str):
        return F.window(ts, self.bin).getField("start")


STRUCTURING = BinnedRule(rules.rule_structuring, "1 day", "first_txn")
VELOCITY = BinnedRule(rules.rule_high_velocity, "1 hour", "timestamp")
SMURFING = BinnedRule(rules.rule_smurfing, "2 days", "timestamp")


def keep_late(rows: DataFrame, batch_id: int, live: BatchStore, path: str, lateness: str = "1 hour") -> None:
    """Store the keys of the rows of a batch that are older than the watermark, which is ``lateness`` before the newest row
    that ``live`` holds with this batch. Call it after the batch was appended to ``live``; a repeated call changes nothing."""
    late = BatchStore(rows.sparkSession, path, LATE)
    newest = live.manifest().newest
    mark = F.lit(newest).cast("timestamp") - interval(lateness)
    keys = rows.filter(F.col("timestamp") < mark).select("account_id", "timestamp", mark.alias("watermark")).distinct()
    late.append(keys, batch_id)
    late.tidy()


def late_bins(late: DataFrame, rule: BinnedRule) -> DataFrame:
    """The bins of late rows that had ended at the watermark, so that their stream had closed them."""
    bins = late.select("account_id", "watermark", F.window("timestamp", rule.bin).alias("w"))
    return bins.filter(F.col("w.end") <= F.col("watermark")).select(
        "account_id", F.col("w.start").alias("bin_start"), F.col("w.end").alias("bin_end")).distinct()


def repair(live: BatchStore, late: str, path: str, rule: BinnedRule, **params) -> int:
    """Evaluate the bins anew that late rows have come for since the last call; returns how many batches of late rows it took.

    Only dates of those bins are read of ``live``, and only rows of those bins go on to the rule. Rows delivered twice count
    once. Bins that reach below the dates ``live`` has dropped stay as they are. The answers form one batch, numbered by the
    newest batch of late rows, so a call that is repeated after a failure leaves one result.
    """
    spark = live.spark
    keys = BatchStore(spark, late, LATE)
    upto, done = keys.manifest().done, BatchStore(spark, path).manifest().done
    if upto <= done:
        return 0
    bins = late_bins(keys.read(before=upto + 1).filter(F.col("batch_id") > done), rule)
    if live.manifest().floor:
        bins = bins.filter(F.to_date("bin_start") >= F.lit(live.manifest().floor).cast("date"))
    first, last = bins.agg(F.to_date(F.min("bin_start")), F.to_date(F.max("bin_end"))).first()
    rows = live.read().drop("batch_id")
    rows = rows.filter(F.col("txn_date").between(F.lit(first), F.lit(last)) if first else F.lit(False))
    rows = rows.withColumn("bin_start", rule.bin_of("timestamp")).join(bins.hint("merge"), list(KEY), "left_semi").drop("bin_start")
    hits = rule.rule(cleaning.dedupe_transactions(rows), **params).withColumn("bin_start", rule.bin_of(rule.at))
    # a bin without a hit is answered too: the stream may have said otherwise, or an earlier call
    answers = bins.select(*KEY).join(hits.hint("merge"), list(KEY), "left")
    store = BatchStore(spark, path, answers.schema)
    store.append(answers, upto)
    store.tidy(newest_answers)
    return upto - done


def newest_answers(answers: DataFrame) -> DataFrame:
    """Of several answers for one bin those of the newest batch; a batch may have found several hits in a bin."""
    last = F.max("batch_id").over(Window.partitionBy(*KEY))
    return answers.withColumn("_last", last).filter("batch_id = _last").drop("_last")


def repaired(hits: DataFrame, spark: SparkSession, path: str, rule: BinnedRule) -> DataFrame:
    """``hits`` of a stream, with the answers stored at ``path`` in place of its own for the bins they speak of."""
    store = BatchStore(spark, path)
    if store.schema is None:
        return hits
    answers = newest_answers(store.read())
    kept = hits.withColumn("bin_start", rule.bin_of(rule.at)).join(
        answers.select(*KEY).distinct().hint("merge"), list(KEY), "left_anti")
    return kept.select(*hits.columns).unionByName(answers.filter(F.col("rule_id").isNotNull()).select(*hits.columns))
