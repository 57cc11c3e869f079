"""The real-time layer. Rules are the batch rules: a streaming DataFrame goes in, a streaming one comes out."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import circular, cleaning, flags, layering, rules, scoring
from ..operators.features import gold_features
from ..operators.flow import flow_from_totals, merge_party_totals, party_totals
from ..functions.columns import interval
from .repair import keep_late
from .sinks import current, keep, newest_of, run_batches, stream_fan_out
from .store import BatchStore

LATENESS = "1 hour"


def stream_ingest(stream: DataFrame) -> DataFrame:
    """Arrivals with the time they came in and no label yet: the time the source gives as ``ingest_ts`` (message bus or files),
    or else the server's."""
    came = F.current_timestamp()
    if "ingest_ts" in stream.columns:
        came = F.coalesce(F.col("ingest_ts").cast("timestamp"), came)
    return stream.withColumns({"ingest_ts": came, "pattern_label": F.lit("PENDING")})


def run_ingest(stream: DataFrame, live_path: str, quarantine_path: str, checkpoint: str, days: int | None = None,
               late_path: str | None = None, lateness: str = LATENESS):
    """Usable arrivals to the live table, by date, the rest to quarantine, in one pass. ``days``: forget older dates of the live
    table. ``late_path``: keep there which rows came later than ``lateness``, for ``repair``."""
    def to_live(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter(cleaning.valid_transaction()).withColumn("txn_date", F.to_date("timestamp"))
        store = BatchStore(batch.sparkSession, live_path, rows.schema, by_date=True)
        store.append(rows, batch_id)
        if late_path:
            keep_late(rows, batch_id, store, late_path, lateness)
        store.tidy(days=days)

    return stream_fan_out(stream_ingest(stream), {
        "live": to_live, "quarantine": lambda b, i: keep(cleaning.quarantine_transactions(b), i, quarantine_path),
    }, checkpoint)


def stream_dedupe(stream: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """At-least-once to once: an id seen within the watermark is dropped; state is forgotten after it."""
    usable = stream.filter(cleaning.valid_transaction())
    return usable.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["txn_id"])


def stream_structuring(live: DataFrame, lateness: str = LATENESS, **params) -> DataFrame:
    return rules.rule_structuring(live.withWatermark("timestamp", lateness), **params)


def stream_velocity(live: DataFrame, lateness: str = LATENESS, **params) -> DataFrame:
    return rules.rule_high_velocity(live.withWatermark("timestamp", lateness), **params)


def stream_smurfing(live: DataFrame, lateness: str = LATENESS, **params) -> DataFrame:
    return rules.rule_smurfing(live.withWatermark("timestamp", lateness), **params)


def stream_dormant(live: DataFrame, a: DataFrame, **params) -> DataFrame:
    """Stream-static join: the account table is read anew for each batch."""
    return rules.rule_dormant_spike(live, a, **params)


def stream_watchlist(live: DataFrame, c: DataFrame, **params) -> DataFrame:
    return rules.rule_watchlist_pep(live, c, **params)


def stream_cash_night(live: DataFrame, **params) -> DataFrame:
    return rules.rule_cash_intensive(live, **params)


def stream_flag_monitor(f: DataFrame) -> DataFrame:
    """Flags that need eyes now, as they are written."""
    return f.filter(F.col("severity").isin("CRITICAL", "HIGH") & (F.col("analyst_decision") == "PENDING")).select(
        "flag_id", "txn_id", "account_id", "customer_id", "pattern_type", "rule_id", "ml_score", "severity",
        "created_at", "notes")


def _reach(batch: DataFrame, back: int, ahead: int = 0) -> Column:
    """Dates up to ``back`` days before and ``ahead`` days after those of a batch, as literals, so that a store's folders of
    other dates are not read."""
    first, last = batch.agg(F.min("txn_date"), F.max("txn_date")).first()
    if first is None:
        return F.lit(False)
    return F.col("txn_date").between(F.lit(first - timedelta(days=back)), F.lit(last + timedelta(days=ahead)))


def run_layering(live: DataFrame, store: str, hits: str, checkpoint: str, lookback: str | None = "24 hours", **params):
    """Layering and mule accounts. Each batch adds its legs to the stored ones and evaluates the accounts it
    touched on their legs of the look-back, which counts from the newest leg ever stored. The batch rule forms no pairs, which
    a join of two streams would. ``hits`` keeps the newest answer of each account (see ``found_mules``)."""
    wanted = ["txn_id", "account_id", "counterparty_account", "amount", "txn_type", "timestamp", "txn_date"]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        legs = batch.filter(F.col("txn_type").isin("WIRE_IN", "WIRE_OUT", "UPI_OUT")).select(*wanted)
        kept = keep(legs, batch_id, store, by_date=True)
        accounts = kept.read(only=batch_id).select("account_id").distinct()
        touched = kept.read(before=batch_id + 1).drop("batch_id").join(accounts, "account_id", "left_semi")
        found = layering.rule_layering_mule(touched, lookback=lookback, as_of=kept.manifest().newest, **params)
        # a touched account without a hit is written too: it may have had one before
        keep(accounts.join(found, "account_id", "left"), batch_id, hits, merged=newest_of("account_id"))

    return run_batches(live, on_batch, checkpoint)


def found_mules(spark: SparkSession, hits: str) -> DataFrame:
    return current(BatchStore(spark, hits).read(), "account_id", "rule_id")


def run_circular(live: DataFrame, store: str, hits: str, checkpoint: str, min_amount=200000, days=(30, 365),
                 pairs: str | None = None, **params):
    """Round-tripping over up to a year. Instead of a year of join state, each batch meets the stored wires whose dates its own
    can reach: as first legs of its answers, and as answers of its first legs. ``hits`` keeps counts of the answers of a
    first leg that add up (see ``found_circles``); ``pairs`` keeps every pair of legs, in the batch that brought the later one."""
    wanted = ["txn_id", "account_id", "customer_id", "counterparty_account", "amount", "txn_type", "country", "timestamp",
              "txn_date"]

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("leg").agg(F.sum("n_answers").alias("n_answers"), F.min("answer").alias("answer"),
                                       F.max("batch_id").alias("batch_id"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        kept = keep(circular._large_wires(batch, min_amount).select(*wanted), batch_id, store, by_date=True)
        new = kept.read(only=batch_id)
        before = kept.read(before=batch_id).where(_reach(new, days[1] + 1, days[1] + 1))
        both = [(new, before.unionByName(new)), (before, new)]
        found = reduce(DataFrame.unionByName, [circular.circular_answers(x, y, min_amount, days, **params) for x, y in both])
        if pairs:  # before the counts, which say that they are there
            keep(reduce(DataFrame.unionByName, [circular.circular_pairs(x, y, min_amount, days, **params) for x, y in both]),
                 batch_id, pairs)
        keep(circular.merge_answers(found), batch_id, hits, merged=merged)

    return run_batches(live, on_batch, checkpoint)


def found_circles(spark: SparkSession, store: str, hits: str, min_amount=200000, pairs: str | None = None) -> DataFrame:
    """What the stream knows by now: the batch rule over all wires it has seen, with a row for every answer if it kept ``pairs``."""
    hit = BatchStore(spark, hits)
    found = circular.merge_answers(hit.read())
    if pairs:
        return circular.describe_pairs(BatchStore(spark, pairs).read(before=hit.manifest().done + 1), found)
    return circular.describe_circles(BatchStore(spark, store, by_date=True).read().drop("batch_id"), found, min_amount)


def run_scoring(
    live: DataFrame, store: str, accounts: DataFrame, customers: DataFrame, model: scoring.RiskModel, scores: str,
    raised: str, checkpoint: str, memory: str | None = "7 days", memory_days: int = 8, at=None,
):
    """Score arrivals on what is known by then. ``store`` holds the rows by date and, per batch, mergeable totals of each
    (account, direction, counterparty). Flow features are lifetime values and come from the totals of the touched accounts;
    rolling ones from their rows within ``memory`` of the batch, of which no older folder is read (``memory_days``; all rows
    where ``memory`` is None). A row that was delivered before with the same date is neither scored nor counted again."""
    def merged(rows: DataFrame) -> DataFrame:
        return merge_party_totals(rows, F.max("batch_id").alias("batch_id"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            rows = BatchStore(spark, f"{store}/rows", batch.schema, by_date=True)
            known = rows.read(before=batch_id).where(_reach(batch, 0)).select("txn_id")
            rows.append(batch.join(known, "txn_id", "left_anti"), batch_id)
            rows.tidy()
        finally:
            batch.unpersist()
        new = rows.read(only=batch_id).drop("batch_id")
        totals = keep(party_totals(new), batch_id, f"{store}/totals", merged=merged)
        owners = new.select("account_id").distinct()
        flow = flow_from_totals(totals.read(before=batch_id + 1).join(owners, "account_id", "left_semi"))
        touched = rows.read(before=batch_id + 1).drop("batch_id")
        if memory:
            since = new.agg(F.min("timestamp")).first()[0]
            touched = touched.where(_reach(new, memory_days)).filter(F.col("timestamp") >= F.lit(since) - interval(memory))
        touched = touched.join(owners, "account_id", "left_semi")
        gold = gold_features(touched, accounts, customers, flow).join(new.select("txn_id"), "txn_id", "left_semi")
        scored = scoring.score_rows(gold, model)
        table = scoring._score_table(scored.withColumns({
            "fraud_type": scoring.coarse_type(F.col("final_risk_score")), "is_fraud": F.lit(None).cast("int")}), at)
        fresh = keep(table, batch_id, scores).read(only=batch_id).drop("batch_id")
        keep(flags.rt_flags(fresh, at=at), batch_id, raised)

    return run_batches(live, on_batch, checkpoint)
