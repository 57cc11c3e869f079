"""Streams cut into batches give what the batch operators give."""

import time

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import circular, features, flow, layering, metrics, rules, scoring
from txnwatch.plans.tables import tables
from txnwatch.schemas import TABLES
from txnwatch.session import scratch_path
from txnwatch.sources import files
from txnwatch.streaming import jobs, sinks
from txnwatch.streaming.store import BatchStore

from .frames import rows, transactions


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return tables(spark, sf_dir)


def in_files(spark, df, parts=3):
    """Write a table as files in time order; returns (folder, schema) for a one-file-per-batch stream."""
    path = scratch_path(spark, "files")
    sec = F.unix_seconds("timestamp")
    cuts = df.select(sec.alias("s")).approxQuantile("s", [i / parts for i in range(1, parts)], 0.0)
    part = sum((sec > c).cast("int") for c in cuts) if cuts else F.lit(0)
    for i in range(parts):  # one after the other: a file stream takes the oldest file first
        df.filter(part == i).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return path, df.schema


def as_stream(spark, source):
    path, schema = source
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def silver_files(spark, t):
    return in_files(spark, t.silver)


def same(a, b):
    names = sorted(b.columns)
    key = lambda r: repr(tuple(r))
    clean = lambda df: sorted(
        (tuple(round(v, 2) if isinstance(v, float) else v for v in r) for r in df.select(names).collect()), key=key)
    return clean(a) == clean(b)


def test_window_rule_in_batches(spark, t, silver_files):
    out = sinks.run_to_table(jobs.stream_structuring(as_stream(spark, silver_files)), scratch_path(spark, "s"), "update")
    assert out.select("batch_id").distinct().count() > 1
    assert same(sinks.latest(out, "account_id", "customer_id", F.to_date("first_txn")), rules.rule_structuring(t.silver))


def test_layering_in_batches(spark, t, silver_files):
    hits = scratch_path(spark, "hits")
    jobs.run_layering(as_stream(spark, silver_files), scratch_path(spark, "legs"), hits, scratch_path(spark, "cp"),
                      lookback=None).awaitTermination()
    assert same(jobs.found_mules(spark, hits), layering.rule_layering_mule(t.silver))


def test_circular_in_batches(spark, t, silver_files):
    wires, hits = scratch_path(spark, "wires"), scratch_path(spark, "hits")
    jobs.run_circular(as_stream(spark, silver_files), wires, hits, scratch_path(spark, "cp")).awaitTermination()
    assert BatchStore(spark, hits).read().select("batch_id").distinct().count() > 1
    assert same(jobs.found_circles(spark, wires, hits), circular.rule_circular_flow(t.silver))


def test_circular_pairs_in_batches(spark, t, silver_files):
    wires, hits, pairs = (scratch_path(spark, n) for n in ("wires", "hits", "pairs"))
    jobs.run_circular(as_stream(spark, silver_files), wires, hits, scratch_path(spark, "cp"), pairs=pairs).awaitTermination()
    found = jobs.found_circles(spark, wires, hits, pairs=pairs)
    assert same(found, circular.rule_circular_flow(t.silver, pairs=True))
    assert found.count() > circular.rule_circular_flow(t.silver).count()


def test_dedupe_in_batches(spark, t):
    source = in_files(spark, t.bronze.filter("timestamp is not null"))
    once = sinks.run_to_table(jobs.stream_dedupe(as_stream(spark, source)), scratch_path(spark, "once"))
    assert rows(once, "txn_id") == rows(t.silver, "txn_id")


def test_scorer_features_are_those_of_gold(spark, t):
    """With the default memory: lifetime flows, rolling features from the last days."""
    last = t.silver.agg(F.max("timestamp")).first()[0]
    part = t.silver.filter(F.col("timestamp") >= F.lit(last) - F.expr("interval 7 days"))
    cut = features.gold_features(part, t.accounts, t.customers, flow.flow_features(t.silver))
    recent = F.col("timestamp") >= F.lit(last) - F.expr("interval 1 hour")
    names = ["txn_id", "pass_through_ratio", "distinct_senders", "distinct_receivers", "rapid_pass_through", "txn_count_1h"]
    assert rows(cut.filter(recent), *names) == rows(t.gold.filter(recent), *names) != []


def test_late_rows_are_counted(spark):
    path = scratch_path(spark, "late")
    transactions(spark, [{"timestamp": "2024-03-05 10:00:00"}]).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    checkpoint, out = scratch_path(spark, "cp"), scratch_path(spark, "out")

    def run():
        query = sinks.run_batches(jobs.stream_dedupe(stream), lambda b, i: sinks.write_batch(b, i, out), checkpoint)
        query.awaitTermination()
        for _ in range(50):  # reports arrive on another thread
            time.sleep(0.1)
        return late.total[str(query.id)]

    late = sinks.LateRows()
    spark.streams.addListener(late)
    assert run() == 0
    transactions(spark, [{"txn_id": "TXN-LATE-1", "timestamp": "2024-03-01 10:00:00"}]).coalesce(1).write.mode("append").parquet(path)
    assert run() == 1
    spark.streams.removeListener(late)


def test_scores_once(spark, t, silver_files):
    """Features of a batch are those gold has over what had arrived by then."""
    scores, raised, checkpoint, store = (scratch_path(spark, n) for n in ("scores", "raised", "cp", "store"))
    jobs.run_scoring(as_stream(spark, silver_files), store, t.accounts, t.customers, t.model, scores, raised, checkpoint,
                     memory=None).awaitTermination()
    got = BatchStore(spark, scores).read()
    assert rows(got, "txn_id") == rows(t.silver, "txn_id")
    assert BatchStore(spark, raised).read().count() == got.filter("final_risk_score > 0.75").count() > 0
    batches = [r[0] for r in got.select("batch_id").distinct().orderBy("batch_id").collect()]
    assert len(batches) == 3
    history = BatchStore(spark, f"{store}/rows", by_date=True)
    for k in batches:
        seen = history.read(before=k + 1).drop("batch_id")
        whole = scoring.score_rows(features.gold_features(seen, t.accounts, t.customers), t.model).select(
            "txn_id", F.col("final_risk_score").alias("want"))
        joined = got.filter(F.col("batch_id") == k).join(whole, "txn_id")
        assert joined.count() == history.read(only=k).count() and joined.filter("abs(final_risk_score - want) > 1e-9").count() == 0


def test_totals_of_any_parts_make_the_flow_features(spark, t):
    part = F.xxhash64("txn_id") % 5
    parts = [flow.party_totals(t.silver.filter(part == k)) for k in range(-4, 5)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    assert same(flow.flow_from_totals(every), flow.flow_features(t.silver))


def test_a_scoring_batch_reads_few_dates(spark, t):
    store = BatchStore(spark, scratch_path(spark, "rows"), t.silver.schema, by_date=True)
    day = t.silver.agg(F.max("txn_date")).first()[0]
    store.append(t.silver, 0)
    store.append(t.silver.limit(0), 1)
    touched = store.read(before=2).where(jobs._reach(t.silver.filter(F.col("txn_date") == F.lit(day)), 8))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "txn_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < len(touched.select("txn_date").distinct().collect()) <= 9


def test_redelivered_rows_are_not_scored_again(spark, t):
    twice = in_files(spark, t.silver.unionByName(t.silver.withColumn("timestamp", F.col("timestamp") + F.expr("interval 2 years"))), 2)
    scores, store = scratch_path(spark, "scores"), scratch_path(spark, "store")
    jobs.run_scoring(as_stream(spark, twice), store, t.accounts, t.customers, t.model, scores,
                     scratch_path(spark, "raised"), scratch_path(spark, "cp"), memory=None).awaitTermination()
    assert rows(BatchStore(spark, scores).read(), "txn_id") == rows(t.silver, "txn_id")
    assert same(flow.flow_from_totals(BatchStore(spark, f"{store}/totals").read()), flow.flow_features(t.silver))


def test_sender_sketches_merge(spark, t):
    exact = t.silver.filter(F.col("txn_type") == "WIRE_IN").groupBy("account_id").agg(F.countDistinct("counterparty_account").alias("n"))
    found = flow.merge_senders(flow.sender_sketches(t.silver)).join(exact, "account_id")
    assert found.filter(F.abs(F.col("senders") - F.col("n")) > 3 * 0.017 * F.col("n") + 0.5).count() == 0
    assert found.count() == exact.count() > 0


def test_ingest_time_is_that_of_the_source(spark, tmp_path):
    """Messages keep the time the bus took them in, files the time they were written; else it is the server's."""
    import os

    sent = spark.createDataFrame([('{"txn_id": "1", "amount": 5}', "2024-01-01 10:59:59"), ('{"txn_id": "2"}', None), ("no json", "2024-01-01 11:00:00")],
                                 "value string, taken string")
    rows = files.parse_json_values(sent, TABLES["transactions"], arrived="taken")
    text = F.col("ingest_ts").cast("string")
    came = dict(tuple(r) for r in jobs.stream_ingest(rows).select("txn_id", text).collect())
    assert came["1"] == "2024-01-01 10:59:59" and came[None] == "2024-01-01 11:00:00" and came["2"] is not None
    assert "ingest_ts" not in files.parse_json_values(sent, TABLES["transactions"]).columns
    bins = lambda df: sorted(tuple(r) for r in metrics.ingestion_per_hour(df).select(
        F.col("ingest_hour").cast("string"), "ingestion_count").collect())
    assert bins(rows) == [("2024-01-01 10:00:00", 1), ("2024-01-01 11:00:00", 1)]

    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/t")
    for name in os.listdir(f"{tmp_path}/t"):
        os.utime(f"{tmp_path}/t/{name}", (1704103200, 1704103200))
    read = files.with_file_time(spark.read.parquet(f"{tmp_path}/t"))
    assert bins(read) == [("2024-01-01 10:00:00", 3)]
