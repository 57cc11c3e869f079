"""Streaming jobs run over everything available; what they kept is compared with the batch result in SQL."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators import cleaning, metrics, scoring
from ..schemas import TABLES
from ..session import scratch_path
from ..sources import driver_tables as given, files
from ..streaming import jobs, repair, sinks
from ..streaming.store import BatchStore
from .batch_queries import AT, CIRCLES, LIVE, TXN, _cash, _dormant, _layering, _smurfing, _structuring, _velocity, _watch
from .registry import register


_stored: dict = {}
_scored: dict = {}
_late: dict = {}


def _arrivals(t):
    """Transactions as a stream, as delivered."""
    return given.transactions(given.stream_given(t.spark, t.sf_dir, "events"))


def _live(t):
    """The live table as a stream: what was delivered, re-deliveries too, went through the dedupe job and was stored."""
    if t not in _stored:
        _stored[t] = scratch_path(t.spark, "live-once")
        sinks.run_batches(jobs.stream_dedupe(_arrivals(t)), lambda b, i: sinks.write_batch(b, i, _stored[t]),
                          scratch_path(t.spark, "checkpoint")).awaitTermination()
    schema = StructType([*TABLES["transactions"].fields, StructField("batch_id", LongType())])
    return cleaning.silver_columns(t.spark.readStream.schema(schema).parquet(_stored[t]).drop("batch_id"))


def _table(t, name, stream, mode="append", *keys):
    out = sinks.run_to_table(stream, scratch_path(t.spark, name), mode)
    return sinks.latest(out, *keys) if keys else out.drop("batch_id")


def _stream_source_json(t):
    path = scratch_path(t.spark, "json")
    t.bronze.write.json(path)
    return _table(t, "from-json", files.stream_source_json(t.spark, path, TABLES["transactions"]))


register("stream_source_json", _stream_source_json, f"SELECT {TXN} FROM bronze")


def _ingested(t):
    live, bad = scratch_path(t.spark, "live"), scratch_path(t.spark, "quarantine")
    jobs.run_ingest(_arrivals(t), live, bad, scratch_path(t.spark, "checkpoint")).awaitTermination()
    read = lambda path, where, by_date: BatchStore(t.spark, path, by_date=by_date).read().select(
        *TABLES["transactions"].names, F.col("ingest_ts").isNotNull().alias("arrived"), F.lit(where).alias("landed"))
    return read(live, "live", True).unionByName(read(bad, "quarantine", False))


_LANDED = TXN.replace('"pattern_label"', "'PENDING' AS pattern_label")
register("stream_ingest", _ingested,
         f"""SELECT {_LANDED}, TRUE AS arrived, 'quarantine' AS landed FROM invalid
         UNION ALL SELECT {_LANDED}, TRUE, 'live' FROM bronze WHERE coalesce(amount > 0 AND account_id IS NOT NULL
         AND customer_id IS NOT NULL AND "timestamp" IS NOT NULL, FALSE)""")


def _messages(t):
    """Transactions as messages: a JSON text and the time at which the bus took it in, up to two hours after the event."""
    sent = t.bronze.filter("timestamp is not null")
    late = F.pmod(F.unix_seconds("timestamp") * 7, F.lit(7200))
    return sent.select(F.to_json(F.struct(*sent.columns)).alias("value"),
                       F.timestamp_seconds(F.unix_seconds("timestamp") + late).alias("taken_in"))


def _came_in(t):
    """The messages as a stream through ingestion into the live table, whose hours of arrival are counted."""
    path, live, bad = (scratch_path(t.spark, n) for n in ("messages", "live", "quarantine"))
    messages = _messages(t)
    messages.write.parquet(path)
    stream = t.spark.readStream.schema(messages.schema).parquet(path)
    jobs.run_ingest(files.parse_json_values(stream, TABLES["transactions"], arrived="taken_in"), live, bad,
                    scratch_path(t.spark, "checkpoint")).awaitTermination()
    return metrics.ingestion_per_hour(BatchStore(t.spark, live, by_date=True).read())


register("stream_ingestion_per_hour", _came_in,
         """SELECT date_trunc('hour', to_timestamp(epoch(ts) + (epoch(ts) * 7) % 7200)::TIMESTAMP) AS ingest_hour,
         count(*) AS ingestion_count FROM (SELECT date_trunc('second', "timestamp") AS ts FROM bronze
         WHERE amount > 0 AND account_id IS NOT NULL AND customer_id IS NOT NULL AND "timestamp" IS NOT NULL) x GROUP BY 1""")


def _by_file(t):
    """Bins of the times the files of the given table were written: every row is in one, and each starts on the hour."""
    bins = metrics.ingestion_per_hour(files.with_file_time(t.read("events")))
    return bins.agg(F.sum("ingestion_count").alias("row_count"),
                    F.count_if(F.date_trunc("hour", "ingest_hour") != F.col("ingest_hour")).alias("off_the_hour"))


register("file_ingestion_per_hour", _by_file, "SELECT count(*) AS row_count, 0 AS off_the_hour FROM events")


def _fanned_out(t):
    hot, lake = scratch_path(t.spark, "hot"), scratch_path(t.spark, "lake")
    sinks.stream_fan_out(_arrivals(t), {
        "hot": lambda b, i: sinks.keep(b, i, hot), "lake": lambda b, i: sinks.keep(b, i, lake),
    }, scratch_path(t.spark, "checkpoint")).awaitTermination()
    read = lambda path, name: BatchStore(t.spark, path).read().select(
        F.lit(name).alias("sink"), *TABLES["transactions"].names)
    return read(hot, "hot").unionByName(read(lake, "lake"))


register("stream_fan_out", _fanned_out, f"""SELECT 'hot' AS sink, {TXN} FROM bronze
    UNION ALL SELECT 'lake', {TXN} FROM bronze""")
register("stream_dedupe", lambda t: cleaning.silver_columns(_table(t, "once", jobs.stream_dedupe(_arrivals(t)))),
         "SELECT * FROM silver", texts=("txn_date",))
register("stream_structuring", lambda t: _table(
    t, "structuring", jobs.stream_structuring(_live(t)), "update", "account_id", "customer_id", F.to_date("first_txn")),
    _structuring(), total_amount=2)
register("stream_velocity", lambda t: _table(
    t, "velocity", jobs.stream_velocity(_live(t)), "update", "account_id", "timestamp"), _velocity(), amount_sum_1h=2)
register("stream_smurfing", lambda t: _table(
    t, "smurfing", jobs.stream_smurfing(_live(t)), "update", "account_id", "timestamp"), _smurfing(), dep_total=2)
register("stream_dormant", lambda t: _table(t, "dormant", jobs.stream_dormant(_live(t), t.accounts)), _dormant())
register("stream_watchlist", lambda t: _table(t, "watchlist", jobs.stream_watchlist(_live(t), t.customers)), _watch())
register("stream_cash_night", lambda t: _table(t, "cash", jobs.stream_cash_night(_live(t))), _cash())


def _layered(t):
    hits = scratch_path(t.spark, "layering")
    jobs.run_layering(_live(t), scratch_path(t.spark, "legs"), hits, scratch_path(t.spark, "checkpoint"),
                      lookback=None).awaitTermination()
    return jobs.found_mules(t.spark, hits)


register("stream_layering", _layered, _layering(), total_in=2)


def _circled(t):
    wires, hits, pairs = (scratch_path(t.spark, n) for n in ("wires", "circles", "circle-pairs"))
    jobs.run_circular(_live(t), wires, hits, scratch_path(t.spark, "checkpoint"), pairs=pairs).awaitTermination()
    return jobs.found_circles(t.spark, wires, hits, pairs=pairs)


register("stream_circular", _circled, CIRCLES)


def _monitored(t):
    path = scratch_path(t.spark, "flags")
    t.flags.write.parquet(path)
    stream = t.spark.readStream.schema(t.flags.schema).parquet(path)
    return _table(t, "monitor", jobs.stream_flag_monitor(stream))


register("stream_flag_monitor", _monitored, LIVE)


def _stream_scores(t):
    if t not in _scored:
        _scored[t] = scratch_path(t.spark, "scores")
        jobs.run_scoring(_live(t), scratch_path(t.spark, "history"), t.accounts, t.customers, t.model, _scored[t],
                         scratch_path(t.spark, "raised"), scratch_path(t.spark, "checkpoint"), at=AT).awaitTermination()
    return BatchStore(t.spark, _scored[t]).read().drop("batch_id")


def _score_facts(t):
    """What holds of every score whatever the model: one per row, within bounds, blended and typed as told."""
    final, parts = F.col("final_risk_score"), F.col("anomaly_score") * 0.4 + F.col("fraud_probability") * 0.6
    return _stream_scores(t).groupBy("txn_id").agg(
        F.count(F.lit(1)).alias("n_scores"),
        F.bool_and(F.col("anomaly_score").between(0, 1) & F.col("fraud_probability").between(0, 1)).alias("in_bounds"),
        F.bool_and(F.abs(final - F.greatest(F.lit(0.0), F.least(F.lit(1.0), parts))) < 1e-9).alias("blended"),
        F.bool_and(F.col("fraud_type") == scoring.coarse_type(final)).alias("typed"),
        F.bool_and(F.col("is_fraud").isNull()).alias("unlabelled"))


register("stream_score", _stream_scores)
register("stream_score_facts", _score_facts, """SELECT txn_id, count(*) AS n_scores, TRUE AS in_bounds, TRUE AS blended,
    TRUE AS typed, TRUE AS unlabelled FROM silver GROUP BY txn_id""")


def _delivered_late(t):
    """All rows of silver, delivered on two occasions, a seventh of them long after their bins are closed. What each stream has
    said and what the repair answered, by rule."""
    if t in _late:
        return _late[t]
    arrivals = scratch_path(t.spark, "arrivals")
    live, late, bad, checkpoint = (scratch_path(t.spark, n) for n in ("live", "late", "bad", "checkpoint"))
    source = t.silver.select(*TABLES["transactions"].names)
    behind = F.pmod(F.xxhash64("txn_id"), F.lit(7)) == 0
    streams = {"structuring": (jobs.stream_structuring, repair.STRUCTURING), "velocity": (jobs.stream_velocity, repair.VELOCITY),
               "smurfing": (jobs.stream_smurfing, repair.SMURFING)}
    out = {name: (scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-repairs")) for name in streams}
    for part in (source.filter(~behind), source.filter(behind)):
        part.write.mode("append").parquet(arrivals)
        stream = t.spark.readStream.schema(source.schema).parquet(arrivals)
        jobs.run_ingest(stream, live, bad, checkpoint, late_path=late).awaitTermination()
        for name, (job, _) in streams.items():
            sinks.run_to_table(job(cleaning.silver_columns(stream)), out[name][0], "update")
    for name, (_, rule) in streams.items():
        repair.repair(BatchStore(t.spark, live, by_date=True), late, out[name][1], rule)
    _late[t] = out
    return out


def _made_good(t, name, rule, *keys):
    path, repairs = _delivered_late(t)[name]
    hits = sinks.latest(BatchStore(t.spark, path).read(), *keys)
    return repair.repaired(hits, t.spark, repairs, rule)


# a seventh of the rows comes after its bins are closed; with the repair the result is the batch rule's
register("late_structuring", lambda t: _made_good(
    t, "structuring", repair.STRUCTURING, "account_id", "customer_id", F.to_date("first_txn")), _structuring(), total_amount=2)
register("late_velocity", lambda t: _made_good(t, "velocity", repair.VELOCITY, "account_id", "timestamp"), _velocity(),
         amount_sum_1h=2)
register("late_smurfing", lambda t: _made_good(t, "smurfing", repair.SMURFING, "account_id", "timestamp"), _smurfing(),
         dep_total=2)
