"""Late rows: what a watermark turned away is made good by evaluating the bins it belongs to anew."""

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import rules
from txnwatch.session import scratch_path
from txnwatch.streaming import jobs, repair
from txnwatch.streaming.store import BatchStore

from .frames import rows, silver, transactions

NOON = "2024-03-0{} 12:{:02d}:00"


def small(day, n, account="A", start=0, **more):
    return [{"txn_id": f"{account}-{day}-{start + k}", "account_id": account, "amount": 9000.0, "timestamp": NOON.format(day, start + k),
             **more} for k in range(n)]


@pytest.fixture
def ingest(spark):
    """Deliver rows as one batch each time; live store and paths."""
    folder, live, late, bad, checkpoint = (scratch_path(spark, n) for n in ("in", "live", "late", "bad", "cp"))

    def deliver(given):
        transactions(spark, given).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(transactions(spark, []).schema).parquet(folder)
        jobs.run_ingest(stream, live, bad, checkpoint, late_path=late).awaitTermination()

    return deliver, lambda: BatchStore(spark, live, by_date=True), late


def hits(spark, given):
    return rules.rule_structuring(silver(spark, given))


def test_repair_equals_batch(spark, ingest):
    deliver, live, late = ingest
    # A gets its third row late, B turns from three to four, C has a hit that no late row touches
    early = [*small(1, 2), *small(1, 3, "B"), *small(1, 3, "C"), *small(5, 1, "D")]
    deliver(early[:-1])
    deliver(early[-1:])
    deliver([*small(1, 1, start=2), *small(1, 1, "B", start=3), *small(2, 1, "E"), {"account_id": None}])
    path = scratch_path(spark, "repairs")
    assert repair.repair(live(), late, path, repair.STRUCTURING) == 3
    everything = [*early, *small(1, 1, start=2), *small(1, 1, "B", start=3), *small(2, 1, "E")]
    names = ["account_id", "txn_count", "alert_msg"]
    said = repair.repaired(hits(spark, early), spark, path, repair.STRUCTURING)
    assert rows(said, *names) == rows(hits(spark, everything), *names)
    assert rows(said, "account_id", "txn_count") == [("A", 3), ("B", 4), ("C", 3)]
    # answers for bins of late rows only, one without a hit among them
    assert rows(BatchStore(spark, path).read(), "account_id", "txn_count") == [("A", 3), ("B", 4), ("E", None)]
    # nothing new: nothing to do
    assert repair.repair(live(), late, path, repair.STRUCTURING) == 0
    # a later night answers once more for the bins it touches; a row delivered twice counts once
    deliver([*small(1, 2, start=3), *small(1, 1, start=2)])
    assert repair.repair(live(), late, path, repair.STRUCTURING) == 1
    said = repair.repaired(hits(spark, early), spark, path, repair.STRUCTURING)
    assert rows(said, "account_id", "txn_count") == [("A", 5), ("B", 4), ("C", 3)]


def test_rows_in_time_are_not_late(spark, ingest):
    deliver, live, late = ingest
    deliver(small(1, 30))
    path = scratch_path(spark, "repairs")
    assert repair.repair(live(), late, path, repair.STRUCTURING) == 1
    assert BatchStore(spark, path).read().count() == 0
    same = hits(spark, small(1, 30))
    assert rows(repair.repaired(same, spark, path, repair.STRUCTURING), "account_id", "txn_count") == [("A", 30)]


def test_without_repairs_the_stream_speaks(spark):
    said = hits(spark, small(1, 3))
    assert repair.repaired(said, spark, scratch_path(spark, "none"), repair.STRUCTURING) is said


def test_dropped_dates_are_left_alone(spark, ingest):
    deliver, live, late = ingest
    deliver([*small(1, 2), *small(9, 1, "D")])
    deliver(small(1, 1, start=2))
    store = live()
    store.drop_before("2024-03-05")
    path = scratch_path(spark, "repairs")
    repair.repair(store, late, path, repair.STRUCTURING)
    assert BatchStore(spark, path).read().count() == 0


def test_rows_behind_their_own_batch_count_as_late(spark, ingest):
    """A stream may cut the batch in two, so its watermark may be past them."""
    deliver, live, late = ingest
    deliver([*small(1, 3), *small(9, 1, "D")])
    keys = BatchStore(spark, late, repair.LATE).read()
    assert rows(keys.select("account_id").distinct(), "account_id") == [("A",)]
    bins = repair.late_bins(keys, repair.STRUCTURING)
    assert rows(bins.select("account_id", F.col("bin_start").cast("date").cast("string").alias("d")), "account_id", "d") == [("A", "2024-03-01")]


def test_no_bins_are_gathered_on_the_driver(spark, ingest, monkeypatch):
    """Bins are as many as late rows may be, so no join with them may broadcast, however small their files are."""
    deliver, live, late = ingest
    early = [*small(1, 2), *small(1, 3, "C"), *small(5, 1, "D")]
    deliver(early)
    deliver(small(1, 1, start=2))
    path, plans = scratch_path(spark, "repairs"), []
    append = BatchStore.append

    def spy(store, answers, *more):
        plans.append(answers._jdf.queryExecution().executedPlan().toString())
        return append(store, answers, *more)

    monkeypatch.setattr(BatchStore, "append", spy)
    assert repair.repair(live(), late, path, repair.STRUCTURING) == 2
    said = repair.repaired(hits(spark, early), spark, path, repair.STRUCTURING)
    assert rows(said, "account_id", "txn_count") == [("A", 3), ("C", 3)]
    plans.append(said._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
