"""Readers, sinks, appends and gates on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import cleaning, investigate, quality
from txnwatch.schemas import TABLES
from txnwatch.session import scratch_path
from txnwatch.sources import files, tables as io
from txnwatch.streaming.store import BatchStore

from .frames import rows, silver, table, transactions


def test_csv_with_and_without_types(spark):
    path = scratch_path(spark, "csv")
    text = ["txn_id,amount,timestamp,account_id,customer_id", "T1,12.5,2024-03-01 10:00:00,A,C", "T2,oops,never,A,C"]
    spark.createDataFrame([(line,) for line in text], "value string").coalesce(1).write.text(path)
    raw = files.read_csv_strings(spark, path)
    assert dict(raw.dtypes) == dict.fromkeys(raw.columns, "string")
    cast = cleaning.cast_bronze(raw)
    assert rows(cast.filter("amount is null and timestamp is null"), "txn_id") == [("T2",)]
    assert rows(cleaning.quarantine_transactions(cast), "txn_id") == [("T2",)]


def test_json_values_as_from_a_bus(spark):
    values = spark.createDataFrame([('{"txn_id": "T1", "amount": 5, "timestamp": "2024-03-01T10:00:00.000Z"}',)], "value string")
    event = files.parse_json_values(values, TABLES["transactions"]).first()
    assert event["amount"] == 5.0 and str(event["timestamp"]) == "2024-03-01 10:00:00"


def test_evolving_tables(spark):
    path = scratch_path(spark, "evolve")
    io.write_evolving(spark.range(2), path)
    io.write_evolving(spark.range(2).withColumn("note", F.lit("x")), path)
    assert io.read_evolving(spark, path).filter("note is null").count() == 2


def test_rule_row_is_added_once(spark):
    rules = io.empty_table(spark, TABLES["detection_rules"])
    once = io.append_rule_row(rules)
    assert once.count() == 1 and io.append_rule_row(once).count() == 1


def test_append_if_new(spark):
    target = spark.createDataFrame([("a",), ("a",)], "id string")
    more = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    assert rows(io.append_if_new(target, more, "id"), "id") == [("b",)]


def test_null_amount_is_quarantined(spark):
    t = transactions(spark, [{"amount": None}, {"amount": 0.0}, {"amount": -1.0}, {"customer_id": None}, {"timestamp": None}, {}])
    assert cleaning.quarantine_transactions(t).count() == 5
    assert cleaning.silver_transactions(t).count() == 1


def test_invalid_copy_does_not_hide_a_valid_one(spark):
    t = transactions(spark, [{"txn_id": "T", "amount": -5.0, "timestamp": "2024-01-01 00:00:00"}, {"txn_id": "T", "amount": 5.0}])
    assert rows(cleaning.silver_transactions(t), "amount") == [(5.0,)]


def test_gates(spark):
    a = table(spark, "accounts", [{"account_id": "ACC-1"}])
    t = transactions(spark, [{"txn_id": "X"}, {"txn_id": "X"}, {"txn_id": None}, {"account_id": "ELSE"}])
    assert rows(quality.dq_report(t, a), "gate", "value", "passed") == [
        ("duplicate_keys", 1, False), ("min_rows", 4, False), ("null_keys", 1, False), ("orphans", 1, True)]


def test_a_bad_table_is_never_published(spark):
    a = table(spark, "accounts", [{"account_id": "ACC-1"}])
    good = transactions(spark, [{}, {"account_id": "ELSE"}])
    store = BatchStore(spark, scratch_path(spark, "bronze"), good.schema)
    assert quality.load_checked(good, a, store, 0, min_rows=2) == [
        ("min_rows", 2, True), ("null_keys", 0, True), ("duplicate_keys", 0, True), ("orphans", 1, True)]
    for bad, gate in (([{}], "min_rows"), ([{"amount": None}, {}], "null_keys"), ([{"txn_id": "X"}, {"txn_id": "X"}], "duplicate_keys"), ([], "min_rows")):
        with pytest.raises(quality.GateFailed) as failed:
            quality.load_checked(transactions(spark, bad), a, store, 1, min_rows=2)
        assert [g for g, _, passed in failed.value.report if not passed] == [gate]
        assert store.read().count() == 2 and store.manifest().done == 0
    assert quality.load_checked(good, a, store, 0, min_rows=2) == []  # published before
    assert quality.load_checked(good, a, store, 1, min_rows=2) and store.read().count() == 4


def test_amount_buckets(spark):
    t = silver(spark, [{"amount": a} for a in (7999.99, 8000.0, 9999.0, 9999.5, 10000.0, 10000.01, 100000.0, 100000.01)])
    assert [r[1] for r in rows(t, "amount", "amount_bucket")] == [
        "NORMAL", "NEAR_THRESHOLD", "NEAR_THRESHOLD", "NORMAL", "NORMAL", "LARGE", "LARGE", "VERY_LARGE"]


def test_lookup_finds_both_id_forms(spark):
    t = silver(spark, [{"txn_id": "TXN-000045"}, {"txn_id": "RT-TXN-000045"}, {"txn_id": "TXN-000046"}, {"txn_id": "NODIGITS"}])
    asked = spark.createDataFrame([("RT-TXN-000045",), ("OTHER",)], "txn_id string")
    assert rows(investigate.inv_txn_lookup(t, asked), "txn_id") == [("RT-TXN-000045",), ("TXN-000045",)]


def test_network_counts_either_side(spark):
    t = silver(spark, [
        {"txn_id": "1", "account_id": "S", "counterparty_account": "A"}, {"txn_id": "2", "account_id": "A", "counterparty_account": "Z"},
        {"txn_id": "3", "account_id": "Q", "counterparty_account": "S"}, {"txn_id": "4", "account_id": "Y", "counterparty_account": "Q"},
        {"txn_id": "5", "account_id": "Y", "counterparty_account": "Z"}])
    f = io.empty_table(spark, TABLES["suspicious_flags"])
    seed = spark.createDataFrame([("S",)], "account_id string")
    assert rows(investigate.inv_network(t, f, seed), "account_id", "counterparty_account") == [
        ("A", "Z"), ("Q", "S"), ("S", "A"), ("Y", "Q")]


def test_shared_folder_is_asked_for_off_local_masters():
    from txnwatch.session import is_local

    assert [is_local(m) for m in ("local", "local[8]", "local[*]", "local-cluster[3,2,1024]", "yarn", "k8s://x")] == [
        True, True, True, False, False, False]
