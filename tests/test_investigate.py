"""Seeded investigations against plain Python."""

import random
from itertools import groupby

from pyspark.sql import functions as F

from txnwatch.operators import alerts, investigate
from txnwatch.schemas import TABLES
from txnwatch.sources import tables as io

from .frames import rows, silver, table


def seeds_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "account_id string")


def some_legs(n=120, accounts=7, seed=3):
    """Few accounts and minutes, so that times tie and accounts meet themselves; one account holds a third of the rows."""
    r = random.Random(seed)
    name = lambda: "HOT" if r.random() < 0.33 else f"A{r.randrange(accounts)}"
    return [{"txn_id": f"T{i:03d}", "account_id": name(), "counterparty_account": None if r.random() < 0.05 else name(),
             "amount": float(i), "timestamp": None if r.random() < 0.05 else f"2024-03-01 10:{r.randrange(30):02d}:00"}
            for i in range(n)]


def chains(legs, seed, hops, limit):
    legs = [x for x in legs if x["counterparty_account"] and x["timestamp"]]
    out = [[x] for x in legs if x["account_id"] == seed]
    for _ in range(hops - 1):
        out = [c + [x] for c in out for x in legs
               if x["account_id"] == c[-1]["counterparty_account"] and x["timestamp"] > c[-1]["timestamp"]]
    out.sort(key=lambda c: [(x["timestamp"], x["txn_id"]) for x in c])
    return [tuple(x["txn_id"] for x in c) for c in out[:limit]]


def test_paths_of_each_seed(spark):
    legs = some_legs()
    t = silver(spark, legs)
    asked = ["HOT", "A1", "A1", "A2", "NOBODY", None]
    for hops, limit in ((1, 4), (2, 7), (3, 5), (4, 6)):
        got = investigate.inv_paths(t, seeds_of(spark, *asked), hops, limit).orderBy("seed", "path").collect()
        found = {s: [tuple(r[f"txn_id{i}"] for i in range(1, hops + 1)) for r in g] for s, g in groupby(got, lambda r: r["seed"])}
        want = {s: chains(legs, s, hops, limit) for s in ("HOT", "A1", "A2")}
        assert found == {s: c for s, c in want.items() if c}
        for _, g in groupby(got, lambda r: r["seed"]):
            assert [r["path"] for r in g] == list(range(1, 1 + len(found[_])))


def test_paths_of_nobody(spark):
    t = silver(spark, some_legs(20))
    assert investigate.inv_paths(t, seeds_of(spark)).count() == 0
    assert investigate.inv_paths(t.limit(0), seeds_of(spark, "HOT")).count() == 0


def test_network_of_each_seed(spark):
    legs = some_legs(60)
    t, f = silver(spark, legs), io.empty_table(spark, TABLES["suspicious_flags"])
    asked = ["A1", "A3", "NOBODY"]
    want = []
    for s in asked:
        near = {x["counterparty_account"] for x in legs if x["account_id"] == s}
        near |= {x["account_id"] for x in legs if x["counterparty_account"] == s}
        near.discard(None)
        want += [(s, x["txn_id"]) for x in legs if x["account_id"] in near or x["counterparty_account"] in near]
    got = investigate.inv_network_by_seed(t, f, seeds_of(spark, *asked))
    assert rows(got, "seed", "txn_id") == sorted(want)
    # over all seeds a transaction is listed once
    every = investigate.inv_network(t, f, seeds_of(spark, *asked))
    assert every.count() == len({i for _, i in want})


def test_dossier_of_seeds_is_the_seeds_part_of_all(spark):
    t = silver(spark, [{"txn_id": "1", "account_id": "A"}, {"txn_id": "2", "account_id": "A"}, {"txn_id": "3", "account_id": "B"}])
    a = table(spark, "accounts", [{"account_id": x, "customer_id": c} for x, c in (("A", "C1"), ("B", "C1"), ("D", "C2"))])
    c = table(spark, "customers", [{"customer_id": x, "watchlist_match": "NONE"} for x in ("C1", "C2")])
    f = table(spark, "suspicious_flags", [
        {"flag_id": "F1", "txn_id": "1", "account_id": "A", "severity": "CRITICAL", "ml_score": 0.9, "analyst_decision": "PENDING"}])
    m = table(spark, "ml_risk_scores", [{"txn_id": "1", "account_id": "A", "final_risk_score": 0.9}])
    h = table(spark, "historical_cases", [
        {"case_id": "1", "account_id": "A", "customer_id": "C1", "sar_filed": "Y"},  # of account and customer: once
        {"case_id": "2", "account_id": "A", "customer_id": "C9", "sar_filed": "N"},  # of the account under somebody else
        {"case_id": "3", "account_id": "B", "customer_id": "C1", "sar_filed": "N"}])  # of the customer's other account
    sources = (a, t, f, m, c, h)
    every = {r["account_id"]: r for r in investigate.inv_account_dossier(*sources).collect()}
    some = {r["account_id"]: r for r in investigate.inv_account_dossier(*sources, seeds=seeds_of(spark, "A", "D", "X")).collect()}
    assert some == {k: every[k] for k in ("A", "D")}
    assert (some["A"]["prior_cases"], some["A"]["prior_sars"], some["A"]["action"]) == (3, 1, "FILE SAR")
    assert some["D"]["action"] == "DISMISS"


def test_seeds_come_before_the_aggregates(spark, sf_dir):
    """Rows of the big tables meet the seeds below the aggregates over them."""
    from txnwatch.plans.tables import tables

    t = tables(spark, sf_dir)
    one = seeds_of(spark, "ACC-000006")
    text = investigate.inv_account_dossier(
        t.accounts, t.silver, t.flags, t.scores, t.customers, t.cases, one)._jdf.queryExecution().optimizedPlan().toString()
    for block in text.split("Aggregate [")[1:]:
        if "sum(amount" in block.split("\n")[0]:
            assert "LeftSemi" in block


def test_signals_of_an_account_meet_in_one_aggregate(spark, sf_dir):
    """A join for each table keeps all of their sorts in one task's memory. The seeds are found once, not for each table."""
    from txnwatch.plans.registry import queries

    text = queries()["inv_account_dossier_seeds"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftOuter") == 3  # totals, customer, cases of the customer
    assert "outcome" not in text  # the cases that choose the seeds


def test_flags_of_any_pattern(spark):
    f = table(spark, "suspicious_flags", [
        {"flag_id": str(i), "pattern_type": p, "ml_score": 0.5} for i, p in enumerate(["MULE_ACCOUNT", "LAYERING", None, "MULE_ACCOUNT"])])
    assert rows(investigate.inv_pattern_flags(f, "MULE_ACCOUNT"), "flag_id") == [("0",), ("3",)]
    assert investigate.inv_pattern_flags(f, "MULE_ACCOUNT", "LAYERING").agg(F.count("*")).first()[0] == 3


def test_one_case_per_account(spark):
    t = silver(spark, [{"txn_id": "1", "account_id": "A", "amount": 5.0}, {"txn_id": "2", "account_id": "A", "amount": 7.0},
                       {"txn_id": "3", "account_id": "B", "amount": 9.0}])
    flag = lambda i, txn, account, score, severity="CRITICAL", pattern="LAYERING": {
        "flag_id": i, "txn_id": txn, "account_id": account, "customer_id": f"C{account}", "ml_score": score, "severity": severity,
        "pattern_type": pattern}
    f = table(spark, "suspicious_flags", [
        flag("F1", "1", "A", 0.96), flag("F2", "1", "A", 0.99, pattern="SMURFING"), flag("F3", "2", "A", None), flag("F4", "9", "A", 0.97),
        flag("F5", "3", "B", 0.99), flag("F6", "3", None, 0.99), flag("F7", "3", "D", 0.9, "HIGH")])
    h = table(spark, "historical_cases", [{"case_id": "1", "account_id": "B", "outcome": "OPEN"}, {"case_id": "2", "account_id": "A", "outcome": "CONFIRMED"}])
    new = alerts.case_open_by_account(f, h, t)
    assert rows(new, "account_id", "customer_id", "pattern_type", "total_amount", "num_txns", "outcome") == [
        ("A", "CA", "SMURFING", 12.0, 3, "OPEN")]
    assert rows(new, "case_id") == rows(alerts.case_open_by_account(f, h, t), "case_id")
    assert alerts.case_open_by_account(f, h.unionByName(new), t).count() == 0
    assert alerts.case_open_by_account(f.limit(0), h.limit(0), t).count() == 0
