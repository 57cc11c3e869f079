"""Thresholds of every rule, one step either side, and the demo scenarios."""

import pytest

from txnwatch.operators import circular, layering, rules
from txnwatch.operators.cleaning import silver_columns

from .frames import rows, silver, table


@pytest.mark.parametrize("amount, hit", [(7999.99, False), (8000.0, True), (9999.0, True), (9999.01, False)])
def test_structuring_amounts(spark, amount, hit):
    t = silver(spark, [{"timestamp": f"2024-03-01 1{i}:00:00"} for i in range(3)], amount=amount)
    assert (rules.rule_structuring(t).count() == 1) is hit


@pytest.mark.parametrize("days, hit", [(["01", "01"], False), (["01", "01", "01"], True), (["01", "01", "02"], False)])
def test_structuring_counts_per_day(spark, days, hit):
    t = silver(spark, [{"timestamp": f"2024-03-{d} 10:0{i}:00"} for i, d in enumerate(days)], amount=9000.0)
    assert (rules.rule_structuring(t).count() == 1) is hit


@pytest.mark.parametrize("hour, hit", [(5, True), (6, False), (21, False), (22, True)])
def test_night_hours(spark, hour, hit):
    t = silver(spark, [{}], amount=30000.0, txn_type="CASH_DEP", timestamp=f"2024-03-01 {hour:02d}:59:59")
    assert (rules.rule_cash_intensive(t).count() == 1) is hit


@pytest.mark.parametrize("count, hit", [(5, False), (6, True)])
def test_velocity(spark, count, hit):
    t = silver(spark, [{"timestamp": f"2024-03-01 10:{i:02d}:00"} for i in range(count)])
    assert (rules.rule_high_velocity(t).count() == 1) is hit


@pytest.mark.parametrize("count, hit", [(6, False), (7, True)])
def test_smurfing(spark, count, hit):
    # both days lie in one two-day bin counted from 1970-01-01
    t = silver(spark, [{"timestamp": f"2024-03-0{2 + i % 2} 1{i}:00:00"} for i in range(count)], txn_type="CASH_DEP",
               amount=7000.0)
    found = rules.rule_smurfing(t)
    assert (found.count() == 1) is hit
    if hit:
        assert str(found.first()["timestamp"]) == "2024-03-02 00:00:00"


@pytest.mark.parametrize("out_at, hit", [
    ("10:00:00", False), ("10:00:01", True), ("12:00:59", True), ("12:01:00", False), ("09:59:59", False)])
def test_layering_counts_minute_boundaries(spark, out_at, hit):
    t = silver(spark, [
        {"txn_type": "WIRE_IN", "timestamp": "2024-03-01 10:00:00", "counterparty_account": "ACC-9"},
        {"txn_type": "UPI_OUT", "timestamp": f"2024-03-01 {out_at}", "amount": 95.0}])
    found = layering.rule_layering_mule(t).collect()
    assert (len(found) == 1) is hit
    if hit:
        assert found[0]["pattern_type"] == "LAYERING" and found[0]["pass_through_pct"] == 95.0


def test_layering_across_midnight_and_blocks(spark):
    t = silver(spark, [{"txn_type": "WIRE_IN", "timestamp": "2024-03-01 23:30:00"},
                       {"txn_type": "WIRE_OUT", "timestamp": "2024-03-02 00:30:00"}])
    assert layering.rule_layering_mule(t).first()["min_gap_min"] == 60


@pytest.mark.parametrize("ratio, hit", [(0.90, False), (0.91, True)])
def test_layering_ratio(spark, ratio, hit):
    t = silver(spark, [{"txn_type": "WIRE_IN"}, {"timestamp": "2024-03-01 10:10:00", "amount": 100 * ratio}])
    assert (layering.rule_layering_mule(t).count() == 1) is hit


def test_layering_fan_out_and_once(spark):
    t = silver(spark, [{"txn_type": "WIRE_IN", "amount": 100.0},
                       {"timestamp": "2024-03-01 10:10:00", "amount": 95.0},
                       {"timestamp": "2024-03-01 10:20:00", "amount": 95.0}])
    assert layering.rule_layering_mule(t).count() == 0  # the in counts twice: 95 of 200
    assert layering.rule_layering_mule(t, dedup=True).first()["total_in"] == 100.0


@pytest.mark.parametrize("gap_days, hit", [(29, False), (30, True), (365, True), (366, False)])
def test_circular_days(spark, gap_days, hit):
    from datetime import datetime, timedelta

    back = (datetime(2024, 1, 1, 10) + timedelta(days=gap_days)).strftime("%Y-%m-%d %H:%M:%S")
    t = silver(spark, [
        {"account_id": "A", "customer_id": "CA", "counterparty_account": "B", "timestamp": "2024-01-01 10:00:00"},
        {"account_id": "B", "customer_id": "CB", "counterparty_account": "A", "timestamp": back, "txn_type": "WIRE_IN"},
    ], amount=300000.0)
    assert (rules_circular(t) == 1) is hit
    assert (circular.circular_flow_nb(t).count() == 1) is hit
    assert (circular.circular_out_legs(t).count() == 1) is hit


def rules_circular(t):
    return circular.rule_circular_flow(t).count()


@pytest.mark.parametrize("back, hit", [(208200.0, False), (210000.0, True), (390000.0, True), (393000.0, False)])
def test_circular_ratio(spark, back, hit):
    t = silver(spark, [
        {"account_id": "A", "customer_id": "CA", "counterparty_account": "B", "amount": 300000.0},
        {"account_id": "B", "customer_id": "CB", "counterparty_account": "A", "amount": back, "txn_type": "WIRE_IN",
         "timestamp": "2024-06-01 10:00:00"}])
    assert (circular.circular_flow_nb(t).count() == 1) is hit
    assert (rules_circular(t) == 1) is hit


def test_circular_same_customer_is_no_circle(spark):
    t = silver(spark, [
        {"account_id": "A", "counterparty_account": "B"},
        {"account_id": "B", "counterparty_account": "A", "txn_type": "WIRE_IN", "timestamp": "2024-06-01 10:00:00"},
    ], amount=300000.0, customer_id="SAME")
    assert rules_circular(t) == 0 and circular.circular_flow_nb(t).count() == 0


def test_circular_return_mode(spark):
    """B wires back to A; in reference mode that is no answer, in return mode it is."""
    t = silver(spark, [
        {"account_id": "A", "customer_id": "CA", "counterparty_account": "B"},
        {"account_id": "B", "customer_id": "CB", "counterparty_account": "A", "timestamp": "2024-06-01 10:00:00"},
    ], amount=300000.0, txn_type="WIRE_OUT")
    assert circular.circular_flow_nb(t).count() == 0
    assert circular.circular_flow_nb(t, mode="return").count() == 1


def test_watchlist_and_pep(spark):
    c = table(spark, "customers", [
        {"customer_id": "L", "watchlist_match": "INTERPOL", "pep_flag": "N"},
        {"customer_id": "P", "watchlist_match": "NONE", "pep_flag": "Y"},
        {"customer_id": "U", "watchlist_match": None, "pep_flag": "Y"}])
    t = silver(spark, [{"customer_id": "L", "amount": 5000.0}, {"customer_id": "L", "amount": 5000.01},
                       {"customer_id": "P", "amount": 100000.0}, {"customer_id": "P", "amount": 100000.01},
                       {"customer_id": "U", "amount": 200000.0}])
    assert rows(rules.rule_watchlist_pep(t, c), "customer_id", "rule_id") == [
        ("L", "RULE-008"), ("P", "RULE-007"), ("U", "RULE-007")]


def test_dormant(spark):
    a = table(spark, "accounts", [{"account_id": "OLD", "days_inactive": 181}, {"account_id": "NEW", "days_inactive": 180}])
    t = silver(spark, [{"account_id": "OLD", "amount": 50000.0}, {"account_id": "OLD", "amount": 50000.01},
                       {"account_id": "NEW", "amount": 60000.0}])
    assert rules.rule_dormant_spike(t, a).count() == 1


def test_lookback_is_strict(spark):
    t = silver(spark, [{"timestamp": "2024-03-01 10:00:00"}, {"timestamp": "2024-03-01 10:00:01"},
                       {"timestamp": "2024-03-02 10:00:00"}], txn_type="CASH_DEP", amount=30000.0)
    from txnwatch.functions.columns import recent

    assert recent(t, "24 hours").count() == 2
    assert recent(t, "24 hours", as_of="2024-03-02 09:59:59").count() == 3


# ---- the four demo scenarios ---------------------------------------------------------------------------


def test_scenario_structuring(spark):
    amounts = [9100.0, 9400.0, 9500.0, 9800.0]
    t = silver(spark, [{"amount": a, "timestamp": f"2024-03-01 1{i}:00:00"} for i, a in enumerate(amounts)],
               account_id="ACC-9001")
    hit = rules.rule_structuring(t).first()
    assert (hit["txn_count"], hit["total_amount"], hit["severity"]) == (4, 37800.0, "HIGH")
    assert hit["alert_msg"] == "STRUCTURING: ACC-9001 made 4 sub-threshold txns totaling 37800.00"


def test_scenario_mule(spark):
    ins = [{"txn_type": "WIRE_IN", "counterparty_account": f"ACC-{i}", "amount": 1000.0,
            "timestamp": f"2024-03-01 10:0{i}:00"} for i in range(5)]
    t = silver(spark, ins + [{"amount": 4850.0, "timestamp": "2024-03-01 10:30:00"}], account_id="ACC-2201")
    hit = layering.rule_layering_mule(t).first()
    assert (hit["rule_id"], hit["severity"], hit["senders"], hit["pass_through_pct"]) == ("RULE-003", "CRITICAL", 5, 97.0)


def test_scenario_layering(spark):
    t = silver(spark, [{"txn_type": "WIRE_IN", "amount": 500000.0},
                       {"amount": 480000.0, "timestamp": "2024-03-01 11:45:00"}], account_id="ACC-2301")
    assert layering.rule_layering_mule(t).first()["rule_id"] == "RULE-002"


def test_scenario_watchlist(spark):
    c = table(spark, "customers", [{"customer_id": "CUST-2701", "watchlist_match": "INTERPOL", "pep_flag": "N"}])
    t = silver(spark, [{"customer_id": "CUST-2701", "amount": 7500.0}])
    hit = rules.rule_watchlist_pep(t, c).first()
    assert (hit["rule_id"], hit["severity"]) == ("RULE-008", "CRITICAL")
    assert silver_columns(t).columns == t.columns
