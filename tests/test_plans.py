"""What the physical plans must and must not hold."""

import re

import pytest

from txnwatch.plans.registry import queries

RUNS = queries()
PYTHON = {"anomaly_fit", "anomaly_score", "ml_risk_scores", "score_new", "model_save_load", "rule_circular_flow", "circular_flow_nb",
          "circular_flow_return", "all_rule_hits"}
EAGER = {n for n in RUNS if n.startswith(("stream_", "late_", "eval_", "gbt_"))} | {"load_checked", "write_table", "write_evolving", "read_csv_typed",
                                                                         "read_csv_strings", "reload_dimensions", "batch_run"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(RUNS) - PYTHON - EAGER))
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    text = plan(RUNS[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroups"):
        assert banned not in text


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(RUNS["rule_dormant_spike"](spark, sf_dir))
    assert "GreaterThan(amount,50000.0)" in text
    assert "merchant_cat" not in text


def test_copies_are_reduced_before_the_shuffle(spark, sf_dir):
    text = plan(RUNS["dedupe_transactions"](spark, sf_dir))
    exchange = text.index("Exchange hashpartitioning(txn_id")
    assert "row_number(), 1, Partial" in text[exchange:]


def test_no_window_holds_a_whole_account(spark, sf_dir):
    """Frames are evaluated per (account, block) or (account, second), never per account."""
    for name in ("window_features", "gold_features", "rule_layering_mule"):
        text = plan(RUNS[name](spark, sf_dir))
        for keys in re.findall(r"windowspecdefinition\(account_id#\d+, (\w+)#", text):
            assert keys in ("block", "sec", "minute"), (name, keys)
        assert "windowspecdefinition(account_id" in text


def test_day_lookback_prunes_partitions(spark, sf_dir):
    from txnwatch.operators import rules
    from txnwatch.plans.tables import tables

    df = rules.rule_cash_intensive(tables(spark, sf_dir).silver, as_of="2024-06-01 00:00:00", lookback="24 hours")
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", plan(df))


def test_rolling_sums_run_once_over_their_rows(spark, sf_dir):
    """A frame that slides is added up anew for each row; only running frames may be used for days and weeks."""
    text = plan(RUNS["gold_features"](spark, sf_dir))
    assert not re.search(r"RangeFrame, -\d", text)


def test_rules_share_scans(spark, sf_dir):
    """The rules over bins take one scan and one aggregate, those that look at one row another scan."""
    from txnwatch.operators import rules
    from txnwatch.plans.tables import tables

    t = tables(spark, sf_dir)
    binned = plan(rules._binned_hits(t.silver))
    assert binned.count("FileScan") == 1 and binned.count("Exchange") == 1
    rows = plan(rules._row_hits(t.silver, t.accounts, t.customers))
    assert rows.count("GreaterThan(amount,5000.0)") == 1
