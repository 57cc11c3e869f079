"""Exactness where one account holds a third of the rows, against brute force on every pair of rows."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from pyspark.sql import functions as F

from txnwatch.operators import circular, cleaning, investigate, layering, windows

from .frames import silver, transactions


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        account = "HOT" if hot else f"A{rnd.randrange(12)}"
        # clustered times, some equal, some with fractions, over block edges (28 days from 1970)
        at = start + timedelta(days=rnd.choice([0, 1, 3, 8, 24, 25, 60]), seconds=rnd.randrange(0, 86400, 20),
                               microseconds=rnd.choice([0, 0, 250000, 999999]))
        rows.append({
            "account_id": account, "customer_id": f"C-{account}", "counterparty_account": rnd.choice(["HOT", "A1", "A2", "A3"]),
            "amount": float(rnd.randrange(1000, 400000)), "timestamp": at.strftime("%Y-%m-%d %H:%M:%S.%f"),
            "txn_type": rnd.choice(["WIRE_IN", "WIRE_OUT", "UPI_OUT", "CASH_DEP"])})
    return silver(spark, rows).cache()


def test_windows(skewed):
    got = windows.window_features(skewed).toPandas().set_index("txn_id")
    pdf = skewed.toPandas()
    pdf["sec"] = pdf["txn_timestamp"].map(lambda v: int(v.timestamp()))
    for _, row in pdf.iterrows():
        same = pdf[pdf.account_id == row.account_id]
        back = lambda seconds: same[(same.sec <= row.sec) & (same.sec >= row.sec - seconds)]
        day = same[same.txn_date == row.txn_date]
        upto = day[(day.txn_timestamp < row.txn_timestamp)
                   | ((day.txn_timestamp == row.txn_timestamp) & (day.txn_id <= row.txn_id))]
        cash = back(172800)[lambda d: d.is_cash == 1]
        mine = got.loc[row.txn_id]
        assert mine.txn_count_same_day == len(upto)
        assert mine.txn_count_7d == len(back(604800))
        assert mine.txn_count_1h == len(back(3600))
        assert mine.amount_sum_1h == pytest.approx(back(3600).amount.sum())
        assert mine.cash_dep_count_48h == len(cash)
        assert mine.cash_sum_48h == pytest.approx(cash.amount.sum())


@pytest.mark.parametrize("once", [False, True])
def test_layering(skewed, once):
    pdf = skewed.toPandas()
    pdf["minute"] = pdf["timestamp"].map(lambda v: int(v.timestamp() // 60))
    ins = pdf[pdf.txn_type == "WIRE_IN"]
    outs = pdf[pdf.txn_type.isin(["WIRE_OUT", "UPI_OUT"])]
    pairs = ins.merge(outs, on="account_id", suffixes=("", "_o"))
    pairs = pairs[(pairs.timestamp_o > pairs.timestamp) & (pairs.minute_o - pairs.minute <= 120)]
    want = {}
    for account, group in pairs.groupby("account_id"):
        legs = group.drop_duplicates("txn_id") if once else group
        total_in, total_out = legs.amount.sum(), group.amount_o.max()
        want[account] = (total_in, total_out, group.counterparty_account.nunique(), (group.minute_o - group.minute).min())
    found = layering.rule_layering_mule(skewed, min_ratio=0.0, dedup=once).collect()
    assert {r["account_id"]: (pytest.approx(r["total_in"]), r["total_out"], r["senders"], r["min_gap_min"]) for r in found} == want


@pytest.mark.parametrize("limit", [200_000, 2])
def test_circular_answers_and_out_legs(skewed, limit, monkeypatch):
    monkeypatch.setattr(circular, "LIMIT", limit)
    pdf = skewed.toPandas()
    large = pdf[(pdf.amount > 50000) & pdf.txn_type.isin(["WIRE_IN", "WIRE_OUT"])]
    pairs = large.merge(large, left_on=["account_id", "counterparty_account"], right_on=["counterparty_account", "account_id"],
                        suffixes=("", "_b"))
    days = (pd.to_datetime(pairs.txn_date_b) - pd.to_datetime(pairs.txn_date)).dt.days
    ratio = (pairs.amount_b * 100 / pairs.amount).round(1)
    pairs = pairs[(days.between(5, 60)) & ratio.between(70, 130) & (pairs.customer_id != pairs.customer_id_b)]
    want = {leg: (len(g), *min(zip(g.timestamp_b, g.amount_b, g.customer_id_b))[1:]) for leg, g in pairs.groupby("txn_id")}
    got = circular.rule_circular_flow(skewed, min_amount=50000, days=(5, 60)).collect()
    assert {r["txn_id"]: (r["n_answers"], r["amount2"], r["customer_id2"]) for r in got} == want != {}
    assert len(got) == len(want)
    found = circular.circular_flow_nb(skewed, min_amount=50000, days=(5, 60))
    legs = {r[0] for r in found.select("out_txn_id").distinct().collect()}
    once = circular.circular_out_legs(skewed, min_amount=50000, days=(5, 60)).select("out_txn_id").collect()
    assert sorted(r[0] for r in once) == sorted(legs)


@pytest.mark.parametrize("mode", ["rule", "reference", "return"])
def test_every_answer_has_a_row(skewed, mode):
    """A row per pair of legs, each with the number of answers of its first leg: nothing is left at the earliest one."""
    pdf = skewed.toPandas()
    large = pdf[(pdf.amount > 50000) & pdf.txn_type.isin(["WIRE_IN", "WIRE_OUT"])]
    first, back = large, large
    if mode != "rule":
        first = large[large.txn_type == "WIRE_OUT"]
        back = large[large.txn_type == ("WIRE_IN" if mode == "reference" else "WIRE_OUT")]
        if mode == "return":
            theirs = large[large.txn_type == "WIRE_IN"].rename(columns={
                "account_id": "counterparty_account", "counterparty_account": "account_id"}).assign(customer_id=None)
            back = pd.concat([back, theirs])
    pairs = first.merge(back, left_on=["account_id", "counterparty_account"], right_on=["counterparty_account", "account_id"],
                        suffixes=("", "_b"))
    days = (pd.to_datetime(pairs.txn_date_b) - pd.to_datetime(pairs.txn_date)).dt.days
    ratio = pairs.amount_b / pairs.amount
    ratio = (ratio * 100).round(1).between(70, 130) if mode == "rule" else ratio.round(2).between(0.7, 1.3)
    pairs = pairs[days.between(5, 60) & ratio & (pairs.customer_id != pairs.customer_id_b)]
    n = pairs.groupby("txn_id").size()
    want = sorted((r.txn_id, r.timestamp_b.value // 1000, r.amount_b, n[r.txn_id]) for r in pairs.itertuples())
    options = {"min_amount": 50000, "days": (5, 60), "pairs": True}
    if mode == "rule":
        got = circular.rule_circular_flow(skewed, **options)
        want = sorted((leg, amount, count) for leg, _, amount, count in want)
        got = got.select("txn_id", "amount2", "n_answers")
    else:
        got = circular.circular_flow_nb(skewed, mode=mode, **options).select(
            "out_txn_id", F.unix_micros("in_time"), "in_amount", "n_answers")
    assert sorted(map(tuple, got.collect())) == want != [] and len(want) > len(n)


def test_a_hundred_thousand_wires_between_two_accounts(spark):
    """Some 10^9 pairs, counted without forming them; every customer answers all others."""
    n = 100_000
    wires = spark.range(n).select(
        F.concat(F.lit("T"), F.lpad("id", 6, "0")).alias("txn_id"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("account_id"),
        F.when(F.col("id") % 2 == 0, "B").otherwise("A").alias("counterparty_account"),
        F.when(F.col("id") % 2 == 0, "CA").otherwise("CB").alias("customer_id"), (F.lit(300000.0) + F.col("id") % 7).alias("amount"),
        F.lit("WIRE_OUT").alias("txn_type"), F.lit("IN").alias("country"),
        F.timestamp_seconds(F.floor(F.col("id") / 1000) * 86400 + 60 * (F.col("id") % 1000)).alias("timestamp"))
    found = circular.rule_circular_flow(wires).agg(F.count("*"), F.sum("n_answers"), F.max("days_gap")).first()
    days = [d + 30 for d in range(100)]  # a leg of day d is answered by the 500 opposite ones of each day from d + 30 on
    assert tuple(found) == (70_000, sum(1000 * 500 * (100 - d) for d in days if d < 100), 30)


def test_dedupe_of_one_row_delivered_many_times(spark):
    copies = [{"txn_id": "TXN-000001"} for _ in range(300)] + [{"txn_id": f"TXN-1{i:05d}"} for i in range(300)]
    t = transactions(spark, copies)
    assert cleaning.dedupe_transactions(t).count() == 301
    once = cleaning.dedupe_transactions(t)
    assert cleaning.dedupe_transactions(once).count() == once.count()


def test_three_hop_against_all_chains(spark, skewed):
    legs = skewed.toPandas()[["txn_id", "account_id", "counterparty_account", "amount", "timestamp"]]
    seeds = spark.createDataFrame([("A1",), ("HOT",)], "account_id string")
    one = legs[legs.account_id.isin(["A1", "HOT"])]
    two = one.merge(legs, left_on="counterparty_account", right_on="account_id", suffixes=("", "_2"))
    two = two[two.timestamp_2 > two.timestamp]
    three = two.merge(legs, left_on="counterparty_account_2", right_on="account_id", suffixes=("", "_3"))
    three = three[three.timestamp_3 > three.timestamp_2].sort_values(
        ["timestamp", "txn_id", "timestamp_2", "txn_id_2", "timestamp_3", "txn_id_3"]).head(20)
    want = list(three[["account_id", "counterparty_account", "counterparty_account_2", "counterparty_account_3",
                       "amount", "amount_2", "amount_3"]].itertuples(index=False, name=None))
    got = [tuple(r) for r in investigate.inv_three_hop(skewed, seeds).collect()]
    assert sorted(got) == sorted(want) and len(got) == 20


def test_common_counterparties_from_either_side(spark, skewed):
    pdf = skewed.toPandas()
    asked = [("HOT", "A1"), ("A1", "HOT"), ("A2", "A3")]
    pairs = spark.createDataFrame(asked, "acct1 string, acct2 string")
    want = {}
    for a, b in asked:
        both = pdf[pdf.account_id == a].merge(pdf[pdf.account_id == b], on="counterparty_account")
        for party, group in both.groupby("counterparty_account"):
            want[(party, a, b)] = (pytest.approx(group.amount_x.sum()), pytest.approx(group.amount_y.sum()))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in investigate.inv_common_counterparties(skewed, pairs).collect()}
    assert got == want


def test_row_order_does_not_matter(skewed):
    shuffled = skewed.orderBy("amount").repartition(5)
    names = ["txn_id", *windows.FEATURES]
    a = sorted(map(tuple, windows.window_features(skewed).select(names).collect()))
    b = sorted(map(tuple, windows.window_features(shuffled).select(names).collect()))
    assert a == b


def test_long_frames_of_one_busy_account(spark):
    """200 000 consecutive seconds of one account. Adding up every frame anew would take 10^10 steps."""
    n = 200000
    rows = spark.range(n).select(
        F.format_string("T%07d", "id").alias("txn_id"), F.lit("HOT").alias("account_id"), F.lit(0.1).alias("amount"),
        F.lit(1).alias("is_cash"), F.timestamp_seconds(F.lit(1709251200) + F.col("id")).alias("txn_timestamp"))
    got = windows.window_features(rows).withColumn("i", F.col("txn_id").substr(2, 7).cast("long"))
    inside = lambda seconds: F.least(F.col("i") + 1, F.lit(seconds + 1))
    wrong = got.filter(
        (F.col("txn_count_7d") != F.col("i") + 1)
        | (F.col("txn_count_1h") != inside(3600))
        | (F.col("cash_dep_count_48h") != inside(172800))
        | (F.abs(F.col("amount_sum_1h") - inside(3600) * 0.1) > 1e-6)
        | (F.abs(F.col("cash_sum_48h") - inside(172800) * 0.1) > 1e-6)
        | (F.col("txn_count_same_day") != F.col("i") % 86400 + 1))
    assert got.count() == n and wrong.count() == 0


def test_rolling_sums_keep_every_amount_and_row(spark):
    rows = silver(spark, [
        {"amount": 200.0, "timestamp": "2024-03-01 10:00:00"}, {"amount": 2e18, "timestamp": "2024-03-01 10:10:00"},
        {"amount": 3.0, "timestamp": "2024-03-01 11:05:00"}, {"amount": float("nan"), "timestamp": "2024-03-03 10:00:00"},
        {"amount": 5.0, "timestamp": "2024-03-03 10:30:00"}, {"amount": 7.0, "timestamp": "2024-03-03 12:00:00"},
        {"amount": 11.0, "account_id": None, "timestamp": "2024-03-01 10:00:00"},
        {"amount": 13.0, "account_id": None, "timestamp": "2024-03-01 10:20:00"}])
    got = {r["txn_id"]: r["amount_sum_1h"] for r in windows.window_features(rows).collect()}
    assert len(got) == 8
    assert [got[f"TXN-{k:06d}"] for k in (1, 2, 3, 6, 7, 8)] == [200.0, 2e18 + 200.0, 2e18 + 3.0, 7.0, 11.0, 24.0]
    assert all(str(got[f"TXN-{k:06d}"]) == "nan" for k in (4, 5))
    with pytest.raises(Exception, match="10 \\*\\* 30"):
        windows.window_features(silver(spark, [{"amount": 1e31}])).collect()


def test_stored_tables_are_cut_into_bounded_tasks(spark, tmp_path):
    """With few shuffle partitions a stored table's rows still come in parts of bounded size."""
    from txnwatch.plans.tables import Tables

    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.range(1_200_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = Tables(spark, str(tmp_path)).stored("wide", rows.repartition("id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
    assert got.count() == 1_200_000
    assert len(got.inputFiles()) > 2
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before[1]
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
