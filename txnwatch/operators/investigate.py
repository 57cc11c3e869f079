"""Investigation queries. ``seeds`` is a DataFrame of account_id; without it every account is covered."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..fixed import HIGH_RISK_COUNTRIES, HOME_COUNTRY
from ..functions.columns import severity_rank, txn_number


def _seeded(t: DataFrame, seeds: DataFrame | None, column: str = "account_id") -> DataFrame:
    if seeds is None:
        return t
    return t.join(seeds.select(F.col("account_id").alias(column)).distinct(), column, "left_semi")


def _in_order(rows: DataFrame, seeds: DataFrame | None) -> DataFrame:
    """A case file reads in time order; the whole table is not sorted for it."""
    return rows if seeds is None else rows.orderBy("timestamp", "txn_id", "flag_id")


def inv_critical_flags(f: DataFrame, t: DataFrame) -> DataFrame:
    """Critical flags with the amount of their transaction, best scored first."""
    critical = f.filter(F.col("severity") == "CRITICAL")
    return critical.join(t.select("txn_id", "amount"), "txn_id", "left").select(
        "flag_id", "txn_id", "account_id", "customer_id", "amount", "pattern_type", "rule_id", "severity", "ml_score",
    ).orderBy(F.desc("ml_score"), "flag_id")


def inv_account_history(t: DataFrame, f: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    flags = f.select("txn_id", "flag_id", "pattern_type", "rule_id", "severity", "ml_score")
    rows = _seeded(t, seeds).join(flags, "txn_id", "left")
    return _in_order(rows, seeds).select(
        "txn_id", "amount", "txn_type", "counterparty_account", "country", "pattern_type", "rule_id", "severity",
        "ml_score")


def inv_why_flagged(f: DataFrame, r: DataFrame, txn_ids: DataFrame | None = None) -> DataFrame:
    """Flags of the given transactions, in either id form, with the rule's wording."""
    if txn_ids is not None:
        wanted = txn_ids.select(txn_number(F.col("txn_id")).alias("_n")).filter("_n <> ''").distinct()
        f = f.withColumn("_n", txn_number(F.col("txn_id"))).join(wanted, "_n", "left_semi")
    return f.join(r.select("rule_id", "condition_summary", "rationale"), "rule_id").select(
        "flag_id", "pattern_type", "ml_score", "severity", "notes", "condition_summary", "rationale")


DEVIATION_FEATURES = ["amount", "txn_count_same_day", "txn_count_7d", "txn_count_1h", "amount_sum_1h", "cash_sum_48h"]


def inv_feature_deviation(g: DataFrame, f: DataFrame) -> DataFrame:
    """Model-only flags: each feature over the account's average of it."""
    flagged = f.filter(F.col("rule_id") == "RULE-010").select("flag_id", "txn_id")
    usual = g.groupBy("account_id").agg(*[F.avg(n).alias(f"avg_{n}") for n in DEVIATION_FEATURES])
    rows = g.select("txn_id", "account_id", *DEVIATION_FEATURES).join(flagged, "txn_id")
    return rows.join(usual, "account_id").select(
        "flag_id", "txn_id", "account_id",
        *[F.try_divide(n, f"avg_{n}").alias(f"{n}_ratio") for n in DEVIATION_FEATURES])


def inv_txn_lookup(t: DataFrame, ids: DataFrame | list[str]) -> DataFrame:
    """Transactions that go by a given id. A list holds a few ids as an analyst writes them: a transaction is found if its
    id contains the number of one of them. Ids of a DataFrame meet by their whole number, original or re-delivered."""
    if isinstance(ids, DataFrame):
        wanted = ids.select(txn_number(F.col("txn_id")).alias("_n")).filter("_n <> ''").distinct()
        found = t.withColumn("_n", txn_number(F.col("txn_id"))).join(wanted, "_n", "left_semi")
    else:
        numbers = [re.search(r"(\d*)$", i).group(1) or i for i in ids]
        found = t.filter(reduce(lambda a, b: a | b, [F.contains("txn_id", F.lit(n)) for n in numbers], F.lit(False)))
    return found.select("txn_id", "account_id", "amount", "txn_type", "counterparty_account", "country", "timestamp")


def inv_unflagged_score(t: DataFrame, f: DataFrame, m: DataFrame) -> DataFrame:
    """Transactions nobody flagged, with the score that let them pass."""
    quiet = t.join(f.select("txn_id"), "txn_id", "left_anti")
    return quiet.join(m.select("txn_id", "final_risk_score", "fraud_type"), "txn_id").select(
        "txn_id", "account_id", "amount", "final_risk_score", "fraud_type")


def inv_watchlist_customers(w: DataFrame, c: DataFrame) -> DataFrame:
    people = c.select(F.col("customer_id").alias("entity_id"), "country", "risk_tier")
    return w.join(people, "entity_id", "left").select("entity_id", "list_name", "risk_level", "country", "risk_tier")


def inv_interpol(w: DataFrame, c: DataFrame) -> DataFrame:
    return inv_watchlist_customers(w.filter(F.col("list_name") == "INTERPOL_RED"), c)


def inv_watchlist_entries(w: DataFrame) -> DataFrame:
    return w.select("entity_id", "entity_type", "list_name", "source", "risk_level", "match_type").orderBy(
        "risk_level", "entity_id", "list_name")


def inv_pep_customers(c: DataFrame) -> DataFrame:
    return c.filter(F.col("pep_flag") == "Y").select(
        "customer_id", "country", "occupation", "risk_tier", "source_of_funds")


def inv_amount_at_risk(t: DataFrame, f: DataFrame) -> DataFrame:
    """Amount behind undecided flags, counted once per flag."""
    waiting = f.filter(F.col("analyst_decision") == "PENDING").groupBy("txn_id").agg(F.count(F.lit(1)).alias("n"))
    return t.join(waiting, "txn_id").agg(F.sum(F.col("amount") * F.col("n")).alias("total_at_risk"))


def inv_pattern_breakdown(f: DataFrame) -> DataFrame:
    counts = f.groupBy("pattern_type", "severity").agg(F.count(F.lit(1)).alias("flag_count"))
    return counts.orderBy(F.desc("flag_count"), "pattern_type", "severity")


def inv_sar_dataset(t: DataFrame, f: DataFrame, c: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """The rows a suspicious-activity report is written from."""
    flags = f.select("txn_id", "flag_id", "pattern_type", "ml_score")
    people = c.select("customer_id", "occupation", "pep_flag", "source_of_funds")
    rows = _seeded(t, seeds).join(flags, "txn_id").join(people, "customer_id")
    return _in_order(rows, seeds).select(
        "txn_id", "amount", "txn_type", "counterparty_account", "country", "timestamp", "pattern_type", "ml_score",
        "occupation", "pep_flag", "source_of_funds")


def inv_decision_counts(f: DataFrame) -> DataFrame:
    return f.groupBy("analyst_decision").agg(F.count(F.lit(1)).alias("flag_count"))


def inv_high_risk_country(t: DataFrame, limit: int = 20) -> DataFrame:
    """The largest transactions with high-risk countries."""
    rows = t.filter(F.col("country").isin(HIGH_RISK_COUNTRIES))
    return rows.select("txn_id", "account_id", "amount", "country", "txn_type").orderBy(
        F.desc("amount"), "txn_id").limit(limit)


def inv_pattern_flags(f: DataFrame, *patterns: str) -> DataFrame:
    """Flags of the given patterns, best scored first."""
    return f.filter(F.col("pattern_type").isin(*patterns)).select(
        "flag_id", "txn_id", "account_id", "pattern_type", "ml_score", "severity", "notes",
    ).orderBy(F.desc("ml_score"), "flag_id")


def inv_circular_flags(f: DataFrame) -> DataFrame:
    return inv_pattern_flags(f, "CIRCULAR_FLOW")


def inv_money_flow(t: DataFrame, seeds: DataFrame) -> DataFrame:
    """The seeds' own transactions (hop 1), then those of every account they dealt with (hop 2)."""
    columns = ["txn_id", "account_id", "txn_type", "counterparty_account", "amount", "country", "timestamp"]
    own = _seeded(t, seeds)
    parties = own.select(F.col("counterparty_account").alias("account_id")).distinct()
    onward = _seeded(t, parties)
    return own.select(F.lit(1).alias("hop"), *columns).unionByName(onward.select(F.lit(2).alias("hop"), *columns))


def inv_connections(t: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Every account's counterparties with count, total and first and last dealing."""
    return _seeded(t, seeds).groupBy("account_id", "counterparty_account").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"),
        F.min("timestamp").alias("first_txn"), F.max("timestamp").alias("last_txn"))


def inv_reverse_trace(t: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """Who dealt with the seed, seen from the other side."""
    named = t.filter(F.col("counterparty_account").isNotNull())
    return _seeded(named, seeds, "counterparty_account").groupBy(
        F.col("counterparty_account").alias("seed"), "account_id"
    ).agg(F.sum("amount").alias("total_sent"), F.count(F.lit(1)).alias("txn_count"))


def inv_common_counterparties(t: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counterparties two accounts share. Totals are those of the joined rows: each side's sum is multiplied
    by the other side's count, so no transaction meets another. Each pair starts from the account with fewer
    counterparties, so one account with very many does not multiply the pairs it is in."""
    pairs = pairs.select("acct1", "acct2").distinct()
    asked = pairs.select(F.explode(F.array("acct1", "acct2")).alias("account_id")).distinct()
    dealt = _seeded(t, asked).groupBy("account_id", "counterparty_account").agg(
        F.sum("amount").alias("total"), F.count(F.lit(1)).alias("n"))
    parties = dealt.groupBy("account_id").agg(F.count(F.lit(1)).alias("parties"))
    for i in (1, 2):
        pairs = pairs.join(parties.select(F.col("account_id").alias(f"acct{i}"), F.col("parties").alias(f"p{i}")), f"acct{i}")
    swap = F.col("p1") > F.col("p2")
    pairs = pairs.select(
        F.when(swap, F.col("acct2")).otherwise(F.col("acct1")).alias("few"),
        F.when(swap, F.col("acct1")).otherwise(F.col("acct2")).alias("many"), swap.alias("swapped"))

    def side(name: str) -> DataFrame:
        return dealt.select(F.col("account_id").alias(name), "counterparty_account",
                            F.col("total").alias(f"{name}_total"), F.col("n").alias(f"{name}_n"))

    met = pairs.join(side("few"), "few").join(side("many"), ["many", "counterparty_account"])
    of_few, of_many = F.col("few_total") * F.col("many_n"), F.col("many_total") * F.col("few_n")
    either = lambda a, b: F.when(F.col("swapped"), b).otherwise(a)
    return met.select(
        "counterparty_account",
        either(F.col("few"), F.col("many")).alias("acct1"), either(F.col("many"), F.col("few")).alias("acct2"),
        either(of_few, of_many).alias("total1"), either(of_many, of_few).alias("total2"))


def inv_circular_check(t: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """The seeds' outgoing wires and every later incoming wire the receiver booked from them."""
    sent = _seeded(t.filter(F.col("txn_type") == "WIRE_OUT"), seeds).select(
        F.col("account_id").alias("sender"), F.col("counterparty_account").alias("sent_to"),
        F.col("amount").alias("sent_amount"), F.col("timestamp").alias("sent_date"))
    back = _seeded(t.filter(F.col("txn_type") == "WIRE_IN"), seeds, "counterparty_account").select(
        F.col("account_id").alias("returned_from"), F.col("counterparty_account").alias("returned_to"),
        F.col("amount").alias("returned_amount"), F.col("timestamp").alias("return_date"))
    return sent.join(
        back,
        (F.col("sender") == F.col("returned_to")) & (F.col("sent_to") == F.col("returned_from"))
        & (F.col("return_date") > F.col("sent_date")),
    ).drop("returned_to")


LEG = ["txn_id", "account_id", "counterparty_account", "amount", "timestamp"]


def _reached(legs: DataFrame) -> DataFrame:
    return legs.select(F.col("counterparty_account").alias("account_id")).distinct()


def inv_paths(t: DataFrame, seeds: DataFrame, hops: int = 3, limit: int = 20) -> DataFrame:
    """For each seed the first ``limit`` chains of ``hops`` transfers, each later than the one before, in the order of the
    (time, id) of their legs: ``seed``, ``path`` (from 1) and account, receiver, amount, time and id of every leg.

    The frontier grows from the seeds: the i-th legs are those of accounts that the legs before lead to, so rows of other accounts
    leave the scan through a semi-join. Going back from the last hop, a leg stays only if a later one can follow it (its time
    is before the newest leg kept of the account it leads to). Every leg left belongs to a whole chain, so on the way forward
    the first ``limit`` partial chains of a seed are enough, and no list of chains is longer than that per seed.
    Legs without a counterparty or time lead nowhere; seeds without an account, or not in the table, have no rows.
    """
    named = t.filter("counterparty_account is not null and timestamp is not null").select(*LEG)
    fronts = [_seeded(named, seeds)]
    for _ in range(hops - 1):
        fronts.append(_seeded(named, _reached(fronts[-1])))
    for i in reversed(range(hops - 1)):
        newest = fronts[i + 1].groupBy(F.col("account_id").alias("counterparty_account")).agg(
            F.max("timestamp").alias("newest"))
        fronts[i] = fronts[i].join(newest, "counterparty_account").filter(F.col("newest") > F.col("timestamp")).select(*LEG)

    chains, order = None, []
    for i, legs in enumerate(fronts, 1):
        leg = legs.select(*[F.col(c).alias(f"{c}{i}") for c in LEG])
        if chains is None:
            chains = leg.withColumn("seed", F.col("account_id1"))
        else:
            chains = chains.drop("path").join(leg, (F.col(f"counterparty_account{i - 1}") == F.col(f"account_id{i}"))
                                              & (F.col(f"timestamp{i}") > F.col(f"timestamp{i - 1}")))
        order += [f"timestamp{i}", f"txn_id{i}"]
        first = Window.partitionBy("seed").orderBy(*order)
        chains = chains.withColumn("path", F.row_number().over(first)).filter(F.col("path") <= limit)
    return chains.select("seed", "path", *[f"{c}{i}" for i in range(1, hops + 1) for c in LEG])


def inv_three_hop(t: DataFrame, seeds: DataFrame, limit: int = 20) -> DataFrame:
    """The first ``limit`` chains of three transfers over all seeds, in time order; ``inv_paths`` lists them for each seed."""
    chains = inv_paths(t, seeds, 3, limit).orderBy(*[f"{c}{i}" for i in (1, 2, 3) for c in ("timestamp", "txn_id")]).limit(limit)
    return chains.select(
        F.col("account_id1").alias("hop1"), F.col("counterparty_account1").alias("hop2"),
        F.col("counterparty_account2").alias("hop3"), F.col("counterparty_account3").alias("hop4"),
        F.col("amount1").alias("amt1"), F.col("amount2").alias("amt2"), F.col("amount3").alias("amt3"))


def inv_unusual(t: DataFrame, a: DataFrame, seeds: DataFrame | None = None, factor: float = 5) -> DataFrame:
    """Transactions well above the account's average."""
    dims = a.select("account_id", "avg_txn_amount", "risk_score", "risk_tier")
    rows = _seeded(t, seeds).join(dims, "account_id").filter(F.col("amount") > F.col("avg_txn_amount") * factor)
    times = F.round(F.try_divide("amount", "avg_txn_amount"), 1)
    return rows.select("account_id", "amount", "avg_txn_amount", times.alias("times_average"), "risk_score", "risk_tier")


def related_accounts(t: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, related): accounts a seed dealt with, or that dealt with it."""
    sent = _seeded(t, seeds).select(F.col("account_id").alias("seed"), F.col("counterparty_account").alias("related"))
    received = _seeded(t, seeds, "counterparty_account").select(
        F.col("counterparty_account").alias("seed"), F.col("account_id").alias("related"))
    return sent.union(received).filter("related is not null").distinct()


def _touching(t: DataFrame, related: DataFrame, by: list[str]) -> DataFrame:
    """The transactions with a related account on either side, once per value of ``by``."""
    one = related.withColumnRenamed("related", "account_id")
    other = related.withColumnRenamed("related", "counterparty_account")
    booked = t.join(one, "account_id")
    # the rows met on both sides are left to the first branch
    named = t.join(other, "counterparty_account").join(one, ["account_id", *by], "left_anti")
    return booked.unionByName(named)


NETWORK = ["account_id", "counterparty_account", "amount", "txn_type", "country", "pattern_type", "severity", "ml_score"]


def _with_flags(near: DataFrame, f: DataFrame) -> DataFrame:
    return near.join(f.select("txn_id", "flag_id", "pattern_type", "severity", "ml_score"), "txn_id", "left")


def inv_network(t: DataFrame, f: DataFrame, seeds: DataFrame) -> DataFrame:
    """Transactions that touch an account related to any of the seeds, with their flags, in time order."""
    near = _touching(t, related_accounts(t, seeds).select("related").distinct(), [])
    return _with_flags(near, f).orderBy("timestamp", "txn_id", "flag_id").select(*NETWORK)


def inv_network_by_seed(t: DataFrame, f: DataFrame, seeds: DataFrame) -> DataFrame:
    """The network of each seed on its own: a transaction near two seeds has a row for each. Rows of other accounts leave the
    scan through the join with the accounts related to the seeds; the table itself is not sorted."""
    return _with_flags(_touching(t, related_accounts(t, seeds), ["seed"]), f).select("seed", "txn_id", "flag_id", *NETWORK)


def inv_pattern_discovery(t, f, w, a, m, seeds: DataFrame) -> DataFrame:
    """Five looks at the seeds as (step, key, value) rows."""
    own_flags = _seeded(f, seeds).groupBy("pattern_type").agg(F.count(F.lit(1)).cast("string").alias("value"))
    parties = _seeded(t, seeds).select("counterparty_account").filter("counterparty_account is not null").distinct()
    party_flags = _seeded(f, parties.withColumnRenamed("counterparty_account", "account_id"))
    owners = _seeded(a, seeds).select(F.col("customer_id").alias("entity_id")).distinct()
    listed = w.join(owners, "entity_id", "left_semi")
    scores = _seeded(m, seeds)
    key = lambda c: F.col(c).alias("key")
    parts = [
        own_flags.select(F.lit(1).alias("step"), key("pattern_type"), "value"),
        parties.select(F.lit(2).alias("step"), key("counterparty_account"), F.lit("CONNECTED").alias("value")),
        party_flags.select(F.lit(3).alias("step"), key("flag_id"), F.col("pattern_type").alias("value")),
        listed.select(F.lit(4).alias("step"), key("entry_id"), F.col("list_name").alias("value")),
        scores.select(F.lit(5).alias("step"), key("txn_id"), F.format_string("%.4f", "final_risk_score").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def inv_timeline(t: DataFrame, f: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    flags = f.select("txn_id", "flag_id", "pattern_type", "severity")
    status = F.when(F.col("flag_id").isNotNull(), F.concat("pattern_type", F.lit(" ("), "severity", F.lit(")")))
    return _in_order(_seeded(t, seeds).join(flags, "txn_id", "left"), seeds).select(
        "timestamp", "txn_type", "amount", "counterparty_account", "country",
        status.otherwise("CLEAN").alias("status"))


def inv_similar_accounts(f: DataFrame, seeds: DataFrame, limit: int = 10) -> DataFrame:
    """For each seed, other accounts showing the pattern of its best scored flag, the ``limit`` best scored."""
    own = _seeded(f, seeds).groupBy(F.col("account_id").alias("seed")).agg(
        F.min_by("pattern_type", F.struct(-F.col("ml_score"), "flag_id")).alias("pattern_type"))
    others = f.join(seeds.select("account_id").distinct(), "account_id", "left_anti")
    alike = others.join(own, "pattern_type").groupBy("seed", "account_id", "pattern_type", "ml_score", "severity").agg(
        F.count(F.lit(1)).alias("flag_count"))
    best = Window.partitionBy("seed").orderBy(F.desc("ml_score"), "account_id", "severity")
    return alike.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= limit).drop("_n")


def inv_cross_border(t: DataFrame, seeds: DataFrame | None = None, home: str = HOME_COUNTRY) -> DataFrame:
    abroad = _seeded(t, seeds).filter(F.col("country") != home)
    return abroad.groupBy("account_id", "country").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"))


def inv_trend(t: DataFrame, by: str = "txn_date") -> DataFrame:
    """Counts by date or by pattern, busiest first."""
    return t.groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), by)


def account_signals(a, t, f, m, c, h, seeds: DataFrame | None = None) -> DataFrame:
    """One row per account: its totals, flags, scores, watchlist match and cases of account and customer. Rows of accounts
    other than the seeds, and of customers other than theirs, are left out before anything is added up."""
    a, t, f, m = (_seeded(rows, seeds) for rows in (a, t, f, m))
    if seeds is not None:
        people = a.select("customer_id").distinct()
        c, filed = c.join(people, "customer_id", "left_semi"), h.join(people, "customer_id", "left_semi")
    else:
        filed = h
    people = c.select("customer_id", "name_hash", "watchlist_match")
    # a case of the account is usually one of its customer too: add the customer's cases and, of the
    # account's, those filed under somebody else
    counts = [F.count(F.lit(1)).alias("cases"), F.count_if(F.col("sar_filed") == "Y").alias("sars")]
    owners = a.select("account_id", F.col("customer_id").alias("owner"))
    elsewhere = h.join(owners, "account_id").filter(~F.col("customer_id").eqNullSafe(F.col("owner")))
    of_customer = filed.groupBy("customer_id").agg(*counts).withColumnsRenamed({"cases": "cust_cases", "sars": "cust_sars"})
    # one aggregate over the rows of all four tables: an account's totals meet in one place, not in a join for each table
    kind = lambda name: F.lit(name).alias("kind")
    rows = t.select("account_id", kind("moved"), "amount", "timestamp")
    for more in (
        f.select("account_id", kind("flag"), "analyst_decision", severity_rank(F.col("severity")).alias("rank"), "ml_score"),
        m.select("account_id", kind("score"), "final_risk_score"),
        elsewhere.select("account_id", kind("case"), "sar_filed"),
    ):
        rows = rows.unionByName(more, allowMissingColumns=True)
    number = lambda name: F.count_if(F.col("kind") == name)
    of_account = rows.groupBy("account_id").agg(
        number("moved").alias("txn_count"), F.sum("amount").alias("total_amount"),
        F.min("timestamp").alias("first_txn"), F.max("timestamp").alias("last_txn"),
        number("flag").alias("flag_count"), F.count_if(F.col("analyst_decision") == "PENDING").alias("pending_flags"),
        F.min("rank").alias("worst"), F.max("ml_score").alias("max_flag_score"), F.max("final_risk_score").alias("max_score"),
        number("case").alias("cases"), F.count_if(F.col("sar_filed") == "Y").alias("sars"))
    base = a.select("account_id", "customer_id").join(of_account, "account_id", "left")
    for part in (people, of_customer):
        base = base.join(part, "customer_id", "left")
    zero = ["txn_count", "flag_count", "pending_flags", "cases", "sars", "cust_cases", "cust_sars"]
    return base.na.fill(0, zero).withColumns({
        "prior_cases": F.col("cases") + F.col("cust_cases"),
        "prior_sars": F.col("sars") + F.col("cust_sars"),
        "watchlist_match": F.coalesce("watchlist_match", F.lit("NONE")),
        "worst_severity": F.when(F.col("worst") == 1, "CRITICAL").when(F.col("worst") == 2, "HIGH")
        .when(F.col("worst") == 3, "MEDIUM"),
    }).drop("worst", "cases", "sars", "cust_cases", "cust_sars")


def recommended_action():
    """Our rule for the next step: watchlisted or previously reported and critical, file a report; critical,
    freeze; any other flag, review; none, dismiss."""
    critical = F.col("worst_severity") == "CRITICAL"
    known = (F.col("watchlist_match") != "NONE") | (F.col("prior_sars") > 0)
    return (
        F.when(critical & known, "FILE SAR").when(critical, "FREEZE")
        .when(F.col("flag_count") > 0, "REVIEW").otherwise("DISMISS")
    )


def inv_recommend_action(a, t, f, m, c, h, seeds: DataFrame | None = None) -> DataFrame:
    return account_signals(a, t, f, m, c, h, seeds).select(
        "account_id", "worst_severity", "watchlist_match", "prior_sars", "flag_count",
        recommended_action().alias("action"))


def inv_account_dossier(a, t, f, m, c, h, seeds: DataFrame | None = None) -> DataFrame:
    """The summary an investigation starts from, one row per account, with the recommended action. The full
    lists are ``inv_account_history`` and the tables themselves, so nothing is gathered into one row."""
    return account_signals(a, t, f, m, c, h, seeds).withColumn("action", recommended_action())
