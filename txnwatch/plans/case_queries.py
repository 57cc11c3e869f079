"""Flags, metrics, graph, alerts and investigations."""

from pyspark.sql import functions as F

from ..operators import alerts, graph, investigate as inv, metrics
from .oracle import HIGH_RISK
from .registry import register

# ---- metrics -------------------------------------------------------------------------------------------

register("kpi_total_transactions", lambda t: metrics.kpi_total_transactions(t.silver),
         "SELECT count(*) AS total_transactions FROM silver")
register("kpi_total_flagged", lambda t: metrics.kpi_total_flagged(t.flags), "SELECT count(*) AS total_flagged FROM flags")
register("kpi_fraud_rate", lambda t: metrics.kpi_fraud_rate(t.silver, t.flags),
         "SELECT (SELECT count(*) FROM flags)::DOUBLE / (SELECT count(*) FROM silver) AS fraud_rate", fraud_rate=8)
register("kpi_critical", lambda t: metrics.kpi_critical(t.flags),
         "SELECT count(*) AS critical_flags FROM flags WHERE severity = 'CRITICAL'")
register("kpi_pending", lambda t: metrics.kpi_pending(t.flags),
         "SELECT count(*) AS pending_flags FROM flags WHERE analyst_decision = 'PENDING'")
register("kpi_confirmed", lambda t: metrics.kpi_confirmed(t.flags),
         "SELECT count(*) AS confirmed_flags FROM flags WHERE analyst_decision = 'CONFIRMED'")
register("flagged_amount_once", lambda t: metrics.flagged_amount_once(t.silver, t.flags).select("txn_id", "amount"),
         "SELECT txn_id, amount FROM silver WHERE txn_id IN (SELECT txn_id FROM flags)")
register("kpi_flagged_amount", lambda t: metrics.kpi_flagged_amount(t.silver, t.flags),
         "SELECT sum(amount) AS flagged_amount FROM silver WHERE txn_id IN (SELECT txn_id FROM flags)", flagged_amount=2)
register("kpi_avg_ml_score", lambda t: metrics.kpi_avg_ml_score(t.scores),
         "SELECT avg(final_risk_score) AS avg_ml_score FROM scores", avg_ml_score=8)
register("kpi_false_positive_rate", lambda t: metrics.kpi_false_positive_rate(t.flags),
         """SELECT count(*) FILTER (WHERE analyst_decision = 'FALSE_POSITIVE')::DOUBLE / count(*) AS false_positive_rate
         FROM flags""", false_positive_rate=8)
register("kpi_avg_investigation_days", lambda t: metrics.kpi_avg_investigation_days(t.cases),
         "SELECT avg(investigation_days) AS avg_investigation_days FROM cases", avg_investigation_days=8)


def _kpis(where="TRUE"):
    return f"""SELECT (SELECT count(*) FROM silver) AS total_transactions, count(*) AS total_flagged,
        count(*)::DOUBLE / (SELECT count(*) FROM silver) AS fraud_rate,
        count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_flags,
        count(*) FILTER (WHERE analyst_decision = 'PENDING') AS pending_flags,
        count(*) FILTER (WHERE analyst_decision = 'CONFIRMED') AS confirmed_flags,
        (SELECT sum(amount) FROM silver WHERE txn_id IN (SELECT txn_id FROM flags WHERE {where})) AS flagged_amount,
        (SELECT avg(final_risk_score) FROM scores) AS avg_ml_score,
        count(*) FILTER (WHERE analyst_decision = 'FALSE_POSITIVE')::DOUBLE / count(*) AS false_positive_rate,
        (SELECT avg(investigation_days) FROM cases) AS avg_investigation_days
        FROM flags WHERE {where}"""


KPI_ROUND = {"fraud_rate": 8, "flagged_amount": 2, "avg_ml_score": 8, "false_positive_rate": 8, "avg_investigation_days": 8}
register("kpi_all", lambda t: metrics.kpi_all(t.silver, t.flags, t.scores, t.cases), _kpis(), **KPI_ROUND)
register("kpi_all_sliced", lambda t: metrics.kpi_all(
    t.silver, t.flags, t.scores, t.cases, severity="HIGH", pattern_type="STRUCTURING"),
    _kpis("severity = 'HIGH' AND pattern_type = 'STRUCTURING'"), **KPI_ROUND)

_paths = """flags f LEFT JOIN silver s USING (txn_id) LEFT JOIN acc a ON s.account_id = a.account_id
    LEFT JOIN cust c ON a.customer_id = c.customer_id"""
register("country_total_flagged", lambda t: metrics.country_total_flagged(t.flags, t.silver, t.accounts, t.customers),
         f"SELECT c.country, count(*) AS value FROM {_paths} GROUP BY 1")
register("country_flagged_amount", lambda t: metrics.country_flagged_amount(t.flags, t.silver, t.accounts, t.customers),
         """SELECT c.country, sum(s.amount) AS value FROM silver s LEFT JOIN acc a ON s.account_id = a.account_id
         LEFT JOIN cust c ON a.customer_id = c.customer_id WHERE s.txn_id IN (SELECT txn_id FROM flags)
         GROUP BY 1""", value=2)
register("country_pending", lambda t: metrics.country_pending(t.flags, t.silver, t.accounts, t.customers),
         f"SELECT c.country, count(*) AS value FROM {_paths} WHERE f.analyst_decision = 'PENDING' GROUP BY 1")
register("country_avg_investigation_days",
         lambda t: metrics.country_avg_investigation_days(t.cases, t.accounts, t.customers),
         """SELECT c.country, avg(investigation_days) AS value FROM cases h LEFT JOIN acc a ON h.account_id = a.account_id
         LEFT JOIN cust c ON a.customer_id = c.customer_id GROUP BY 1""", value=8)
register("flags_by_pattern", lambda t: metrics.flags_by_pattern(t.flags),
         "SELECT pattern_type, count(*) AS flag_count FROM flags WHERE flag_id IS NOT NULL AND flag_id <> '' GROUP BY 1")
register("flags_over_time", lambda t: metrics.flags_over_time(t.flags),
         "SELECT created_at, count(*) AS total_flagged FROM flags GROUP BY 1")
register("alert_queue", lambda t: metrics.alert_queue(t.flags, t.silver, t.rules),
         """SELECT flag_id, f.txn_id, f.account_id, s.amount, f.pattern_type, f.rule_id, severity, ml_score, analyst_decision
         FROM flags f JOIN silver s ON f.txn_id = s.txn_id WHERE f.rule_id IN (SELECT rule_id FROM rules)""")

# ---- investigations ------------------------------------------------------------------------------------


def seed(t):
    """The account an investigation would start with: the one with most critical flags."""
    worst = t.flags.filter(F.col("severity") == "CRITICAL").groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return worst.orderBy(F.desc("n"), "account_id").limit(1).select("account_id")


register("inv_critical_flags", lambda t: inv.inv_critical_flags(t.flags, t.silver),
         """SELECT flag_id, f.txn_id, f.account_id, f.customer_id, s.amount, pattern_type, rule_id, severity, ml_score
         FROM flags f LEFT JOIN silver s ON f.txn_id = s.txn_id WHERE severity = 'CRITICAL'""")
register("inv_account_history", lambda t: inv.inv_account_history(t.silver, t.flags),
         """SELECT s.txn_id, amount, txn_type, counterparty_account, country, pattern_type, rule_id, severity, ml_score
         FROM silver s LEFT JOIN flags f ON s.txn_id = f.txn_id""")
register("inv_why_flagged", lambda t: inv.inv_why_flagged(t.flags, t.rules, t.flags.filter("severity = 'CRITICAL'")),
         """SELECT flag_id, f.pattern_type, ml_score, severity, notes, condition_summary, rationale
         FROM flags f JOIN rules r ON f.rule_id = r.rule_id
         WHERE txn_id IN (SELECT txn_id FROM flags WHERE severity = 'CRITICAL')""")
_avg = ", ".join(f"avg({n}) AS avg_{n}" for n in inv.DEVIATION_FEATURES)
_ratio = ", ".join(f"CASE WHEN avg_{n} <> 0 THEN {n} / avg_{n} END AS {n}_ratio" for n in inv.DEVIATION_FEATURES)
register("inv_feature_deviation", lambda t: inv.inv_feature_deviation(t.gold, t.flags),
         f"""WITH u AS (SELECT account_id, {_avg} FROM gold GROUP BY 1)
         SELECT flag_id, g.txn_id, g.account_id, {_ratio} FROM gold g JOIN flags f ON g.txn_id = f.txn_id
         JOIN u ON g.account_id = u.account_id WHERE rule_id = 'RULE-010'""",
         **{f"{n}_ratio": 6 for n in inv.DEVIATION_FEATURES})
register("inv_txn_lookup", lambda t: inv.inv_txn_lookup(t.silver, t.flags),
         """SELECT txn_id, account_id, amount, txn_type, counterparty_account, country, "timestamp" FROM silver
         WHERE regexp_extract(txn_id, '(\\d+)$', 1) IN (SELECT regexp_extract(txn_id, '(\\d+)$', 1) FROM flags)""")
register("inv_txn_lookup_ids", lambda t: inv.inv_txn_lookup(t.silver, ["TXN-000050", "RT-TXN-00000007"]),
         """SELECT txn_id, account_id, amount, txn_type, counterparty_account, country, "timestamp" FROM silver
         WHERE txn_id LIKE '%000050%' OR txn_id LIKE '%00000007%'""")
register("inv_unflagged_score", lambda t: inv.inv_unflagged_score(t.silver, t.flags, t.scores),
         """SELECT s.txn_id, s.account_id, s.amount, final_risk_score, fraud_type FROM silver s
         JOIN scores m ON s.txn_id = m.txn_id WHERE s.txn_id NOT IN (SELECT txn_id FROM flags)""")
_wl = """SELECT entity_id, list_name, risk_level, country, risk_tier
    FROM wl LEFT JOIN cust ON entity_id = customer_id"""
register("inv_watchlist_customers", lambda t: inv.inv_watchlist_customers(t.watchlists, t.customers), _wl)
register("inv_interpol", lambda t: inv.inv_interpol(t.watchlists, t.customers), _wl + " WHERE list_name = 'INTERPOL_RED'")
register("inv_watchlist_entries", lambda t: inv.inv_watchlist_entries(t.watchlists),
         "SELECT entity_id, entity_type, list_name, source, risk_level, match_type FROM wl")
register("inv_pep_customers", lambda t: inv.inv_pep_customers(t.customers),
         "SELECT customer_id, country, occupation, risk_tier, source_of_funds FROM cust WHERE pep_flag = 'Y'")
register("inv_amount_at_risk", lambda t: inv.inv_amount_at_risk(t.silver, t.flags),
         """SELECT sum(amount) AS total_at_risk FROM silver s JOIN flags f ON s.txn_id = f.txn_id
         WHERE analyst_decision = 'PENDING'""", total_at_risk=2)
_breakdown = "SELECT pattern_type, severity, count(*) AS flag_count FROM flags GROUP BY 1, 2"
register("inv_pattern_breakdown", lambda t: inv.inv_pattern_breakdown(t.flags), _breakdown)
register("inv_sar_dataset", lambda t: inv.inv_sar_dataset(t.silver, t.flags, t.customers),
         """SELECT s.txn_id, amount, txn_type, counterparty_account, s.country, "timestamp", pattern_type, ml_score,
         occupation, pep_flag, source_of_funds FROM silver s JOIN flags f ON s.txn_id = f.txn_id
         JOIN cust c ON s.customer_id = c.customer_id""")
register("inv_decision_counts", lambda t: inv.inv_decision_counts(t.flags),
         "SELECT analyst_decision, count(*) AS flag_count FROM flags GROUP BY 1")
register("inv_high_risk_country", lambda t: inv.inv_high_risk_country(t.silver),
         f"""SELECT txn_id, account_id, amount, country, txn_type FROM silver WHERE country IN {HIGH_RISK}
         ORDER BY amount DESC, txn_id LIMIT 20""")
register("inv_circular_flags", lambda t: inv.inv_circular_flags(t.flags),
         """SELECT flag_id, txn_id, account_id, pattern_type, ml_score, severity, notes FROM flags
         WHERE pattern_type = 'CIRCULAR_FLOW'""")
register("inv_pattern_flags", lambda t: inv.inv_pattern_flags(t.flags, "STRUCTURING", "DORMANT_SPIKE"),
         """SELECT flag_id, txn_id, account_id, pattern_type, ml_score, severity, notes FROM flags
         WHERE pattern_type IN ('STRUCTURING', 'DORMANT_SPIKE')""")
_own = "(SELECT account_id FROM seed)"


def seeds(t):
    """Every account with a critical flag and an open case."""
    return t.seeds


_seeds = """(SELECT account_id FROM flags WHERE severity = 'CRITICAL'
    AND account_id IN (SELECT account_id FROM cases WHERE outcome = 'OPEN'))"""
_flow = 'txn_id, account_id, txn_type, counterparty_account, amount, country, "timestamp"'
register("inv_money_flow", lambda t: inv.inv_money_flow(t.silver, seed(t)),
         f"""SELECT 1 AS hop, {_flow} FROM silver WHERE account_id IN {_own}
         UNION ALL SELECT 2, {_flow} FROM silver WHERE account_id IN
            (SELECT counterparty_account FROM silver WHERE account_id IN {_own})""")
register("inv_connections", lambda t: inv.inv_connections(t.silver),
         """SELECT account_id, counterparty_account, count(*) AS txn_count, sum(amount) AS total_amount,
         min("timestamp") AS first_txn, max("timestamp") AS last_txn FROM silver GROUP BY 1, 2""", total_amount=2)
register("inv_reverse_trace", lambda t: inv.inv_reverse_trace(t.silver),
         """SELECT counterparty_account AS seed, account_id, sum(amount) AS total_sent, count(*) AS txn_count
         FROM silver GROUP BY 1, 2""", total_sent=2)


def _pairs(t):
    """The seed with each other account that dealt with one of the seed's counterparties."""
    own = inv._seeded(t.silver, seed(t))
    parties = own.select("counterparty_account").distinct()
    others = t.silver.join(parties, "counterparty_account", "left_semi").select(F.col("account_id").alias("acct2")).distinct()
    first = seed(t).scalar()
    return others.filter(F.col("acct2") != first).select(first.alias("acct1"), "acct2")


register("inv_common_counterparties", lambda t: inv.inv_common_counterparties(t.silver, _pairs(t)),
         f"""WITH pairs AS (SELECT DISTINCT x.account_id AS acct1, y.account_id AS acct2 FROM silver x
            JOIN silver y USING (counterparty_account) WHERE x.account_id IN {_own} AND y.account_id NOT IN {_own})
         SELECT a.counterparty_account, acct1, acct2, sum(a.amount) AS total1, sum(b.amount) AS total2
         FROM pairs JOIN silver a ON a.account_id = acct1 JOIN silver b ON b.account_id = acct2
         WHERE a.counterparty_account = b.counterparty_account GROUP BY 1, 2, 3""", total1=2, total2=2)
register("inv_circular_check", lambda t: inv.inv_circular_check(t.silver),
         """SELECT x.account_id AS sender, x.counterparty_account AS sent_to, x.amount AS sent_amount,
         x."timestamp" AS sent_date, y.account_id AS returned_from, y.amount AS returned_amount,
         y."timestamp" AS return_date FROM silver x JOIN silver y ON x.account_id = y.counterparty_account
         WHERE x.txn_type = 'WIRE_OUT' AND y.txn_type = 'WIRE_IN' AND x.counterparty_account = y.account_id
         AND y."timestamp" > x."timestamp" """)
register("inv_three_hop", lambda t: inv.inv_three_hop(t.silver, seed(t)),
         f"""SELECT a.account_id AS hop1, a.counterparty_account AS hop2, b.counterparty_account AS hop3,
         c.counterparty_account AS hop4, a.amount AS amt1, b.amount AS amt2, c.amount AS amt3
         FROM silver a JOIN silver b ON a.counterparty_account = b.account_id
         JOIN silver c ON b.counterparty_account = c.account_id
         WHERE a.account_id IN {_own} AND b."timestamp" > a."timestamp" AND c."timestamp" > b."timestamp"
         ORDER BY a."timestamp", a.txn_id, b."timestamp", b.txn_id, c."timestamp", c.txn_id LIMIT 20""")
# the newest leg of each account bounds what can follow, or the twin would list every chain
register("inv_paths", lambda t: inv.inv_paths(t.silver, seeds(t), 3, 5),
         f"""WITH legs AS (SELECT txn_id, account_id, counterparty_account, amount, "timestamp" FROM silver
            WHERE counterparty_account IS NOT NULL),
         last AS (SELECT account_id, max("timestamp") AS newest FROM legs GROUP BY 1),
         second AS (SELECT b.* FROM legs b JOIN last l ON b.counterparty_account = l.account_id WHERE l.newest > b."timestamp"),
         last2 AS (SELECT account_id, max("timestamp") AS newest FROM second GROUP BY 1),
         one AS (SELECT a.* FROM legs a JOIN last2 l ON a.counterparty_account = l.account_id
            WHERE a.account_id IN {_seeds} AND l.newest > a."timestamp"
            QUALIFY row_number() OVER (PARTITION BY a.account_id ORDER BY a."timestamp", a.txn_id) <= 5),
         two AS (SELECT a.txn_id AS txn_id1, a.account_id AS account_id1, a.counterparty_account AS counterparty_account1,
            a.amount AS amount1, a."timestamp" AS timestamp1, b.txn_id AS txn_id2, b.account_id AS account_id2,
            b.counterparty_account AS counterparty_account2, b.amount AS amount2, b."timestamp" AS timestamp2
            FROM one a JOIN second b ON a.counterparty_account = b.account_id AND b."timestamp" > a."timestamp"
            QUALIFY row_number() OVER (PARTITION BY a.account_id
                ORDER BY a."timestamp", a.txn_id, b."timestamp", b.txn_id) <= 5)
         SELECT account_id1 AS seed, row_number() OVER (PARTITION BY account_id1
                ORDER BY timestamp1, txn_id1, timestamp2, txn_id2, c."timestamp", c.txn_id) AS path,
            two.*, c.txn_id AS txn_id3, c.account_id AS account_id3, c.counterparty_account AS counterparty_account3,
            c.amount AS amount3, c."timestamp" AS timestamp3
         FROM two JOIN legs c ON counterparty_account2 = c.account_id AND c."timestamp" > timestamp2
         QUALIFY path <= 5""")
register("inv_network_by_seed", lambda t: inv.inv_network_by_seed(t.silver, t.flags, seeds(t)),
         f"""WITH near AS (SELECT account_id AS seed, counterparty_account AS related FROM silver WHERE account_id IN {_seeds}
            UNION SELECT counterparty_account, account_id FROM silver WHERE counterparty_account IN {_seeds}),
         met AS (SELECT seed, txn_id FROM near JOIN silver ON account_id = related
            UNION SELECT seed, txn_id FROM near JOIN silver ON counterparty_account = related)
         SELECT seed, s.txn_id, flag_id, s.account_id, counterparty_account, amount, txn_type, country, pattern_type, severity,
            ml_score FROM met JOIN silver s ON met.txn_id = s.txn_id LEFT JOIN flags f ON s.txn_id = f.txn_id""")
register("inv_unusual", lambda t: inv.inv_unusual(t.silver, t.accounts),
         """SELECT s.account_id, amount, avg_txn_amount, round(amount / nullif(avg_txn_amount, 0), 1) AS times_average,
         risk_score, risk_tier FROM silver s JOIN acc a ON s.account_id = a.account_id
         WHERE amount > avg_txn_amount * 5""")
register("inv_network", lambda t: inv.inv_network(t.silver, t.flags, seed(t)),
         f"""WITH direct AS (SELECT counterparty_account AS related FROM silver WHERE account_id IN {_own}
            UNION SELECT account_id FROM silver WHERE counterparty_account IN {_own})
         SELECT s.account_id, counterparty_account, amount, txn_type, country, pattern_type, severity, ml_score
         FROM silver s LEFT JOIN flags f ON s.txn_id = f.txn_id WHERE s.account_id IN (SELECT related FROM direct)
         OR counterparty_account IN (SELECT related FROM direct)""")
register("inv_pattern_discovery", lambda t: inv.inv_pattern_discovery(
    t.silver, t.flags, t.watchlists, t.accounts, t.scores, seed(t)),
    f"""WITH p AS (SELECT DISTINCT counterparty_account AS c FROM silver WHERE account_id IN {_own})
    SELECT 1 AS step, pattern_type AS key, count(*)::VARCHAR AS value FROM flags WHERE account_id IN {_own} GROUP BY 2
    UNION ALL SELECT 2, c, 'CONNECTED' FROM p
    UNION ALL SELECT 3, flag_id, pattern_type FROM flags WHERE account_id IN (SELECT c FROM p)
    UNION ALL SELECT 4, entry_id, list_name FROM wl WHERE entity_id IN (SELECT customer_id FROM acc WHERE account_id IN {_own})
    UNION ALL SELECT 5, txn_id, printf('%.4f', final_risk_score) FROM scores WHERE account_id IN {_own}""")
register("inv_timeline", lambda t: inv.inv_timeline(t.silver, t.flags),
         """SELECT "timestamp", txn_type, amount, counterparty_account, country,
         CASE WHEN flag_id IS NOT NULL THEN concat(pattern_type, ' (', severity, ')') ELSE 'CLEAN' END AS status
         FROM silver s LEFT JOIN flags f ON s.txn_id = f.txn_id""")
register("inv_similar_accounts", lambda t: inv.inv_similar_accounts(t.flags, seed(t)),
         f"""WITH own AS (SELECT account_id AS seed, arg_min(pattern_type, (-ml_score, flag_id)) AS pattern_type FROM flags
            WHERE account_id IN {_own} GROUP BY 1),
         alike AS (SELECT seed, account_id, pattern_type, ml_score, severity, count(*) AS flag_count
            FROM flags JOIN own USING (pattern_type) WHERE account_id NOT IN {_own} GROUP BY ALL)
         SELECT * FROM alike QUALIFY row_number() OVER (PARTITION BY seed ORDER BY ml_score DESC, account_id, severity) <= 10""")
register("inv_cross_border", lambda t: inv.inv_cross_border(t.silver),
         """SELECT account_id, country, count(*) AS txn_count, sum(amount) AS total_amount FROM silver
         WHERE country <> 'IN' GROUP BY 1, 2""", total_amount=2)
register("inv_trend", lambda t: inv.inv_trend(t.silver),
         "SELECT txn_date, count(*) AS row_count FROM silver GROUP BY 1", texts=("txn_date",))
register("inv_trend_pattern", lambda t: inv.inv_trend(t.flags, "pattern_type"),
         "SELECT pattern_type, count(*) AS row_count FROM flags GROUP BY 1")

SIGNALS = """
    WITH mv AS (SELECT account_id, count(*) AS txn_count, sum(amount) AS total_amount, min("timestamp") AS first_txn,
        max("timestamp") AS last_txn FROM silver GROUP BY 1),
    fl AS (SELECT account_id, count(*) AS flag_count, count(*) FILTER (WHERE analyst_decision = 'PENDING') AS pending_flags,
        max(ml_score) AS max_flag_score, CASE WHEN bool_or(severity = 'CRITICAL') THEN 'CRITICAL'
        WHEN bool_or(severity = 'HIGH') THEN 'HIGH' ELSE 'MEDIUM' END AS worst_severity FROM flags GROUP BY 1),
    sc AS (SELECT account_id, max(final_risk_score) AS max_score FROM scores GROUP BY 1),
    pr AS (SELECT a.account_id, count(DISTINCT case_id) AS prior_cases,
        count(DISTINCT CASE WHEN sar_filed = 'Y' THEN case_id END) AS prior_sars
        FROM acc a JOIN cases h ON h.account_id = a.account_id OR h.customer_id = a.customer_id GROUP BY 1)
    SELECT a.account_id, a.customer_id, coalesce(txn_count, 0) AS txn_count, total_amount, first_txn, last_txn,
        coalesce(flag_count, 0) AS flag_count, coalesce(pending_flags, 0) AS pending_flags, max_flag_score, max_score,
        name_hash, coalesce(watchlist_match, 'NONE') AS watchlist_match, coalesce(prior_cases, 0) AS prior_cases,
        coalesce(prior_sars, 0) AS prior_sars, worst_severity,
        CASE WHEN worst_severity = 'CRITICAL' AND (coalesce(watchlist_match, 'NONE') <> 'NONE' OR coalesce(prior_sars, 0) > 0)
            THEN 'FILE SAR' WHEN worst_severity = 'CRITICAL' THEN 'FREEZE'
            WHEN coalesce(flag_count, 0) > 0 THEN 'REVIEW' ELSE 'DISMISS' END AS action
    FROM acc a LEFT JOIN mv ON a.account_id = mv.account_id LEFT JOIN fl ON a.account_id = fl.account_id
    LEFT JOIN sc ON a.account_id = sc.account_id LEFT JOIN pr ON a.account_id = pr.account_id
    LEFT JOIN cust c ON a.customer_id = c.customer_id"""
_sources = lambda t: (t.accounts, t.silver, t.flags, t.scores, t.customers, t.cases)
register("inv_account_dossier", lambda t: inv.inv_account_dossier(*_sources(t)), SIGNALS, total_amount=2)
register("inv_recommend_action", lambda t: inv.inv_recommend_action(*_sources(t)),
         f"SELECT account_id, worst_severity, watchlist_match, prior_sars, flag_count, action FROM ({SIGNALS}) x")

register("inv_account_dossier_seeds", lambda t: inv.inv_account_dossier(*_sources(t), seeds=seeds(t)),
         f"SELECT * FROM ({SIGNALS}) x WHERE account_id IN {_seeds}", total_amount=2)
register("inv_recommend_action_seeds", lambda t: inv.inv_recommend_action(*_sources(t), seeds=seeds(t)),
         f"""SELECT account_id, worst_severity, watchlist_match, prior_sars, flag_count, action FROM ({SIGNALS}) x
         WHERE account_id IN {_seeds}""")

# ---- graph ---------------------------------------------------------------------------------------------

EDGES = {
    "owns": "SELECT customer_id AS src, account_id AS dst, 'OWNS' AS edge FROM acc",
    "has": "SELECT account_id AS src, txn_id AS dst, 'HAS' AS edge FROM silver",
    "sends_to": "SELECT txn_id AS src, counterparty_account AS dst, 'SENDS_TO' AS edge FROM silver",
    "triggers": "SELECT txn_id AS src, flag_id AS dst, 'TRIGGERS' AS edge FROM flags JOIN silver USING (txn_id)",
    "matches": "SELECT customer_id AS src, entry_id AS dst, 'MATCHES' AS edge FROM wl JOIN cust ON entity_id = customer_id",
}
register("graph_vertices", lambda t: graph.graph_vertices(t.accounts, t.customers, t.silver, t.flags, t.watchlists),
         """SELECT account_id AS id, 'Account' AS type FROM acc UNION ALL SELECT customer_id, 'Customer' FROM cust
         UNION ALL SELECT txn_id, 'Transaction' FROM silver UNION ALL SELECT flag_id, 'SuspiciousEvent' FROM flags
         UNION ALL SELECT entry_id, 'WatchlistEntry' FROM wl""")
register("edges_owns", lambda t: graph.edges_owns(t.accounts), EDGES["owns"])
register("edges_has", lambda t: graph.edges_has(t.silver), EDGES["has"])
register("edges_sends_to", lambda t: graph.edges_sends_to(t.silver), EDGES["sends_to"])
register("edges_triggers", lambda t: graph.edges_triggers(t.silver, t.flags), EDGES["triggers"])
register("edges_matches", lambda t: graph.edges_matches(t.customers, t.watchlists), EDGES["matches"])
register("graph_edges", lambda t: graph.graph_edges(t.accounts, t.customers, t.silver, t.flags, t.watchlists),
         " UNION ALL ".join(EDGES.values()))
register("graph_mule_hubs", lambda t: graph.graph_mule_hubs(t.silver),
         """SELECT account_id, distinct_senders, distinct_receivers, total_in, total_out FROM flow
         WHERE distinct_senders >= 3 AND distinct_receivers BETWEEN 1 AND 3""", total_in=2, total_out=2)
register("graph_pass_through", lambda t: graph.graph_pass_through(t.silver),
         """SELECT * FROM (SELECT account_id, txn_date, sum(amount) FILTER (WHERE txn_type = 'WIRE_IN') AS total_in,
            sum(amount) FILTER (WHERE txn_type IN ('WIRE_OUT', 'UPI_OUT')) AS total_out FROM silver GROUP BY 1, 2) x
         WHERE total_in >= 50000 AND total_out >= total_in * 0.9""", texts=("txn_date",), total_in=2, total_out=2)
register("graph_watchlist_reach", lambda t: graph.graph_watchlist_reach(t.silver, t.accounts, t.customers),
         """WITH watched AS (SELECT account_id FROM acc JOIN cust USING (customer_id) WHERE watchlist_match <> 'NONE')
         SELECT account_id, counterparty_account AS watched FROM silver
            WHERE counterparty_account IN (SELECT account_id FROM watched) AND account_id <> counterparty_account
         UNION SELECT counterparty_account, account_id FROM silver
            WHERE account_id IN (SELECT account_id FROM watched) AND account_id <> counterparty_account""")

# ---- alerts and cases ----------------------------------------------------------------------------------

register("alert_enrich", lambda t: alerts.alert_enrich(t.flags, t.cases, t.customers, t.scores),
         """SELECT flag_id, f.txn_id, f.account_id, f.customer_id, f.pattern_type, rule_id, severity, ml_score,
         coalesce(n, 0) AS prior_cases, coalesce(watchlist_match, 'NONE') AS watchlist_match, final_risk_score
         FROM flags f LEFT JOIN (SELECT account_id, count(*) AS n FROM cases GROUP BY 1) h ON f.account_id = h.account_id
         LEFT JOIN cust c ON f.customer_id = c.customer_id LEFT JOIN scores m ON f.txn_id = m.txn_id""")
register("alert_route", lambda t: alerts.alert_route(t.flags),
         """SELECT flag_id, txn_id, account_id, severity, ml_score, created_at,
         CASE severity WHEN 'CRITICAL' THEN 'IMMEDIATE' WHEN 'HIGH' THEN 'QUEUE_5_MIN' ELSE 'DAILY_REPORT' END AS channel
         FROM flags WHERE analyst_decision = 'PENDING'""")
register("case_open", lambda t: alerts.case_open(t.flags, t.cases, t.silver),
         """SELECT 'CASE-' || substr(md5(flag_id), 1, 10) AS case_id, f.account_id, f.customer_id, pattern_type,
         amount AS total_amount, 1 AS num_txns, NULL::INTEGER AS investigation_days, 'OPEN' AS outcome, 'N' AS sar_filed,
         NULL::DATE AS close_date FROM flags f LEFT JOIN silver s ON f.txn_id = s.txn_id WHERE severity = 'CRITICAL'
         AND f.account_id NOT IN (SELECT account_id FROM cases WHERE outcome = 'OPEN')""",
         doubles=("investigation_days",), texts=("close_date",))
register("case_open_by_account", lambda t: alerts.case_open_by_account(t.flags, t.cases, t.silver),
         """WITH crit AS (SELECT * FROM flags WHERE severity = 'CRITICAL'
            AND account_id NOT IN (SELECT account_id FROM cases WHERE outcome = 'OPEN')),
         best AS (SELECT account_id, customer_id, pattern_type FROM crit
            QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY ml_score DESC, flag_id) = 1),
         moved AS (SELECT account_id, sum(amount) AS total_amount, count(*)::INTEGER AS num_txns FROM silver
            WHERE txn_id IN (SELECT txn_id FROM crit) GROUP BY 1),
         prior AS (SELECT account_id, count(*) AS n FROM cases GROUP BY 1)
         SELECT 'CASE-' || substr(md5(account_id || '/' || coalesce(n, 0)::VARCHAR), 1, 10) AS case_id, account_id, customer_id,
         pattern_type, total_amount, num_txns, NULL::INTEGER AS investigation_days, 'OPEN' AS outcome, 'N' AS sar_filed,
         NULL::DATE AS close_date FROM best JOIN moved USING (account_id) LEFT JOIN prior USING (account_id)""",
         doubles=("investigation_days",), texts=("close_date",), total_amount=2)
register("label_feedback", lambda t: alerts.label_feedback(t.silver, t.flags),
         """WITH d AS (SELECT txn_id, max(CASE analyst_decision WHEN 'CONFIRMED' THEN 1 WHEN 'FALSE_POSITIVE' THEN 0 END)
            AS decision FROM flags GROUP BY 1)
         SELECT s.txn_id, pattern_label, coalesce(decision,
            CASE pattern_label WHEN 'CLEAN' THEN 0 WHEN 'PENDING' THEN NULL ELSE 1 END)::INTEGER AS is_fraud
         FROM silver s LEFT JOIN d ON s.txn_id = d.txn_id""", doubles=("is_fraud",))
