"""Plain SQL for the same tables and results, written independently of the Spark operators.

``CTES`` names the derived tables; ``with_tables(sql)`` puts the ones a query mentions in front of it.
"""

from __future__ import annotations

import re

from ..fixed import CIRCULAR_RULE, HIGH_RISK_COUNTRIES, MODEL_FEATURES, RULE_CATALOGUE
from ..sources.driver_tables import CHANNELS, COUNTRIES, MERCHANTS


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


HIGH_RISK = _in(HIGH_RISK_COUNTRIES)
RULE_COLUMNS = "rule_id, pattern_type, detection_layer, condition_summary, default_severity, rationale"

CTES = {
    "bronze": f"""
        WITH e AS (SELECT event_id AS i, user_id AS u, value AS v, epoch_us(ts) // 1000000 AS s FROM events),
        x AS (SELECT *, (s - 1704067200) // 259200 AS b, (s - 1704067200) % 86400 AS sod FROM e),
        d AS (SELECT * FROM x UNION ALL SELECT * FROM x WHERE i % 50 = 0)
        SELECT 'TXN-' || lpad(i::VARCHAR, 8, '0') AS txn_id,
            'ACC-' || lpad(u::VARCHAR, 6, '0') AS account_id,
            CASE WHEN i % 101 = 0 THEN NULL
                ELSE 'CUST-' || lpad((CASE WHEN u % 10 = 9 THEN u - 1 ELSE u END)::VARCHAR, 6, '0') END AS customer_id,
            'ACC-' || lpad((CASE WHEN u % 10 IN (6, 7) THEN (CASE WHEN u % 2 = 0 THEN u + 1 ELSE u - 1 END)
                ELSE u + 1 + i % 4 END)::VARCHAR, 6, '0') AS counterparty_account,
            CASE WHEN i % 97 = 0 THEN -v
                WHEN u % 10 IN (6, 7) THEN (900000 + (i % 7) * 50000)::DOUBLE
                WHEN u % 15 = 0 THEN (CASE WHEN i % 3 = 0 THEN 10000 + i % 500 ELSE 60000 + i % 700 END)::DOUBLE
                WHEN u % 11 = 4 THEN (8000 + (i * 13) % 2000)::DOUBLE
                WHEN i % 9 = 0 THEN round(v * 1000, 2)
                ELSE round(v * 100, 2) END AS amount,
            CASE WHEN i % 17 = 0 THEN NULL WHEN i % 3 = 0 THEN 'USD' ELSE 'INR' END AS currency,
            CASE WHEN u % 10 IN (6, 7) THEN (CASE WHEN i % 2 = 0 THEN 'WIRE_OUT' ELSE 'WIRE_IN' END)
                WHEN u % 15 = 0 THEN (CASE WHEN i % 3 = 0 THEN 'WIRE_IN' ELSE 'WIRE_OUT' END)
                WHEN u % 7 = 3 THEN 'CASH_DEP'
                WHEN i % 10 <= 1 THEN 'WIRE_OUT' WHEN i % 10 <= 3 THEN 'WIRE_IN' WHEN i % 10 <= 5 THEN 'CASH_DEP'
                WHEN i % 10 = 6 THEN 'UPI_OUT' WHEN i % 10 = 7 THEN 'PURCHASE' WHEN i % 10 = 8 THEN 'SALARY'
                ELSE 'EMI' END AS txn_type,
            {_list(CHANNELS)}[i % 4 + 1] AS channel,
            {_list(COUNTRIES)}[i % 25 + 1] AS country,
            {_list(MERCHANTS)}[i % 6 + 1] AS merchant_cat,
            CASE WHEN i % 103 = 0 THEN NULL ELSE make_timestamp((1704067200 + b * 3110400 +
                CASE WHEN u % 5 = 0 THEN 79200 + sod // 24 ELSE sod END) * 1000000) END AS "timestamp",
            CASE WHEN i % 10 = 3 THEN 'PENDING' WHEN u % 10 IN (6, 7) THEN 'CIRCULAR_FLOW'
                WHEN u % 15 = 0 THEN 'MULE_ACCOUNT' WHEN u % 11 = 4 THEN 'STRUCTURING'
                WHEN u % 7 = 3 THEN 'SMURFING' ELSE 'CLEAN' END AS pattern_label
        FROM d""",
    "invalid": """SELECT * FROM bronze WHERE NOT coalesce(amount > 0 AND account_id IS NOT NULL
        AND customer_id IS NOT NULL AND "timestamp" IS NOT NULL, FALSE)""",
    "silver": f"""
        SELECT txn_id, account_id, customer_id, counterparty_account, amount,
            coalesce(currency, 'INR') AS currency, txn_type, channel, country, merchant_cat, "timestamp", pattern_label,
            "timestamp" AS txn_timestamp, "timestamp"::DATE AS txn_date, hour("timestamp")::INTEGER AS txn_hour,
            (dayofweek("timestamp") + 1)::INTEGER AS txn_dayofweek,
            CASE WHEN dayofweek("timestamp") IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
            CASE WHEN hour("timestamp") >= 22 OR hour("timestamp") <= 5 THEN 1 ELSE 0 END AS is_night,
            CASE WHEN country IN {HIGH_RISK} THEN 1 ELSE 0 END AS country_risk,
            CASE WHEN amount BETWEEN 8000 AND 9999 THEN 'NEAR_THRESHOLD' WHEN amount > 100000 THEN 'VERY_LARGE'
                WHEN amount > 10000 THEN 'LARGE' ELSE 'NORMAL' END AS amount_bucket,
            CASE WHEN txn_type = 'CASH_DEP' THEN 1 ELSE 0 END AS is_cash
        FROM (SELECT DISTINCT * FROM bronze WHERE amount > 0 AND account_id IS NOT NULL
            AND customer_id IS NOT NULL AND "timestamp" IS NOT NULL)""",
    "acc": """
        SELECT 'ACC-' || lpad(k::VARCHAR, 6, '0') AS account_id,
            'CUST-' || lpad((CASE WHEN k % 10 = 9 THEN k - 1 ELSE k END)::VARCHAR, 6, '0') AS customer_id,
            CASE k % 3 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'CURRENT' ELSE 'NRE' END AS acct_type,
            DATE '2015-01-01' + ((k * 13) % 3000)::INTEGER AS open_date,
            ((k * 37) % 400)::INTEGER AS days_inactive, ((k * 7) % 60)::INTEGER AS txn_count_30d,
            CASE WHEN k % 50 = 0 THEN NULL ELSE (1000 + (k * 91) % 9000)::DOUBLE END AS avg_txn_amount,
            (k % 5)::INTEGER AS countries_30d, (k % 100)::DOUBLE / 100 AS cash_ratio,
            ((k * 17) % 100)::DOUBLE / 100 AS risk_score,
            CASE WHEN (k * 17) % 100 < 40 THEN 'LOW' WHEN (k * 17) % 100 < 75 THEN 'HIGH' ELSE 'VERY_HIGH' END AS risk_tier
        FROM (SELECT c_custkey AS k FROM customer)""",
    "cust": f"""
        SELECT 'CUST-' || lpad(k::VARCHAR, 6, '0') AS customer_id, md5(c_name) AS name_hash,
            {_list(COUNTRIES)}[c_nationkey % 25 + 1] AS country, c_mktsegment AS occupation,
            CASE WHEN k % 9 = 4 THEN 'Y' ELSE 'N' END AS pep_flag,
            CASE k % 3 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'PENDING' ELSE 'EXPIRED' END AS kyc_status,
            CASE k % 3 WHEN 0 THEN 'LOW' WHEN 1 THEN 'HIGH' ELSE 'VERY_HIGH' END AS risk_tier,
            CASE k % 20 WHEN 0 THEN 'INTERPOL' WHEN 1 THEN 'PEP_LIST' ELSE 'NONE' END AS watchlist_match,
            CASE k % 4 WHEN 0 THEN 'SALARY' WHEN 1 THEN 'BUSINESS' WHEN 2 THEN 'INVESTMENT' ELSE 'INHERITANCE' END
                AS source_of_funds
        FROM (SELECT *, c_custkey AS k FROM customer) WHERE k % 10 <> 9""",
    "wl": """
        WITH k AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 20 IN (0, 1)),
        e AS (SELECT k, 'WL-' AS p, 'CUST-' AS o, 'INDIVIDUAL' AS t FROM k
            UNION ALL SELECT k, 'WLX-', 'EXT-', 'ENTITY' FROM k WHERE k % 200 = 0)
        SELECT p || lpad(k::VARCHAR, 6, '0') AS entry_id, o || lpad(k::VARCHAR, 6, '0') AS entity_id, t AS entity_type,
            CASE WHEN k % 20 = 0 THEN 'INTERPOL_RED' ELSE 'PEP_LIST' END AS list_name,
            CASE WHEN k % 20 = 0 THEN 'INTERPOL' ELSE 'FIU' END AS source,
            CASE WHEN k % 20 = 0 THEN 'CRITICAL' ELSE 'HIGH' END AS risk_level,
            DATE '2020-01-01' + (k % 1000)::INTEGER AS added_date,
            CASE WHEN k % 2 = 0 THEN 'EXACT' ELSE 'FUZZY' END AS match_type
        FROM e""",
    "cases": f"""
        SELECT 'CASE-' || lpad(o::VARCHAR, 8, '0') AS case_id, 'ACC-' || lpad(k::VARCHAR, 6, '0') AS account_id,
            'CUST-' || lpad((CASE WHEN k % 10 = 9 THEN k - 1 ELSE k END)::VARCHAR, 6, '0') AS customer_id,
            {_list([r[1] for r in RULE_CATALOGUE] + [CIRCULAR_RULE[1]])}[o % 11 + 1] AS pattern_type,
            o_totalprice AS total_amount, (1 + o % 20)::INTEGER AS num_txns, (1 + o % 60)::INTEGER AS investigation_days,
            CASE o % 3 WHEN 0 THEN 'CONFIRMED' WHEN 1 THEN 'FALSE_POSITIVE' ELSE 'OPEN' END AS outcome,
            CASE WHEN o % 2 = 0 THEN 'Y' ELSE 'N' END AS sar_filed, o_orderdate::DATE AS close_date
        FROM (SELECT *, o_orderkey AS o, o_custkey AS k FROM orders)""",
    "rules": f"SELECT * FROM (VALUES {_values(RULE_CATALOGUE + [CIRCULAR_RULE])}) v({RULE_COLUMNS})",
    "flags": """
        WITH s AS (SELECT *, substr(txn_id, 5)::BIGINT AS id,
            CASE WHEN amount <= 9999 THEN 'RULE-001' WHEN amount > 200000 THEN 'RULE-011' ELSE 'RULE-004' END AS rule_id
            FROM silver WHERE amount BETWEEN 8000 AND 9999 OR amount > 50000),
        d AS (SELECT * FROM s UNION ALL SELECT * REPLACE ('RULE-010' AS rule_id) FROM s WHERE id % 7 = 0),
        p AS (SELECT *, (75 + id % 25)::DOUBLE / 100 AS ml_score FROM d)
        SELECT 'FLAG-' || substr(md5(rule_id || txn_id), 1, 10) AS flag_id, txn_id, account_id, customer_id,
            CASE rule_id WHEN 'RULE-001' THEN 'STRUCTURING' WHEN 'RULE-004' THEN 'DORMANT_SPIKE'
                WHEN 'RULE-011' THEN 'CIRCULAR_FLOW' ELSE 'UNKNOWN_SUSPICIOUS' END AS pattern_type,
            rule_id, ml_score, CASE WHEN rule_id = 'RULE-010' THEN 'ML_NOTEBOOK' ELSE 'KQL_RULE' END AS detection_source,
            CASE WHEN ml_score > 0.95 THEN 'CRITICAL' WHEN ml_score > 0.85 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
            CASE id % 3 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'CONFIRMED' ELSE 'FALSE_POSITIVE' END AS analyst_decision,
            "timestamp" + INTERVAL 60 SECOND AS created_at, 'raised by ' || rule_id AS notes
        FROM p""",
    "scores": """
        WITH p AS (SELECT *, substr(txn_id, 5)::BIGINT AS id FROM silver),
        b AS (SELECT *, ((id * 31) % 1000)::DOUBLE / 1000 AS anomaly_score,
            ((id * 17) % 1000)::DOUBLE / 1000 AS fraud_probability FROM p),
        z AS (SELECT *, round(anomaly_score * 0.4::DOUBLE + fraud_probability * 0.6::DOUBLE, 4) AS final_risk_score FROM b)
        SELECT txn_id, account_id, customer_id, amount, anomaly_score, fraud_probability, final_risk_score,
            CASE WHEN final_risk_score > 0.75 THEN 'UNKNOWN_SUSPICIOUS' ELSE 'CLEAN' END AS fraud_type,
            CASE pattern_label WHEN 'CLEAN' THEN 0 WHEN 'PENDING' THEN NULL ELSE 1 END::INTEGER AS is_fraud,
            "timestamp" + INTERVAL 300 SECOND AS scored_at
        FROM z""",
    "inflow": """SELECT account_id, sum(amount) AS total_in, max(txn_timestamp) AS last_in,
        count(DISTINCT counterparty_account) AS distinct_senders FROM silver WHERE txn_type = 'WIRE_IN' GROUP BY 1""",
    "outflow": """SELECT account_id, sum(amount) AS total_out, min(txn_timestamp) AS first_out_after,
        count(DISTINCT counterparty_account) AS distinct_receivers
        FROM silver WHERE txn_type IN ('WIRE_OUT', 'UPI_OUT') GROUP BY 1""",
    "flowj": """SELECT account_id, coalesce(total_in, 0) AS total_in, last_in, coalesce(distinct_senders, 0) AS distinct_senders,
        coalesce(total_out, 0) AS total_out, first_out_after, coalesce(distinct_receivers, 0) AS distinct_receivers
        FROM inflow FULL JOIN outflow USING (account_id)""",
    "flow": """SELECT *, CASE WHEN total_in > 0 THEN total_out / total_in ELSE 0.0 END AS pass_through_ratio,
        (epoch_us(first_out_after) // 1000000 - epoch_us(last_in) // 1000000)::DOUBLE / 60 AS in_out_gap_min FROM flowj""",
    "win": """
        SELECT *, count(txn_id) OVER (PARTITION BY account_id, txn_date ORDER BY txn_timestamp, txn_id
                ROWS UNBOUNDED PRECEDING) AS txn_count_same_day,
            count(txn_id) OVER (w RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS txn_count_7d,
            count(txn_id) OVER (w RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS txn_count_1h,
            sum(amount) OVER (w RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS amount_sum_1h,
            (sum(is_cash) OVER (w RANGE BETWEEN 172800 PRECEDING AND CURRENT ROW))::BIGINT AS cash_dep_count_48h,
            sum(CASE WHEN is_cash = 1 THEN amount ELSE 0.0::DOUBLE END)
                OVER (w RANGE BETWEEN 172800 PRECEDING AND CURRENT ROW) AS cash_sum_48h
        FROM (SELECT *, epoch_us(txn_timestamp) // 1000000 AS sec FROM silver)
        WINDOW w AS (PARTITION BY account_id ORDER BY sec)""",
    "gold": """
        SELECT w.* EXCLUDE (sec), CASE WHEN w.amount BETWEEN 8000 AND 9999 THEN 1 ELSE 0 END AS near_threshold_flag,
            a.avg_txn_amount, a.days_inactive, a.cash_ratio, a.risk_score AS acct_risk_score,
            w.amount / (coalesce(a.avg_txn_amount, 0) + 0.01::DOUBLE) AS amount_vs_avg,
            CASE WHEN a.days_inactive > 180 THEN 1 ELSE 0 END AS dormant_flag,
            c.pep_flag, c.watchlist_match, c.risk_tier AS cust_risk_tier,
            CASE WHEN c.pep_flag = 'Y' THEN 1 ELSE 0 END AS pep_numeric,
            CASE WHEN coalesce(c.watchlist_match, 'NONE') <> 'NONE' THEN 1 ELSE 0 END AS watchlist_hit,
            coalesce(f.pass_through_ratio, 0.0) AS pass_through_ratio, f.in_out_gap_min,
            coalesce(f.distinct_senders, 0) AS distinct_senders, coalesce(f.distinct_receivers, 0) AS distinct_receivers,
            CASE WHEN coalesce(f.pass_through_ratio, 0.0) > 0.9 AND coalesce(f.in_out_gap_min, 99999) <= 120
                THEN 1 ELSE 0 END AS rapid_pass_through,
            CASE pattern_label WHEN 'CLEAN' THEN 0 WHEN 'PENDING' THEN NULL ELSE 1 END::INTEGER AS is_fraud
        FROM win w LEFT JOIN acc a USING (account_id) LEFT JOIN cust c ON w.customer_id = c.customer_id
        LEFT JOIN flow f ON w.account_id = f.account_id""",
    "matrix": "SELECT txn_id, " + ", ".join(f"coalesce({n}, 0)::DOUBLE AS {n}" for n in MODEL_FEATURES) + " FROM gold",
    "seed": """SELECT account_id FROM flags WHERE severity = 'CRITICAL' GROUP BY 1
        ORDER BY count(*) DESC, account_id LIMIT 1""",
    "scored": """SELECT g.*, s.anomaly_score, s.fraud_probability, s.final_risk_score
        FROM gold g JOIN scores s USING (txn_id)""",
}

def with_tables(sql: str, rounding: dict[str, int] | None = None, doubles: tuple[str, ...] = (),
                texts: tuple[str, ...] = ()) -> str:
    """Prefix the derived tables the query needs; round, widen or print the columns named."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"(?:FROM|JOIN)\s+(\w+)", text, re.I)):
            if name in CTES and name not in needed:
                need(CTES[name])
                if name not in needed:
                    needed.append(name)

    need(sql)
    changes = [f"round({c}, {d}) AS {c}" for c, d in (rounding or {}).items()]
    changes += [f"{c}::DOUBLE AS {c}" for c in doubles]
    changes += [f"{c}::VARCHAR AS {c}" for c in texts]
    columns = f"* REPLACE ({', '.join(changes)})" if changes else "*"
    tables = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    return (f"WITH {tables}\n" if tables else "") + f"SELECT {columns} FROM ({sql}) q"
