"""Sources, gates, cleaning, features, rules."""

from pyspark.sql import functions as F

from ..operators import circular, cleaning, features, flow, layering, metrics, quality, rules, windows
from ..schemas import DIMENSIONS, TABLES, TXN_COLUMNS
from ..session import scratch_path
from ..sources import driver_tables as given, files, tables as io
from ..streaming.store import BatchStore
from .registry import register

AT = "2025-01-01 00:00:00"
TXN = ", ".join(f'"{c}"' for c in TXN_COLUMNS)

# ---- sources and sinks ---------------------------------------------------------------------------------

register("scan_table", lambda t: t.read("events").withColumn("ts", F.col("ts").cast("timestamp")), "SELECT * FROM events")


def _as_csv(t, df, name):
    path = scratch_path(t.spark, name)
    df.write.option("header", True).option("timestampFormat", files.CSV_TIMESTAMP).csv(path)
    return path


register("read_csv_typed", lambda t: files.read_csv_typed(
    t.spark, _as_csv(t, t.bronze, "csv"), TABLES["transactions"]), f"SELECT {TXN} FROM bronze")


def _csv_strings(t):
    raw = files.read_csv_strings(t.spark, _as_csv(t, t.bronze, "csv"))
    # the engines print doubles differently: compare amounts as text with two digits
    return raw.withColumn("amount", F.format_string("%.2f", F.col("amount").cast("double")))


register("read_csv_strings", _csv_strings, """
    SELECT * REPLACE (printf('%.2f', amount) AS amount, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp")
    FROM bronze""")


def _written(t):
    path = scratch_path(t.spark, "written")
    io.write_table(t.silver, path, partition_by="txn_date")
    io.write_table(t.silver, path, mode="append", partition_by="txn_date")
    return t.spark.read.schema(t.silver.schema).parquet(path)


register("write_table", _written, "SELECT * FROM silver UNION ALL SELECT * FROM silver",
         texts=("txn_date",))


def _evolving(t):
    path = scratch_path(t.spark, "evolving")
    io.write_evolving(t.flags.drop("notes"), path)
    io.write_evolving(t.flags, path)
    return io.read_evolving(t.spark, path)


register("write_evolving", _evolving, "SELECT * FROM flags UNION ALL SELECT * REPLACE (NULL::VARCHAR AS notes) FROM flags")
register("append_common_columns", lambda t: io.append_common_columns(
    t.bronze.drop("merchant_cat"), t.bronze.drop("channel").withColumn("amount", F.col("amount").cast("string"))),
    """SELECT * EXCLUDE (merchant_cat) FROM bronze
    UNION ALL SELECT * EXCLUDE (merchant_cat) REPLACE (NULL::VARCHAR AS channel) FROM bronze""")
register("append_union", lambda t: io.append_union(t.scores, t.scores), "SELECT * FROM scores UNION ALL SELECT * FROM scores",
         doubles=("is_fraud",))
register("append_rule_row", lambda t: io.append_rule_row(io.append_rule_row(
    t.rules.join(t.flags.select("rule_id").distinct().filter("rule_id <> 'RULE-011'"), "rule_id", "left_semi"))),
    "SELECT * FROM rules WHERE rule_id IN (SELECT rule_id FROM flags) OR rule_id = 'RULE-011'")
register("append_if_new", lambda t: io.append_if_new(t.flags, t.silver.select("txn_id", "amount"), "txn_id"),
         "SELECT txn_id, amount FROM silver WHERE txn_id NOT IN (SELECT txn_id FROM flags)")


def _reload(t):
    raw = scratch_path(t.spark, "raw")
    for name, df in zip(DIMENSIONS, (t.accounts, t.customers, t.watchlists, t.cases, t.rules)):
        df.write.option("header", True).csv(f"{raw}/{name}")
    return io.table_counts(io.reload_dimensions(t.spark, raw, scratch_path(t.spark, "dims")))


register("reload_dimensions", _reload, """
    SELECT 'accounts' AS table_name, count(*) AS row_count FROM acc UNION ALL SELECT 'customers', count(*) FROM cust
    UNION ALL SELECT 'watchlists', count(*) FROM wl UNION ALL SELECT 'historical_cases', count(*) FROM cases
    UNION ALL SELECT 'detection_rules', count(*) FROM rules""")
register("empty_table", lambda t: io.append_union(io.empty_table(t.spark, TABLES["suspicious_flags"]), t.flags),
         "SELECT * FROM flags")
register("drop_column", lambda t: io.drop_column(t.bronze, "merchant_cat", "channel"),
         "SELECT * EXCLUDE (merchant_cat, channel) FROM bronze")
register("table_counts", lambda t: io.table_counts({
    "transactions": t.bronze, "accounts": t.accounts, "customers": t.customers, "watchlists": t.watchlists,
    "historical_cases": t.cases, "detection_rules": t.rules, "suspicious_flags": t.flags, "ml_risk_scores": t.scores,
}), """SELECT 'transactions' AS table_name, count(*) AS row_count FROM bronze
    UNION ALL SELECT 'accounts', count(*) FROM acc UNION ALL SELECT 'customers', count(*) FROM cust
    UNION ALL SELECT 'watchlists', count(*) FROM wl UNION ALL SELECT 'historical_cases', count(*) FROM cases
    UNION ALL SELECT 'detection_rules', count(*) FROM rules UNION ALL SELECT 'suspicious_flags', count(*) FROM flags
    UNION ALL SELECT 'ml_risk_scores', count(*) FROM scores""")
register("take_rows", lambda t: io.take_rows(t.silver, 100, "txn_id").drop("txn_date"),
         "SELECT * EXCLUDE (txn_date) FROM silver ORDER BY txn_id LIMIT 100")

# ---- gates and cleaning --------------------------------------------------------------------------------

GATES = {
    "min_rows": "SELECT 'min_rows' AS gate, count(*) AS value, count(*) >= 1000 AS passed FROM bronze",
    "null_keys": """SELECT 'null_keys' AS gate, count(*) AS value, count(*) = 0 AS passed
        FROM bronze WHERE txn_id IS NULL OR amount IS NULL""",
    "duplicate_keys": """SELECT 'duplicate_keys' AS gate, count(*) AS value, count(*) = 0 AS passed
        FROM (SELECT txn_id FROM bronze GROUP BY 1 HAVING count(*) > 1) x""",
    "orphans": """SELECT 'orphans' AS gate, count(*) AS value, TRUE AS passed
        FROM bronze WHERE account_id NOT IN (SELECT account_id FROM acc)""",
}
register("dq_min_rows", lambda t: quality.dq_min_rows(t.bronze), GATES["min_rows"])
register("dq_null_keys", lambda t: quality.dq_null_keys(t.bronze), GATES["null_keys"])
register("dq_duplicate_keys", lambda t: quality.dq_duplicate_keys(t.bronze), GATES["duplicate_keys"])
register("dq_orphans", lambda t: quality.dq_orphans(t.bronze, t.accounts), GATES["orphans"])
register("dq_report", lambda t: quality.dq_report(t.bronze, t.accounts), " UNION ALL ".join(GATES.values()))


def _loaded(t):
    """Bronze as delivered and silver, each loaded through the gates: the reports, and how many rows a reader sees after."""
    schema, out = "loaded string, gate string, value long, passed boolean, published long", []
    for name, rows in (("bronze", t.bronze), ("silver", t.silver)):
        store = BatchStore(t.spark, scratch_path(t.spark, f"{name}-checked"), rows.schema)
        try:
            report = quality.load_checked(rows, t.accounts, store, 0)
        except quality.GateFailed as failed:
            report = failed.report
        seen = store.read().count()
        out += [(name, *gate, seen) for gate in report]
    return t.spark.createDataFrame(out, schema)


def _loading(name: str) -> str:
    gates = " UNION ALL ".join(GATES.values()).replace("FROM bronze", f"FROM {name}")
    return f"""SELECT '{name}' AS loaded, g.*, CASE WHEN (SELECT bool_and(passed) FROM ({gates}) p)
        THEN (SELECT count(*) FROM {name}) ELSE 0 END AS published FROM ({gates}) g"""


register("load_checked", _loaded, _loading("bronze") + " UNION ALL " + _loading("silver"))
register("quarantine_transactions", lambda t: cleaning.quarantine_transactions(t.bronze, AT),
         f"SELECT *, TIMESTAMP '{AT}' AS quarantined_at FROM invalid")
register("dedupe_transactions", lambda t: cleaning.dedupe_transactions(t.bronze), "SELECT DISTINCT * FROM bronze")
register("cast_bronze", lambda t: cleaning.cast_bronze(t.bronze.withColumns({
    "amount": F.when(F.col("amount") > 0, F.col("amount").cast("string")).otherwise("bad"),
    "timestamp": F.date_format("timestamp", files.CSV_TIMESTAMP)})),
    "SELECT * REPLACE (CASE WHEN amount > 0 THEN amount END AS amount) FROM bronze")
register("silver_transactions", lambda t: cleaning.silver_transactions(t.bronze), "SELECT * FROM silver",
         texts=("txn_date",))
register("label_distribution", lambda t: cleaning.label_distribution(t.bronze),
         "SELECT pattern_label, count(*) AS txn_count FROM bronze GROUP BY 1")
register("retention_prune", lambda t: cleaning.retention_prune(t.silver).drop("txn_date"),
         """SELECT * EXCLUDE (txn_date) FROM silver
         WHERE "timestamp" > (SELECT max("timestamp") FROM silver) - INTERVAL 90 DAY""")

# ---- filters, sorts, sets ------------------------------------------------------------------------------

register("project_rename", lambda t: t.silver.select(
    "account_id", F.col("amount").alias("amount_in"), F.col("timestamp").alias("t_in"),
    F.col("counterparty_account").alias("sender")),
    'SELECT account_id, amount AS amount_in, "timestamp" AS t_in, counterparty_account AS sender FROM silver')
register("extend_columns", lambda t: t.silver.select(
    "txn_id", F.concat_ws("|", "account_id", "txn_type", F.format_string("%.2f", "amount")).alias("summary"),
    (F.col("amount") > 10000).alias("is_large")),
    """SELECT txn_id, account_id || '|' || txn_type || '|' || printf('%.2f', amount) AS summary, amount > 10000 AS is_large
    FROM silver""")
register("having", lambda t: t.silver.groupBy("account_id").agg(
    F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount")).filter("txn_count > 60"),
    "SELECT account_id, count(*) AS txn_count, sum(amount) AS total_amount FROM silver GROUP BY 1 HAVING count(*) > 60",
    total_amount=2)
register("sort_multi", lambda t: t.flags.select("severity", "ml_score", "flag_id").orderBy(
    "severity", F.desc("ml_score"), "flag_id"), "SELECT severity, ml_score, flag_id FROM flags")
register("top_n", lambda t: t.silver.select("txn_id", "account_id", "amount").orderBy(F.desc("amount"), "txn_id").limit(20),
         "SELECT txn_id, account_id, amount FROM silver ORDER BY amount DESC, txn_id LIMIT 20")
register("distinct_values", lambda t: t.bronze.select("pattern_label").distinct(), "SELECT DISTINCT pattern_label FROM bronze")
register("union_distinct", lambda t: t.silver.select(F.col("account_id").alias("related")).union(
    t.silver.select("counterparty_account")).distinct(),
    "SELECT account_id AS related FROM silver UNION SELECT counterparty_account FROM silver")

# ---- flow, windows, gold -------------------------------------------------------------------------------

register("flow_inflow", lambda t: flow.flow_inflow(t.silver), "SELECT * FROM inflow", total_in=2)
register("flow_outflow", lambda t: flow.flow_outflow(t.silver), "SELECT * FROM outflow", total_out=2)
register("flow_join", lambda t: flow.flow_join(t.silver),
         "SELECT * FROM flowj", total_in=2, total_out=2)
FLOW_ROUND = {"pass_through_ratio": 6, "in_out_gap_min": 4}
register("flow_features", lambda t: flow.flow_features(t.silver), "SELECT * FROM flow",
         total_in=2, total_out=2, **FLOW_ROUND)
register("approx_senders", lambda t: flow.approx_senders(t.silver))


def _sketched(t):
    """Stored day sketches merged over all days, against the exact count: within three standard errors of 1.7 % each."""
    stored = t.stored("sender-sketches", flow.sender_sketches(t.silver), "txn_date")
    exact = flow.flow_inflow(t.silver).select("account_id", "distinct_senders")
    off = F.abs(F.col("senders") - F.col("distinct_senders"))
    return flow.merge_senders(stored).join(exact, "account_id").select(
        "account_id", "distinct_senders", (off <= 0.5 + 3 * 0.017 * F.col("distinct_senders")).alias("within"))


register("sender_sketches", _sketched, """SELECT account_id, count(DISTINCT counterparty_account) AS distinct_senders, TRUE AS within
    FROM silver WHERE txn_type = 'WIRE_IN' GROUP BY account_id""")

register("binned_group_by", lambda t: t.silver.groupBy("account_id", F.window("timestamp", "2 days").alias("w")).agg(
    F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")).select(
    "account_id", F.col("w.start").alias("bin_start"), "n", "total"),
    """SELECT account_id, make_timestamp(epoch_us("timestamp") // 172800000000 * 172800000000) AS bin_start,
    count(*) AS n, sum(amount) AS total FROM silver GROUP BY 1, 2""", total=2)
register("ingestion_per_hour", lambda t: metrics.ingestion_per_hour(t.scores, "scored_at"),
    "SELECT date_trunc('hour', scored_at) AS ingest_hour, count(*) AS ingestion_count FROM scores GROUP BY 1")
register("conditional_counts", lambda t: t.silver.groupBy("account_id").agg(
    F.count_if(F.col("amount") > 10000).alias("large"), F.min("amount").alias("lowest"), F.max("amount").alias("highest"),
    F.avg("amount").alias("average")),
    """SELECT account_id, count(*) FILTER (WHERE amount > 10000) AS large, min(amount) AS lowest, max(amount) AS highest,
    avg(amount) AS average FROM silver GROUP BY 1""", average=5)

for _name in windows.FEATURES:
    register(f"win_{_name}", lambda t, f=getattr(windows, f"win_{_name}"): f(t.silver),
             f"SELECT txn_id, account_id, txn_timestamp, {_name} FROM win", **({_name: 2} if "sum" in _name else {}))
register("window_features", lambda t: windows.window_features(t.silver), "SELECT * EXCLUDE (sec) FROM win",
         texts=("txn_date",), amount_sum_1h=2, cash_sum_48h=2)

register("enrich_accounts", lambda t: features.enrich_accounts(t.silver, t.accounts),
         """SELECT s.*, avg_txn_amount, days_inactive, cash_ratio, risk_score AS acct_risk_score
         FROM silver s LEFT JOIN acc a ON s.account_id = a.account_id""", texts=("txn_date",))
register("enrich_customers", lambda t: features.enrich_customers(t.silver, t.customers),
         """SELECT s.*, pep_flag, watchlist_match, risk_tier AS cust_risk_tier
         FROM silver s LEFT JOIN cust c ON s.customer_id = c.customer_id""", texts=("txn_date",))
register("enrich_flow", lambda t: features.enrich_flow(t.silver, flow.flow_features(t.silver)),
         """SELECT s.*, coalesce(pass_through_ratio, 0.0) AS pass_through_ratio, in_out_gap_min,
         coalesce(distinct_senders, 0) AS distinct_senders, coalesce(distinct_receivers, 0) AS distinct_receivers
         FROM silver s LEFT JOIN flow f ON s.account_id = f.account_id""", texts=("txn_date",), **FLOW_ROUND)

register("feat_near_threshold", lambda t: features.feat_near_threshold(t.silver).select("txn_id", "near_threshold_flag"),
         "SELECT txn_id, near_threshold_flag FROM gold")
register("feat_amount_vs_avg", lambda t: features.feat_amount_vs_avg(features.enrich_accounts(t.silver, t.accounts)).select(
    "txn_id", "amount_vs_avg"), "SELECT txn_id, amount_vs_avg FROM gold", amount_vs_avg=6)
register("feat_dormant", lambda t: features.feat_dormant(features.enrich_accounts(t.silver, t.accounts)).select(
    "txn_id", "dormant_flag"), "SELECT txn_id, dormant_flag FROM gold")
register("feat_pep", lambda t: features.feat_pep(features.enrich_customers(t.silver, t.customers)).select(
    "txn_id", "pep_numeric"), "SELECT txn_id, pep_numeric FROM gold")
register("feat_watchlist", lambda t: features.feat_watchlist(features.enrich_customers(t.silver, t.customers)).select(
    "txn_id", "watchlist_hit"), "SELECT txn_id, watchlist_hit FROM gold")
register("feat_rapid_pass_through", lambda t: features.feat_rapid_pass_through(
    features.enrich_flow(t.silver, flow.flow_features(t.silver))).select("txn_id", "rapid_pass_through"),
    "SELECT txn_id, rapid_pass_through FROM gold")
register("feat_label", lambda t: features.feat_label(t.silver).select("txn_id", "is_fraud"), "SELECT txn_id, is_fraud FROM gold",
         doubles=("is_fraud",))
GOLD_ROUND = {"amount_sum_1h": 2, "cash_sum_48h": 2, "amount_vs_avg": 6, **FLOW_ROUND}
register("gold_features", lambda t: features.gold_features(t.silver, t.accounts, t.customers), "SELECT * FROM gold",
         doubles=("is_fraud",), texts=("txn_date",), **GOLD_ROUND)

# ---- rules ---------------------------------------------------------------------------------------------

_since = """ AND "timestamp" > (SELECT max("timestamp") FROM silver) - INTERVAL 24 HOUR"""


def _structuring(w=""):
    return f"""SELECT account_id, customer_id, count(*) AS txn_count, sum(amount) AS total_amount,
        'STRUCTURING' AS pattern_type, 'RULE-001' AS rule_id, 'HIGH' AS severity,
        printf('STRUCTURING: %s made %d sub-threshold txns totaling %.2f', account_id, count(*), sum(amount)) AS alert_msg,
        min("timestamp") AS first_txn, max("timestamp") AS last_txn
        FROM silver WHERE amount BETWEEN 8000 AND 9999{w}
        GROUP BY account_id, customer_id, "timestamp"::DATE HAVING count(*) >= 3"""


def _layering(w="", weight="amount_in"):
    total = "sum(amount_in)"
    return f"""
        WITH i AS (SELECT txn_id, account_id, amount AS amount_in, "timestamp" AS t_in, counterparty_account AS sender
            FROM silver WHERE txn_type = 'WIRE_IN'{w}),
        o AS (SELECT account_id, amount AS amount_out, "timestamp" AS t_out
            FROM silver WHERE txn_type IN ('WIRE_OUT', 'UPI_OUT'){w}),
        p AS (SELECT *, epoch_us(t_out) // 60000000 - epoch_us(t_in) // 60000000 AS gap FROM i JOIN o USING (account_id)
            WHERE t_out > t_in AND epoch_us(t_out) // 60000000 - epoch_us(t_in) // 60000000 <= 120),
        g AS (SELECT account_id, {total} AS total_in, max(amount_out) AS total_out, count(DISTINCT sender) AS senders,
            min(gap) AS min_gap_min FROM p GROUP BY 1)
        SELECT account_id, total_in, total_out, round(total_out * 100.0 / total_in, 1) AS pass_through_pct, senders,
            min_gap_min, CASE WHEN senders >= 2 THEN 'MULE_ACCOUNT' ELSE 'LAYERING' END AS pattern_type,
            CASE WHEN senders >= 2 THEN 'RULE-003' ELSE 'RULE-002' END AS rule_id, 'CRITICAL' AS severity,
            printf('%s: %s pass-through %.1f%%', CASE WHEN senders >= 2 THEN 'MULE' ELSE 'LAYERING' END, account_id,
                round(total_out * 100.0 / total_in, 1)) AS alert_msg
        FROM g WHERE total_out / total_in > 0.90"""


def _dormant(w="", extra=""):
    return f"""SELECT {extra}s.account_id, s.customer_id, amount, days_inactive, 'DORMANT_SPIKE' AS pattern_type,
        'RULE-004' AS rule_id, 'HIGH' AS severity,
        printf('DORMANT SPIKE: %s inactive %d days, moved %.2f', s.account_id, days_inactive, amount) AS alert_msg,
        "timestamp" FROM silver s JOIN acc a ON s.account_id = a.account_id
        WHERE amount > 50000 AND days_inactive > 180{w}"""


def _cash(w="", extra=""):
    return f"""SELECT {extra}account_id, customer_id, amount, txn_hour AS hour, 'CASH_INTENSIVE' AS pattern_type,
        'RULE-005' AS rule_id, 'HIGH' AS severity,
        printf('CASH NIGHT: %s deposited %.2f at hour %d', account_id, amount, txn_hour) AS alert_msg, "timestamp"
        FROM silver WHERE txn_type = 'CASH_DEP' AND amount > 25000 AND is_night = 1{w}"""


def _velocity(w=""):
    return f"""SELECT account_id, count(*) AS txn_count_1h, sum(amount) AS amount_sum_1h, 'HIGH_VELOCITY' AS pattern_type,
        'RULE-006' AS rule_id, 'MEDIUM' AS severity,
        printf('VELOCITY: %s had %d txns in 1 hour, total %.2f', account_id, count(*), sum(amount)) AS alert_msg,
        date_trunc('hour', s."timestamp") AS "timestamp"
        FROM silver s WHERE TRUE{w} GROUP BY account_id, date_trunc('hour', s."timestamp") HAVING count(*) > 5"""


def _smurfing(w=""):
    return f"""SELECT account_id, count(*) AS dep_count, sum(amount) AS dep_total, 'SMURFING' AS pattern_type,
        'RULE-009' AS rule_id, 'HIGH' AS severity,
        printf('SMURFING: %s made %d small cash deposits totaling %.2f', account_id, count(*), sum(amount)) AS alert_msg,
        make_timestamp(epoch_us(s."timestamp") // 172800000000 * 172800000000) AS "timestamp"
        FROM silver s WHERE txn_type = 'CASH_DEP' AND amount < 7500{w}
        GROUP BY account_id, epoch_us(s."timestamp") // 172800000000 HAVING count(*) >= 7"""


def _watch(w="", extra=""):
    return f"""SELECT {extra}account_id, s.customer_id, amount, watchlist_match, pep_flag,
        CASE WHEN watchlist_match <> 'NONE' THEN 'WATCHLIST_HIT' ELSE 'PEP_LARGE_TXN' END AS pattern_type,
        CASE WHEN watchlist_match <> 'NONE' THEN 'RULE-008' ELSE 'RULE-007' END AS rule_id, 'CRITICAL' AS severity,
        printf('%s: %s | amount %.2f | list: %s', CASE WHEN watchlist_match <> 'NONE' THEN 'WATCHLIST' ELSE 'PEP' END,
            s.customer_id, amount, watchlist_match) AS alert_msg, "timestamp"
        FROM silver s JOIN cust c ON s.customer_id = c.customer_id
        WHERE amount > 5000 AND (watchlist_match <> 'NONE' OR (pep_flag = 'Y' AND amount > 100000)){w}"""


CIRCLES = """SELECT x.account_id, x.customer_id, x.counterparty_account, y.customer_id AS customer_id2, x.amount,
    y.amount AS amount2, round(y.amount * 100.0 / x.amount, 1) AS return_ratio,
    date_diff('day', x."timestamp", y."timestamp")::INTEGER AS days_gap, x.country, y.country AS country2,
    count(*) OVER (PARTITION BY x.txn_id) AS n_answers, x.txn_id, 'CIRCULAR_FLOW' AS pattern_type, 'RULE-011' AS rule_id,
    CASE WHEN x.amount > 1000000 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
    printf('ROUND-TRIP: %s (%s) sent %.2f -> got back %.2f from different customer %s in %d days', x.account_id,
        x.customer_id, x.amount, y.amount, y.customer_id, date_diff('day', x."timestamp", y."timestamp")) AS alert_msg
    FROM silver x JOIN silver y ON x.counterparty_account = y.account_id AND y.counterparty_account = x.account_id
    WHERE x.txn_type IN ('WIRE_OUT', 'WIRE_IN') AND y.txn_type IN ('WIRE_OUT', 'WIRE_IN')
    AND x.amount > 200000 AND y.amount > 200000 AND x.customer_id <> y.customer_id AND y."timestamp" > x."timestamp"
    AND date_diff('day', x."timestamp", y."timestamp") BETWEEN 30 AND 365
    AND round(y.amount * 100.0 / x.amount, 1) BETWEEN 70 AND 130"""

CIRCLES_NB = """SELECT x.account_id AS sender, x.customer_id AS sender_cust, x.counterparty_account AS receiver,
    x.amount AS out_amount, x.txn_timestamp AS out_time, x.txn_id AS out_txn_id, y.account_id AS recv_acct,
    y.customer_id AS recv_cust, y.counterparty_account AS from_acct, y.amount AS in_amount, y.txn_timestamp AS in_time,
    y.txn_id AS in_txn_id, date_diff('day', x.txn_timestamp, y.txn_timestamp)::INTEGER AS days_gap,
    round(y.amount / x.amount, 2) AS return_ratio, count(*) OVER (PARTITION BY x.txn_id) AS n_answers
    FROM silver x JOIN silver y ON x.account_id = y.counterparty_account AND x.counterparty_account = y.account_id
    WHERE x.txn_type = 'WIRE_OUT' AND y.txn_type = 'WIRE_IN' AND x.amount > 200000 AND y.amount > 200000
    AND x.customer_id <> y.customer_id AND y.txn_timestamp > x.txn_timestamp
    AND date_diff('day', x.txn_timestamp, y.txn_timestamp) BETWEEN 30 AND 365
    AND round(y.amount / x.amount, 2) BETWEEN 0.7 AND 1.3"""

# B's wire to A, or A's wire in from B; the latter names no customer for B
CIRCLES_RETURN = """
    WITH b AS (SELECT account_id AS recv_acct, customer_id AS recv_cust, counterparty_account AS from_acct,
            amount AS in_amount, txn_timestamp AS in_time, txn_id AS in_txn_id
        FROM silver WHERE txn_type = 'WIRE_OUT' AND amount > 200000
        UNION ALL SELECT counterparty_account, NULL, account_id, amount, txn_timestamp, txn_id
        FROM silver WHERE txn_type = 'WIRE_IN' AND amount > 200000)
    SELECT x.account_id AS sender, x.customer_id AS sender_cust, x.counterparty_account AS receiver,
        x.amount AS out_amount, x.txn_timestamp AS out_time, x.txn_id AS out_txn_id, b.*,
        date_diff('day', x.txn_timestamp, in_time)::INTEGER AS days_gap, round(in_amount / x.amount, 2) AS return_ratio,
        count(*) OVER (PARTITION BY x.txn_id) AS n_answers
    FROM silver x JOIN b ON x.account_id = from_acct AND x.counterparty_account = recv_acct
    WHERE x.txn_type = 'WIRE_OUT' AND x.amount > 200000 AND (x.customer_id <> recv_cust OR recv_cust IS NULL)
    AND in_time > x.txn_timestamp AND date_diff('day', x.txn_timestamp, in_time) BETWEEN 30 AND 365
    AND round(in_amount / x.amount, 2) BETWEEN 0.7 AND 1.3"""

DAY = {"lookback": "24 hours"}
register("rule_structuring", lambda t: rules.rule_structuring(t.silver), _structuring(), total_amount=2)
register("rule_structuring_24h", lambda t: rules.rule_structuring(t.silver, **DAY), _structuring(_since), total_amount=2)
register("rule_layering_mule", lambda t: layering.rule_layering_mule(t.silver), _layering(), total_in=2)
register("rule_layering_mule_24h", lambda t: layering.rule_layering_mule(t.silver, **DAY), _layering(_since), total_in=2)
register("rule_layering_mule_once", lambda t: layering.rule_layering_mule(t.silver, dedup=True),
         _layering().replace("sum(amount_in) AS total_in, max(amount_out) AS total_out",
                             "sum(amount_in) AS total_in, max(top_out) AS total_out")
         .replace("count(DISTINCT sender) AS senders,\n            min(gap) AS min_gap_min FROM p GROUP BY 1",
                  """count(DISTINCT sender) AS senders,
            min(gap) AS min_gap_min FROM (SELECT account_id, txn_id, any_value(amount_in) AS amount_in,
            any_value(sender) AS sender, max(amount_out) AS top_out, min(gap) AS gap FROM p GROUP BY 1, 2) u GROUP BY 1"""),
         total_in=2)
register("rule_dormant_spike", lambda t: rules.rule_dormant_spike(t.silver, t.accounts), _dormant())
register("rule_dormant_spike_24h", lambda t: rules.rule_dormant_spike(t.silver, t.accounts, **DAY), _dormant(_since))
register("rule_cash_intensive", lambda t: rules.rule_cash_intensive(t.silver), _cash())
register("rule_cash_intensive_24h", lambda t: rules.rule_cash_intensive(t.silver, **DAY), _cash(_since))
register("rule_high_velocity", lambda t: rules.rule_high_velocity(t.silver), _velocity(), amount_sum_1h=2)
register("rule_high_velocity_24h", lambda t: rules.rule_high_velocity(t.silver, **DAY), _velocity(
    _since.replace('AND "timestamp"', 'AND s."timestamp"')), amount_sum_1h=2)
register("rule_smurfing", lambda t: rules.rule_smurfing(t.silver), _smurfing(), dep_total=2)
register("rule_smurfing_24h", lambda t: rules.rule_smurfing(t.silver, **DAY), _smurfing(
    _since.replace('AND "timestamp"', 'AND s."timestamp"')), dep_total=2)
register("rule_watchlist_pep", lambda t: rules.rule_watchlist_pep(t.silver, t.customers), _watch())
register("rule_watchlist_pep_24h", lambda t: rules.rule_watchlist_pep(t.silver, t.customers, **DAY), _watch(_since))
LIVE = """SELECT flag_id, txn_id, account_id, customer_id, pattern_type, rule_id, ml_score, severity, created_at, notes
    FROM flags WHERE severity IN ('CRITICAL', 'HIGH') AND analyst_decision = 'PENDING'"""
register("rule_live_flags", lambda t: rules.rule_live_flags(t.flags, lookback="24 hours"),
         LIVE + " AND created_at > (SELECT max(created_at) FROM flags) - INTERVAL 24 HOUR")
register("rule_circular_flow", lambda t: circular.rule_circular_flow(t.silver, pairs=True), CIRCLES)
register("circular_flow_nb", lambda t: circular.circular_flow_nb(t.silver, pairs=True), CIRCLES_NB)
register("circular_flow_return", lambda t: circular.circular_flow_nb(t.silver, mode="return", pairs=True), CIRCLES_RETURN)

_hit = "rule_id, pattern_type, severity, account_id"
HITS = f"""
    SELECT {_hit}, customer_id, NULL::VARCHAR AS txn_id, total_amount AS amount, alert_msg, last_txn AS event_ts
        FROM ({_structuring()}) a
    UNION ALL SELECT {_hit}, NULL, NULL, total_in, alert_msg, NULL FROM ({_layering()}) b
    UNION ALL SELECT {_hit}, customer_id, txn_id, amount, alert_msg, "timestamp" FROM ({_dormant(extra='txn_id, ')}) c
    UNION ALL SELECT {_hit}, customer_id, txn_id, amount, alert_msg, "timestamp" FROM ({_cash(extra='txn_id, ')}) d
    UNION ALL SELECT {_hit}, NULL, NULL, amount_sum_1h, alert_msg, "timestamp" FROM ({_velocity()}) e
    UNION ALL SELECT {_hit}, customer_id, txn_id, amount, alert_msg, "timestamp" FROM ({_watch(extra='txn_id, ')}) f
    UNION ALL SELECT {_hit}, NULL, NULL, dep_total, alert_msg, "timestamp" FROM ({_smurfing()}) g
    UNION ALL SELECT {_hit}, customer_id, txn_id, amount, alert_msg, NULL FROM ({CIRCLES}) h"""
register("all_rule_hits", lambda t: rules.all_rule_hits(t.silver, t.accounts, t.customers), HITS, amount=2)
register("explain_rule", lambda t: rules.explain_rule(rules.rule_watchlist_pep(t.silver, t.customers), t.rules),
         f"SELECT w.*, condition_summary, rationale FROM ({_watch()}) w JOIN rules r USING (rule_id)")
