"""Scoring: deterministic parts with a SQL check; fitted models by rows only (tests check their quality)."""

from pyspark.sql import functions as F

from ..fixed import MODEL_FEATURES
from ..operators import flags, scoring, typology
from ..functions.columns import severity_band
from ..session import scratch_path
from .batch_queries import AT, CIRCLES_NB
from .registry import register

MONEY = {"amount_sum_1h": 2, "cash_sum_48h": 2, "amount_vs_avg": 6, "pass_through_ratio": 6}


def _scored(t):
    """Gold rows with the scores of a past run."""
    return t.gold.join(t.scores.select("txn_id", "anomaly_score", "fraud_probability", "final_risk_score"), "txn_id")


TYPED = """SELECT *, CASE WHEN near_threshold_flag = 1 AND txn_count_same_day >= 3 THEN 'STRUCTURING'
    WHEN rapid_pass_through = 1 AND distinct_senders >= 2 THEN 'MULE_ACCOUNT' WHEN rapid_pass_through = 1 THEN 'LAYERING'
    WHEN dormant_flag = 1 AND amount > 50000 THEN 'DORMANT_SPIKE' WHEN watchlist_hit = 1 AND amount > 5000 THEN 'WATCHLIST_HIT'
    WHEN pep_numeric = 1 AND amount > 100000 THEN 'PEP_LARGE_TXN' WHEN cash_dep_count_48h >= 7 AND is_cash = 1 THEN 'SMURFING'
    WHEN is_cash = 1 AND is_night = 1 AND amount > 25000 THEN 'CASH_INTENSIVE' WHEN txn_count_1h > 5 THEN 'HIGH_VELOCITY'
    WHEN final_risk_score > 0.75 THEN 'UNKNOWN_SUSPICIOUS' ELSE 'CLEAN' END AS fraud_type FROM scored"""
BAND = "CASE WHEN final_risk_score > 0.95 THEN 'CRITICAL' WHEN final_risk_score > 0.85 THEN 'HIGH' ELSE 'MEDIUM' END"

register("feature_matrix", lambda t: scoring.feature_matrix(t.gold), "SELECT * FROM matrix", **MONEY)
_z = ", ".join(
    f"({n} - avg({n}) OVER ()) / CASE WHEN stddev_pop({n}) OVER () > 0 THEN stddev_pop({n}) OVER () ELSE 1 END AS {n}"
    for n in MODEL_FEATURES)
register("standard_scale", lambda t: scoring.standard_scale(scoring.feature_matrix(t.gold)),
         f"SELECT txn_id, {_z} FROM matrix", **{n: 5 for n in MODEL_FEATURES})
register("split_holdout", lambda t: scoring.split_holdout(t.gold),
         """SELECT txn_id, is_fraud, CASE WHEN ('0x' || substr(md5(txn_id), 1, 6))::BIGINT % 100 < 25 THEN 'test'
         ELSE 'train' END AS part FROM gold WHERE is_fraud IS NOT NULL""")
register("blend_score", lambda t: scoring.blend_score(t.scores.drop("final_risk_score")).select("txn_id", "final_risk_score"),
         """SELECT txn_id, greatest(0, least(1, anomaly_score * 0.4::DOUBLE + fraud_probability * 0.6::DOUBLE)) AS final_risk_score
         FROM scores""", final_risk_score=6)
register("severity_band", lambda t: t.scores.select("txn_id", severity_band(F.col("final_risk_score")).alias("severity")),
         f"SELECT txn_id, {BAND} AS severity FROM scores")
register("typology_label", lambda t: typology.typology_label(_scored(t)).select("txn_id", "fraud_type"),
         f"SELECT txn_id, fraud_type FROM ({TYPED}) x")
register("unscored_transactions", lambda t: scoring.unscored_transactions(
    t.gold.select("txn_id", "account_id"), t.scores.filter("fraud_type = 'CLEAN'")),
    "SELECT txn_id, account_id FROM gold WHERE txn_id NOT IN (SELECT txn_id FROM scores WHERE fraud_type = 'CLEAN')")
_flag = f"""'RULE-010' AS rule_id, final_risk_score AS ml_score, {BAND} AS severity, 'PENDING' AS analyst_decision,
    TIMESTAMP '{AT}' AS created_at"""
register("ml_flags", lambda t: flags.ml_flags(typology.typology_label(_scored(t)), t.flags, at=AT),
         f"""SELECT 'FLAG-ML-' || substr(md5('RULE-010' || txn_id), 1, 10) AS flag_id, txn_id, account_id, customer_id,
         fraud_type AS pattern_type, {_flag}, 'ML_NOTEBOOK' AS detection_source,
         printf('ML score %.3f | typology %s', final_risk_score, fraud_type) AS notes
         FROM ({TYPED}) x WHERE final_risk_score > 0.75 AND txn_id NOT IN (SELECT txn_id FROM flags)""")
register("rt_flags", lambda t: flags.rt_flags(t.scores, t.flags, at=AT),
         f"""SELECT 'FLAG-RT-' || substr(md5('RULE-010' || txn_id), 1, 10) AS flag_id, txn_id, account_id, customer_id,
         fraud_type AS pattern_type, {_flag}, 'ML_REALTIME' AS detection_source,
         printf('Real-time ML score %.3f', final_risk_score) AS notes
         FROM scores WHERE final_risk_score > 0.75 AND txn_id NOT IN (SELECT txn_id FROM flags)""")
register("circular_flags", lambda t: flags.circular_flags(t.silver, at=AT),
         f"""SELECT 'FLAG-CIRC-' || substr(md5('RULE-011' || out_txn_id), 1, 10) AS flag_id, out_txn_id AS txn_id,
         sender AS account_id, sender_cust AS customer_id, 'CIRCULAR_FLOW' AS pattern_type, 'RULE-011' AS rule_id,
         0.95::DOUBLE AS ml_score, 'ML_NOTEBOOK' AS detection_source,
         CASE WHEN out_amount > 1000000 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, 'PENDING' AS analyst_decision,
         TIMESTAMP '{AT}' AS created_at,
         'Circular flow: money returned to sender within 1 year, different customer' AS notes
         FROM (SELECT DISTINCT out_txn_id, sender, sender_cust, out_amount FROM ({CIRCLES_NB}) c) x""")
register("flag_summary", lambda t: flags.flag_summary(t.flags),
         "SELECT pattern_type, severity, count(*) AS flag_count FROM flags GROUP BY 1, 2")
register("eval_report", lambda t: scoring.eval_report(t.scores),
         """WITH p AS (SELECT l.label, is_fraud = l.label AS truth, (fraud_probability > 0.5)::INTEGER = l.label AS guess
            FROM scores, (VALUES (0), (1)) l(label) WHERE is_fraud IS NOT NULL),
         c AS (SELECT label, count(*) FILTER (WHERE truth AND guess) AS hit, count(*) FILTER (WHERE NOT truth AND guess) AS extra,
            count(*) FILTER (WHERE truth AND NOT guess) AS missed FROM p GROUP BY 1)
         SELECT label, hit::DOUBLE / (hit + extra) AS precision, hit::DOUBLE / (hit + missed) AS recall,
         2.0::DOUBLE * hit / (2 * hit + extra + missed) AS f1, hit + missed AS support FROM c""",
         precision=8, recall=8, f1=8)
register("eval_auc", lambda t: scoring.eval_auc(t.scores),
         """WITH g AS (SELECT fraud_probability AS s, count(*) FILTER (WHERE is_fraud = 1) AS p,
            count(*) FILTER (WHERE is_fraud = 0) AS n FROM scores WHERE is_fraud IS NOT NULL GROUP BY 1),
         c AS (SELECT p, n, sum(n) OVER (ORDER BY s) - n AS below FROM g)
         SELECT (sum(p * (below + n / 2.0::DOUBLE)) / (sum(p) * sum(n)))::DOUBLE AS auc FROM c""", auc=8)

# fitted models: no SQL twin
register("anomaly_fit", lambda t: scoring.anomaly_fit(scoring.standard_scale(scoring.feature_matrix(t.gold))))
register("anomaly_score", lambda t: scoring.normalise_rows(t.stored("raw", scoring.raw_anomaly(
    t.model.scale(scoring.feature_matrix(t.gold)), t.model.nodes).select("txn_id", "raw"))))
register("gbt_fit", lambda t: t.spark.createDataFrame(
    [(i, float(w), n) for i, (w, n) in enumerate(zip(t.model.gbt.weights, t.model.gbt.node_counts()))],
    "round int, weight double, nodes int"))
register("gbt_score", lambda t: scoring.gbt_score(scoring.feature_matrix(t.gold), t.model.gbt).select(
    "txn_id", "fraud_probability"))
register("eval_auc_model", lambda t: scoring.eval_auc(scoring.gbt_score(scoring.feature_matrix(
    t.gold.filter(F.col("is_fraud").isNotNull()), "is_fraud").filter(scoring.is_holdout(F.col("txn_id"))), t.model.gbt)))


def _saved_and_loaded(t):
    path = scratch_path(t.spark, "model")
    scoring.model_save(t.model, path)
    return scoring.ml_risk_scores(t.gold, scoring.model_load(t.spark, path), AT)


register("model_save_load", _saved_and_loaded)
register("ml_risk_scores", lambda t: scoring.ml_risk_scores(t.gold, t.model, AT))
register("score_new", lambda t: scoring.score_new(t.gold, t.scores.filter("fraud_type = 'CLEAN'"), t.model, AT))
