"""One canonical schema per table. A `!` marks a column that must not be null."""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {"string": StringType(), "double": DoubleType(), "int": IntegerType(), "date": DateType(),
          "timestamp": TimestampType()}

_COLUMNS = {
    "transactions": """
        txn_id string!, account_id string!, customer_id string!,
        counterparty_account string, amount double!, currency string, txn_type string,
        channel string, country string, merchant_cat string, timestamp timestamp, pattern_label string""",
    "accounts": """
        account_id string!, customer_id string!, acct_type string, open_date date,
        days_inactive int, txn_count_30d int, avg_txn_amount double, countries_30d int,
        cash_ratio double, risk_score double, risk_tier string""",
    "customers": """
        customer_id string!, name_hash string, country string, occupation string,
        pep_flag string, kyc_status string, risk_tier string, watchlist_match string,
        source_of_funds string""",
    "watchlists": """
        entry_id string!, entity_id string, entity_type string, list_name string,
        source string, risk_level string, added_date date, match_type string""",
    "historical_cases": """
        case_id string!, account_id string, customer_id string, pattern_type string,
        total_amount double, num_txns int, investigation_days int, outcome string,
        sar_filed string, close_date date""",
    "detection_rules": """
        rule_id string!, pattern_type string, detection_layer string,
        condition_summary string, default_severity string, rationale string""",
    "suspicious_flags": """
        flag_id string!, txn_id string, account_id string, customer_id string,
        pattern_type string, rule_id string, ml_score double, detection_source string,
        severity string, analyst_decision string, created_at timestamp, notes string""",
    "ml_risk_scores": """
        txn_id string!, account_id string, customer_id string, amount double,
        anomaly_score double, fraud_probability double, final_risk_score double,
        fraud_type string, is_fraud int, scored_at timestamp""",
}


def _schema(text: str) -> StructType:
    columns = [column.split() for column in text.split(",")]
    return StructType([StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")) for name, kind in columns])


TABLES = {name: _schema(text) for name, text in _COLUMNS.items()}
DIMENSIONS = ["accounts", "customers", "watchlists", "historical_cases", "detection_rules"]
FLAG_COLUMNS = TABLES["suspicious_flags"].names
SCORE_COLUMNS = TABLES["ml_risk_scores"].names
TXN_COLUMNS = TABLES["transactions"].names
