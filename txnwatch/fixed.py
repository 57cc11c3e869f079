"""Domains, the rule catalogue and default thresholds."""

# Countries treated as high risk, and the home country.
HIGH_RISK_COUNTRIES = ["NG", "RU", "AE", "MX", "PK", "IR", "KP", "MM", "KH", "TR"]
HOME_COUNTRY = "IN"
DEFAULT_CURRENCY = "INR"

# Transaction types that move money in or out of an account.
MONEY_IN = ["WIRE_IN"]
MONEY_OUT = ["WIRE_OUT", "UPI_OUT"]
WIRES = ["WIRE_OUT", "WIRE_IN"]

# The model's input features, in order.
MODEL_FEATURES = [
    "amount", "txn_count_same_day", "txn_count_7d", "txn_count_1h", "amount_sum_1h",
    "cash_dep_count_48h", "cash_sum_48h", "near_threshold_flag", "country_risk",
    "is_weekend", "is_night", "is_cash", "dormant_flag", "amount_vs_avg", "pep_numeric",
    "watchlist_hit", "pass_through_ratio", "distinct_senders", "distinct_receivers",
    "rapid_pass_through",
]

# Rule id, pattern, layer, condition, default severity, why it matters.
RULE_CATALOGUE = [
    ("RULE-001", "STRUCTURING", "RULE", "3 or more transactions of 8000-9999 on one account in one day", "HIGH",
     "Amounts kept just under a reporting threshold"),
    ("RULE-002", "LAYERING", "RULE", "Wire in and more than 90% out within 120 minutes", "CRITICAL",
     "Funds pass through without staying"),
    ("RULE-003", "MULE_ACCOUNT", "RULE", "Credits from 2 or more senders forwarded within 120 minutes", "CRITICAL",
     "Account collects and forwards for others"),
    ("RULE-004", "DORMANT_SPIKE", "RULE", "Account idle for over 180 days moves more than 50000", "HIGH",
     "Sleeping account woken for one movement"),
    ("RULE-005", "CASH_INTENSIVE", "RULE", "Cash deposit above 25000 between 22:00 and 05:59", "HIGH",
     "Large cash outside banking hours"),
    ("RULE-006", "HIGH_VELOCITY", "RULE", "More than 5 transactions on one account in one hour", "MEDIUM",
     "Automated or coordinated activity"),
    ("RULE-007", "PEP_LARGE_TXN", "RULE", "Politically exposed customer moves more than 100000", "CRITICAL",
     "Enhanced diligence applies"),
    ("RULE-008", "WATCHLIST_HIT", "RULE", "Watchlisted customer moves more than 5000", "CRITICAL",
     "Sanctions or police list match"),
    ("RULE-009", "SMURFING", "RULE", "7 or more cash deposits under 7500 within 2 days", "HIGH",
     "Cash split into many small deposits"),
    ("RULE-010", "UNKNOWN_SUSPICIOUS", "ML", "Blended model score above 0.75", "MEDIUM",
     "Anomalous with no rule matched"),
]

# The eleventh rule, appended to the catalogue after the first ten.
CIRCULAR_RULE = (
    "RULE-011", "CIRCULAR_FLOW", "KQL+ML",
    "Customer sends WIRE_OUT and receives WIRE_IN of 70-130% amount from same or linked counterparty"
    " within 30-365 days",
    "CRITICAL",
    "Round-tripping / circular flow. FATF Red Flag for trade-based money laundering. Money leaves and"
    " returns to same entity through intermediaries.",
)
