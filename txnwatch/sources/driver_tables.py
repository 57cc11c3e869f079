"""The surveillance tables, derived from the given Parquet tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed import CIRCULAR_RULE, RULE_CATALOGUE
from ..functions.columns import fraud_label, severity_band, stable_id
from ..schemas import FLAG_COLUMNS, SCORE_COLUMNS, TABLES, TXN_COLUMNS

# Lists the derivation indexes by position.
COUNTRIES = ["IN", "US", "GB", "NG", "RU", "AE", "MX", "PK", "IR", "KP", "MM", "KH", "TR", "SG", "DE",
             "FR", "JP", "CN", "BR", "ZA", "AU", "CA", "CH", "NL", "HK"]
CHANNELS = ["MOBILE", "BRANCH", "ATM", "ONLINE"]
MERCHANTS = ["RETAIL", "TRAVEL", "GROCERY", "FUEL", "JEWELRY", "OTHER"]


def pick(values: list[str], index: str):
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.expr(f"cast({index} as int) + 1"))


def read_given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_given(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    """The same table as a stream. The pattern matches a single file as well as a folder of files."""
    schema = read_given(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{sf_dir}/{name}.parque[t]")


def transactions(events: DataFrame, redeliver: bool = True) -> DataFrame:
    """Transactions as delivered: nulls, non-positive amounts and re-delivered rows included."""
    base = events.select(
        F.col("event_id").alias("i"),
        F.col("user_id").alias("u"),
        F.col("value").alias("v"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"),
    ).withColumns({
        "b": F.expr("(s - 1704067200) div 259200"),
        "sod": F.expr("(s - 1704067200) % 86400"),
    })
    if redeliver:
        base = base.withColumn("copy", F.explode(F.expr("if(i % 50 = 0, array(1, 2), array(1))")))
    columns = {
        "txn_id": "concat('TXN-', lpad(cast(i as string), 8, '0'))",
        "account_id": "concat('ACC-', lpad(cast(u as string), 6, '0'))",
        "customer_id": """if(i % 101 = 0, null,
            concat('CUST-', lpad(cast(if(u % 10 = 9, u - 1, u) as string), 6, '0')))""",
        "counterparty_account": """concat('ACC-', lpad(cast(
            if(u % 10 in (6, 7), if(u % 2 = 0, u + 1, u - 1), u + 1 + i % 4) as string), 6, '0'))""",
        "amount": """cast(case
            when i % 97 = 0 then -v
            when u % 10 in (6, 7) then 900000 + (i % 7) * 50000
            when u % 15 = 0 then if(i % 3 = 0, 10000 + i % 500, 60000 + i % 700)
            when u % 11 = 4 then 8000 + (i * 13) % 2000
            when i % 9 = 0 then round(v * 1000, 2)
            else round(v * 100, 2) end as double)""",
        "currency": "case when i % 17 = 0 then null when i % 3 = 0 then 'USD' else 'INR' end",
        "txn_type": """case
            when u % 10 in (6, 7) then if(i % 2 = 0, 'WIRE_OUT', 'WIRE_IN')
            when u % 15 = 0 then if(i % 3 = 0, 'WIRE_IN', 'WIRE_OUT')
            when u % 7 = 3 then 'CASH_DEP'
            when i % 10 in (0, 1) then 'WIRE_OUT'
            when i % 10 in (2, 3) then 'WIRE_IN'
            when i % 10 in (4, 5) then 'CASH_DEP'
            when i % 10 = 6 then 'UPI_OUT'
            when i % 10 = 7 then 'PURCHASE'
            when i % 10 = 8 then 'SALARY'
            else 'EMI' end""",
        "timestamp": """if(i % 103 = 0, null, timestamp_seconds(
            1704067200 + b * 3110400 + if(u % 5 = 0, 79200 + sod div 24, sod)))""",
        "pattern_label": """case
            when i % 10 = 3 then 'PENDING'
            when u % 10 in (6, 7) then 'CIRCULAR_FLOW'
            when u % 15 = 0 then 'MULE_ACCOUNT'
            when u % 11 = 4 then 'STRUCTURING'
            when u % 7 = 3 then 'SMURFING'
            else 'CLEAN' end""",
    }
    built = {name: F.expr(text) for name, text in columns.items()}
    built["channel"] = pick(CHANNELS, "i % 4")
    built["merchant_cat"] = pick(MERCHANTS, "i % 6")
    built["country"] = pick(COUNTRIES, "i % 25")
    return base.select(*[built[name].alias(name) for name in TXN_COLUMNS])


def accounts(customer: DataFrame) -> DataFrame:
    k = customer.select(F.col("c_custkey").alias("k"))
    columns = {
        "account_id": "concat('ACC-', lpad(cast(k as string), 6, '0'))",
        "customer_id": "concat('CUST-', lpad(cast(if(k % 10 = 9, k - 1, k) as string), 6, '0'))",
        "acct_type": "case k % 3 when 0 then 'SAVINGS' when 1 then 'CURRENT' else 'NRE' end",
        "open_date": "date_add(date'2015-01-01', cast((k * 13) % 3000 as int))",
        "days_inactive": "cast((k * 37) % 400 as int)",
        "txn_count_30d": "cast((k * 7) % 60 as int)",
        "avg_txn_amount": "if(k % 50 = 0, null, cast(1000 + (k * 91) % 9000 as double))",
        "countries_30d": "cast(k % 5 as int)",
        "cash_ratio": "cast(k % 100 as double) / 100",
        "risk_score": "cast((k * 17) % 100 as double) / 100",
        "risk_tier": """case when (k * 17) % 100 < 40 then 'LOW'
            when (k * 17) % 100 < 75 then 'HIGH' else 'VERY_HIGH' end""",
    }
    return k.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def customers(customer: DataFrame) -> DataFrame:
    """Keys ending in 9 are second accounts of the customer before, so they are accounts but no customers of their own."""
    rows = customer.filter("c_custkey % 10 <> 9").withColumnRenamed("c_custkey", "k")
    columns = {
        "customer_id": "concat('CUST-', lpad(cast(k as string), 6, '0'))",
        "name_hash": "md5(c_name)",
        "occupation": "c_mktsegment",
        "pep_flag": "if(k % 9 = 4, 'Y', 'N')",
        "kyc_status": "case k % 3 when 0 then 'VERIFIED' when 1 then 'PENDING' else 'EXPIRED' end",
        "risk_tier": "case k % 3 when 0 then 'LOW' when 1 then 'HIGH' else 'VERY_HIGH' end",
        "watchlist_match": "case k % 20 when 0 then 'INTERPOL' when 1 then 'PEP_LIST' else 'NONE' end",
        "source_of_funds": """case k % 4 when 0 then 'SALARY' when 1 then 'BUSINESS'
            when 2 then 'INVESTMENT' else 'INHERITANCE' end""",
    }
    built = {name: F.expr(text) for name, text in columns.items()}
    built["country"] = pick(COUNTRIES, "c_nationkey % 25")
    return rows.select(*[built[name].alias(name) for name in TABLES["customers"].names])


def watchlists(customer: DataFrame) -> DataFrame:
    listed = customer.filter("c_custkey % 20 in (0, 1) and c_custkey % 10 <> 9").select(
        F.col("c_custkey").alias("k"), F.expr("explode(if(c_custkey % 200 = 0, array('WL', 'WLX'), array('WL')))")
        .alias("kind"),
    )
    columns = {
        "entry_id": "concat(kind, '-', lpad(cast(k as string), 6, '0'))",
        "entity_id": "concat(if(kind = 'WL', 'CUST-', 'EXT-'), lpad(cast(k as string), 6, '0'))",
        "entity_type": "if(kind = 'WL', 'INDIVIDUAL', 'ENTITY')",
        "list_name": "if(k % 20 = 0, 'INTERPOL_RED', 'PEP_LIST')",
        "source": "if(k % 20 = 0, 'INTERPOL', 'FIU')",
        "risk_level": "if(k % 20 = 0, 'CRITICAL', 'HIGH')",
        "added_date": "date_add(date'2020-01-01', cast(k % 1000 as int))",
        "match_type": "if(k % 2 = 0, 'EXACT', 'FUZZY')",
    }
    return listed.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def historical_cases(orders: DataFrame) -> DataFrame:
    """Every order is a case."""
    rows = orders.withColumnsRenamed({"o_orderkey": "o", "o_custkey": "k"})
    columns = {
        "case_id": "concat('CASE-', lpad(cast(o as string), 8, '0'))",
        "account_id": "concat('ACC-', lpad(cast(k as string), 6, '0'))",
        "customer_id": "concat('CUST-', lpad(cast(if(k % 10 = 9, k - 1, k) as string), 6, '0'))",
        "total_amount": "o_totalprice",
        "num_txns": "cast(1 + o % 20 as int)",
        "investigation_days": "cast(1 + o % 60 as int)",
        "outcome": "case o % 3 when 0 then 'CONFIRMED' when 1 then 'FALSE_POSITIVE' else 'OPEN' end",
        "sar_filed": "if(o % 2 = 0, 'Y', 'N')",
        "close_date": "cast(o_orderdate as date)",
    }
    built = {name: F.expr(text) for name, text in columns.items()}
    built["pattern_type"] = pick([r[1] for r in RULE_CATALOGUE] + [CIRCULAR_RULE[1]], "o % 11")
    return rows.select(*[built[name].alias(name) for name in TABLES["historical_cases"].names])


def detection_rules(spark: SparkSession, with_circular: bool = True) -> DataFrame:
    rows = RULE_CATALOGUE + ([CIRCULAR_RULE] if with_circular else [])
    return spark.createDataFrame(rows, TABLES["detection_rules"])


def suspicious_flags(silver: DataFrame) -> DataFrame:
    """Flags standing in for a past scoring run: by amount band, some transactions twice."""
    rows = (
        silver.filter("amount between 8000 and 9999 or amount > 50000")
        .withColumn("id", F.expr("cast(substr(txn_id, 5) as bigint)"))
        .withColumn("first_rule", F.expr(
            "case when amount <= 9999 then 'RULE-001' when amount > 200000 then 'RULE-011' else 'RULE-004' end"))
        .withColumn("rule_id", F.explode(F.expr(
            "if(id % 7 = 0, array(first_rule, 'RULE-010'), array(first_rule))")))
        .withColumn("ml_score", F.expr("cast(75 + id % 25 as double) / 100"))
    )
    built = {
        "flag_id": stable_id("FLAG-", F.col("rule_id"), F.col("txn_id")),
        "pattern_type": F.expr("""case rule_id when 'RULE-001' then 'STRUCTURING' when 'RULE-004' then 'DORMANT_SPIKE'
            when 'RULE-011' then 'CIRCULAR_FLOW' else 'UNKNOWN_SUSPICIOUS' end"""),
        "detection_source": F.expr("if(rule_id = 'RULE-010', 'ML_NOTEBOOK', 'KQL_RULE')"),
        "severity": severity_band(F.col("ml_score")),
        "analyst_decision": F.expr(
            "case id % 3 when 0 then 'PENDING' when 1 then 'CONFIRMED' else 'FALSE_POSITIVE' end"),
        "created_at": F.col("timestamp") + F.expr("interval 60 seconds"),
        "notes": F.concat(F.lit("raised by "), F.col("rule_id")),
    }
    return rows.select(*[built.get(name, F.col(name)).alias(name) for name in FLAG_COLUMNS])


def ml_risk_scores(silver: DataFrame) -> DataFrame:
    """Scores standing in for a past scoring run."""
    rows = silver.withColumn("id", F.expr("cast(substr(txn_id, 5) as bigint)"))
    anomaly = F.expr("cast((id * 31) % 1000 as double) / 1000")
    chance = F.expr("cast((id * 17) % 1000 as double) / 1000")
    built = {
        "anomaly_score": anomaly,
        "fraud_probability": chance,
        "final_risk_score": F.round(anomaly * 0.4 + chance * 0.6, 4),
        "fraud_type": F.when(F.round(anomaly * 0.4 + chance * 0.6, 4) > 0.75, "UNKNOWN_SUSPICIOUS").otherwise("CLEAN"),
        "is_fraud": fraud_label(F.col("pattern_label")),
        "scored_at": F.col("timestamp") + F.expr("interval 300 seconds"),
    }
    return rows.select(*[built.get(name, F.col(name)).alias(name) for name in SCORE_COLUMNS])
