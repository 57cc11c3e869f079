"""Small hand-written tables."""

from pyspark.sql import functions as F

from txnwatch.operators.cleaning import silver_columns
from txnwatch.schemas import TABLES

DEFAULTS = {
    "account_id": "ACC-1", "customer_id": "CUST-1", "counterparty_account": "ACC-2", "amount": 100.0, "currency": "INR",
    "txn_type": "WIRE_OUT", "channel": "ONLINE", "country": "IN", "merchant_cat": "OTHER",
    "timestamp": "2024-03-01 10:00:00", "pattern_label": "CLEAN",
}


def transactions(spark, rows, **common):
    """Bronze rows; what a row does not say comes from ``common`` and then from the defaults."""
    names = TABLES["transactions"].names
    full = []
    for i, row in enumerate(rows):
        values = {"txn_id": f"TXN-{i + 1:06d}", **DEFAULTS, **common, **row}
        full.append(tuple(values[n] for n in names))
    text = ", ".join(f"{f.name} {'string' if f.name == 'timestamp' else f.dataType.simpleString()}" for f in TABLES["transactions"])
    return spark.createDataFrame(full, text).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def silver(spark, rows, **common):
    return silver_columns(transactions(spark, rows, **common))


def table(spark, name, rows):
    """Rows of a table as dicts; missing columns are null."""
    schema = TABLES[name]
    text = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], text)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
