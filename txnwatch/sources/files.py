"""File and stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
INGESTED = "ingest_ts"


def read_csv_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and a fixed schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("timestampFormat", CSV_TIMESTAMP).csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string; casts are left to ``cast_to``."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast string columns to a schema; what does not parse becomes null for the gates to catch."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns]
    )


def stream_source_json(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """Stream of JSON events from a folder, on a fixed schema."""
    return spark.readStream.schema(schema).options(**options).json(path)


def parse_json_values(values: DataFrame, schema: StructType, column: str = "value", arrived: str | None = None) -> DataFrame:
    """The same events as they come from a message bus: one JSON text per row. ``arrived`` names the column with the time at which
    the bus took the message in; it is kept as ``ingest_ts``, and a replay of the messages does not change it."""
    event = F.from_json(F.col(column).cast("string"), schema)
    kept = [] if arrived is None else [F.col(arrived).cast("timestamp").alias(INGESTED)]
    return values.select(event.alias("event"), *kept).select("event.*", *[INGESTED for _ in kept])


def with_file_time(df: DataFrame) -> DataFrame:
    """Rows read from files, batch or stream, with the time their file was written as ``ingest_ts``. It comes from the listing
    of the files and costs no column read."""
    return df.withColumn(INGESTED, F.col("_metadata.file_modification_time"))
