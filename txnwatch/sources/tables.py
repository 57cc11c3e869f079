"""Table scans, sinks and appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..fixed import CIRCULAR_RULE
from ..schemas import DIMENSIONS, TABLES
from .files import cast_to, read_csv_strings


def scan_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A catalogue table, or a Parquet table in a folder."""
    return spark.read.parquet(f"{folder}/{name}") if folder else spark.table(name)


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: str | None = None,
    as_path: bool = True,
) -> None:
    """Write a table. With ``partition_by`` rows are first gathered per partition value; the rebalance
    hint lets Spark split a value that holds too much and merge those that hold little."""
    if partition_by:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if as_path:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_evolving(df: DataFrame, path: str) -> None:
    """Append rows whose columns differ from what is stored; ``read_evolving`` merges the schemas."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def append_union(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Table append as a multiset union; columns one side lacks become null."""
    return target.unionByName(rows, allowMissingColumns=True)


def append_common_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append the columns both tables have, cast to the target's types."""
    common = sorted(set(source.columns) & set(target.columns))
    types = dict(target.dtypes)
    rows = source.select(*[F.col(c).try_cast(types[c]).alias(c) for c in common])
    return target.unionByName(rows, allowMissingColumns=True)


def append_if_new(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key the target does not hold yet: what a repeated append has to add."""
    return rows.join(target.select(key).distinct(), key, "left_anti")


def append_rule_row(rules: DataFrame) -> DataFrame:
    """Add the circular-flow rule to the catalogue unless it is there."""
    row = rules.sparkSession.createDataFrame([CIRCULAR_RULE], TABLES["detection_rules"])
    return rules.unionByName(append_if_new(rules, row, "rule_id"))


def drop_column(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def reload_dimensions(spark: SparkSession, raw: str, target: str) -> dict[str, DataFrame]:
    """Overwrite the five dimension tables from their raw CSV files."""
    loaded = {}
    for name in DIMENSIONS:
        rows = cast_to(read_csv_strings(spark, f"{raw}/{name}"), TABLES[name])
        write_table(rows, f"{target}/{name}")
        loaded[name] = spark.read.parquet(f"{target}/{name}")
    return loaded


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: name and row count."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = counts[0]
    for nxt in counts[1:]:
        out = out.unionByName(nxt)
    return out


def take_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A sample of n rows that is the same on every run."""
    return df.orderBy(*order).limit(n)
