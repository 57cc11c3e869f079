"""The surveillance tables of one data folder, derived once and shared by the queries."""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cleaning, features, scoring
from ..session import fine_shuffles, prepare, scratch_path
from ..sources import driver_tables as given
from ..sources.tables import write_table

_lock = threading.RLock()
_known: dict[tuple[str, str], "Tables"] = {}


class Tables:
    """Silver and gold are written to the shared folder, as the batch pipeline does, and read back: queries
    then scan stored columns with pushed-down filters, and a lost executor costs no recomputation."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return given.read_given(self.spark, self.sf_dir, name)

    def stored(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, name)
        with fine_shuffles(self.spark):
            write_table(df, path, partition_by=partition_by)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def bronze(self) -> DataFrame:
        return given.transactions(self.read("events"))

    @cached_property
    def silver(self) -> DataFrame:
        with _lock:
            return self.stored("silver", cleaning.silver_transactions(self.bronze), "txn_date")

    @cached_property
    def gold(self) -> DataFrame:
        with _lock:
            return self.stored("gold", features.gold_features(self.silver, self.accounts, self.customers))

    @cached_property
    def accounts(self) -> DataFrame:
        return given.accounts(self.read("customer"))

    @cached_property
    def customers(self) -> DataFrame:
        return given.customers(self.read("customer"))

    @cached_property
    def watchlists(self) -> DataFrame:
        return given.watchlists(self.read("customer"))

    @cached_property
    def cases(self) -> DataFrame:
        return given.historical_cases(self.read("orders"))

    @cached_property
    def rules(self) -> DataFrame:
        return given.detection_rules(self.spark)

    @cached_property
    def flags(self) -> DataFrame:
        return given.suspicious_flags(self.silver)

    @cached_property
    def scores(self) -> DataFrame:
        return given.ml_risk_scores(self.silver)

    @cached_property
    def seeds(self) -> DataFrame:
        """Accounts that investigations start from. They meet every table, so they are found once and stored."""
        with _lock:
            critical = self.flags.filter(F.col("severity") == "CRITICAL").select("account_id").distinct()
            return self.stored("seeds", critical.join(self.cases.filter(F.col("outcome") == "OPEN"), "account_id", "left_semi"))

    @cached_property
    def model(self) -> scoring.RiskModel:
        with _lock:
            return scoring.fit_model(self.gold, scratch_path(self.spark, "forest"))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _known:
            _known[key] = Tables(spark, sf_dir)
        return _known[key]
