"""Quality gates: each returns rows of (gate, value, passed)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _gate(name: str, value, passed) -> list:
    return [F.lit(name).alias("gate"), value.cast("long").alias("value"), passed.alias("passed")]


def dq_min_rows(t: DataFrame, n: int = 1000) -> DataFrame:
    return t.agg(F.count(F.lit(1)).alias("c")).select(*_gate("min_rows", F.col("c"), F.col("c") >= n))


def dq_null_keys(t: DataFrame) -> DataFrame:
    missing = F.count_if(F.col("txn_id").isNull() | F.col("amount").isNull())
    return t.agg(missing.alias("c")).select(*_gate("null_keys", F.col("c"), F.col("c") == 0))


def duplicate_keys(t: DataFrame, key: str = "txn_id") -> DataFrame:
    """The keys delivered more than once, with their counts."""
    return t.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def dq_duplicate_keys(t: DataFrame) -> DataFrame:
    counted = duplicate_keys(t).agg(F.count(F.lit(1)).alias("c"))
    return counted.select(*_gate("duplicate_keys", F.col("c"), F.col("c") == 0))


def orphans(t: DataFrame, a: DataFrame) -> DataFrame:
    """Transactions whose account is not in the account table."""
    return t.join(a.select("account_id"), "account_id", "left_anti")


def dq_orphans(t: DataFrame, a: DataFrame) -> DataFrame:
    """Orphan accounts are legal (external parties), so the gate reports and always passes."""
    # counting per account first leaves one row per account to match, however busy the account is
    per_account = t.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    counted = orphans(per_account, a).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("c"))
    return counted.select(*_gate("orphans", F.col("c"), F.lit(True)))


def dq_report(t: DataFrame, a: DataFrame, min_rows: int = 1000) -> DataFrame:
    """Every gate. The row count and the null keys share one pass over the table."""
    missing = F.count_if(F.col("txn_id").isNull() | F.col("amount").isNull())
    single_pass = t.agg(F.count(F.lit(1)).alias("n"), missing.alias("m")).select(
        F.explode(F.array(
            F.struct(*_gate("min_rows", F.col("n"), F.col("n") >= min_rows)),
            F.struct(*_gate("null_keys", F.col("m"), F.col("m") == 0)),
        )).alias("g")
    ).select("g.*")
    return single_pass.unionByName(dq_duplicate_keys(t)).unionByName(dq_orphans(t, a))


def dq_dimension(t: DataFrame, name: str, key: str) -> DataFrame:
    """Gates of a dimension table, from one count per key: it has rows, no row lacks the key, no key comes twice."""
    per_key = t.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("long")
    counted = per_key.agg(
        F.coalesce(F.sum("n"), none).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), none).alias("missing"),
        F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("repeated"))
    return counted.select(F.explode(F.array(
        F.struct(*_gate(f"{name}.rows", F.col("rows"), F.col("rows") > 0)),
        F.struct(*_gate(f"{name}.null_keys", F.col("missing"), F.col("missing") == 0)),
        F.struct(*_gate(f"{name}.duplicate_keys", F.col("repeated"), F.col("repeated") == 0)),
    )).alias("g")).select("g.*")


class GateFailed(Exception):
    """A table that did not pass; ``report`` holds the rows of (gate, value, passed)."""

    def __init__(self, report: list[tuple[str, int, bool]]):
        super().__init__("not published: " + ", ".join(f"{gate} = {value}" for gate, value, passed in report if not passed))
        self.report = report


def load_checked(t: DataFrame, a: DataFrame, store, batch_id: int, min_rows: int = 1000) -> list[tuple[str, int, bool]]:
    """Append ``t`` to ``store`` (see ``streaming.store``) unless a gate fails; returns the report, or raises ``GateFailed`` with
    it, and then no reader ever sees the rows.

    ``t`` is computed once: the gates read the three key columns of what was written. A batch that is published already is not
    written again and has an empty report.
    """
    report = []

    def check(written: DataFrame) -> None:
        report.extend(map(tuple, dq_report(written, a, min_rows).collect()))
        if not all(passed for _, _, passed in report):
            raise GateFailed(report)

    store.append(t, batch_id, check)
    return report
