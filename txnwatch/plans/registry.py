"""Name -> query, and name -> the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .oracle import with_tables
from .tables import Tables, tables


@dataclass
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    rounding: dict[str, int]
    doubles: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(tables(spark, sf_dir))
        # sums of doubles depend on the order of addition in their last digits, and client libraries
        # disagree on how to show dates, and whole numbers with nulls among them
        changes = {c: F.round(c, d) for c, d in self.rounding.items()}
        changes |= {c: F.col(c).cast("double") for c in self.doubles} | {c: F.col(c).cast("string") for c in self.texts}
        return df.withColumns(changes) if changes else df

    def oracle(self) -> str | None:
        return with_tables(self.sql, self.rounding, self.doubles, self.texts) if self.sql else None


QUERIES: dict[str, Query] = {}


def register(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None, doubles: tuple[str, ...] = (),
             texts: tuple[str, ...] = (), **rounding: int) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = Query(name, build, sql, rounding, doubles, texts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: q.run for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.oracle() for name, q in QUERIES.items() if q.sql}


def _load() -> None:
    from . import batch_queries, case_queries, job_queries, model_queries, stream_queries  # noqa: F401
