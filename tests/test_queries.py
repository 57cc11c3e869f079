"""Every registered query against its SQL twin, on the whole small tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .compare import compare, connect
from txnwatch.session import prepare

RUNS, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    assert compare(RUNS[name](spark, sf_dir).toPandas(), duck.execute(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_gives_rows(spark, sf_dir, name):
    assert RUNS[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and len(df.columns) == 45


def test_every_sql_has_a_query():
    assert set(SQL) <= set(RUNS)


def test_a_session_of_a_caller_compiles_wide_projections(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        prepare(spark)
        assert spark.conf.get(name) == "8000"
    finally:
        spark.conf.set(name, before)
