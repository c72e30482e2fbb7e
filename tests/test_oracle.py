"""Every registered query against its DuckDB oracle on the small fixture."""

import duckdb
import pytest

import __spark_entry__ as E
from tickframe.plans import catalog
from conftest import SF_SMALL
from tools.oracle_check import TABLES, compare

NAMES = sorted(catalog.spark_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_queries()) == set(catalog.spark_queries()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert compare(got, want) == "ok"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "dynamic_attention_score" in df.columns
