"""Driver contract: entry() runs, every query has a name-matched oracle, and a sample of
queries equals its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
SAMPLE = ("stg_drug_spending", "int_prescriber_summary", "mart_specialty_vs_generic",
          "mart_dq_completeness", "mart_executive_summary", "snapshot_drug_spending",
          "report_engagement_by_specialty_tier", "checks_staging")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "engagement_tier" in df.columns


def test_every_query_has_oracle():
    from claimlake.plans.catalog import all_queries
    q, o = all_queries(), E.oracle_sql()
    assert sorted(set(q) - set(o)) == []
    assert set(q) <= set(E.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    srows = [tuple(r) for r in df.collect()]
    order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    order_o = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted("|".join(_norm(r[i]) for i in order_s) for r in srows)
    b = sorted("|".join(_norm(r[i]) for i in order_o) for r in orows)
    assert a == b
