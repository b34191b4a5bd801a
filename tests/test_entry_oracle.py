"""The driver contract and the DuckDB oracle, on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cinderframe.plans.queries import QUERIES as LIBRARY

SF = "/root/testdata/sf0.001"
TABLES = ["lineitem", "orders", "customer", "nation", "events"]


def _canon(v):
    import datetime as dt
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_canon(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)),
                  key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_co2_kg_per_t" in df.columns


def test_every_query_has_oracle():
    from cinderframe.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("name", ["dq_freshness", "rpt_pipeline_log", "audit_summary", "ingest_openaq",
                                  "co2_intensity", "rpt_kpi"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = E.queries()[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = con.execute(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)
