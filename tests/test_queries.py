"""Queries beside their SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from ledgerloom.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
FULL = {"merge_companies": "phone", "page_emails": "email", "page_socials": "url", "technologies": "evidence", "hosting": "hosting_provider", "keywords": "keywords", "norm_phone": "phone", "norm_cin": "cin", "shared_domains": "domain", "crawl_worklist": "final_url"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(frame: pd.DataFrame, columns):
    return sorted(tuple("" if pd.isna(v) else str(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, FOLDER).toPandas()
    want = duck.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))
    if name in FULL and len(got):
        assert got[FULL[name]].notna().any()


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalogue.queries()[name](spark, FOLDER).count() >= 1
