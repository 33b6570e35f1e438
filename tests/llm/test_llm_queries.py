"""Queries that SQL can express, beside it; the others run over the smallest tables."""

import glob
import os

import duckdb
import pytest

from ledgerloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = queries.queries()[name](spark, FOLDER)
    want = con.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*sorted(want.columns)).collect())) == sorted(map(tuple, want[sorted(want.columns)].itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_runs(spark, name):
    assert queries.queries()[name](spark, FOLDER).count() >= 1


def test_long_lists_of_towns_are_whole_or_an_error(spark, monkeypatch):
    towns = spark.range(12_000).selectExpr("concat('town', id) AS city", "array('other') AS alt_names")
    monkeypatch.setattr(queries, "table", lambda *_: towns)
    assert len(queries._towns(spark, "")) == 12_000
    monkeypatch.setattr(queries, "MOST_TOWNS", 100)
    with pytest.raises(ValueError):
        queries._towns(spark, "")
