import math

import duckdb
import pytest

import __spark_entry__ as se
from sitelens.sources.tables import TABLES, table_path

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert {r["rule"] for r in rows} >= {"total", "priority", "duplicate_title"}


def test_oracle_keys_subset_of_queries():
    assert set(se.oracle_sql()) <= set(se.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return con


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = se.queries()[name](spark, SMALL)
    res = duck.sql(se.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    cols = sorted(sdf.columns)
    s_rows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    idx = [res.columns.index(c) for c in cols]
    o_rows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert s_rows == o_rows
