"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as ent
from rulelake import plans
from rulelake.session import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(plans.all_sql()))
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ent.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _digest(df.columns, rows) == _digest(rel.columns, rel.fetchall())


def test_every_query_has_oracle():
    assert set(plans.all_queries()) == set(plans.all_sql())
    assert set(ent.oracle_sql()) <= set(ent.queries())


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() >= 0
