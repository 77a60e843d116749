"""Every registered query vs its DuckDB SQL twin on the same tables (the driver's gate, locally)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from starling.oracle.sql import oracle_sql
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SQL = oracle_sql()    # twins of the LLM queries are tested in their own folder


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_contract_shapes(spark):
    qs = E.queries()
    assert set(SQL) <= set(qs) and set(E.oracle_sql()) <= set(qs)
    assert len(qs) >= 55
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["county_name", "total_premium", "policies"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())
