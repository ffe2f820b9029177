"""Every registered query against its independent DuckDB formulation."""

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from convoy.oracle_sql import ORACLE
from convoy.plans.registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def _rows(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    return cols, sorted(tuple(_norm(x) for x in r) for r in zip(*data))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert got.num_rows == want.num_rows
    assert gr == wr
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["route_code", "origin_city", "destination_city", "total_km",
                          "consumo", "consumo_en_100km"]
