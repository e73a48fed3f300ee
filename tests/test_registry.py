"""Driver contract: every registered query runs and matches its SQL oracle."""

import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tillroll.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_contract_shapes():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 40
    assert set(sql) <= set(qs)
    assert all(re.match(r"q_|op\d+_|pipeline$", name) for name in qs)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_type", "avg_price"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(q for q in entry.oracle_sql() if q.startswith("q_")))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    s = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=repr)
    o = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert s == o
