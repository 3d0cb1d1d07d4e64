"""Each registered query against its DuckDB oracle text (sf0.001; the
driver repeats this at sf0.01, see scripts/oracle_check.py)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
FLOWS = {"load_landed", "load_preblocked", "run_load", "with_retry"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._ORACLE)


@pytest.mark.parametrize("key", sorted(k for k in E._QUERIES if k not in FLOWS))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF0001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[key])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("key", sorted(FLOWS))
def test_flow_matches_source(spark, duck, key):
    df = E.queries()[key](spark, SF0001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[key])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got == want


def test_entry_gives_block_report(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["block_id", "n_rows"]
    assert sum(r["n_rows"] for r in rows) == 1500
