"""Every registered query against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from leadmill.plans import all_queries  # noqa: F401
from leadmill.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "orders", "pages"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    cols = sorted(df.columns)
    got = Counter(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    res = con.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    want = Counter(repr(tuple(_norm(r[ocols.index(c)]) for c in cols)) for r in res.fetchall())
    assert got == want


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "email_address" in df.columns
