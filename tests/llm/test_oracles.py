"""Every query with SQL against DuckDB at sf0.001, and every query's shape."""

import math
from collections import Counter

import duckdb
import pytest

from leadmill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(ORACLES[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    assert got == Counter(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_native_plans_have_no_python(spark):
    for key in ("op4_quality_rules", "op5_url_filters", "op8_secret_scans", "op10_sharding"):
        plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct")), key
