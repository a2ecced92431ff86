"""Every registered job equals its DuckDB oracle on the smallest benchmark tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conform.plans.registry import ORACLE, QUERIES
from tools.compare import canon, duck

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")), "Python in the hot path"
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    c1, r1 = canon(df.columns, rows)
    c2, r2 = canon([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert r1 == r2


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["utility_id", "feeder_id", "max_hosting_capacity", "min_hosting_capacity",
                          "last_refresh_date", "voltage_kv", "batch_date"]
