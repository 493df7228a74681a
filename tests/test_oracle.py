"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from cohortlens.plans import catalog
from cohortlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, f"{v:.6f}")
    return (3, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    # the final plan stays JVM-side and has no cross product (no Python UDF, no nested-loop join)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsIn|MapInPandas|PythonUDF", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    cur = con.execute(E.oracle_sql()[name])
    assert df.columns == [d[0] for d in cur.description]
    a = sorted(tuple(_norm(x) for x in r) for r in rows)
    b = sorted(tuple(_norm(x) for x in r) for r in cur.fetchall())
    assert a == b


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
