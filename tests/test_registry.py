"""Every registered query against its SQL, and what its plan must not contain."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import check
from queryset.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
NO_SQL = set()
PYTHON_ALLOWED = {"mdl_baseline", "inf_batch", "flow_reasoning"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in check.TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def test_contract(spark):
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in PYTHON_ALLOWED:
        assert "EvalPython" not in plan and "InPandas" not in plan
    got = check.canon(df.columns, [tuple(r) for r in df.collect()])
    if name not in NO_SQL:
        cur = con.execute(entry_points.oracle_sql()[name])
        want = check.canon([d[0] for d in cur.description], cur.fetchall())
        assert got == want
