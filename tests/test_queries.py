"""Every registered query against its DuckDB counterpart, and what their plans may not contain."""

import glob
import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@needs_data
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in plan
    columns = sorted(df.columns)
    got = Counter(tuple(repr(v) for v in row) for row in df.select(*columns).collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(repr(row[i]) for i in order) for row in result.fetchall())
    assert got == want


@needs_data
@pytest.mark.parametrize(("name", "scans", "exchanges"), [
    ("dq_summary", 0, 0), ("asof_backward", 2, 3), ("asof_fallback", 2, 3), ("reconcile_totals", 4, 10)])
def test_plans_read_and_shuffle_no_more_than_they_need(spark, name, scans, exchanges):
    """Counted in the final plan: what a query writes on the way (one scan and two exchanges of an as-of join) is behind it."""
    df = entry.queries()[name](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan|Scan parquet", plan)) <= scans
    assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", plan)) <= exchanges


@needs_data
def test_every_query_has_an_oracle():
    """Queries of the training-data operators have brute-force tests of their own where SQL can't express them."""
    core = {name for name in entry.queries() if not name.startswith("op") and name != "pipeline"}
    assert core == set(entry.QUERIES) and core <= set(entry.oracle_sql())


@needs_data
def test_entry_has_rows_and_no_personal_column(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["country", "month", "currency"]
