"""Plan guards for every registered query: no cartesian / nested-loop joins,
no row-at-a-time Python UDFs, Python workers only in the page pass, and
narrow scans (column pruning reaches the Parquet reader)."""

import pytest

import __spark_entry__ as E
from hirelens.plans.queries import QUERIES

from .conftest import SF_SMALL

PYTHON_WORKER_QUERIES = {"x3_x8_extract_pages", "x3_x8_job_page_fields"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON_WORKER_QUERIES:
        assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan
    assert "FileScan parquet" in plan or "Scan parquet" in plan or "ReadSchema" in plan


def test_jobs_view_reads_only_needed_columns(spark):
    df = E.queries()["l3_search_facets"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # orders: only the join key and the date reach the reader
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
