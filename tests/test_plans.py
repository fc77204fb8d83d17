"""Plan guards for every registered query: no cross/nested-loop joins, no row-at-a-time
Python, Python only where archives are parsed, pruning and pushdown where expected."""

import re

import pytest

import __spark_entry__ as entry
from meridian.plans import suite
from tests.conftest import SMALL

PYTHON_OK = {"sheet_roundtrip", "sheet_archive_errors"}


def _plan(spark, name):
    df = entry.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(suite.QUERIES))
def test_no_cross_join_no_row_python(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON_OK:
        assert not re.search(r"ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


def test_projection_pruned_and_filter_pushed(spark):
    conform = entry.queries()["dq_report"](spark, SMALL)
    formatted = conform._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", formatted)
    assert schemas and all("acctbal" not in s for s in schemas)
    project = entry.queries()["record_project"](spark, SMALL)
    formatted = project._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(o_orderstatus,F)" in formatted
