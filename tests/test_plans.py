"""Properties every physical plan must have to hold on large tables."""

import pytest

import __spark_entry__ as entry
from gleanwork import workload

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan, plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # Only partial results may meet in one task: aggregates or the rows of a top-k.
            below = " ".join(lines[i + 1:i + 5])
            assert "partial_" in below or "LocalLimit" in below or "TakeOrdered" in below, plan
        if "+- Window [" in line or line.lstrip(" :").startswith("Window ["):
            assert "Exchange SinglePartition" not in " ".join(lines[i + 1:i + 4]), plan


def test_columns_are_pruned(spark):
    plan = plan_of(entry.queries()["keyword_filter_any"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = plan_of(entry.queries()["page_status"](spark, SF))
    assert "WholeStageCodegen" in plan or "*(1)" in plan
    assert "Python" not in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(entry.queries()["add_missing_ids"](spark, SF))
    assert "GreaterThan(p_size,40)" in plan and "GreaterThanOrEqual(l_quantity,50.0)" in plan
