"""What physical plans of the library's own queries must not contain."""

import pytest

import __spark_entry__  # noqa: F401
from checks.base import QUERIES

WRITING = ("cdc", "load_delta", "stream", "ingest", "generations", "sync_tables", "written", "validate",
           "raw_orders", "touched", "by_bucket")
LAZY = [n for n in sorted(QUERIES) if not any(w in n for w in WRITING)]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow", "SinglePartition, REPARTITION"):
        assert word not in plan


@pytest.mark.parametrize("name", ["snapshot_delta_orders", "merge_resurrect_orders", "next_snapshot_orders", "scd2_history_orders", "timestamp_delta_orders"])
def test_large_sides_are_joined_by_shuffle(spark, sf, shuffled, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)


@pytest.mark.parametrize("name", ["load_delta_orders", "merge_widened_value_orders", "snapshot_cdc_retyped_orders", "stream_merge_orders", "timestamp_cdc_delta_orders"])
def test_no_cross_join_and_no_python_on_the_way(spark, sf, name):
    """The plans of everything that a writing query runs, not of its result alone."""
    seen = spark._jsparkSession.sharedState().statusStore()
    before = seen.executionsCount()
    QUERIES[name](spark, sf).count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executions = seen.executionsList()
    plans = [executions.apply(k).physicalPlanDescription() for k in range(executions.size())][before:]
    assert len(plans) > 5
    for plan in plans:
        for word in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow", "SinglePartition, REPARTITION"):
            assert word not in plan
