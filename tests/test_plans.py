"""Physical-plan checks: the properties the design relies on at scale."""

import pytest

from conftest import SF_SMALL

from encore.registry import build

Q = build().queries


def plan_of(spark, name):
    df = Q[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_trailing_windows_is_one_pruned_scan_without_expand(spark):
    from encore.operators.windows import trailing_windows
    from encore.sources.standins import standin

    df = trailing_windows(standin(spark, SF_SMALL, "plays"), "20240130")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "PartitionFilters: [isnotnull(data_dt" in plan
    assert "Expand" not in plan
    assert "SortAggregate" not in plan          # int day keeps both stages hash aggregates
    # only the three needed columns are read
    assert "ReadSchema: struct<song_id:bigint,uid:bigint,order_id:bigint>" in plan


def test_top_influence_limits_before_the_shuffle(spark):
    plan = plan_of(spark, "top_influence")
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", sorted(Q))
def test_no_single_task_or_cross_product(spark, name):
    plan = plan_of(spark, name)
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", ["song_features", "machine_stats", "machine_dim", "client_log_parse",
                                  "newly_active_users", "song_dim"])
def test_no_python_in_relational_jobs(spark, name):
    plan = plan_of(spark, name)
    assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "PythonUDF" not in plan
