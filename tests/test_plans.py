"""Plan properties of every registered query."""

import pytest

from pricelens.plans.registry import all_queries

from conftest import SF_SMALL

QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_row_udf(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name == "forecast_additive":
        assert "FlatMapGroupsInPandas" in plan
    else:
        assert "FlatMapGroupsInPandas" not in plan


def test_line_items_are_scanned_once(spark):
    # sparkPlan: the physical plan before AQE (an executed AQE plan prints
    # both its final and its initial form)
    plan = QUERIES["weekly_summary"](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet [l_") == 1


def test_filters_reach_the_scan(spark):
    plan = QUERIES["delivery_margins"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in plan


def _physical(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_product_facet_reaches_the_part_scan(spark):
    plan = _physical(QUERIES["regional_comparison"](spark, SF_SMALL))
    part_scan = [line for line in plan.splitlines() if "FileScan parquet [p_partkey" in line][0]
    assert "In(p_type, [PROMO,STANDARD])" in part_scan or "In(p_type, [STANDARD,PROMO])" in part_scan


def test_national_and_regional_rows_share_one_aggregation(spark):
    plan = _physical(QUERIES["silver_prices"](spark, SF_SMALL))
    assert plan.count("Expand") == 1
    assert plan.count("FileScan parquet [l_") == 1


def test_zones_are_not_shuffled_for_the_margin_join(spark):
    plan = _physical(QUERIES["delivery_margins"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "c_custkey" not in line and "padd_region" not in line


def test_weekly_window_is_fused(spark):
    plan = _physical(QUERIES["weekly_summary"](spark, SF_SMALL))
    assert plan.count("Window [") == 1


def test_baseline_forecast_has_no_join_back(spark):
    plan = _physical(QUERIES["forecast_linear_seasonal"](spark, SF_SMALL))
    upstream_joins = plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin")
    adapter_joins = _physical(QUERIES["weekly_summary"](spark, SF_SMALL))
    # the horizon rows open from the last row of the history: no second upstream
    assert upstream_joins == (adapter_joins.count("SortMergeJoin")
                              + adapter_joins.count("BroadcastHashJoin"))
