"""Plan properties that matter at scale, asserted on the executed plans."""

import os

import pytest

import __spark_entry__ as entry
from fixtures import plan_text

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF_DIR}/orders.parquet"), reason="test data not present")


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    df.write.format("noop").mode("overwrite").save()
    return plan_text(df)


def test_top1_per_key_limits_before_the_shuffle(spark):
    plan = _plan(spark, "latest_per_key")
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial limit sits below the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_density_is_one_partial_aggregation_without_a_window(spark):
    plan = _plan(spark, "density_classify")
    assert "Window" not in plan and plan.count("Exchange") == 1 and "partial_" in plan


def test_hash_grouping_is_partially_aggregated(spark):
    plan = _plan(spark, "content_hash_dedup")
    assert "partial_min" in plan and "partial_count" in plan


def test_whitespace_profile_does_not_explode_pages(spark):
    assert "Generate" not in _plan(spark, "whitespace_profile")


def test_low_cardinality_lookups_are_broadcast(spark):
    for name in ("manifest_entries", "resolve_fact_keys", "high_water_mark", "star_join_leaf_sum"):
        assert "BroadcastHashJoin" in _plan(spark, name), name


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "high_water_mark")
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in plan
    key = _plan(spark, "key_profile")
    assert "ReadSchema: struct<o_custkey:bigint>" in key


def test_grand_total_is_a_scalar_subquery_not_a_join(spark):
    plan = _plan(spark, "share_of_total")
    assert "Subquery" in plan and "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
