"""Shapes of physical plans."""

import pytest

from weirflow import registry
from weirflow.plans.joins import BROADCAST_BYTES_CONF

EAGER = {"ml_train", "ml_predict", "ml_evaluate", "hierarchy_paths", "descendants", "lineage_impact"}
STREAMS = {
    "stream_sales", "stream_sensor", "stream_sessions", "stream_event_stats", "late_data", "discarding_append", "accumulating_update",
    "panes_accumulating", "panes_discarding", "panes_log", "stream_dedup", "insert_absent_sink", "stream_static_join", "stream_fan_out",
    "stream_batch_recon",
}
QUERIES = registry.queries()


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER - STREAMS))
def test_no_cross_join_and_no_row_python(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert node not in text
    if name != "risk_pandas_udf":
        assert "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["latest_per_key", "second_highest", "top_count", "loan_etl", "dedup_by_fields", "mode_per_group"])
def test_rank_limits_reach_the_map_side(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@pytest.mark.parametrize("name", ["scan_pruned", "field_filter", "recent_windows", "future_dates", "daily_counts"])
def test_filters_reach_the_reader(spark, sf_dir, name):
    assert "PushedFilters: [IsNotNull" in plan(spark, sf_dir, name)


def test_broadcast_only_when_small(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(spark, sf_dir, "broadcast_join")
        spark.conf.set(BROADCAST_BYTES_CONF, "1000")
        assert "BroadcastHashJoin" not in plan(spark, sf_dir, "broadcast_join")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset(BROADCAST_BYTES_CONF)
