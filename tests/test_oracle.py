"""Every registered query against its SQL, value by value; the windowed ones also with forced segments."""

import pytest
from compare import compare, connect

from weirflow import registry
from weirflow.plans.segments import SEGMENT_BYTES_CONF

QUERIES, SQL = registry.queries(), registry.oracles()
SEGMENTED = [
    "balance_reset", "sessionize", "outlier_p95", "percentiles", "ordered_funnel", "pattern_match", "running_total",
    "change_detect", "ntile_buckets", "ntile_table", "bounded_window", "rank_family", "scd2_build", "moving_stats",
    "asof_scd2", "nest_items", "ordered_array", "session_summary", "session_metrics", "fraud_rules", "time_weighted",
    "corr_cumulative", "vault_load", "unit_fix", "duration_alert",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert compare(con, df, SQL[name]) is None
    else:
        assert df.columns and df.count() > 0


@pytest.mark.parametrize("name", SEGMENTED)
def test_query_with_forced_segments(spark, con, sf_dir, name):
    spark.conf.set(SEGMENT_BYTES_CONF, "0")
    try:
        assert compare(con, QUERIES[name](spark, sf_dir), SQL[name]) is None
    finally:
        spark.conf.unset(SEGMENT_BYTES_CONF)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
