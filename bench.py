"""Time the headline queries: one JSON line with the seconds of each.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the local threads, ``BENCH_QUERIES`` an optional
comma-separated list in place of the default one. Results go to a sink that discards rows, so the whole
result is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weirflow import registry  # noqa: E402
from weirflow.session import build_session  # noqa: E402

HEADLINE = [
    "loan_etl", "word_count", "star_join", "region_sales", "event_stats", "sliding_sensor", "session_summary", "sessionize",
    "balance_reset", "outlier_p95", "percentiles", "running_total", "rank_family", "second_highest", "scd2_build", "asof_scd2",
    "moving_stats", "pattern_match", "fraud_rules", "range_self_join", "salted_join", "hot_key_join", "nest_items", "ledger_recon",
    "cdc_merge", "upsert", "snapshot_check", "incremental_lookback", "schema_tests", "pii_scan", "dedup_events", "stream_sales",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
           "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = registry.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in todo]
    spark.read.parquet(f"{directory}/lineitem.parquet").selectExpr("sum(l_quantity)").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        todo[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(directory).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
