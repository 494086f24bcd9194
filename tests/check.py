"""Run registered queries against their SQL: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import compare, connect  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from weirflow.session import build_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    directory = f"/root/testdata/sf{sf}"
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"}
    if os.environ.get("SEGMENT_BYTES"):
        conf["spark.weirflow.segment.bytes"] = os.environ["SEGMENT_BYTES"]
    spark = build_session("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    todo, sql = entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name in names or todo:
        if name.endswith("*"):
            continue
        start = time.time()
        try:
            df = todo[name](spark, directory)
            problem = compare(con, df, sql[name]) if name in sql else f"rows-only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        took = time.time() - start
        if problem and not problem.startswith("rows-only"):
            bad += 1
        print(f"{'ok  ' if problem is None else 'DIFF' if not problem.startswith('rows') else 'rows'} {name} {took:.2f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
