"""Streams over several files: late rows, panes, sinks, joins."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import timewindows
from weirflow.streaming import jobs, panes, sinks, sources

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("k", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("v", T.DoubleType())])


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def write_batches(spark, folder, batches):
    """One file per micro-batch, read in the order of their times."""
    import os
    import time

    for i, rows in enumerate(batches):
        part = f"{folder}/b{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.utime(f"{part}/{name}", (time.time() - 1000 + 10 * i,) * 2)
    return sources.parquet_stream(spark, f"{folder}/*", SCHEMA, files_per_trigger=1)


def test_late_rows_are_dropped_after_the_lateness(spark, tmp_path):
    stream = write_batches(spark, str(tmp_path), [
        [(1, "a", at(5), 1.0)], [(2, "a", at(65), 1.0)], [(3, "a", at(6), 1.0)],  # within ten minutes: counted
        [(4, "a", at(120), 1.0)], [(7, "z", at(121), 1.0)],  # Spark drops by the watermark of the batch before
        [(5, "a", at(7), 1.0)], [(6, "a", at(300), 1.0)]])
    out = sinks.drain_to_files(timewindows.sums_by_window(stream.withWatermark("ts", "10 minutes"), "ts", "k", "v", "1 hour"), "t")
    assert {r.window_start: r.n for r in out.filter("k = 'a'").collect()} == {at(0): 2, at(60): 1, at(120): 1}


@pytest.fixture(scope="module")
def pane_batches():
    first = [(i, "a", at(i % 50), 1.0) for i in range(25)]
    second = [(100 + i, "a", at(10 + i), 2.0) for i in range(12)] + [(200, "b", at(30), 5.0)]
    closing = [(300, "z", at(64), 0.0)]
    late = [(400 + i, "a", at(59), 3.0) for i in range(6)]
    end = [(500, "z", at(200), 0.0)]
    return [first, second, closing, late, end, [(501, "z", at(400), 0.0)]]


def test_panes(spark, tmp_path, pane_batches):
    jobs.use_rocksdb(spark)
    logs = {}
    for mode in panes.MODES:
        stream = write_batches(spark, str(tmp_path / mode), pane_batches)
        out = sinks.drain_to_files(panes.window_panes(stream, "k", "ts", "v", mode=mode), mode)
        logs[mode] = [r for r in out.orderBy("key", "window_start", "pane_no").collect() if r.window_start == at(0)]
    acc, dis = ([r for r in logs[m] if r.key == "a"] for m in panes.MODES)
    assert [r.pane for r in acc] == ["early", "early", "on_time", "late"]
    assert [r.n for r in acc] == [25, 37, 37, 43]
    assert [r.n for r in dis] == [25, 12, 0, 6]
    assert sum(r.n for r in dis) == acc[-1].n and sum(r.total for r in dis) == pytest.approx(acc[-1].total)
    assert [(r.pane, r.n, r.total) for r in logs["accumulating"] if r.key == "b"] == [("on_time", 1, 5.0)]


def test_retracting_is_refused(spark, tmp_path):
    stream = write_batches(spark, str(tmp_path), [[(1, "a", at(1), 1.0)]])
    with pytest.raises(ValueError):
        panes.window_panes(stream, "k", "ts", "v", mode="retracting")


def test_sessions_equal_batch(spark, tmp_path):
    rows = [(i, "u", at(m), 1.0) for i, m in enumerate([0, 10, 45, 76, 77, 200])]
    stream = write_batches(spark, str(tmp_path), [rows, [(99, "u", at(1000), 1.0)]])
    out = sinks.drain_to_files(jobs.session_stream(stream.withWatermark("ts", "10 minutes"), "k", "ts", "k"), "s")
    got = sorted((r.session_start, r.last_event, r.total_events) for r in out.collect())
    assert got == [(at(0), at(10), 2), (at(45), at(45), 1), (at(76), at(77), 2), (at(200), at(200), 1)]


def test_dedup_and_absent_sink(spark, tmp_path):
    rows = [(i, "a", at(i), 1.0) for i in range(10)]
    stream = write_batches(spark, str(tmp_path), [rows, rows[:5] + [(50, "a", at(12), 1.0)]])
    assert sinks.drain_to_files(jobs.deduplicated(stream, "id", "ts", "1 hour"), "d").count() == 11
    base = sinks.drain_batches(stream, "a", lambda df, no, b: sinks.insert_if_absent(df, no, f"{b}/out", "id"), mode="append")
    assert spark.read.parquet(f"{base}/out").count() == 11
    # A batch that is run again replaces its own rows.
    again = spark.createDataFrame(rows[:5] + [(50, "a", at(12), 1.0)], SCHEMA)
    sinks.insert_if_absent(again, 1, f"{base}/out", "id")
    assert spark.read.parquet(f"{base}/out").count() == 11


def test_interval_join(spark, tmp_path):
    left = write_batches(spark, str(tmp_path / "l"), [[(1, "a", at(0), 1.0), (2, "b", at(0), 1.0)]])
    right = write_batches(spark, str(tmp_path / "r"), [[(10, "a", at(5), 1.0), (11, "a", at(50), 1.0)]])
    l = left.select("k", F.col("ts").alias("lt"), "id").withWatermark("lt", "1 hour")
    r = right.select("k", F.col("ts").alias("rt"), F.col("id").alias("rid")).withWatermark("rt", "1 hour")
    out = sinks.drain_to_files(jobs.interval_join(l, r, "k", "lt", "rt", "30 minutes"), "j")
    assert [(x.id, x.rid) for x in out.collect()] == [(1, 10)]


def test_topic_of_json_lines(spark, tmp_path):
    lines = [json.dumps({"event_type": "a", "timestamp": "2024-01-01T00:00:10Z", "value": 2.0}), "not json", json.dumps({"event_type": "b", "value": 1.0})]
    (tmp_path / "m.txt").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("timestamp", T.StringType()), T.StructField("value", T.DoubleType())])
    rows = sources.parsed_events(sources.text_topic(spark, str(tmp_path)), schema, "timestamp", "1 minute", keep_undated=False)
    assert [r.event_type for r in sinks.drain_to_files(rows, "topic").collect()] == ["a"]
    both = sources.parsed_events(sources.text_topic(spark, str(tmp_path)), schema, "timestamp", "1 minute")
    assert sinks.drain_to_files(both, "topic").count() == 2


def test_table_sink_fan_out_and_alerts(spark, tmp_path):
    rows = [(i, "a", at(i), float(i)) for i in range(10)]
    stream = write_batches(spark, str(tmp_path / "in"), [rows[:5], rows[5:]])
    spark.sql("DROP TABLE IF EXISTS stream_out")
    q = sinks.start_table(stream, "stream_out", str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.table("stream_out").count() == 10
    base = jobs.fan_out(stream, "f", {"raw": lambda b: b, "big": lambda b: b.filter("v > 6")})
    assert spark.read.parquet(f"{base}/raw").count() == 10 and spark.read.parquet(f"{base}/big").count() == 3
    alert = spark.createDataFrame([("X", "l", "c", 1.0, 500, "HIGH", "r")], "alert_type string, loan_id string, customer_id string, amount double, credit_score int, risk_category string, region string")
    assert json.loads(sinks.alert_messages(alert).first().value)["loan_id"] == "l"
    assert sinks.audit_rows(alert, F.lit("2024-01-01").cast("timestamp")).first().status == "OPEN"


def test_session_types_include_all_and_join_across_batches(spark, tmp_path):
    kinds = lambda rows: [(i, k, at(m), 1.0) for i, k, m in rows]
    stream = write_batches(spark, str(tmp_path), [
        kinds([(1, "view", 0), (2, "odd \"type\"", 5), (3, "buy", 50)]), kinds([(4, "view", 100)]), kinds([(5, "buy", 27)]),  # late: joins the first two sessions
        kinds([(6, None, 130)]), [(99, "z", at(9000), 1.0)]])
    rows = stream.withColumn("u", F.lit("u")).withWatermark("ts", "1 day")
    got = sorted((r.session_start, r.last_event, r.total_events, json.loads(r.event_types), r.most_common_event) for r in sinks.drain_to_files(jobs.session_stream(rows, "u", "ts", "k"), "s").collect())
    assert got == [(at(0), at(50), 4, {"buy": 2, 'odd "type"': 1, "view": 1}, "buy"), (at(100), at(130), 2, {"unknown": 1, "view": 1}, "unknown")]


def test_clock_panes_equal_a_replayed_list(spark, tmp_path):
    """Rows (minute, arrival in seconds): early panes after 60 s, the end at 3,600 + 30 s, late panes after 300 s, up to an hour late."""
    came = [(1, 10), (2, 40), (3, 71), (4, 3_000), (5, 3_629), (6, 3_630), (7, 3_900), (8, 3_931), (9, 7_100), (10, 7_229), (11, 7_230), (12, 9_000)]
    want = [("early", 2), ("early", 3), ("early", 4), ("on_time", 5), ("late", 7), ("late", 8), ("late", 10)]
    jobs.use_rocksdb(spark)
    second = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    for parts in (1, 3, 12):  # the panes do not depend on the micro-batches
        size = len(came) // parts
        rows = [(i, str(second(s)), at(m), 1.0) for i, (m, s) in enumerate(came)]
        batches = [rows[i : i + size] for i in range(0, len(rows), size)]
        stream = write_batches(spark, str(tmp_path / str(parts)), batches + [[(99, str(second(99_999)), at(90_000), 0.0)]])
        rows = stream.withColumns({"arrived": F.col("k").cast("timestamp"), "k": F.lit("a")})
        out = sinks.drain_to_files(panes.clock_panes(rows, "k", "ts", "arrived", "v", skew_seconds=30, lateness_seconds=3600), "clock")
        assert [(r.pane, r.n) for r in out.orderBy("window_start", "pane_no").collect() if r.window_start == at(0)] == want


def test_rows_too_late_for_their_window_are_dropped_in_any_arrow_batch(spark, tmp_path):
    jobs.use_rocksdb(spark)
    late = [(i, "a", at(5), 1.0) for i in range(3)] + [(9, "a", at(200), 1.0)]
    for size in ("1", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        stream = write_batches(spark, str(tmp_path / size), [[(1, "a", at(1), 1.0)], [(2, "a", at(190), 1.0)], late, [(3, "z", at(900), 1.0)]])
        out = sinks.drain_to_files(panes.window_panes(stream, "k", "ts", "v"), "drop")
        assert [(r.pane, r.n) for r in out.orderBy("window_start", "pane_no").collect()] == [("on_time", 1), ("on_time", 2)]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_fraud_in_one_pass(spark, tmp_path):
    from weirflow.streaming import fraud

    jobs.use_rocksdb(spark)
    row = lambda i, k, m, v: (i, k, at(m), v)
    first = [row(1, "a", 0, 10.0), row(2, "a", 5, 40.0), row(3, "a", 6, None)]
    second = [row(4, "b", 400, 20.0), row(5, "a", 3, 11.0), row(6, None, 401, 5.0)]  # 5 is late, but its bucket has not been judged
    stream = write_batches(spark, str(tmp_path), [first, second, [row(9, None, 99_999, 0.0)]]).withColumn("u", F.when(F.col("id") < 9, 1))
    out = sinks.drain_to_files(fraud.fraud_stream(stream, "id", "u", "ts", "k", "v", late_after="10 hours"), "fraud")
    assert sorted((r.event_id, r.rules) for r in out.collect()) == [(1, "velocity,new_type"), (2, "velocity,amount"), (3, "velocity"), (4, "new_type"), (5, "velocity"), (6, "new_type")]


def test_metrics_merge_once_after_a_repeated_batch(spark, tmp_path):
    outputs = jobs.loan_outputs(F.lit("LOW"), 1e9)
    loans = lambda rows: spark.createDataFrame([(at(m), "r", "t", a, s) for m, a, s in rows], "ts timestamp, region string, loan_type string, amount double, credit_score int")
    folder = str(tmp_path / "metrics")
    for number, rows in ((0, [(1, 10.0, 500), (2, 20.0, None)]), (1, [(3, 5.0, 700), (7, 1.0, 600)]), (1, [(3, 5.0, 700), (7, 1.0, 600)])):
        sinks.write_batch(outputs["metrics"](loans(rows)), number, folder)
    got = [tuple(r)[4:] for r in jobs.merged_metrics(spark.read.parquet(folder)).orderBy("window_start").collect()]
    assert got == [(3, 35.0, 600.0, 1), (1, 1.0, 600.0, 0)]


def test_feed_is_one_unsorted_file_a_batch_in_small_row_groups(spark):
    import pyarrow.parquet as pq

    from weirflow.streaming import feeds

    rows = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.timestamp_seconds(F.col("id") * 7919 % 400_000).alias("ts"))
    stream = feeds.replay(rows, "ts", "one", closing=("ts",))
    seen = []
    base = sinks.drain_batches(stream, "one", lambda df, no, b: seen.append([r for r in df.agg(F.min("ts"), F.max("ts"), F.count("*")).first()]), mode="append")
    assert base and [n for *_, n in seen][-1] == 1 and sum(n for *_, n in seen) == 400_001 and len(seen) == feeds.SLICES + 1
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    files = [f.removeprefix("file://").removeprefix("file:") for f in spark.read.parquet(stream._jdf.queryExecution().analyzed().toString().split("FileSource[")[1].split("]")[0]).inputFiles()]
    assert len(files) == feeds.SLICES + 1 and max(pq.ParquetFile(f).num_row_groups for f in files) > 1


def test_fraud_has_one_timer_and_few_state_calls_a_user():
    from types import SimpleNamespace

    from pyspark.sql import Row

    from weirflow.streaming import fraud

    class State:
        """A user's state and timers in place of Spark's; counts the calls."""
        calls, timers = 0, set()

        def __init__(self, *_):
            self.rows, self.value = [], None

        def __getattribute__(self, name):
            State.calls += not name.startswith("_") and name not in ("rows", "value")
            return object.__getattribute__(self, name)

        def exists(self):
            return bool(self.rows) or self.value is not None

        def appendValue(self, v):
            self.rows.append(v)

        def appendList(self, v):
            self.rows += v

        def put(self, v):
            self.rows = list(v)

        def clear(self):
            self.rows = []

        def get(self):
            return self.value if self.value is not None else iter(self.rows) if self.rows else None

        def update(self, v):
            self.value = v

    def remove(t):
        State.timers.discard(t)

    handle = SimpleNamespace(getListState=State, getValueState=State, registerTimer=State.timers.add, deleteTimer=remove)
    p = fraud.FraudProcessor(1000, 3, 3.0)
    p.init(handle)
    clock = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    rows = [Row(us=i * 1_000_000, event_id=i, kind="ab"[i % 2], cents=100, value=1.0 + 9 * (i == 150)) for i in range(1, 201)]
    assert list(p.handleInputRows((7, True), iter(reversed(rows)), clock(0))) == []
    assert State.timers == {2000} and State.calls < 6
    State.timers.clear()
    first = list(p.handleExpiredTimer((7, True), clock(100_000), SimpleNamespace(getExpiryTimeInMs=lambda: 2000)))
    assert [(r.event_id, r.rules) for r in first] == [(1, "new_type"), (2, "new_type")] and State.timers == {101_000}
    second = list(p.handleExpiredTimer((7, True), clock(300_000), SimpleNamespace(getExpiryTimeInMs=lambda: 101_000)))
    assert [(r.event_id, r.rules) for r in second] == [(150, "amount")] and State.calls < 20
