"""Known results on the sample rows."""

import pytest
from fixtures import ACTIVITY, HOURLY_SALES, SENSOR_WINDOWS, SENSORS, SESSIONS_5_COUNT, SESSIONS_30, TRANSACTIONS
from pyspark.sql import functions as F

from weirflow.operators import sessions, timewindows


def frame(spark, text, names, numbers=()):
    rows = [tuple(line.split(",")) for line in text.strip().splitlines()]
    df = spark.createDataFrame(rows, names).withColumn("ts", F.to_timestamp("ts"))
    return df.withColumns({n: F.col(n).cast("double") for n in numbers}) if numbers else df


def test_hourly_sales(spark):
    df = frame(spark, TRANSACTIONS, ["id", "user", "ts", "category", "amount", "region"], ["amount"])
    got = timewindows.sales_by_window(df, "ts", "region", "amount", "category")
    rows = got.select(F.hour("window_start"), "region", "total_sales", "transaction_count", "avg_transaction_value", "top_category")
    assert sorted(tuple(r) for r in rows.collect()) == sorted(HOURLY_SALES)


def test_sliding_sensors(spark):
    df = frame(spark, SENSORS, ["sensor", "device", "ts", "temperature", "humidity", "location"], ["temperature", "humidity"])
    got = timewindows.sensor_by_window(df, "ts", "sensor", "device", "location", "temperature", "humidity")
    rows = {(r.s, r.sensor_id): r for r in got.withColumn("s", F.date_format("window_start", "HH:mm")).collect()}
    assert len(rows) == len(SENSOR_WINDOWS)
    for start, sensor, *values in SENSOR_WINDOWS:
        r = rows[(start, sensor)]
        assert [r.avg_temperature, r.avg_humidity, r.max_temperature, r.min_temperature, r.reading_count] == pytest.approx(values, abs=0.0101)
        assert r.device_id == "IOT_DEV_" + sensor[-3:]


@pytest.fixture(scope="module")
def activity(spark):
    return frame(spark, ACTIVITY, ["event_id", "user", "ts", "event_type", "action", "session_id"])


def test_sessions(activity):
    first = F.min_by("session_id", "ts").alias("first_session")
    got = sessions.session_summary(activity, "user", "ts", "event_id", sessions.gap_exceeds_seconds(1800), [first])
    clock = lambda c: F.date_format(c, "HH:mm:ss")
    end = F.col("session_end") + F.expr("interval 30 minutes")
    rows = got.select("user", clock("session_start"), clock(end), "event_count", "first_session")
    assert sorted(tuple(r) for r in rows.collect()) == sorted(SESSIONS_30)
    short = sessions.session_summary(activity, "user", "ts", "event_id", sessions.gap_exceeds_seconds(300), [])
    assert short.count() == SESSIONS_5_COUNT


def test_session_paths_in_parts(activity):
    gap = sessions.gap_exceeds_seconds(1800)
    whole = sessions.session_paths(activity, "user", "ts", "event_id", gap, "event_type", "types")
    assert whole.filter("part_no > 0").isEmpty()
    from weirflow.plans.lists import ordered_lists

    marked = sessions.mark_sessions(activity, "user", "ts", "event_id", gap)
    parts = ordered_lists(marked, ["user", "session_no"], ["ts", "event_id"], {"types": ["event_type"]}, part_rows=2)
    joined = {}
    for r in parts.orderBy("part_no").collect():
        joined.setdefault((r.user, r.session_no), []).extend(r.types)
        assert r.item_count <= 2
    assert joined == {(r.user, r.session_no): r.types for r in whole.collect()}


def test_exactly_one_gap_apart_is_one_session(spark):
    df = spark.createDataFrame([(1, "u", "2024-01-01 10:00:00"), (2, "u", "2024-01-01 10:30:00"), (3, "u", "2024-01-01 11:00:01")], "id int, u string, t string")
    df = df.withColumn("ts", F.to_timestamp("t"))
    assert sessions.session_summary(df, "u", "ts", "id", sessions.gap_exceeds_seconds(1800), []).count() == 2
    assert sessions.session_summary(df, "u", "ts", "id", sessions.gap_exceeds_minutes(30), []).count() == 1
