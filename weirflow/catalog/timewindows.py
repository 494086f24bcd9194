"""Event-time windows on whole tables: the batch side of the streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog.standins import LOANS_SQL, davg, dsum, events_utc, loans, ntz, r2
from weirflow.functions import scales
from weirflow.functions.fixed import RISK_5
from weirflow.operators import sessions, timewindows
from weirflow.plans import dedup
from weirflow.plans.lists import ordered_lists
from weirflow.plans.segments import plan_cuts, running_window
from weirflow.registry import query

BOUNDS = ("window_start", "window_end")


def tumbling(minutes: int, column: str = "ts") -> str:
    return f"time_bucket(INTERVAL {minutes} MINUTE, {column}) AS window_start, time_bucket(INTERVAL {minutes} MINUTE, {column}) + INTERVAL {minutes} MINUTE AS window_end"


def sliding_source(length: int, slide: int, columns: str = "*") -> str:
    """Each event once per window that holds it."""
    return (f"(SELECT {columns}, time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL {slide} MINUTE * k AS window_start, "
            f"time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL {slide} MINUTE * k + INTERVAL {length} MINUTE AS window_end FROM events, range({length // slide}) r(k))")


def sales_stream(df):
    """Events as sales: region, category, amount."""
    return df.select("event_id", "ts", F.col("event_type").alias("region"), F.concat(F.lit("c"), (F.col("user_id") % 5).cast("string")).alias("category"), F.col("value").alias("amount"))


def eavg(x: str) -> str:
    return r2(f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE) / COUNT({x})")


SALES_STREAM = "(SELECT event_id, ts, event_type AS region, concat('c', user_id % 5) AS category, value AS amount FROM events)"


@query("tumbling_sales", f"""WITH s AS (SELECT *, time_bucket(INTERVAL 60 MINUTE, ts) AS w FROM {SALES_STREAM}), c AS (SELECT w, region, category, COUNT(*) AS n FROM s GROUP BY 1, 2, 3),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY w, region ORDER BY n DESC, category) AS rn FROM c) WHERE rn = 1)
 SELECT s.w AS window_start, s.w + INTERVAL 60 MINUTE AS window_end, s.region, {dsum('amount')} AS total_sales, COUNT(*) AS transaction_count, {davg('amount')} AS avg_transaction_value, MIN(b.category) AS top_category
 FROM s JOIN b ON s.w = b.w AND s.region = b.region GROUP BY s.w, s.region""")
def tumbling_sales(t):
    return ntz(timewindows.sales_by_window(sales_stream(events_utc(t)), "ts", "region", "amount", "category"), *BOUNDS)


def sensor_stream(df):
    return df.select(
        "event_id", "ts", F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("sensor_id"), F.concat(F.lit("D"), (F.col("event_id") % 3).cast("string")).alias("device_id"),
        F.col("event_type").alias("location"), F.col("value").alias("temperature"), (F.col("value") / 2).alias("humidity"))


@query("sliding_sensor", f"""SELECT window_start, window_end, concat('S', user_id) AS sensor_id, concat('D', arg_min(event_id, (ts, event_id)) % 3) AS device_id, arg_min(event_type, (ts, event_id)) AS location, {eavg('value')} AS avg_temperature, {eavg('(value / 2)')} AS avg_humidity,
 {r2('MAX(value)')} AS max_temperature, {r2('MIN(value)')} AS min_temperature, COUNT(*) AS reading_count FROM {sliding_source(10, 5)} GROUP BY 1, 2, user_id""")
def sliding_sensor(t):
    return ntz(timewindows.sensor_by_window(sensor_stream(events_utc(t)), "ts", "sensor_id", "device_id", "location", "temperature", "humidity", row_id="event_id"), *BOUNDS)


GAP_SQL = """g AS (SELECT *, lag(ts) OVER (PARTITION BY u ORDER BY ts, event_id) AS p FROM src),
 f AS (SELECT *, CAST(SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL {minutes} MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY u ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sn FROM g)"""


@query("session_summary", f"""WITH src AS (SELECT event_id, ts, user_id AS u, event_type FROM events), {GAP_SQL.format(minutes=30)},
 h AS (SELECT u, sn, string_agg(concat('"', event_type, '":', n), ',' ORDER BY event_type) AS hs FROM (SELECT u, sn, event_type, COUNT(*) AS n FROM f GROUP BY 1, 2, 3) GROUP BY 1, 2)
 SELECT f.u AS user_id, arg_min(f.event_id, (f.ts, f.event_id)) AS session_id, MIN(f.ts) AS session_start, MAX(f.ts) AS session_end, MIN(f.ts) AS window_start, MAX(f.ts) + INTERVAL 30 MINUTE AS window_end, COUNT(*) AS event_count, 0 AS part_no,
 string_agg(f.event_type, ',' ORDER BY f.ts, f.event_id) AS event_types, concat('{{', MIN(h.hs), '}}') AS event_summary FROM f JOIN h ON f.u = h.u AND f.sn = h.sn GROUP BY f.u, f.sn""")
def session_summary(t):
    """Sessions with a 30 minute gap: bounds, ordered types (in parts of 10,000) and counts per type."""
    rows = t.events.select("event_id", "ts", "user_id", "event_type")
    cuts = plan_cuts(rows, ["ts", "event_id"], keys=["user_id"])
    marked = sessions.mark_sessions(rows, "user_id", "ts", "event_id", sessions.gap_exceeds_seconds(1800), cuts=cuts)
    keys = ["user_id", "session_no"]
    main = marked.groupBy(*keys).agg(
        F.min(F.struct("ts", "event_id"))["event_id"].alias("session_id"), F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("event_count"))
    counts = sessions.type_counts(marked, keys, "event_type").select(*keys, "event_summary")
    types = ordered_lists(marked, keys, ["ts", "event_id"], {"event_types": ["event_type"]}, cuts=cuts).drop("item_count")
    joined = main.join(counts, keys).join(types, keys)
    return joined.select(
        "user_id", "session_id", "session_start", "session_end", F.col("session_start").alias("window_start"),
        (F.col("session_end") + F.expr("interval 30 minutes")).alias("window_end"), "event_count", "part_no", F.concat_ws(",", "event_types").alias("event_types"), "event_summary")


@query("session_metrics", f"""WITH src AS (SELECT event_id, ts, CASE WHEN event_id % 20 = 0 THEN 'anonymous' ELSE CAST(user_id AS VARCHAR) END AS u, event_type FROM events), {GAP_SQL.format(minutes=5)},
 c AS (SELECT u, sn, event_type, COUNT(*) AS n FROM f GROUP BY 1, 2, 3),
 h AS (SELECT u, sn, concat('{{', string_agg(concat('"', event_type, '":', n), ',' ORDER BY event_type), '}}') AS event_types, (list(event_type ORDER BY n DESC, event_type))[1] AS most_common_event FROM c GROUP BY 1, 2)
 SELECT f.u AS user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 5 MINUTE AS session_end, CAST(date_sub('second', MIN(ts), MAX(ts) + INTERVAL 5 MINUTE) AS BIGINT) AS session_duration_seconds, COUNT(*) AS total_events, MIN(h.event_types) AS event_types, MIN(most_common_event) AS most_common_event
 FROM f JOIN h ON f.u = h.u AND f.sn = h.sn GROUP BY f.u, f.sn""")
def session_metrics(t):
    """Five minute gap; the length includes the gap; events without a user count as 'anonymous'."""
    user = F.when(F.col("event_id") % 20 != 0, F.col("user_id").cast("string"))
    rows = t.events.select("event_id", "ts", F.coalesce(user, F.lit("anonymous")).alias("user_id"), "event_type")
    marked = sessions.mark_sessions(rows, "user_id", "ts", "event_id", sessions.gap_exceeds_seconds(300))
    keys = ["user_id", "session_no"]
    end = F.max("ts") + F.expr("interval 5 minutes")
    main = marked.groupBy(*keys).agg(F.min("ts").alias("session_start"), end.alias("session_end"))
    counts = sessions.type_counts(marked, keys, "event_type").withColumnRenamed("event_summary", "event_types")
    return main.join(counts, keys).withColumn(
        "session_duration_seconds", F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end"))).drop("session_no")


@query("event_stats", f"""SELECT {tumbling(1)}, coalesce(event_type, 'unknown') AS key, COUNT(value) AS event_count, {dsum('value')} AS total_value, {davg('value')} AS avg_value, MAX(value) AS max_value, MIN(value) AS min_value FROM events GROUP BY 1, 2, 3""")
def event_stats(t):
    return ntz(timewindows.event_stats(events_utc(t), "ts", "event_type", "value"), *BOUNDS)


@query("event_stats_sliding", f"""SELECT window_start, window_end, event_type AS key, COUNT(value) AS event_count, {dsum('value')} AS total_value, {davg('value')} AS avg_value, MAX(value) AS max_value, MIN(value) AS min_value FROM {sliding_source(60, 30)} GROUP BY 1, 2, 3""")
def event_stats_sliding(t):
    return ntz(timewindows.event_stats(events_utc(t), "ts", "event_type", "value", "1 hour", "30 minutes"), *BOUNDS)


@query("velocity_alert", f"SELECT window_start, window_end, user_id, COUNT(*) AS txn_count FROM {sliding_source(360, 60)} GROUP BY 1, 2, 3 HAVING COUNT(*) > 3")
def velocity_alert(t):
    """Six hour windows and a threshold of 3: the default of 10 in 60 seconds finds nothing in these events."""
    return ntz(timewindows.velocity_alerts(events_utc(t), "ts", "user_id", 3, "6 hours", "1 hour"), *BOUNDS)


@query("fraud_rules", """WITH r AS (SELECT event_id, user_id, ts, event_type, value, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS s, COUNT(value) OVER w AS c, COUNT(*) OVER (PARTITION BY user_id, time_bucket(INTERVAL 6 HOUR, ts)) AS burst,
 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 j AS (SELECT event_id, user_id, concat_ws(',', CASE WHEN burst > 3 THEN 'velocity' END, CASE WHEN value > 3 * (s / c) THEN 'amount' END, CASE WHEN nth = 1 THEN 'new_type' END) AS rules FROM r) SELECT * FROM j WHERE rules <> ''""")
def fraud_rules(t):
    """Three rules per event: too many in a window, far above the user's mean so far, first of its kind."""
    rows = t.events.select("event_id", "user_id", "ts", "event_type", F.col("value").cast("decimal(18,2)").alias("amount"), "value")
    upto = running_window(rows, ["user_id"], ["ts", "event_id"], {"s": ("sum", "amount"), "c": ("count", "amount")})
    before_sum, before_n = (F.col("s") - F.coalesce("amount", F.lit(0))).cast("double"), F.col("c") - F.when(F.col("amount").isNotNull(), 1).otherwise(0)
    mean = F.try_divide(before_sum, before_n.cast("double"))
    bucket = F.window(F.col("ts").cast("timestamp"), "6 hours")["start"]
    bursts = rows.groupBy("user_id", bucket.alias("__w")).agg(F.count("*").alias("burst")).filter("burst > 3").select("user_id", "__w", F.lit(True).alias("__fast"))
    first = rows.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id"))["event_id"].alias("event_id")).select("event_id", F.lit(True).alias("__first"))
    judged = upto.withColumn("__w", bucket).join(bursts, ["user_id", "__w"], "left").join(first, "event_id", "left")
    rules = F.concat_ws(",", F.when(F.col("__fast"), "velocity"), F.when(F.col("value") > 3 * mean, "amount"), F.when(F.col("__first"), "new_type"))
    return judged.select("event_id", "user_id", rules.alias("rules")).filter("rules <> ''")


@query("dedup_events", "SELECT event_id, user_id, event_type, ts FROM events")
def dedup_events(t):
    """Every event delivered twice or three times, kept once."""
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    repeated = rows.unionByName(rows).unionByName(rows.filter("event_id % 3 = 0"))
    return repeated.dropDuplicates(["event_id"])


@query("dedup_by_fields", "SELECT * EXCLUDE (rn) FROM (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def dedup_by_fields(t):
    rows = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"), "ts")
    return dedup.latest_per_key(rows, ["user_id", "event_type", "day"], ["ts", "event_id"]).drop("ts")


@query("high_risk_alerts", f"""WITH {LOANS_SQL}, c AS (SELECT *, {scales.sql_case('credit_score', RISK_5, '>=')} AS risk_category FROM loans)
 SELECT 'HIGH_RISK_APPLICATION' AS alert_type, loan_id, customer_id, amount, credit_score, risk_category, region, concat_ws('; ', CASE WHEN risk_category = 'VERY_HIGH' THEN 'very high risk' END, CASE WHEN amount > 50000 THEN 'large amount' END) AS alert_reason
 FROM c WHERE risk_category = 'VERY_HIGH' OR amount > 50000""")
def high_risk_alerts(t):
    rows = loans(t).withColumn("risk_category", scales.at_least("credit_score", RISK_5))
    alerts = timewindows.high_risk_alerts(rows, "risk_category", "amount", 50_000)
    return alerts.select(F.lit("HIGH_RISK_APPLICATION").alias("alert_type"), "loan_id", "customer_id", "amount", "credit_score", "risk_category", "region", "alert_reason")


def loan_stream(df):
    """Events as loan applications with a region, a type, an amount and a score."""
    return df.select(
        "event_id", "ts", F.concat(F.lit("r"), (F.col("user_id") % 4).cast("string")).alias("region"), F.col("event_type").alias("loan_type"),
        F.col("value").alias("amount"), (300 + (F.col("event_id") * 7) % 551).cast("int").alias("credit_score"))


@query("windowed_loan_metrics", f"""SELECT {tumbling(5)}, concat('r', user_id % 4) AS region, event_type AS loan_type, COUNT(*) AS application_count, {dsum('value')} AS total_amount, {r2('CAST(SUM(300 + (event_id * 7) % 551) AS DOUBLE) / COUNT(*)', 1)} AS avg_credit_score,
 COUNT(*) FILTER (WHERE 300 + (event_id * 7) % 551 < 550) AS high_risk_count FROM events GROUP BY 1, 2, 3, 4""")
def windowed_loan_metrics(t):
    rows = loan_stream(events_utc(t))
    return ntz(timewindows.loan_metrics_by_window(rows, "ts", "region", "loan_type", "amount", "credit_score", F.col("credit_score") < 550), *BOUNDS)


@query("annotate_window", f"SELECT event_id, ts AS event_timestamp, {tumbling(60)} FROM events")
def annotate_window(t):
    marked = timewindows.with_window_bounds(events_utc(t).select("event_id", "ts"), "ts", "1 hour")
    return ntz(marked.withColumnRenamed("ts", "event_timestamp"), "event_timestamp", *BOUNDS)


@query("late_monitor", "SELECT event_id, CAST(event_id % 900 AS BIGINT) AS lateness_seconds, event_id % 900 > 300 AS is_late FROM events")
def late_monitor(t):
    arrived = t.events.select("event_id", "ts", (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") % 900)).alias("arrived"))
    return timewindows.lateness(arrived, "ts", "arrived").select("event_id", "lateness_seconds", "is_late")


@query("count_by_key_5m", f"SELECT {tumbling(5)}, event_type, COUNT(*) AS event_count FROM events GROUP BY 1, 2, 3")
def count_by_key_5m(t):
    return ntz(timewindows.counts_by_window(events_utc(t), "ts", ["event_type"], "5 minutes"), *BOUNDS)


@query("recent_windows", f"SELECT * FROM (SELECT {tumbling(60)}, event_type, COUNT(*) AS event_count FROM events GROUP BY 1, 2, 3) WHERE window_start >= TIMESTAMP '2024-01-20' - INTERVAL 24 HOUR AND window_start < TIMESTAMP '2024-01-20' ORDER BY window_start DESC")
def recent_windows(t):
    """The last 24 hours, newest first. The range is put on the event time, where it reaches the reader."""
    recent = t.events.filter(F.expr("ts >= timestamp_ntz '2024-01-19' and ts < timestamp_ntz '2024-01-20'")).withColumn("ts", F.col("ts").cast("timestamp"))
    return ntz(timewindows.counts_by_window(recent, "ts", ["event_type"], "1 hour"), *BOUNDS).orderBy(F.desc("window_start"))
