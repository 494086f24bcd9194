"""Streaming jobs over a replayed feed of several micro-batches.

Events arrive in the order of ``arrived``: most at their event time, some 90 minutes, a day, 8 or 13 days late. The feed ends with a row
far in the future, so every window ends and comes out. The SQL side knows the micro-batches as well: a row counts if its window had not
ended by the watermark of the batch before.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog.standins import davg, dsum, ntz, r2
from weirflow.catalog.timewindows import (
    BOUNDS, eavg, loan_stream, sales_stream, sensor_stream, tumbling,
)
from weirflow.functions import scales
from weirflow.functions.fixed import RISK_5
from weirflow.operators import timewindows
from weirflow.registry import Tables, query
from weirflow.streaming import feeds, fraud, jobs, panes, sinks

LATE = {7: 90, 8: 1_440, 9: 8 * 1_440, 10: 13 * 1_440}  # minutes by event_id % 40


def arrivals(t: Tables):
    """The events with the time at which each arrives."""
    minutes = F.coalesce(*(F.when(F.col("event_id") % 40 == k, v) for k, v in LATE.items()), F.lit(0))
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return events.withColumn("arrived", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes))


def feed(t: Tables, name: str, delay: str | None = None, closing: bool = True, copies: int = 1):
    """The events as a stream; further copies of each arrive a day apart."""
    rows = arrivals(t)
    if copies > 1:
        rows = rows.withColumn("arrived", F.explode(F.sequence("arrived", F.col("arrived") + F.make_dt_interval(F.lit(copies - 1)), F.expr("interval 1 day"))))
    stream = feeds.replay(rows, "arrived", name, closing=("ts", "arrived") if closing else ())
    return stream.withWatermark("ts", delay) if delay else stream


FEED = f"""dated AS (SELECT *, ts + INTERVAL 1 MINUTE * (CASE event_id % 40 {' '.join(f'WHEN {k} THEN {v}' for k, v in LATE.items())} ELSE 0 END) AS arrived FROM events),
 span AS (SELECT min(epoch_us(arrived)) AS lo, max(epoch_us(arrived)) AS hi, greatest({feeds.SLICES}, COUNT(*) // {feeds.SLICE_ROWS}) AS slices FROM dated),
 feed AS (SELECT d.*, least(slices - 1, (epoch_us(arrived) - lo) * slices // greatest(hi - lo, 1)) AS batch FROM dated d, span),
 clock AS (SELECT batch, date_trunc('milliseconds', MAX(MAX(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS seen, date_trunc('milliseconds', MAX(MAX(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)) AS seen_before FROM feed GROUP BY batch)"""


def kept(minutes: int, length: int, late_after: int, slide: int | None = None) -> str:
    """SQL: every window of each row, without the rows that come too late for it. Spark drops by the watermark of the batch before."""
    slide = slide or length
    return f"""WITH {FEED}, kept AS (SELECT * FROM (SELECT f.*, seen_before, time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL {slide} MINUTE * k AS window_start,
  time_bucket(INTERVAL {slide} MINUTE, ts) - INTERVAL {slide} MINUTE * k + INTERVAL {length} MINUTE AS window_end FROM feed f JOIN clock USING (batch), range({length // slide}) r(k))
  WHERE seen_before IS NULL OR window_end > seen_before - INTERVAL {late_after} MINUTE)"""


@query("stream_sales", f"""{kept(60, 60, 10)}, s AS (SELECT window_start, window_end, event_type AS region, concat('c', user_id % 5) AS category, value AS amount FROM kept),
 b AS (SELECT *, row_number() OVER (PARTITION BY window_start, region ORDER BY n DESC, category) AS rn FROM (SELECT window_start, region, category, COUNT(*) AS n FROM s GROUP BY 1, 2, 3))
 SELECT s.window_start, window_end, s.region, {dsum('amount')} AS total_sales, COUNT(*) AS transaction_count, {davg('amount')} AS avg_transaction_value, MIN(b.category) AS top_category
 FROM s JOIN b ON s.window_start = b.window_start AND s.region = b.region AND rn = 1 GROUP BY 1, 2, 3""")
def stream_sales(t):
    out = timewindows.sales_by_window(sales_stream(feed(t, "sales", "10 minutes")), "ts", "region", "amount", "category")
    return ntz(sinks.drain_to_files(out, "sales"), *BOUNDS)


@query("stream_sensor", f"""{kept(10, 10, 10, 5)} SELECT window_start, window_end, concat('S', user_id) AS sensor_id, concat('D', arg_min(event_id, (ts, event_id)) % 3) AS device_id, arg_min(event_type, (ts, event_id)) AS location, {eavg('value')} AS avg_temperature, {eavg('(value / 2)')} AS avg_humidity,
 {r2('MAX(value)')} AS max_temperature, {r2('MIN(value)')} AS min_temperature, COUNT(*) AS reading_count FROM kept GROUP BY 1, 2, user_id""")
def stream_sensor(t):
    rows = sensor_stream(feed(t, "sensor", "10 minutes"))
    out = timewindows.sensor_by_window(rows, "ts", "sensor_id", "device_id", "location", "temperature", "humidity", row_id="event_id")
    return ntz(sinks.drain_to_files(out, "sensor"), *BOUNDS)


@query("stream_sessions", """WITH g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
 f AS (SELECT *, SUM(CASE WHEN p IS NULL OR ts - p > INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sn FROM g),
 h AS (SELECT user_id, sn, concat('{', string_agg(concat('"', event_type, '":', n), ',' ORDER BY event_type), '}') AS event_types, (list(event_type ORDER BY n DESC, event_type))[1] AS most_common_event FROM (SELECT user_id, sn, event_type, COUNT(*) AS n FROM f GROUP BY 1, 2, 3) GROUP BY 1, 2)
 SELECT CAST(f.user_id AS VARCHAR) AS user_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL 30 MINUTE AS window_end, MIN(ts) AS session_start, MAX(ts) AS last_event, COUNT(*) AS total_events, MIN(event_types) AS event_types, MIN(most_common_event) AS most_common_event,
 CAST(date_sub('second', MIN(ts), MAX(ts) + INTERVAL 30 MINUTE) AS BIGINT) AS session_duration_seconds FROM f JOIN h ON f.user_id = h.user_id AND f.sn = h.sn GROUP BY f.user_id, f.sn""")
def stream_sessions(t):
    """Late events up to 20 days are waited for: they extend and join sessions of earlier micro-batches."""
    out = jobs.session_stream(feed(t, "sessions", "20 days"), "user_id", "ts", "event_type")
    return ntz(sinks.drain_to_files(out, "sessions"), *BOUNDS, "session_start", "last_event")


@query("stream_event_stats", f"""{kept(1, 1, 10)} SELECT window_start, window_end, event_type AS key, COUNT(value) AS event_count, {dsum('value')} AS total_value, {davg('value')} AS avg_value, MAX(value) AS max_value, MIN(value) AS min_value FROM kept GROUP BY 1, 2, 3""")
def stream_event_stats(t):
    return ntz(sinks.drain_to_files(timewindows.event_stats(feed(t, "stats", "10 minutes"), "ts", "event_type", "value"), "stats"), *BOUNDS)


SUMS = f"SELECT window_start, window_end, event_type, COUNT(*) AS n, {dsum('value')} AS total FROM kept GROUP BY 1, 2, 3"


@query("late_data", f"{kept(60, 60, 10)} {SUMS}")
def late_data(t):
    """One hour windows that wait ten minutes for late rows; later ones are dropped by the watermark."""
    return ntz(sinks.drain_to_files(timewindows.sums_by_window(feed(t, "late", "600 seconds"), "ts", "event_type", "value", "1 hour"), "late"), *BOUNDS)


@query("late_data_week", f"{kept(60, 60, 7 * 1_440)} {SUMS}")
def late_data_week(t):
    """The same with a week: rows of earlier micro-batches still count."""
    return ntz(sinks.drain_to_files(timewindows.sums_by_window(feed(t, "late", "7 days"), "ts", "event_type", "value", "1 hour"), "late"), *BOUNDS)


@query("discarding_append", f"{kept(5, 5, 2)} {SUMS}")
def discarding_append(t):
    """Five minute windows, two minutes late: each window comes out once."""
    return ntz(sinks.drain_to_files(timewindows.sums_by_window(feed(t, "append", "2 minutes"), "ts", "event_type", "value", "5 minutes"), "append"), *BOUNDS)


@query("accumulating_update", f"{kept(60, 60, 10)} {SUMS}")
def accumulating_update(t):
    """Update mode: every batch emits the full value of each changed window, the last one stands."""
    out = timewindows.sums_by_window(feed(t, "update", "10 minutes", closing=False), "ts", "event_type", "value", "1 hour")
    return ntz(sinks.drain_updates(out, "update", ["window_start", "event_type"]), *BOUNDS)


HOUR, WEEK = 3_600_000, 7 * 86_400_000
# Panes by counts, batch by batch: rows of a window whose lateness has run out are dropped; what was there comes out when the window has
# ended before late rows; then the rows are added and the counts looked at; then the timers of the window's end and of its lateness.
PANES = f"""WITH RECURSIVE {FEED},
 turns AS (SELECT row_number() OVER (ORDER BY batch) AS turn, batch, coalesce(epoch_ms(seen) - {WEEK}, 0) AS wm FROM clock
  UNION ALL SELECT COUNT(*) + 1, NULL, (SELECT epoch_ms(MAX(ts)) FROM feed) - {WEEK} FROM clock UNION ALL SELECT COUNT(*) + 2, NULL, 9000000000000000 FROM clock),
 part AS (SELECT event_type AS key, epoch_ms(time_bucket(INTERVAL 60 MINUTE, ts)) AS w, turn, COUNT(*) AS dn, SUM(CAST(value * 100 AS BIGINT)) AS dc FROM feed JOIN turns USING (batch)
  WHERE wm < epoch_ms(time_bucket(INTERVAL 60 MINUTE, ts)) + {HOUR} GROUP BY 1, 2, 3),
 steps AS (SELECT k.key, k.w, t.turn, t.wm, coalesce(p.dn, 0) AS dn, coalesce(p.dc, 0) AS dc FROM (SELECT DISTINCT key, w FROM part) k CROSS JOIN turns t LEFT JOIN part p ON p.key = k.key AND p.w = k.w AND p.turn = t.turn),
 st AS (SELECT key, w, CAST(0 AS BIGINT) AS turn, CAST(0 AS HUGEINT) AS n, CAST(0 AS HUGEINT) AS c, CAST(0 AS HUGEINT) AS shown, 0 AS no, false AS closed, CAST([] AS STRUCT(kind VARCHAR, no INTEGER, n HUGEINT, c HUGEINT)[]) AS out FROM (SELECT DISTINCT key, w FROM part)
  UNION ALL SELECT key, w, turn, n, c, CASE WHEN e THEN n ELSE shown3 END, no3 + CAST(e AS INTEGER), closed3, list_concat(out3, CASE WHEN e THEN [{{'kind': 'late', 'no': no3, 'n': n, 'c': c}}] ELSE [] END) FROM (
   SELECT *, wm >= w + {HOUR} AND n > shown3 AS e FROM (
   SELECT key, w, turn, wm, n, c, CASE WHEN d THEN n ELSE shown2 END AS shown3, no2 + CAST(d AS INTEGER) AS no3, closed1 OR d AS closed3, list_concat(out2, CASE WHEN d THEN [{{'kind': 'on_time', 'no': no2, 'n': n, 'c': c}}] ELSE [] END) AS out3 FROM (
   SELECT *, CASE WHEN p THEN n ELSE shown1 END AS shown2, no1 + CAST(p AS INTEGER) AS no2, list_concat(out1, CASE WHEN p THEN [{{'kind': CASE WHEN closed1 THEN 'late' ELSE 'early' END, 'no': no1, 'n': n, 'c': c}}] ELSE [] END) AS out2, n > 0 AND NOT closed1 AND wm >= w + {HOUR} - {WEEK} AS d FROM (
   SELECT key, w, turn, wm, n0 + dn AS n, c0 + dc AS c, closed0 OR a AS closed1, CASE WHEN a AND n0 > 0 THEN n0 ELSE shown0 END AS shown1, no0 + CAST(a AND n0 > 0 AS INTEGER) AS no1, list_concat(out0, CASE WHEN a AND n0 > 0 THEN [{{'kind': 'on_time', 'no': no0, 'n': n0, 'c': c0}}] ELSE [] END) AS out1,
    dn > 0 AND n0 + dn - CASE WHEN a AND n0 > 0 THEN n0 ELSE shown0 END >= CASE WHEN closed0 OR a THEN {{late}} ELSE {{early}} END AS p FROM (
   SELECT x.key, x.w, x.turn, x.wm, x.dn, x.dc, st.n AS n0, st.c AS c0, st.shown AS shown0, st.no AS no0, st.closed AS closed0, st.out AS out0, x.dn > 0 AND NOT st.closed AND x.wm >= x.w + {HOUR} - {WEEK} AS a FROM st JOIN steps x ON x.key = st.key AND x.w = st.w AND x.turn = st.turn + 1)))))),
 log AS (SELECT key, w, unnest(out) AS p FROM st WHERE turn = (SELECT MAX(turn) FROM turns)),
 shown AS (SELECT key, make_timestamp(w * 1000) AS window_start, make_timestamp((w + {HOUR}) * 1000) AS window_end, p.kind AS pane, CAST(p.no AS BIGINT) AS pane_no, CAST(p.n AS BIGINT) AS n, CAST(p.c AS DOUBLE) / 100 AS total FROM log)"""
COUNTS = {"early": 3, "late": 2}  # of rows: the defaults of 10 and 5 rarely fire in windows this small


def _panes(t, mode):
    jobs.use_rocksdb(t.spark)
    rows = panes.window_panes(feed(t, "panes"), "event_type", "ts", "value", lateness_seconds=WEEK // 1000, early_count=COUNTS["early"], late_count=COUNTS["late"], mode=mode)
    return sinks.drain_to_files(rows, "panes")


_LOG = PANES.replace("{late}", str(COUNTS["late"])).replace("{early}", str(COUNTS["early"]))


@query("panes_log", f"{_LOG} SELECT * FROM shown")
def panes_log(t):
    """Every pane as it was emitted: early ones by 3 rows, one at the window's end, late ones by 2 rows up to a week."""
    return ntz(_panes(t, "accumulating"), *BOUNDS)


_TOTALS = f"{_LOG} SELECT key, window_start, window_end, MAX(n) AS n, arg_max(total, pane_no) AS total FROM shown GROUP BY 1, 2, 3"


@query("panes_accumulating", _TOTALS)
def panes_accumulating(t):
    """Early, on-time and late panes by count; the last pane of a window holds its total."""
    best = _panes(t, "accumulating").groupBy("key", *BOUNDS).agg(F.max("n").alias("n"), F.max_by("total", "pane_no").alias("total"))
    return ntz(best, *BOUNDS)


@query("panes_discarding", _TOTALS)
def panes_discarding(t):
    """Panes with only what is new: they add up to the total."""
    added = _panes(t, "discarding").groupBy("key", *BOUNDS).agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(18,2)")).cast("double").alias("total"))
    return ntz(added, *BOUNDS)


# Panes by time: the moments at which rows of a window arrive, in order, and at each what is due before it. The last moment is the end.
CLOCK_PANES = f"""WITH RECURSIVE {FEED},
 came AS (SELECT event_type AS key, epoch_ms(time_bucket(INTERVAL 60 MINUTE, ts)) AS w, epoch_ms(arrived) AS moment, COUNT(*) AS dn, SUM(CAST(value * 100 AS BIGINT)) AS dc FROM feed GROUP BY 1, 2, 3),
 steps AS (SELECT *, row_number() OVER (PARTITION BY key, w ORDER BY moment) AS turn FROM (FROM came UNION ALL SELECT DISTINCT key, w, 9000000000000000, 0, 0 FROM came)),
 st AS (SELECT DISTINCT key, w, CAST(0 AS BIGINT) AS turn, CAST(0 AS HUGEINT) AS n, CAST(0 AS HUGEINT) AS c, CAST(0 AS HUGEINT) AS shown, CAST(0 AS HUGEINT) AS shown_c, 0 AS no, false AS closed, false AS over, CAST(NULL AS BIGINT) AS due, CAST([] AS STRUCT(kind VARCHAR, no INTEGER, n HUGEINT, c HUGEINT)[]) AS out FROM came
  UNION ALL SELECT key, w, turn, CASE WHEN over1 THEN n ELSE n + dn END, CASE WHEN over1 THEN c ELSE c + dc END, CASE WHEN e THEN n ELSE shown2 END, CASE WHEN e THEN c ELSE sc2 END, no2 + CAST(e AS INTEGER), closed2, over1,
    CASE WHEN over1 THEN NULL WHEN due2 IS NULL THEN least(moment + CASE WHEN closed2 THEN {{late}} ELSE {{early}} END, w + {{open}} + {{lateness}}) ELSE due2 END,
    list_concat(out2, CASE WHEN e THEN [{{'kind': 'late', 'no': no2, 'n': n - {{new}} * shown2, 'c': c - {{new}} * sc2}}] ELSE [] END) FROM (
   SELECT *, over1 AND NOT over0 AND n > shown2 AS e FROM (
   SELECT key, w, turn, moment, dn, dc, n, c, over0, over1, CASE WHEN d AND n > 0 THEN n ELSE shown1 END AS shown2, CASE WHEN d AND n > 0 THEN c ELSE sc1 END AS sc2, no1 + CAST(d AND n > 0 AS INTEGER) AS no2, closed0 OR d AS closed2, CASE WHEN d THEN NULL ELSE due1 END AS due2,
    list_concat(out1, CASE WHEN d AND n > 0 THEN [{{'kind': 'on_time', 'no': no1, 'n': n - {{new}} * shown1, 'c': c - {{new}} * sc1}}] ELSE [] END) AS out2 FROM (
   SELECT *, CASE WHEN f THEN n ELSE shown0 END AS shown1, CASE WHEN f THEN c ELSE sc0 END AS sc1, no0 + CAST(f AS INTEGER) AS no1, CASE WHEN f THEN NULL ELSE due0 END AS due1, NOT closed0 AND w + {{open}} <= moment AS d, over0 OR w + {{open}} + {{lateness}} <= moment AS over1,
    list_concat(out0, CASE WHEN f THEN [{{'kind': CASE WHEN closed0 THEN 'late' ELSE 'early' END, 'no': no0, 'n': n - {{new}} * shown0, 'c': c - {{new}} * sc0}}] ELSE [] END) AS out1 FROM (
   SELECT x.*, st.n, st.c, st.shown AS shown0, st.shown_c AS sc0, st.no AS no0, st.closed AS closed0, st.over AS over0, st.due AS due0, st.out AS out0, coalesce(st.due <= x.moment AND NOT st.over AND (st.closed OR st.due < x.w + {{open}}), false) AS f FROM st JOIN steps x ON x.key = st.key AND x.w = st.w AND x.turn = st.turn + 1))))),
 log AS (SELECT key, w, unnest(out) AS p FROM st JOIN (SELECT key, w, MAX(turn) AS turn FROM steps GROUP BY 1, 2) USING (key, w, turn))
SELECT key, make_timestamp(w * 1000) AS window_start, make_timestamp((w + {HOUR}) * 1000) AS window_end, p.kind AS pane, CAST(p.no AS BIGINT) AS pane_no, CAST(p.n AS BIGINT) AS n, CAST(p.c AS DOUBLE) / 100 AS total FROM log"""


def clock_panes_sql(*, skew: int, lateness: int, early: int, late: int, discarding: bool) -> str:
    """All times in seconds."""
    values = {"late": late * 1000, "early": early * 1000, "open": HOUR + skew * 1000, "lateness": lateness * 1000, "new": int(discarding)}
    sql = CLOCK_PANES
    for name, value in values.items():
        sql = sql.replace("{" + name + "}", str(value))
    return sql


@query("panes_by_time", clock_panes_sql(skew=300, lateness=9 * 86_400, early=60, late=300, discarding=False))
def panes_by_time(t):
    """Early panes 60 seconds after a first unseen row, late ones after 300 seconds, up to nine days late."""
    jobs.use_rocksdb(t.spark)
    rows = panes.clock_panes(feed(t, "clock"), "event_type", "ts", "arrived", "value", skew_seconds=300, lateness_seconds=9 * 86_400)
    return ntz(sinks.drain_to_files(rows, "clock"), *BOUNDS)


@query("panes_by_time_discarding", clock_panes_sql(skew=0, lateness=14 * 86_400, early=900, late=120, discarding=True))
def panes_by_time_discarding(t):
    """Late panes two minutes after a late row, each with only what is new."""
    jobs.use_rocksdb(t.spark)
    rows = panes.clock_panes(feed(t, "clock"), "event_type", "ts", "arrived", "value", lateness_seconds=14 * 86_400, early_seconds=900, late_seconds=120, mode="discarding")
    return ntz(sinks.drain_to_files(rows, "clock"), *BOUNDS)


@query("stream_dedup", "SELECT event_id, user_id, event_type, ts FROM events")
def stream_dedup(t):
    """Every event three times on the stream, a day apart, each kept once."""
    jobs.use_rocksdb(t.spark)
    out = jobs.deduplicated(feed(t, "dedup", closing=False, copies=3), "event_id", "ts", "20 days").select("event_id", "user_id", "event_type", "ts")
    return ntz(sinks.drain_to_files(out, "dedup"), "ts")


@query("insert_absent_sink", "SELECT event_id, user_id, value FROM events")
def insert_absent_sink(t):
    """Repeated deliveries in later micro-batches into a table that takes each event once."""
    twice = feed(t, "absent", closing=False, copies=2).select("event_id", "user_id", "value")
    base = sinks.drain_batches(twice, "absent", lambda df, no, b: sinks.insert_if_absent(df, no, f"{b}/out", "event_id"), mode="append")
    return t.spark.read.parquet(f"{base}/out").drop("batch_id")


@query("stream_static_join", "SELECT event_id, user_id, coalesce(c_mktsegment, 'Unknown') AS c_mktsegment FROM events LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON user_id = c_custkey")
def stream_static_join(t):
    static = t.customer.filter("c_custkey % 3 <> 0").withColumnRenamed("c_custkey", "user_id")
    out = jobs.enriched(feed(t, "static", closing=False).select("event_id", "user_id"), static, "user_id", "c_mktsegment")
    return sinks.drain_to_files(out.select("event_id", "user_id", "c_mktsegment"), "static")


def _loan_outputs(t):
    outputs = jobs.loan_outputs(scales.at_least("credit_score", RISK_5), 400)
    return jobs.fan_out(loan_stream(feed(t, "fan", closing=False)), "fan", outputs)


@query("stream_fan_out", f"""WITH l AS (SELECT event_id, value AS amount, {scales.sql_case('(300 + (event_id * 7) % 551)', RISK_5, '>=')} AS risk FROM events)
 SELECT 'raw' AS output, COUNT(*) AS rows, {dsum('amount')} AS total FROM l UNION ALL SELECT 'alerts', COUNT(*), {dsum('amount')} FROM l WHERE risk = 'VERY_HIGH' OR amount > 400 UNION ALL SELECT 'metrics', COUNT(*), {dsum('amount')} FROM l""")
def stream_fan_out(t):
    """Raw archive, alerts and window metrics from one pass over the stream."""
    base = _loan_outputs(t)
    read = lambda name: t.spark.read.parquet(f"{base}/{name}")
    total = lambda df, name, n, s: df.agg(F.lit(name).alias("output"), n.cast("bigint").alias("rows"), F.sum(s).cast("double").alias("total"))
    amount = F.col("amount").cast("decimal(18,2)")
    return (total(read("raw"), "raw", F.count("*"), amount).unionByName(total(read("alerts"), "alerts", F.count("*"), amount))
            .unionByName(total(read("metrics"), "metrics", F.sum("n"), F.col("s"))))


@query("alert_outbox", f"""WITH l AS (SELECT event_id, value AS amount, {scales.sql_case('(300 + (event_id * 7) % 551)', RISK_5, '>=')} AS risk FROM events)
 SELECT event_id, amount, 1 AS sent FROM l WHERE risk = 'VERY_HIGH' OR amount > 400""")
def alert_outbox(t):
    """Alerts of a stream that delivers every event twice, through an outbox to a topic; the relay runs again and sends nothing more."""
    def each(batch, number, base):
        alerts = timewindows.high_risk_alerts(batch.withColumn("risk_category", scales.at_least("credit_score", RISK_5)), "risk_category", "amount", 400)
        for _ in range(2):  # the batch is run again
            sinks.outbox_batch(alerts, number, f"{base}/outbox")
            sinks.relay_outbox(t.spark, f"{base}/outbox", f"{base}/sent", sinks.to_topic_folder(f"{base}/topic"))

    base = sinks.drain_batches(loan_stream(feed(t, "alerts", closing=False, copies=2)), "alerts", each, mode="append")
    topic = t.spark.read.schema(sinks.MESSAGE).json(f"{base}/topic")
    value = F.from_json("value", "event_id long, amount double")
    return topic.select(value.alias("m")).groupBy("m.event_id", "m.amount").agg(F.count(F.lit(1)).cast("int").alias("sent"))


@query("stream_loan_metrics", f"""SELECT {tumbling(5)}, concat('r', user_id % 4) AS region, event_type AS loan_type, COUNT(*) AS application_count, {dsum('value')} AS total_amount, {r2('CAST(SUM(300 + (event_id * 7) % 551) AS DOUBLE) / COUNT(*)', 1)} AS avg_credit_score,
 COUNT(*) FILTER (WHERE 300 + (event_id * 7) % 551 < 550) AS high_risk_count FROM events GROUP BY 1, 2, 3, 4""")
def stream_loan_metrics(t):
    """The metrics of the same pass, merged over all micro-batches: late rows add to windows of earlier ones."""
    metrics = t.spark.read.parquet(f"{_loan_outputs(t)}/metrics")
    return ntz(jobs.merged_metrics(metrics), *BOUNDS)


@query("stream_fraud", """WITH r AS (SELECT event_id, user_id, ts, event_type, value, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS s, COUNT(value) OVER w AS c, COUNT(*) OVER (PARTITION BY user_id, time_bucket(INTERVAL 6 HOUR, ts)) AS burst,
 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 j AS (SELECT event_id, user_id, concat_ws(',', CASE WHEN burst > 3 THEN 'velocity' END, CASE WHEN value > 3 * (s / c) THEN 'amount' END, CASE WHEN nth = 1 THEN 'new_type' END) AS rules FROM r) SELECT * FROM j WHERE rules <> ''""")
def stream_fraud(t):
    """The three fraud rules in one pass over the stream, each bucket judged when the watermark has passed it."""
    jobs.use_rocksdb(t.spark)
    return sinks.drain_to_files(fraud.fraud_stream(feed(t, "fraud"), "event_id", "user_id", "ts", "event_type", "value", late_after="20 days"), "fraud")


@query("stream_batch_recon", f"""{kept(60, 60, 10)}, s AS (SELECT window_start, event_type, COUNT(*) AS n FROM kept GROUP BY 1, 2), b AS (SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS window_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)
 SELECT b.window_start, b.event_type, s.n AS stream_value, b.n AS batch_value, s.n IS NOT DISTINCT FROM b.n AS agrees FROM b LEFT JOIN s ON b.window_start = s.window_start AND b.event_type = s.event_type""")
def stream_batch_recon(t):
    """Every window with its count from the stream and from a batch run over the same rows: they differ where rows came too late."""
    keys = ["window_start", "event_type"]
    streamed = sinks.drain_updates(timewindows.sums_by_window(feed(t, "recon", "10 minutes", closing=False), "ts", "event_type", "value", "1 hour"), "recon", keys)
    batch = timewindows.sums_by_window(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "value", "1 hour")
    return ntz(jobs.compare_with_batch(streamed, batch, keys, "n"), "window_start")
