"""Window analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog.standins import LOANS_SQL, SALES_SQL, loans, r2, sales
from weirflow.functions.numbers import money, pct, rounded
from weirflow.operators import sessions, windows
from weirflow.plans import dedup
from weirflow.plans.segments import frame_window, plan_cuts, running_window
from weirflow.registry import query


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("amount"))


@query("second_highest", "SELECT o_custkey, amount, order_date, o_orderkey FROM (SELECT o_custkey, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS order_date, o_orderkey, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS r FROM orders) WHERE r = 2")
def second_highest(t):
    return windows.nth_highest(_orders(t), "o_custkey", "amount", 2)


@query("yoy_growth", f"""WITH {SALES_SQL}, m AS (SELECT CAST(date_trunc('month', txn_date) AS DATE) AS month, region, SUM(CAST(amount AS DECIMAL(18,2))) AS rev FROM sales GROUP BY 1, 2),
 p AS (SELECT month, region, CAST(rev AS DOUBLE) AS revenue, CAST(lag(rev, 12) OVER (PARTITION BY region ORDER BY month) AS DOUBLE) AS prev_year_revenue FROM m)
 SELECT *, {r2('(revenue - prev_year_revenue) / NULLIF(prev_year_revenue, 0) * 100')} AS yoy_growth_pct FROM p WHERE prev_year_revenue IS NOT NULL""")
def yoy_growth(t):
    monthly = sales(t).groupBy(F.to_date(F.date_trunc("month", "txn_date")).alias("month"), "region").agg(F.sum(money("amount")).cast("double").alias("revenue"))
    # One row per region and month: a plain window is enough at any size.
    seen = frame_window(monthly, ["region"], ["month"], {"prev_year_revenue": lambda w: F.lag("revenue", 12).over(w)}, before=12, segments=1)
    return seen.filter(F.col("prev_year_revenue").isNotNull()).withColumn(
        "yoy_growth_pct", pct(F.col("revenue") - F.col("prev_year_revenue"), "prev_year_revenue"))


STREAK_SQL = """d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS grp FROM d),
 s AS (SELECT user_id, MIN(day) AS streak_start, MAX(day) AS streak_end, COUNT(*) AS consecutive_days FROM g GROUP BY user_id, grp)"""


def _streaks(t):
    return windows.streaks(t.events.select("user_id", F.to_date("ts").alias("day")), "user_id", "day")


@query("login_streaks", f"WITH {STREAK_SQL} SELECT * FROM s")
def login_streaks(t):
    return _streaks(t)


@query("max_streak", f"WITH {STREAK_SQL} SELECT user_id, MAX(consecutive_days) AS max_consecutive_days FROM s GROUP BY 1")
def max_streak(t):
    return _streaks(t).groupBy("user_id").agg(F.max("consecutive_days").alias("max_consecutive_days"))


@query("balance_reset", """WITH RECURSIVE o AS (SELECT event_id, user_id, CAST(CASE WHEN event_type = 'purchase' THEN -4 * value ELSE value END AS DECIMAL(18,2)) AS amount,
 row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
 b AS (SELECT event_id, user_id, rn, amount, CAST(greatest(amount, 0) AS DECIMAL(28,2)) AS bal FROM o WHERE rn = 1
 UNION ALL SELECT o.event_id, o.user_id, o.rn, o.amount, CAST(greatest(b.bal + o.amount, 0) AS DECIMAL(28,2)) FROM o JOIN b ON o.user_id = b.user_id AND o.rn = b.rn + 1)
 SELECT event_id, user_id, CAST(amount AS DOUBLE) AS amount, CAST(bal AS DOUBLE) AS running_balance FROM b""")
def balance_reset(t):
    amount = F.when(F.col("event_type") == "purchase", -4 * F.col("value")).otherwise(F.col("value")).cast("decimal(18,2)")
    rows = t.events.select("event_id", "user_id", "ts", amount.alias("amount"))
    done = windows.balance_with_floor(rows, "user_id", ["ts", "event_id"], "amount")
    return done.select("event_id", "user_id", F.col("amount").cast("double"), F.col("running_balance").cast("double"))


@query("outlier_p95", f"""WITH {LOANS_SQL}, p AS (SELECT *, percent_rank() OVER (PARTITION BY region ORDER BY amount) AS pr FROM loans), q AS (SELECT region, quantile_cont(amount, 0.95) AS lim FROM loans GROUP BY 1)
 SELECT loan_id, p.region, amount, {r2('lim')} AS limit_value, CASE WHEN amount > lim THEN 'OUTLIER' ELSE 'NORMAL' END AS flag FROM p JOIN q ON p.region = q.region WHERE pr > 0.95""")
def outlier_p95(t):
    found = windows.outliers(loans(t).select("loan_id", "region", "amount"), "region", "amount", "loan_id")
    return found.withColumn("limit_value", rounded("limit_value"))


SESSION_SQL = """g AS (SELECT *, date_sub('minute', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS gap FROM events),
 f AS (SELECT *, CAST(SUM(CASE WHEN gap IS NULL OR gap > {minutes} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM g),
 n AS (SELECT *, CAST((row_number() OVER (PARTITION BY user_id, session_id ORDER BY ts, event_id) - 1) // 10000 AS INTEGER) AS part_no FROM f),
 s AS (SELECT user_id, session_id, MIN(ts) AS session_start, MAX(ts) AS session_end, date_sub('second', MIN(ts), MAX(ts)) AS session_duration_sec, COUNT(*) AS events_in_session FROM f GROUP BY 1, 2),
 p AS (SELECT user_id, session_id, part_no, string_agg(event_type, '>' ORDER BY ts, event_id) AS page_path FROM n GROUP BY 1, 2, 3)"""


def clickstream_sessions(t, minutes: int):
    """Sessions with their page path; a session of up to 10,000 events is one row, longer ones have parts."""
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    cuts = plan_cuts(rows, ["ts", "event_id"], keys=["user_id"])
    marked = sessions.mark_sessions(rows, "user_id", "ts", "event_id", sessions.gap_exceeds_minutes(minutes), "session_id", cuts)
    from weirflow.plans.lists import ordered_lists

    summary = marked.groupBy("user_id", "session_id").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("events_in_session"),
    ).withColumn("session_duration_sec", F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")))
    paths = ordered_lists(marked, ["user_id", "session_id"], ["ts", "event_id"], {"page_path": ["event_type"]}, cuts=cuts)
    return summary.join(paths.drop("item_count"), ["user_id", "session_id"]).withColumn("page_path", F.concat_ws(">", "page_path"))


@query("sessionize", f"WITH {SESSION_SQL.format(minutes=30)} SELECT s.*, part_no, page_path FROM s JOIN p ON s.user_id = p.user_id AND s.session_id = p.session_id")
def sessionize(t):
    return clickstream_sessions(t, 30)


@query("sessionize_12h", f"WITH {SESSION_SQL.format(minutes=720)} SELECT s.*, part_no, page_path FROM s JOIN p ON s.user_id = p.user_id AND s.session_id = p.session_id")
def sessionize_12h(t):
    return clickstream_sessions(t, 720)


@query("ordered_funnel", """SELECT event_type AS current_step, nxt AS next_step, COUNT(DISTINCT user_id) AS users FROM (SELECT user_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
 WHERE event_type IN ('view', 'click', 'signup', 'purchase') GROUP BY 1, 2""")
def ordered_funnel(t):
    return windows.step_transitions(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"], "event_type", ["view", "click", "signup", "purchase"])


@query("missing_dates", """WITH l AS (SELECT DISTINCT user_id AS source, CAST(ts AS DATE) AS day FROM events WHERE (day(ts) + user_id) % 5 <> 0),
 c AS (SELECT source, CAST(unnest(generate_series((SELECT min(day) FROM l), (SELECT max(day) FROM l), INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT source FROM l)),
 m AS (SELECT c.source, c.day FROM c LEFT JOIN l ON c.source = l.source AND c.day = l.day WHERE l.day IS NULL),
 g AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY source ORDER BY day) AS INTEGER) AS grp FROM m) SELECT source, MIN(day) AS gap_start, MAX(day) AS gap_end, COUNT(*) AS days_missing FROM g GROUP BY source, grp""")
def missing_dates(t):
    loads = t.events.filter((F.dayofmonth("ts") + F.col("user_id")) % 5 != 0).select(F.col("user_id").alias("source"), F.to_date("ts").alias("day"))
    first, last = (loads.agg(f("day")).scalar() for f in (F.min, F.max))
    return windows.missing_ranges(loads, "source", "day", first, last)


@query("scd2_build", """WITH d AS (SELECT * FROM (SELECT o_custkey, o_orderpriority AS segment, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
 l AS (SELECT *, lag(segment) OVER w AS ps, lag(status) OVER w AS pt FROM d WINDOW w AS (PARTITION BY o_custkey ORDER BY day)),
 v AS (SELECT *, SUM(CASE WHEN segment <> ps OR status <> pt OR ps IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY day) AS ver FROM l),
 e AS (SELECT o_custkey, segment, status, ver, MIN(day) AS effective_from FROM v GROUP BY 1, 2, 3, 4)
 SELECT o_custkey, segment, status, effective_from, coalesce(lead(effective_from) OVER (PARTITION BY o_custkey ORDER BY ver) - 1, DATE '9999-12-31') AS effective_to, lead(effective_from) OVER (PARTITION BY o_custkey ORDER BY ver) IS NULL AS is_current FROM e""")
def scd2_build(t):
    rows = t.orders.select("o_custkey", F.col("o_orderpriority").alias("segment"), F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day"), "o_orderkey")
    daily = dedup.latest_per_key(rows, ["o_custkey", "day"], ["-o_orderkey"]).drop("o_orderkey")
    return windows.scd2_versions(daily, "o_custkey", "day", ["segment", "status"])


DAILY_SQL = "daily AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue, COUNT(*) AS n FROM events GROUP BY 1, 2)"


def daily_events(t):
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum(money("value")).cast("double").alias("revenue"), F.count("*").alias("n"))


@query("moving_stats", f"""WITH {DAILY_SQL} SELECT event_type, day, revenue, {r2('avg(revenue) OVER s')} AS moving_avg, {r2('quantile_cont(revenue, 0.5) OVER l')} AS rolling_median, {r2('revenue - avg(revenue) OVER s')} AS deviation,
 {r2('(revenue - avg(revenue) OVER l) / NULLIF(stddev_samp(revenue) OVER l, 0)')} AS z_score FROM daily
 WINDOW s AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), l AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def moving_stats(t):
    return windows.moving_statistics(daily_events(t).drop("n"), "event_type", "day", "revenue")


@query("pattern_match", """WITH l AS (SELECT user_id, event_type, ts, lead(event_type, 1) OVER w AS e2, lead(event_type, 2) OVER w AS e3, lead(ts, 2) OVER w AS t3 FROM events WHERE event_type IN ('view', 'click', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
 SELECT DISTINCT user_id, ts AS first_time, t3 AS last_time, date_sub('minute', ts, t3) AS minutes_to_convert FROM l WHERE event_type = 'view' AND e2 = 'click' AND e3 = 'purchase' AND date_sub('minute', ts, t3) <= 1440""")
def pattern_match(t):
    return windows.sequence_matches(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id", "event_type", ("view", "click", "purchase"), 1440)


@query("running_total", "SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total FROM orders")
def running_total(t):
    rows = _orders(t).withColumn("amount", money("amount"))
    done = running_window(rows, ["o_custkey"], ["order_date", "o_orderkey"], {"running_total": ("sum", "amount")})
    return done.select("o_orderkey", "o_custkey", F.col("running_total").cast("double"))


@query("latest_per_key", "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_per_key(t):
    return dedup.latest_per_key(t.orders, ["o_custkey"], ["-o_orderdate", "-o_orderkey"])


@query("change_detect", """SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, CAST(lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS previous,
 CAST(CAST(o_totalprice AS DECIMAL(18,2)) - lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS change FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)""")
def change_detect(t):
    done = windows.change_from_previous(_orders(t).withColumn("amount", money("amount")), "o_custkey", ["order_date", "o_orderkey"], "amount")
    return done.select("o_orderkey", "o_custkey", *[F.col(c).cast("double").alias(c) for c in ("amount", "previous", "change")])


@query("declining_spend", """WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders GROUP BY 1, 2),
 l AS (SELECT *, lag(spend, 1) OVER w AS previous_month, lag(spend, 2) OVER w AS two_months_ago FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY month)) SELECT * FROM l WHERE spend < previous_month AND previous_month < two_months_ago""")
def declining_spend(t):
    monthly = t.orders.groupBy("o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(F.sum(money("o_totalprice")).cast("double").alias("spend"))
    return windows.falling_streak(monthly, "o_custkey", "month", "spend")


@query("trailing_alert", f"""WITH {DAILY_SQL}, a AS (SELECT event_type, day, n, avg(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS x FROM daily)
 SELECT event_type, day, n, {r2('x')} AS trailing_avg FROM a WHERE n > 1.1 * x""")
def trailing_alert(t):
    return windows.trailing_alert(daily_events(t).select("event_type", "day", "n"), "event_type", "day", "n", factor=1.1)


@query("ntile_buckets", "SELECT c_custkey, c_mktsegment, ntile(10) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS decile FROM customer")
def ntile_buckets(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return windows.ntile_buckets(rows, ["c_mktsegment"], ["-c_acctbal", "c_custkey"], 10, "decile").drop("c_acctbal")


@query("ntile_table", "SELECT c_custkey, ntile(100) OVER (ORDER BY c_acctbal, c_custkey) AS percentile FROM customer")
def ntile_table(t):
    return windows.ntile_buckets(t.customer.select("c_custkey", "c_acctbal"), [], ["c_acctbal", "c_custkey"], 100, "percentile").drop("c_acctbal")


@query("bounded_window", """SELECT o_orderkey, o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS sum_last_31, COUNT(*) OVER w AS rows_in_frame FROM orders
 WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)""")
def bounded_window(t):
    rows = _orders(t).withColumn("amount", money("amount"))
    done = frame_window(rows, ["o_custkey"], ["order_date", "o_orderkey"], {
        "s": lambda w: F.sum("amount").over(w.rowsBetween(-30, 0)), "rows_in_frame": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-30, 0))}, before=30)
    return done.select("o_orderkey", "o_custkey", F.col("s").cast("double").alias("sum_last_31"), "rows_in_frame")


@query("rank_family", """SELECT o_orderkey, o_custkey, row_number() OVER (w ORDER BY o_orderdate, o_orderkey) AS rn, rank() OVER (w ORDER BY o_orderdate) AS rnk, dense_rank() OVER (w ORDER BY o_orderdate) AS dense_rnk,
 lag(o_totalprice) OVER (w ORDER BY o_orderdate, o_orderkey) AS previous_amount, lead(o_totalprice) OVER (w ORDER BY o_orderdate, o_orderkey) AS next_amount,
 CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (w ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_amount, ntile(4) OVER (w ORDER BY o_orderdate, o_orderkey) AS quartile FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def rank_family(t):
    from weirflow.plans.quantiles import ntile_of

    rows = _orders(t).withColumn("m", money("amount"))
    order, keys, cuts = ["order_date", "o_orderkey"], ["o_custkey"], plan_cuts(rows, ["order_date", "o_orderkey"], keys=["o_custkey"])
    framed = frame_window(rows, keys, order, {"previous_amount": lambda w: F.lag("amount").over(w), "next_amount": lambda w: F.lead("amount").over(w)}, before=1, after=1, cuts=cuts)
    numbered = running_window(framed, keys, order, {"rn": ("row_number", None), "s": ("sum", "m"), "n": ("total_count", None)}, cuts=cuts)
    ranked = running_window(numbered, keys, ["order_date"], {"rnk": ("rank", None), "dense_rnk": ("dense_rank", None)}, cuts=cuts)
    return ranked.select("o_orderkey", "o_custkey", "rn", "rnk", "dense_rnk", "previous_amount", "next_amount", F.col("s").cast("double").alias("running_amount"), ntile_of(F.col("rn"), F.col("n"), 4).alias("quartile"))


@query("sigma_anomaly", f"""WITH {DAILY_SQL}, a AS (SELECT event_type, day, revenue, avg(revenue) OVER w AS m, stddev_samp(revenue) OVER w AS s FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
 SELECT event_type, day, revenue, {r2('m')} AS rolling_avg, {r2('s')} AS rolling_sd FROM a WHERE abs(revenue - m) > 2 * s""")
def sigma_anomaly(t):
    return windows.sigma_alert(daily_events(t).drop("n"), "event_type", "day", "revenue", sigmas=2.0)


