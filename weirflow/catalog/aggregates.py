"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog.cleaning import DIRTY_EVENTS_SQL, dirty_events
from weirflow.catalog.standins import (
    AS_OF, LOANS_SQL, SALES_SQL, davg, dsum, events_utc, loans, ntz, r2, sales,
)
from weirflow.functions import scales
from weirflow.functions.fixed import DPD_BUCKETS
from weirflow.functions.numbers import money_avg, money_sum, pct, ratio, rounded
from weirflow.operators import aggregate as agg
from weirflow.operators import sessions, timewindows
from weirflow.plans import dedup, lists
from weirflow.plans.quantiles import exact_percentiles
from weirflow.plans.spread import spread
from weirflow.registry import query


@query("word_count", r"""SELECT word, COUNT(*) AS count, CAST(length(word) AS INTEGER) AS word_length FROM
 (SELECT unnest(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s]', '', 'g'), '\s+')) AS word FROM documents) WHERE length(word) >= 3 GROUP BY word""")
def word_count(t):
    return agg.word_count(spread(t.documents.select("text")), "text")


@query("metric_agg", f"""WITH {DIRTY_EVENTS_SQL}, n AS (SELECT event_type, TRY_CAST(value AS DOUBLE) AS v FROM dirty WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL)
 SELECT event_type, {dsum('v')} AS total, {davg('v')} AS average, COUNT(v) AS n, MIN(v) AS lowest, MAX(v) AS highest FROM n GROUP BY 1""")
def metric_agg(t):
    return agg.metric_summary(dirty_events(t), "event_type", "value")


@query("window_stats", f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type AS key,
 COUNT(value) AS event_count, {dsum('value')} AS total_value, {davg('value')} AS avg_value, MAX(value) AS max_value, MIN(value) AS min_value FROM events GROUP BY 1, 2, 3""")
def window_stats(t):
    return ntz(timewindows.event_stats(events_utc(t), "ts", "event_type", "value", "1 hour"), "window_start", "window_end")


@query("region_sales", f"""WITH {SALES_SQL}, counted AS (SELECT region, txn_date, category, COUNT(*) AS n FROM sales GROUP BY 1, 2, 3),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY region, txn_date ORDER BY n DESC, category) AS rn FROM counted) WHERE rn = 1)
 SELECT CAST(s.txn_date AS TIMESTAMP) AS window_start, CAST(s.txn_date AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, s.region, {dsum('amount')} AS total_sales, COUNT(*) AS transaction_count,
 {davg('amount')} AS avg_transaction_value, MIN(b.category) AS top_category FROM sales s JOIN best b ON s.region = b.region AND s.txn_date = b.txn_date GROUP BY s.txn_date, s.region""")
def region_sales(t):
    rows = sales(t).withColumn("ts", F.col("txn_date").cast("timestamp"))
    return ntz(timewindows.sales_by_window(rows, "ts", "region", "amount", "category", "1 day"), "window_start", "window_end")


@query("region_minmax", f"""WITH {SALES_SQL}, s AS (SELECT *, CASE WHEN txn_id % 19 = 0 THEN NULL ELSE region END AS reg FROM sales)
 SELECT CAST(txn_date AS TIMESTAMP) AS window_start, CAST(txn_date AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, coalesce(reg, 'UNKNOWN') AS region, {dsum('amount')} AS total_sales, COUNT(*) AS transaction_count,
 {davg('amount')} AS average_transaction, MAX(amount) AS max_transaction, MIN(amount) AS min_transaction FROM s GROUP BY 1, 2, 3""")
def region_minmax(t):
    rows = sales(t).withColumns({
        "ts": F.col("txn_date").cast("timestamp"), "region": F.when(F.col("txn_id") % 19 != 0, F.col("region"))})
    return ntz(timewindows.sales_range_by_window(rows, "ts", "region", "amount", "1 day"), "window_start", "window_end")


@query("loan_metrics", f"""WITH {LOANS_SQL} SELECT region, loan_type, COUNT(*) AS application_count, {dsum('amount')} AS total_amount,
 {r2('CAST(SUM(credit_score) AS DOUBLE) / COUNT(*)', 1)} AS avg_credit_score, COUNT(*) FILTER (WHERE credit_score < 550) AS high_risk_count FROM loans GROUP BY 1, 2""")
def loan_metrics(t):
    return loans(t).groupBy("region", "loan_type").agg(
        F.count("*").alias("application_count"), money_sum("amount").alias("total_amount"),
        rounded(ratio(F.sum("credit_score"), F.count("*")), 1).alias("avg_credit_score"),
        F.count_if(F.col("credit_score") < 550).alias("high_risk_count"))


@query("default_rate", f"""WITH {LOANS_SQL} SELECT loan_type, COUNT(*) AS loan_count, {dsum('amount')} AS total_amount, coalesce({dsum("CASE WHEN credit_score < 400 THEN amount END")}, 0) AS default_amount,
 {r2("coalesce(" + dsum("CASE WHEN credit_score < 400 THEN amount END") + ", 0) / " + dsum('amount') + " * 100")} AS default_rate_pct FROM loans GROUP BY 1""")
def default_rate(t):
    bad = F.when(F.col("credit_score") < 400, F.col("amount"))
    totals = loans(t).groupBy("loan_type").agg(
        F.count("*").alias("loan_count"), money_sum("amount").alias("total_amount"),
        F.coalesce(money_sum(bad), F.lit(0.0)).alias("default_amount"))
    return totals.withColumn("default_rate_pct", pct("default_amount", "total_amount"))


@query("daily_summary", f"""WITH {SALES_SQL} SELECT txn_date, region, COUNT(*) AS applications, {dsum('amount')} AS total_amount,
 {r2("CAST(COUNT(*) FILTER (WHERE status = 'F') AS DOUBLE) / COUNT(*) * 100")} AS approval_rate, {r2("CAST(COUNT(*) FILTER (WHERE status = 'P') AS DOUBLE) / COUNT(*) * 100")} AS default_rate FROM sales GROUP BY 1, 2""")
def daily_summary(t):
    return sales(t).groupBy("txn_date", "region").agg(
        F.count("*").alias("applications"), money_sum("amount").alias("total_amount"),
        pct(F.count_if(F.col("status") == "F"), F.count("*")).alias("approval_rate"),
        pct(F.count_if(F.col("status") == "P"), F.count("*")).alias("default_rate"))


@query("daily_counts", f"SELECT o_orderpriority, COUNT(*) AS orders, {dsum('o_totalprice')} AS total FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '{AS_OF}' - 1 GROUP BY 1")
def daily_counts(t):
    """Yesterday, as a range on the stored column so that the filter reaches the reader."""
    day = f"o_orderdate >= timestamp_ntz '{AS_OF}' - interval 1 day and o_orderdate < timestamp_ntz '{AS_OF}'"
    return t.orders.filter(F.expr(day)).groupBy("o_orderpriority").agg(F.count("*").alias("orders"), money_sum("o_totalprice").alias("total"))


@query("daily_metrics", f"WITH {SALES_SQL} SELECT txn_date, region, {dsum('amount')} AS daily_total, COUNT(*) AS txn_count FROM sales GROUP BY 1, 2")
def daily_metrics(t):
    return sales(t).groupBy("txn_date", "region").agg(money_sum("amount").alias("daily_total"), F.count("*").alias("txn_count"))


@query("count_distinct", "SELECT event_type, COUNT(DISTINCT user_id) AS users, COUNT(*) AS events FROM events GROUP BY 1")
def count_distinct(t):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("events"))


@query("approx_distinct")
def approx_distinct(t):
    """HyperLogLog estimates: two sketches of fixed size per group, whatever the number of rows."""
    return t.events.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.02).alias("users_hll"),
        F.hll_sketch_estimate(F.hll_sketch_agg("user_id")).alias("users_sketch"))


@query("top_count", """SELECT l_returnflag, l_partkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_partkey) AS rn
 FROM (SELECT l_returnflag, l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE rn <= 10""")
def top_count(t):
    counts = t.lineitem.groupBy("l_returnflag", "l_partkey").agg(F.count("*").alias("n"))
    return dedup.top_per_key(counts, ["l_returnflag"], ["-n", "l_partkey"], 10)


@query("top_count_approx")
def top_count_approx(t):
    """Approximate heavy values from a sketch of fixed size."""
    top = F.expr("approx_top_k(l_partkey, 10, 10000)")
    return t.lineitem.groupBy("l_returnflag").agg(top.alias("top")).select("l_returnflag", F.inline("top"))


@query("percentiles", f"""SELECT l_returnflag, {r2('quantile_cont(l_extendedprice, 0.5)')} AS median, {r2('quantile_cont(l_extendedprice, 0.95)')} AS p95, {r2('quantile_cont(l_extendedprice, 0.99)')} AS p99 FROM lineitem GROUP BY 1""")
def percentiles(t):
    exact = exact_percentiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"median": 0.5, "p95": 0.95, "p99": 0.99})
    return exact.select("l_returnflag", *[rounded(c).alias(c) for c in ("median", "p95", "p99")])


@query("percentiles_approx")
def percentiles_approx(t):
    """Quantile sketch of fixed size per group."""
    return t.lineitem.groupBy("l_returnflag").agg(
        *[F.percentile_approx("l_extendedprice", p, 10000).alias(n) for n, p in (("median", 0.5), ("p95", 0.95), ("p99", 0.99))])


@query("ordered_array", """SELECT user_id, part_no, COUNT(*) AS item_count, string_agg(event_type, '>' ORDER BY item_no) AS path FROM
 (SELECT *, CAST((item_no - 1) // 10000 AS INTEGER) AS part_no FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS item_no FROM events)) GROUP BY 1, 2""")
def ordered_array(t):
    rows = t.events.select("user_id", "ts", "event_id", "event_type")
    return lists.ordered_lists(rows, ["user_id"], ["ts", "event_id"], {"path": ["event_type"]}).withColumn("path", F.concat_ws(">", "path"))


@query("string_agg", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, MIN(event_type) AS any_type, MIN(ts) AS first_ts FROM events GROUP BY 1")
def string_agg(t):
    """The distinct values are found first; only those reach the list."""
    per_type = t.events.groupBy("user_id", "event_type").agg(F.min("ts").alias("ts"))
    return per_type.groupBy("user_id").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("event_type"))).alias("types"), F.min("event_type").alias("any_type"), F.min("ts").alias("first_ts"))


TYPES = ["click", "error", "purchase", "signup", "view"]


@query("pivot", "SELECT CAST(ts AS DATE) AS day, " + ", ".join(
    f"CAST(SUM(CASE WHEN event_type = '{x}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS {x}" for x in TYPES) + " FROM events GROUP BY 1")
def pivot(t):
    """The values are listed, so Spark does not run a job to find them."""
    return t.events.groupBy(F.to_date("ts").alias("day")).pivot("event_type", TYPES).agg(money_sum("value"))


@query("pivot_profit", f"""SELECT user_id, {dsum("CASE WHEN event_type = 'purchase' THEN value END")} AS revenue, {dsum("CASE WHEN event_type = 'click' THEN value END")} AS cost,
 CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) - SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS profit FROM events GROUP BY 1""")
def pivot_profit(t):
    of = lambda kind: F.sum(F.when(F.col("event_type") == kind, F.col("value").cast("decimal(18,2)")))
    sums = t.events.groupBy("user_id").agg(of("purchase").alias("r"), of("click").alias("c"))
    return sums.select("user_id", F.col("r").cast("double").alias("revenue"), F.col("c").cast("double").alias("cost"), (F.col("r") - F.col("c")).cast("double").alias("profit"))


@query("unpivot", """SELECT p_partkey, 'size' AS metric, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size IS NOT NULL
 UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part WHERE p_partkey % 5 <> 0 AND p_retailprice IS NOT NULL""")
def unpivot(t):
    wide = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("price"))
    return wide.unpivot(["p_partkey"], ["size", "price"], "metric", "value").filter(F.col("value").isNotNull())


FUNNEL = ["view", "click", "signup", "purchase", "error"]


@query("funnel", "WITH f AS (SELECT user_id, " + ", ".join(f"MAX(CASE WHEN event_type = '{s}' THEN 1 ELSE 0 END) AS {s}" for s in FUNNEL)
       + " FROM events GROUP BY 1), s AS (SELECT COUNT(*) AS total_users, " + ", ".join(f"CAST(SUM({s}) AS BIGINT) AS {s}" for s in FUNNEL) + " FROM f) SELECT *, "
       + ", ".join(f"{r2(f'CAST({b} AS DOUBLE) / NULLIF({a}, 0) * 100', 1)} AS {a}_to_{b}_pct" for a, b in zip(FUNNEL, FUNNEL[1:]))
       + f", {r2('CAST(error AS DOUBLE) / NULLIF(view, 0) * 100', 1)} AS overall_pct FROM s")
def funnel(t):
    return agg.funnel(t.events, "user_id", "event_type", FUNNEL)


RATES_SQL = """rates AS (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) / 100000 AS x, CAST(CAST(o_totalprice / 100000 AS DECIMAL(18,6)) AS DOUBLE) AS rate, CAST(o_orderdate AS DATE) AS effective FROM
 (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)"""


@query("time_weighted", f"""WITH {RATES_SQL}, p AS (SELECT *, coalesce(lead(effective) OVER (PARTITION BY o_custkey ORDER BY effective) - 1, DATE '1998-12-31') AS until FROM rates),
 w AS (SELECT *, date_diff('day', greatest(effective, DATE '1998-01-01'), least(until, DATE '1998-12-31')) + 1 AS days FROM p WHERE until >= DATE '1998-01-01' AND effective <= DATE '1998-12-31')
 SELECT o_custkey, {r2('CAST(SUM(CAST(rate AS DECIMAL(18,6)) * days) AS DOUBLE) / SUM(days)', 4)} AS time_weighted_avg_rate, CAST(SUM(days) AS BIGINT) AS total_days FROM w GROUP BY 1""")
def time_weighted(t):
    rows = t.orders.select("o_custkey", "o_orderkey", (F.col("o_totalprice") / 100000).cast("decimal(18,6)").alias("rate"), F.to_date("o_orderdate").alias("effective"))
    daily = dedup.latest_per_key(rows, ["o_custkey", "effective"], ["-o_orderkey"])
    return agg.time_weighted_average(daily.drop("o_orderkey"), "o_custkey", "rate", "effective", "1998-01-01", "1998-12-31")


DELINQUENT_SQL = f"""status AS (SELECT l_orderkey AS loan_id, MAX(CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END) AS last_paid, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS due,
 SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS paid FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{AS_OF}' GROUP BY 1),
 dpd AS (SELECT loan_id, CAST(due - paid AS DOUBLE) AS outstanding, CAST(date_diff('day', last_paid, DATE '{AS_OF}') AS INTEGER) AS days_past_due FROM status WHERE paid < due)"""


def delinquent(t):
    paid = F.col("l_linestatus") == "F"
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("loan_id"), F.to_date("l_shipdate").alias("due"), F.when(paid, F.to_date("l_shipdate")).alias("paid"),
        F.col("l_extendedprice").alias("amount_due"), F.when(paid, F.col("l_extendedprice")).alias("amount_paid"))
    found = agg.delinquency(rows, "loan_id", "due", "paid", "amount_due", "amount_paid", AS_OF)
    return found.withColumn("delinquency_bucket", scales.up_to("days_past_due", DPD_BUCKETS))


@query("delinquency", f"WITH {DELINQUENT_SQL} SELECT *, {scales.sql_case('days_past_due', DPD_BUCKETS, '<=')} AS delinquency_bucket FROM dpd")
def delinquency(t):
    return delinquent(t)


@query("delinquency_summary", f"""WITH {DELINQUENT_SQL}, b AS (SELECT *, {scales.sql_case('days_past_due', DPD_BUCKETS, '<=')} AS delinquency_bucket FROM dpd)
 SELECT delinquency_bucket, COUNT(*) AS loan_count, {dsum('outstanding')} AS total_outstanding, {r2('CAST(SUM(days_past_due) AS DOUBLE) / NULLIF(COUNT(days_past_due), 0)')} AS avg_dpd FROM b GROUP BY 1""")
def delinquency_summary(t):
    return delinquent(t).groupBy("delinquency_bucket").agg(
        F.count("*").alias("loan_count"), money_sum("outstanding").alias("total_outstanding"),
        rounded(ratio(F.sum("days_past_due"), F.count("days_past_due"))).alias("avg_dpd"))


@query("cumulative_distinct", """WITH f AS (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS day FROM orders GROUP BY 1), d AS (SELECT day, COUNT(*) AS new_keys FROM f GROUP BY 1)
 SELECT day, new_keys, CAST(SUM(new_keys) OVER (ORDER BY day) AS BIGINT) AS cumulative_keys FROM d""")
def cumulative_distinct(t):
    return agg.cumulative_distinct(t.orders.select("o_custkey", F.to_date("o_orderdate").alias("o_day")), "o_custkey", "o_day")


@query("event_histogram", """WITH c AS (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)
 SELECT user_id, CAST(SUM(n) AS BIGINT) AS total_events, concat('{', string_agg(concat('"', event_type, '":', n), ',' ORDER BY event_type), '}') AS event_summary,
 (list(event_type ORDER BY n DESC, event_type))[1] AS most_common_event FROM c GROUP BY 1""")
def event_histogram(t):
    return sessions.type_counts(t.events, ["user_id"], "event_type")


@query("count_threshold", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 HAVING COUNT(*) > 70")
def count_threshold(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).filter("n > 70")


@query("daily_revenue", f"""WITH {SALES_SQL} SELECT concat(CAST(txn_date AS VARCHAR), '_', region) AS date_region_key, txn_date AS revenue_date, region, COUNT(*) AS transaction_count,
 {dsum('amount')} AS total_revenue, {davg('amount')} AS avg_transaction FROM sales GROUP BY 2, 3""")
def daily_revenue(t):
    grouped = sales(t).groupBy(F.col("txn_date").alias("revenue_date"), "region").agg(
        F.count("*").alias("transaction_count"), money_sum("amount").alias("total_revenue"), money_avg("amount").alias("avg_transaction"))
    return grouped.withColumn("date_region_key", F.concat_ws("_", F.col("revenue_date").cast("string"), "region"))


@query("feature_table", f"""SELECT o_custkey, COUNT(*) AS order_count, {dsum('o_totalprice')} AS total_spend, {davg('o_totalprice')} AS avg_spend, MAX(o_totalprice) AS max_spend,
 COUNT(DISTINCT o_orderpriority) AS priorities, CAST(date_diff('day', MAX(CAST(o_orderdate AS DATE)), DATE '2001-08-01') AS INTEGER) AS recency_days,
 COUNT(*) FILTER (WHERE o_orderdate >= DATE '2001-05-03') AS orders_90d FROM orders GROUP BY 1""")
def feature_table(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("order_count"), money_sum("o_totalprice").alias("total_spend"), money_avg("o_totalprice").alias("avg_spend"),
        F.max("o_totalprice").alias("max_spend"), F.size(F.collect_set("o_orderpriority")).cast("bigint").alias("priorities"),
        F.datediff(F.lit("2001-08-01").cast("date"), F.to_date(F.max("o_orderdate"))).alias("recency_days"),
        F.count_if(F.expr("o_orderdate >= timestamp_ntz '2001-05-03'")).alias("orders_90d"))


@query("salted_agg", f"SELECT l_returnflag, {dsum('l_extendedprice')} AS total, COUNT(*) AS n FROM lineitem GROUP BY 1")
def salted_agg(t):
    return agg.salted_sum(t.lineitem, "l_returnflag", "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey"])


@query("failure_rate_topk", f"""SELECT user_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE event_type = 'error') AS failures,
 {r2("CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS DOUBLE) / COUNT(*) * 100")} AS failure_pct FROM events GROUP BY 1 ORDER BY failure_pct DESC, user_id LIMIT 5""")
def failure_rate_topk(t):
    failed = F.count_if(F.col("event_type") == "error")
    rates = t.events.groupBy("user_id").agg(F.count("*").alias("total"), failed.alias("failures"), pct(failed, F.count("*")).alias("failure_pct"))
    return rates.orderBy(F.desc("failure_pct"), "user_id").limit(5)


@query("summary_table", f"SELECT CAST(o_orderdate AS DATE) AS summary_date, o_orderstatus, COUNT(*) AS orders, {dsum('o_totalprice')} AS total, {davg('o_totalprice')} AS average FROM orders GROUP BY 1, 2")
def summary_table(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("summary_date"), "o_orderstatus").agg(
        F.count("*").alias("orders"), money_sum("o_totalprice").alias("total"), money_avg("o_totalprice").alias("average"))
