"""Data quality and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog.cleaning import DIRTY_EVENTS_SQL, dirty_events
from weirflow.catalog.standins import LOANS_SQL, loans, r2
from weirflow.catalog.windows import DAILY_SQL, daily_events
from weirflow.functions import text
from weirflow.functions.numbers import money, pct
from weirflow.operators import quality as q
from weirflow.plans import checks
from weirflow.plans.quantiles import exact_percentiles
from weirflow.registry import query

NOW = "2024-01-31 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")



NULLED_SQL = """nulled AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 25 = 0 THEN NULL ELSE value END AS value, ts FROM events)"""


def nulled(t):
    key = F.col("event_id")
    return t.events.select("event_id", F.when(key % 10 != 0, F.col("user_id")).alias("user_id"), F.when(key % 25 != 0, F.col("value")).alias("value"), "ts")


@query("dq_completeness", f"""WITH {NULLED_SQL} SELECT 'events' AS table_name, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE user_id IS NULL) AS null_user_id, COUNT(*) FILTER (WHERE value IS NULL) AS null_value, COUNT(*) FILTER (WHERE ts IS NULL) AS null_ts,
 {r2('CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) / COUNT(*) * 100')} AS null_pct FROM nulled""")
def dq_completeness(t):
    return q.completeness(nulled(t), "events", ["user_id", "value", "ts"])


@query("dq_uniqueness", "SELECT COUNT(*) AS total, COUNT(DISTINCT o_custkey) AS distinct_keys, COUNT(*) - COUNT(DISTINCT o_custkey) AS duplicates FROM orders")
def dq_uniqueness(t):
    return q.uniqueness(t.orders, "o_custkey")


@query("dq_freshness", f"SELECT MAX(ts) AS last_load, date_sub('minute', MAX(ts), TIMESTAMP '{NOW}') AS minutes_since_load, CASE WHEN date_sub('minute', MAX(ts), TIMESTAMP '{NOW}') > 120 THEN 'STALE' ELSE 'FRESH' END AS freshness_status FROM events")
def dq_freshness(t):
    return q.freshness(t.events, "ts", _now())


SOURCE = "(SELECT * FROM orders WHERE o_orderkey % 10 <> 0)"
TARGET = "(SELECT * FROM orders WHERE o_orderkey % 7 <> 0)"


def _both(t):
    return t.orders.filter("o_orderkey % 10 <> 0"), t.orders.filter("o_orderkey % 7 <> 0")


@query("dq_count_match", f"SELECT s AS source_count, t AS target_count, s - t AS difference, CASE WHEN s = t THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT COUNT(*) AS s FROM {SOURCE}), (SELECT COUNT(*) AS t FROM {TARGET})")
def dq_count_match(t):
    return q.count_match(*_both(t))


@query("dq_recon_tolerance", f"""WITH s AS (SELECT COUNT(*) AS c, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM {SOURCE}), t AS (SELECT COUNT(*) AS c, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM {TARGET})
 SELECT 'row_count' AS check_type, CAST(s.c AS DOUBLE) AS source_value, CAST(t.c AS DOUBLE) AS target_value, CAST(abs(s.c - t.c) AS DOUBLE) AS difference, CASE WHEN abs(s.c - t.c) <= s.c * 0.001 THEN 'PASS' ELSE 'FAIL' END AS status FROM s, t
 UNION ALL SELECT 'amount_sum', CAST(s.v AS DOUBLE), CAST(t.v AS DOUBLE), CAST(abs(s.v - t.v) AS DOUBLE), CASE WHEN abs(s.v - t.v) < 0.01 THEN 'PASS' ELSE 'FAIL' END FROM s, t""")
def dq_recon_tolerance(t):
    return q.totals_within(*_both(t), "o_totalprice")


LEDGER_SQL = """s AS (SELECT o_orderkey AS txn_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_custkey AS account FROM orders WHERE o_orderkey % 10 <> 0),
 t AS (SELECT o_orderkey AS txn_id, CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS amount, o_custkey + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS account FROM orders WHERE o_orderkey % 7 <> 0),
 r AS (SELECT coalesce(s.txn_id, t.txn_id) AS txn_id, s.amount AS sa, t.amount AS ta, CASE WHEN s.txn_id IS NULL THEN 'MISSING_IN_SOURCE' WHEN t.txn_id IS NULL THEN 'MISSING_IN_TARGET' WHEN s.amount <> t.amount THEN 'AMOUNT_MISMATCH'
 WHEN s.account <> t.account THEN 'ACCOUNT_MISMATCH' ELSE 'MATCHED' END AS reconciliation_status FROM s FULL OUTER JOIN t ON s.txn_id = t.txn_id)"""


def ledgers(t):
    key = F.col("o_orderkey")
    source, target = _both(t)
    s = source.select(key.alias("txn_id"), money("o_totalprice").alias("amount"), F.col("o_custkey").alias("account"))
    g = target.select(
        key.alias("txn_id"), (money("o_totalprice") + F.when(key % 13 == 0, 1).otherwise(0)).cast("decimal(18,2)").alias("amount"),
        (F.col("o_custkey") + F.when(key % 17 == 0, 1).otherwise(0)).alias("account"))
    return s, g


@query("ledger_recon", f"""WITH {LEDGER_SQL} SELECT reconciliation_status, COUNT(*) AS record_count, CAST(SUM(abs(coalesce(sa, 0) - coalesce(ta, 0))) AS DOUBLE) AS total_variance FROM r GROUP BY 1
 UNION ALL SELECT 'SUMMARY', COUNT(*), CAST(SUM(CASE WHEN reconciliation_status <> 'MATCHED' THEN 1 ELSE 0 END) AS DOUBLE) FROM r""")
def ledger_recon(t):
    return q.reconciliation_report(q.reconcile(*ledgers(t), "txn_id", "amount", "account"))


@query("ledger_mismatches", f"WITH {LEDGER_SQL} SELECT txn_id, CAST(sa AS DOUBLE) AS source_amount, CAST(ta AS DOUBLE) AS target_amount, reconciliation_status FROM r WHERE reconciliation_status <> 'MATCHED'")
def ledger_mismatches(t):
    rows = q.reconcile(*ledgers(t), "txn_id", "amount", "account").filter("reconciliation_status <> 'MATCHED'")
    return rows.select("txn_id", F.col("source_amount").cast("double"), F.col("target_amount").cast("double"), "reconciliation_status")


@query("layer_recon", """WITH c AS (SELECT 1 AS i, 'source' AS layer, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders
 UNION ALL SELECT 2, 'landing', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders
 UNION ALL SELECT 3, 'raw', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders WHERE o_orderkey % 100 <> 0
 UNION ALL SELECT 4, 'curated', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END) FROM orders WHERE o_orderkey % 100 <> 0
 UNION ALL SELECT 5, 'serving', COUNT(*), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders WHERE o_orderkey < 0),
 v AS (SELECT *, lag(n) OVER (ORDER BY i) AS pn, lag(v) OVER (ORDER BY i) AS pv FROM c)
 SELECT layer, n AS row_count, CAST(v AS DOUBLE) AS total_amount, n - coalesce(pn, n) AS row_diff, CAST(v - coalesce(pv, v) AS DOUBLE) AS amount_diff,
 CASE WHEN n = 0 THEN 'CRITICAL: No data' WHEN abs(n - coalesce(pn, n)) > 0 THEN 'WARNING: Row count mismatch' WHEN abs(v - coalesce(pv, v)) > 0.01 THEN 'WARNING: Amount mismatch' ELSE 'PASS' END AS status FROM v""")
def layer_recon(t):
    rows = t.orders.select("o_orderkey", money("o_totalprice").alias("amount"))
    raw = rows.filter("o_orderkey % 100 <> 0")
    curated = raw.withColumn("amount", F.col("amount") + F.when(F.col("o_orderkey") % 50 == 1, 1).otherwise(0))
    return q.layer_chain({"source": rows, "landing": rows, "raw": raw, "curated": curated, "serving": rows.filter("o_orderkey < 0")}, "amount")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]


@query("expectations", f"""SELECT 'not_null:c_name' AS check_name, v AS check_value, v <= 0 AS passed FROM (SELECT COUNT(*) FILTER (WHERE c_name IS NULL) AS v FROM customer)
 UNION ALL SELECT 'between:c_acctbal', v, v <= 0 FROM (SELECT COUNT(*) FILTER (WHERE NOT c_acctbal BETWEEN 0 AND 1000000) AS v FROM customer)
 UNION ALL SELECT 'in_set:c_mktsegment', v, v <= 0 FROM (SELECT COUNT(*) FILTER (WHERE c_mktsegment NOT IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD')) AS v FROM customer)
 UNION ALL SELECT 'unique:c_custkey', v, v <= 0 FROM (SELECT COUNT(c_custkey) - COUNT(DISTINCT c_custkey) AS v FROM customer)
 UNION ALL SELECT 'row_count', v, v BETWEEN 100 AND 10000000 FROM (SELECT COUNT(*) AS v FROM customer)""")
def expectations(t):
    return checks.run(t.customer, [
        checks.not_null("c_name"), checks.between("c_acctbal", 0, 1_000_000), checks.in_set("c_mktsegment", SEGMENTS),
        checks.unique("c_custkey"), checks.row_count(100, 10_000_000)])


@query("gate_check", "SELECT CASE WHEN COUNT(*) > 0 THEN 1 ELSE 0 END AS has_data, CASE WHEN COUNT(*) FILTER (WHERE o_totalprice < 0) = 0 THEN 1 ELSE 0 END AS no_negatives, CASE WHEN COUNT(*) = COUNT(DISTINCT o_orderkey) THEN 1 ELSE 0 END AS no_dupes FROM orders")
def gate_check(t):
    yes = lambda c: F.when(c, 1).otherwise(0)
    return t.orders.agg(
        yes(F.count("*") > 0).alias("has_data"), yes(F.count_if(F.col("o_totalprice") < 0) == 0).alias("no_negatives"),
        yes(F.count("*") == F.count_distinct("o_orderkey")).alias("no_dupes"))


@query("schema_tests", f"""WITH {LOANS_SQL} SELECT 'not_null:loan_id' AS test, COUNT(*) FILTER (WHERE loan_id IS NULL) AS failures FROM loans
 UNION ALL SELECT 'unique:loan_id', COUNT(loan_id) - COUNT(DISTINCT loan_id) FROM loans
 UNION ALL SELECT 'in_set:loan_type', COUNT(*) FILTER (WHERE loan_type NOT IN ('PERSONAL','AUTO','MORTGAGE','CREDIT_CARD','STUDENT','HOME_EQUITY')) FROM loans
 UNION ALL SELECT 'between:amount', COUNT(*) FILTER (WHERE NOT amount BETWEEN 0 AND 10000000) FROM loans
 UNION ALL SELECT 'not_in_set:application_date', COUNT(*) FILTER (WHERE application_date IN (DATE '9999-12-31')) FROM loans
 UNION ALL SELECT 'relationships:l_suppkey', COUNT(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 3)""")
def schema_tests(t):
    import datetime

    from weirflow.functions.fixed import LOAN_TYPES

    results = checks.run(loans(t), [
        checks.not_null("loan_id"), checks.unique("loan_id"), checks.in_set("loan_type", LOAN_TYPES),
        checks.between("amount", 0, 10_000_000), checks.not_in_set("application_date", [datetime.date(9999, 12, 31)])])
    lost = q.orphans(t.lineitem, "l_suppkey", t.supplier.filter("s_suppkey % 10 <> 3"), "s_suppkey").agg(
        F.lit("relationships:l_suppkey").alias("test"), F.count("*").alias("failures"))
    return results.select(F.col("check_name").alias("test"), F.col("check_value").alias("failures")).unionByName(lost)


@query("balance_test", """WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1), f AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1)
 SELECT f.day, CAST(f.v AS DOUBLE) AS total_amount, CAST(s.v AS DOUBLE) AS source_amount FROM f JOIN s ON f.day = s.day WHERE abs(f.v - s.v) > 0.01""")
def balance_test(t):
    daily = lambda df, out: df.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias(out))
    both = daily(t.orders.filter("o_orderkey % 50 <> 0"), "f").join(daily(t.orders, "s"), "day")
    return both.filter(F.abs(F.col("f") - F.col("s")) > 0.01).select("day", F.col("f").cast("double").alias("total_amount"), F.col("s").cast("double").alias("source_amount"))


@query("future_dates", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-30'")
def future_dates(t):
    return t.orders.filter(F.expr("o_orderdate > timestamp_ntz '2001-06-30'")).select("o_orderkey", "o_orderdate")


@query("source_freshness", f"""WITH l AS (SELECT user_id, MAX(ts) AS last_load, date_sub('minute', MAX(ts), TIMESTAMP '{NOW}') AS age_minutes FROM events GROUP BY 1)
 SELECT *, CASE WHEN age_minutes > 1440 THEN 'error' WHEN age_minutes > 720 THEN 'warn' ELSE 'pass' END AS status FROM l""")
def source_freshness(t):
    return q.source_freshness(t.events, "user_id", "ts", _now(), 12, 24)


@query("assertions", """SELECT 'uniqueKey' AS assertion, COUNT(*) AS failures FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1)
 UNION ALL SELECT 'nonNull', COUNT(*) FROM orders WHERE o_orderkey IS NULL OR o_totalprice IS NULL UNION ALL SELECT 'rowConditions', COUNT(*) FROM orders WHERE NOT (o_totalprice > 1000)""")
def assertions(t):
    repeated = q.duplicates(t.orders, ["o_custkey", "o_orderdate"]).agg(F.lit("uniqueKey").alias("assertion"), F.count("*").alias("failures"))
    rest = checks.run(t.orders, [checks.condition("nonNull", "o_orderkey is not null and o_totalprice is not null"), checks.condition("rowConditions", "o_totalprice > 1000")])
    return repeated.unionByName(rest.select(F.col("check_name").alias("assertion"), F.col("check_value").alias("failures")))


@query("migration_check", f"""WITH s AS (SELECT COUNT(*) AS c, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem), t AS (SELECT COUNT(*) AS c, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM (SELECT * FROM lineitem))
 SELECT 'row_count' AS check_type, CAST(s.c AS DOUBLE) AS source_value, CAST(t.c AS DOUBLE) AS target_value, CAST(abs(s.c - t.c) AS DOUBLE) AS difference, CASE WHEN s.c = t.c THEN 'PASS' ELSE 'FAIL' END AS status FROM s, t
 UNION ALL SELECT 'amount_sum', CAST(s.v AS DOUBLE), CAST(t.v AS DOUBLE), CAST(abs(s.v - t.v) AS DOUBLE), CASE WHEN abs(s.v - t.v) < 1 THEN 'PASS' ELSE 'FAIL' END FROM s, t""")
def migration_check(t):
    return q.totals_within(t.lineitem, t.lineitem.select("*"), "l_extendedprice", count_share=0.0, sum_limit=1.0)


@query("table_diff", """WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0)
 SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def table_diff(t):
    source, target = _both(t)
    changed = F.when(F.col("o_orderkey") % 13 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return q.table_diff(source.select("o_orderkey", "o_orderstatus"), target.select("o_orderkey", changed))


@query("keyed_diff", """WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 10 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 7 <> 0),
 j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderstatus AS s1, b.o_orderstatus AS s2, a.o_orderpriority AS p1, b.o_orderpriority AS p2 FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
 SELECT o_orderkey, 'o_orderstatus' AS column_name, s1 AS left_value, s2 AS right_value FROM j WHERE s1 IS DISTINCT FROM s2 UNION ALL SELECT o_orderkey, 'o_orderpriority', p1, p2 FROM j WHERE p1 IS DISTINCT FROM p2""")
def keyed_diff(t):
    source, target = _both(t)
    changed = F.when(F.col("o_orderkey") % 13 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    return q.keyed_diff(source, target.select("o_orderkey", changed, "o_orderpriority"), "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("dq_metrics", """SELECT DATE '2024-01-31' AS check_date, 'customer' AS table_name, n AS check_name, CAST(v AS DOUBLE) AS check_value, CAST(0.0 AS DOUBLE) AS threshold, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'run-1' AS run_id FROM
 (SELECT 'not_null:c_name' AS n, COUNT(*) FILTER (WHERE c_name IS NULL) AS v FROM customer UNION ALL SELECT 'unique:c_nationkey', COUNT(c_nationkey) - COUNT(DISTINCT c_nationkey) FROM customer)""")
def dq_metrics(t):
    results = checks.run(t.customer, [checks.not_null("c_name"), checks.unique("c_nationkey")])
    return q.metric_rows(results, F.lit("2024-01-31").cast("date"), "customer", "run-1")


@query("dq_alerts", f"""WITH {NULLED_SQL}, d AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, COUNT(*) FILTER (WHERE user_id IS NULL) AS x FROM nulled WHERE day(ts) % 9 <> 0 OR event_id % 3 = 0 GROUP BY 1), l AS (SELECT *, lag(n) OVER (ORDER BY day) AS b FROM d),
 p AS (SELECT day, n AS rows, {r2('CAST(x AS DOUBLE) / n * 100')} AS null_pct, {r2('CAST(b - n AS DOUBLE) / b * 100')} AS drop_pct FROM l)
 SELECT *, concat_ws(',', CASE WHEN null_pct > 5 THEN 'null_pct' END, CASE WHEN drop_pct > 20 THEN 'row_drop' END) AS alerts FROM p WHERE null_pct > 5 OR drop_pct > 20""")
def dq_alerts(t):
    kept = nulled(t).filter((F.dayofmonth("ts") % 9 != 0) | (F.col("event_id") % 3 == 0))
    daily = kept.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("user_id").isNull()).alias("nulls"))
    return q.daily_alerts(daily, "day", "n", "nulls")


@query("find_duplicates", "SELECT user_id, event_type, CAST(ts AS DATE) AS day, COUNT(*) AS cnt FROM events GROUP BY 1, 2, 3 HAVING COUNT(*) > 1")
def find_duplicates(t):
    return q.duplicates(t.events.select("user_id", "event_type", F.to_date("ts").alias("day")), ["user_id", "event_type", "day"])


@query("source_zero_rows", f"""WITH {DIRTY_EVENTS_SQL} SELECT DISTINCT e.user_id FROM events e WHERE e.user_id NOT IN (SELECT user_id FROM events JOIN dirty ON events.event_id = dirty.event_id WHERE TRY_CAST(dirty.value AS DOUBLE) > 480)""")
def source_zero_rows(t):
    """Users without one valid value above 480."""
    rows = t.events.select("event_id", "user_id").join(dirty_events(t).select("event_id", text.number("value").alias("number")), "event_id")
    return q.silent_sources(t.events.select("user_id").distinct(), rows, "user_id", F.col("number") > 480)


@query("partition_alignment", """WITH p AS (SELECT CASE WHEN event_id % 500 = 0 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS part_date, ts FROM events)
 SELECT part_date, CAST(MIN(ts) AS DATE) AS min_date, CAST(MAX(ts) AS DATE) AS max_date FROM p GROUP BY 1 HAVING CAST(MIN(ts) AS DATE) <> part_date OR CAST(MAX(ts) AS DATE) <> part_date""")
def partition_alignment(t):
    day = F.to_date("ts")
    filed = t.events.select(F.when(F.col("event_id") % 500 == 0, F.date_add(day, 1)).otherwise(day).alias("part_date"), "ts")
    return q.misfiled(filed, "part_date", "ts")


UNIT_SQL = "v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * CASE WHEN l_partkey % 97 = 0 THEN 100 ELSE 1 END AS price FROM lineitem)"


@query("unit_fix", f"""WITH {UNIT_SQL}, p AS (SELECT quantile_cont(l_extendedprice, 0.99) AS lim FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r2('CASE WHEN price > lim THEN price / 100 ELSE price END')} AS fixed_price, price > lim AS was_rescaled FROM v, p""")
def unit_fix(t):
    """The historic p99 is one number: a scalar subquery."""
    broken = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") * F.when(F.col("l_partkey") % 97 == 0, 100).otherwise(1)).alias("price"))
    limit = exact_percentiles(t.lineitem.select("l_extendedprice"), [], "l_extendedprice", {"p99": 0.99}).scalar()
    return q.rescale_above(broken, "price", limit, 100).drop("price")


@query("duration_alert", f"""WITH {DAILY_SQL}, a AS (SELECT event_type, day, revenue, avg(revenue) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS x, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS rn FROM daily)
 SELECT event_type, day, revenue AS latest, {r2('x')} AS rolling_avg, revenue > 1.5 * x AS is_slow FROM a WHERE rn = 1""")
def duration_alert(t):
    return q.duration_alerts(daily_events(t).drop("n"), "event_type", "day", "revenue")


@query("weekly_compliance", f"""WITH {DAILY_SQL} SELECT event_type, CAST(date_trunc('week', day) AS DATE) AS week, COUNT(*) AS runs, {r2('CAST(COUNT(*) FILTER (WHERE n <= 70) AS DOUBLE) / COUNT(*) * 100')} AS compliance_pct FROM daily GROUP BY 1, 2""")
def weekly_compliance(t):
    return daily_events(t).groupBy("event_type", F.to_date(F.date_trunc("week", "day")).alias("week")).agg(
        F.count("*").alias("runs"), pct(F.count_if(F.col("n") <= 70), F.count("*")).alias("compliance_pct"))


@query("stale_success", f"""SELECT event_type, MAX(ts) FILTER (WHERE value > 100 AND event_type <> 'view') AS last_success, COUNT(*) AS runs, CAST(date_sub('second', MAX(ts) FILTER (WHERE value > 100 AND event_type <> 'view'), TIMESTAMP '{NOW}') AS BIGINT) AS age_seconds,
 coalesce(date_sub('second', MAX(ts) FILTER (WHERE value > 100 AND event_type <> 'view'), TIMESTAMP '{NOW}') > 2 * 14400, true) AS is_stale FROM events GROUP BY 1""")
def stale_success(t):
    """Event types as jobs that run every four hours: stale when the last success is more than two intervals ago, or there was none."""
    return q.stale_jobs(t.events, "event_type", "ts", (F.col("value") > 100) & (F.col("event_type") != "view"), _now(), 14_400)


@query("result_age", f"""SELECT event_type, MAX(time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE) AS latest_data, CAST(date_sub('minute', MAX(time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE), TIMESTAMP '{NOW}') AS BIGINT) AS age_minutes FROM events GROUP BY 1""")
def result_age(t):
    """How far the newest hourly result of each type lies behind the clock."""
    hourly = t.events.select("event_type", (F.date_trunc("hour", "ts") + F.expr("interval 1 hour")).cast("timestamp_ntz").alias("window_end"))
    return q.result_age(hourly, "window_end", _now(), ["event_type"])
