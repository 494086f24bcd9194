"""Projections, joins, set operations, sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.catalog.standins import LOANS_SQL, dsum, loans, r2
from weirflow.functions import scales
from weirflow.functions.fixed import DUPLICATE_CONFIDENCE
from weirflow.functions.numbers import money_sum, rounded
from weirflow.operators import relational as rel
from weirflow.plans import asof, dedup, graph, joins, lists
from weirflow.plans.segments import plan_cuts, running_window
from weirflow.registry import query
from weirflow.sources import tables



@query("scan_pruned", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-04-01'")
def scan_pruned(t):
    """The date range reaches the parquet reader; on a partitioned layout it also prunes folders."""
    return t.orders.filter(F.expr("o_orderdate >= timestamp_ntz '1997-03-01' and o_orderdate < timestamp_ntz '1997-04-01'")).select("o_orderkey", "o_totalprice")


@query("project_filter", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def project_filter(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("date_range_sum", f"SELECT o_orderpriority, COUNT(*) AS orders, {dsum('o_totalprice')} AS total FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30' AND o_orderstatus = 'O' GROUP BY 1")
def date_range_sum(t):
    ranged = t.orders.filter(F.expr("o_orderdate between timestamp_ntz '1997-01-01' and timestamp_ntz '1997-06-30'"))
    return ranged.filter(F.col("o_orderstatus") == "O").groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), money_sum("o_totalprice").alias("total"))


@query("select_except", "SELECT * EXCLUDE (o_orderpriority, o_orderstatus) FROM orders")
def select_except(t):
    return t.orders.drop("o_orderpriority", "o_orderstatus")


@query("case_status", f"WITH {LOANS_SQL} SELECT loan_id, CASE WHEN date_diff('day', application_date, DATE '1999-06-30') > 90 AND status = 'O' THEN 'DEFAULT' WHEN status = 'O' THEN 'ACTIVE' ELSE 'CLOSED' END AS loan_status FROM loans")
def case_status(t):
    overdue = F.datediff(F.lit("1999-06-30").cast("date"), "application_date") > 90
    status = F.when(overdue & (F.col("status") == "O"), "DEFAULT").when(F.col("status") == "O", "ACTIVE").otherwise("CLOSED")
    return loans(t).select("loan_id", status.alias("loan_status"))


@query("having_filter", f"SELECT o_custkey, COUNT(*) AS orders, {dsum('o_totalprice')} AS total FROM orders GROUP BY 1 HAVING COUNT(*) > 10")
def having_filter(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"), money_sum("o_totalprice").alias("total")).filter("orders > 10")


ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]


def nested_orders(t):
    """Order rows with their items nested: ``items`` is an array of structs."""
    items = lists.ordered_lists(
        t.lineitem.select("l_orderkey", *ITEM_ORDER, "l_quantity", "l_extendedprice"), ["l_orderkey"], ITEM_ORDER,
        {"items": ["l_partkey", "l_quantity", "l_extendedprice"]},
    )
    head = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return head.join(items, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


ITEM_TEXT = "concat(l_partkey, ':', CAST(l_quantity AS INTEGER), ':', CAST(l_extendedprice AS DECIMAL(18,2)))"


@query("nest_items", f"""SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, part_no, COUNT(*) AS item_count,
 string_agg({ITEM_TEXT}, ';' ORDER BY item_no) AS items FROM
 (SELECT *, CAST((item_no - 1) // 10000 AS INTEGER) AS part_no FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS item_no FROM lineitem))
 JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4""")
def nest_items(t):
    text = F.transform("items", lambda i: F.concat_ws(
        ":", i["l_partkey"].cast("string"), i["l_quantity"].cast("int").cast("string"),
        i["l_extendedprice"].cast("decimal(18,2)").cast("string")))
    return nested_orders(t).withColumn("items", F.concat_ws(";", text))


@query("unnest_items", f"SELECT o_orderkey, o_custkey, l_partkey, {r2('l_quantity * l_extendedprice')} AS line_total FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def unnest_items(t):
    return nested_orders(t).select("o_orderkey", "o_custkey", F.inline("items")).select(
        "o_orderkey", "o_custkey", "l_partkey", rounded(F.col("l_quantity") * F.col("l_extendedprice")).alias("line_total"))


@query("public_view", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0")
def public_view(t):
    return tables.public_view(t.customer, hidden=["c_name", "c_acctbal"], condition=F.col("c_acctbal") > 0)


@query("wide_table", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, c_name, c_mktsegment, n_name AS nation, r_name AS region
 FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def wide_table(t):
    places = joins.join_dimension(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, ["r_regionkey"], "left")
    people = joins.join_dimension(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), places, ["n_nationkey"], "left")
    wide = joins.join_dimension(t.orders.withColumnRenamed("o_custkey", "c_custkey"), people, ["c_custkey"], "left", size_of=t.customer)
    return wide.select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("amount"),
        "c_name", "c_mktsegment", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_keys(t):
    return t.events.select("user_id", "event_type").distinct()


@query("inner_join", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 1000")
def inner_join(t):
    return t.orders.filter("o_totalprice > 1000").join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("left_join_dim", f"""SELECT o_orderkey, o_totalprice, c_name, c_mktsegment, {scales.sql_case('o_totalprice', [(10000, 'HIGH_VALUE'), (1000, 'MEDIUM_VALUE'), (None, 'LOW_VALUE')], '>')} AS value_tier
 FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey WHERE o_totalprice > 0""")
def left_join_dim(t):
    from weirflow.functions.fixed import VALUE_TIERS

    dim = t.customer.filter("c_custkey % 10 <> 0").withColumnRenamed("c_custkey", "o_custkey")
    return joins.join_dimension(t.orders.filter("o_totalprice > 0"), dim, ["o_custkey"], "left").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment", scales.above("o_totalprice", VALUE_TIERS).alias("value_tier"))


@query("cross_join", """WITH days AS (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM events)
 SELECT event_type AS source, day FROM (SELECT DISTINCT event_type FROM events) CROSS JOIN days""")
def cross_join(t):
    """Every source with every calendar day: the calendar is a short array, so no cross join is needed."""
    span = t.events.agg(F.sequence(F.to_date(F.min("ts")), F.to_date(F.max("ts"))))
    return rel.with_calendar(t.events.select(F.col("event_type").alias("source")), ["source"], span.scalar(), "day")


@query("semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-01-01')")
def semi_join(t):
    recent = t.orders.filter("o_orderdate >= timestamp_ntz '2001-01-01'").select(F.col("o_custkey").alias("c_custkey")).distinct()  # a hot right side cannot be split
    return t.customer.join(recent, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("anti_join", "SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '2001-01-01') ON c_custkey = o_custkey WHERE o_custkey IS NULL")
def anti_join(t):
    recent = t.orders.filter("o_orderdate >= timestamp_ntz '2001-01-01'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.join(recent, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("range_self_join", f"""SELECT a.event_id AS first_event_id, b.event_id AS second_event_id, a.user_id, a.event_type, a.ts AS first_ts, b.ts AS second_ts,
 date_sub('second', a.ts, b.ts) AS seconds_apart, {scales.sql_case("date_sub('second', a.ts, b.ts)", DUPLICATE_CONFIDENCE, '<')} AS confidence
 FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = b.event_type AND b.ts > a.ts AND date_sub('minute', a.ts, b.ts) <= 5 AND a.event_id <> b.event_id""")
def range_self_join(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    pairs = joins.range_join_pairs(rows, ["user_id", "event_type"], "ts", "event_id", 5, ["event_id", "ts"])
    return pairs.withColumn("confidence", scales.below("seconds_apart", DUPLICATE_CONFIDENCE))


TREE_SQL = "tree AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey < 10 THEN NULL ELSE p_partkey // 10 END AS parent FROM part WHERE p_partkey >= 1)"


def tree(t):
    parent = F.when(F.col("p_partkey") >= 10, F.floor(F.col("p_partkey") / 10))
    return t.part.filter("p_partkey >= 1").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), parent.alias("parent"))


@query("hierarchy_paths", f"""WITH RECURSIVE {TREE_SQL}, walk AS (SELECT id, name, parent, name AS full_path, 0 AS depth FROM tree WHERE parent IS NULL
 UNION ALL SELECT c.id, c.name, c.parent, concat(w.full_path, ' > ', c.name), w.depth + 1 FROM tree c JOIN walk w ON c.parent = w.id) SELECT * FROM walk""")
def hierarchy_paths(t):
    return graph.hierarchy_paths(tree(t), "id", "parent", "name")


@query("descendants", f"""WITH RECURSIVE {TREE_SQL}, walk AS (SELECT * FROM tree WHERE id = 3 UNION ALL SELECT c.* FROM tree c JOIN walk w ON c.parent = w.id) SELECT * FROM walk""")
def descendants(t):
    return graph.descendants(tree(t), "id", "parent", 3)


EDGES_SQL = """edges AS (SELECT n_nationkey AS s, (3 * n_nationkey + 1) % 25 AS t, 'copy' AS kind FROM nation
 UNION ALL SELECT n_nationkey, (n_nationkey + 7) % 25, CASE WHEN n_nationkey % 2 = 0 THEN 'agg' ELSE 'join' END FROM nation)"""


def dependencies(t):
    n = F.col("n_nationkey")
    one = t.nation.select(n.alias("s"), ((3 * n + 1) % 25).alias("t"), F.lit("copy").alias("kind"))
    two = t.nation.select(n.alias("s"), ((n + 7) % 25).alias("t"), F.when(n % 2 == 0, "agg").otherwise("join").alias("kind"))
    return one.unionByName(two)


@query("lineage_impact", f"""WITH RECURSIVE {EDGES_SQL}, walk AS (SELECT s, t, kind, 1 AS depth, [s, t] AS path FROM edges WHERE s = 0
 UNION ALL SELECT w.t, e.t, e.kind, w.depth + 1, list_append(w.path, e.t) FROM walk w JOIN edges e ON w.t = e.s WHERE w.depth < 10 AND NOT list_contains(w.path, e.t)),
 best AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY depth, CAST(path AS VARCHAR[])) AS rn FROM walk)
 SELECT t AS affected, CAST(MIN(depth) AS INTEGER) AS hops_from_source, MAX(CASE WHEN rn = 1 THEN array_to_string(CAST(path AS VARCHAR[]), '>') END) AS dependency_path,
 string_agg(DISTINCT kind, ',' ORDER BY kind) AS transform_types FROM best GROUP BY t""")
def lineage_impact(t):
    return graph.downstream_impact(dependencies(t), "s", "t", "kind", 0)


VERSIONS_SQL = """versions AS (SELECT o_custkey, o_orderpriority AS segment, CAST(o_orderdate AS DATE) AS valid_from,
 coalesce(CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS DATE) - 31, DATE '9999-12-31') AS valid_to FROM
 (SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_orderkey % 4 = 0) WHERE rn = 1)"""


def versions(t):
    """Customer segments with validity: each ends 31 days before the next begins (gaps on purpose)."""
    from weirflow.plans.segments import frame_window

    rows = t.orders.filter("o_orderkey % 4 = 0").select(
        "o_custkey", F.col("o_orderpriority").alias("segment"), F.to_date("o_orderdate").alias("valid_from"), "o_orderkey")
    daily = dedup.latest_per_key(rows, ["o_custkey", "valid_from"], ["-o_orderkey"]).drop("o_orderkey")
    ended = frame_window(daily, ["o_custkey"], ["valid_from"], {"next_from": lambda w: F.lead("valid_from").over(w)}, after=1)
    return ended.select("o_custkey", "segment", "valid_from", F.coalesce(F.date_sub("next_from", 31), F.lit("9999-12-31").cast("date")).alias("valid_to"))


@query("asof_scd2", f"""WITH {VERSIONS_SQL} SELECT o_orderkey, o.o_custkey, CAST(o_orderdate AS DATE) AS order_date, v.segment FROM orders o LEFT JOIN versions v
 ON o.o_custkey = v.o_custkey AND CAST(o_orderdate AS DATE) BETWEEN v.valid_from AND v.valid_to""")
def asof_scd2(t):
    facts = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"))
    return asof.asof_lookup(facts, versions(t), "o_custkey", "order_date", "valid_from", "valid_to", ["segment"])


PART_SALES_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey"


def _part_sides(t):
    big = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return big, t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")


@query("broadcast_join", PART_SALES_SQL)
def broadcast_join(t):
    big, small = _part_sides(t)
    return joins.join_dimension(big, small, ["l_partkey"])


@query("salted_join", PART_SALES_SQL)
def salted_join(t):
    big, small = _part_sides(t)
    return joins.salted_join(big, small, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("hot_key_join", PART_SALES_SQL)
def hot_key_join(t):
    big, small = _part_sides(t)
    return joins.hot_key_join(big, small, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"], share=0.0005)


@query("scalar_subquery", f"""SELECT o_custkey, {dsum('o_totalprice')} AS total, (SELECT {dsum('l_extendedprice')} FROM lineitem JOIN orders o2 ON l_orderkey = o2.o_orderkey WHERE o2.o_custkey = o.o_custkey) AS line_total
 FROM orders o GROUP BY o_custkey HAVING abs({dsum('o_totalprice')} - coalesce((SELECT {dsum('l_extendedprice')} FROM lineitem JOIN orders o2 ON l_orderkey = o2.o_orderkey WHERE o2.o_custkey = o.o_custkey), 0)) > 0.01""")
def scalar_subquery(t):
    """Two aggregates per customer, joined on the already unique key."""
    totals = t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("total"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("line_sum"))
    lines = (t.orders.select("o_orderkey", "o_custkey").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
             .groupBy("o_custkey").agg(F.sum("line_sum").cast("double").alias("line_total")))
    return totals.join(lines, "o_custkey", "left").filter(F.abs(F.col("total") - F.coalesce("line_total", F.lit(0.0))) > 0.01)


@query("corr_cumulative", """SELECT a.o_orderkey, a.o_custkey, CAST(a.o_orderdate AS DATE) AS order_date,
 CAST(SUM(CAST(a.o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY a.o_custkey ORDER BY CAST(a.o_orderdate AS DATE)) AS DOUBLE) AS running_total FROM orders a""")
def corr_cumulative(t):
    """Sum of everything up to and including the row's date: days are summed first, so ties are whole."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    daily = rows.groupBy("o_custkey", "order_date").agg(F.sum("amount").alias("day_total"))
    running = running_window(daily, ["o_custkey"], ["order_date"], {"running_total": ("sum", "day_total")}, cuts=plan_cuts(rows, "order_date", keys=["o_custkey"]))
    return rows.drop("amount").join(running.select("o_custkey", "order_date", F.col("running_total").cast("double")), ["o_custkey", "order_date"])


@query("star_join", f"""SELECT r_name AS region, p_brand AS brand, CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS line_count, {dsum('l_extendedprice')} AS revenue
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def star_join(t):
    places = joins.join_dimension(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, ["r_regionkey"]).select("n_nationkey", "r_name")
    people = joins.join_dimension(t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), places, ["n_nationkey"]).select("c_custkey", "r_name")
    heads = joins.join_dimension(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("order_year")), people, ["c_custkey"], size_of=t.customer)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    joined = joins.join_dimension(lines.join(heads, "o_orderkey"), t.part.select("p_partkey", "p_brand"), ["p_partkey"])
    return joined.groupBy(F.col("r_name").alias("region"), F.col("p_brand").alias("brand"), "order_year").agg(
        F.count("*").alias("line_count"), money_sum("l_extendedprice").alias("revenue"))


@query("map_lookup", "SELECT n_nationkey, n_name, CASE n_regionkey WHEN 0 THEN 'south' WHEN 1 THEN 'west' WHEN 2 THEN 'east' ELSE 'Unknown' END AS zone FROM nation")
def map_lookup(t):
    return t.nation.select("n_nationkey", "n_name", rel.map_lookup("n_regionkey", {0: "south", 1: "west", 2: "east"}).alias("zone"))


@query("vault_load", """WITH hubs AS (SELECT DISTINCT 'hub_customer' AS entity, md5(CAST(o_custkey AS VARCHAR)) AS hk, CAST(NULL AS VARCHAR) AS hk2, CAST(NULL AS DATE) AS load_date FROM orders),
 links AS (SELECT DISTINCT 'link_customer_order', md5(CAST(o_custkey AS VARCHAR)), md5(CAST(o_orderkey AS VARCHAR)), CAST(NULL AS DATE) FROM orders),
 daily AS (SELECT * FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
 sats AS (SELECT o_custkey, d, md5(o_orderpriority || '|' || o_orderstatus) AS hd, lag(md5(o_orderpriority || '|' || o_orderstatus)) OVER (PARTITION BY o_custkey ORDER BY d) AS prev FROM daily)
 SELECT * FROM hubs UNION ALL SELECT * FROM links UNION ALL SELECT 'sat_customer', md5(CAST(o_custkey AS VARCHAR)), hd, d FROM sats WHERE prev IS NULL OR prev <> hd""")
def vault_load(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("load_date"))
    vault = rel.vault_split(rows, "o_custkey", "o_orderkey", ["o_orderpriority", "o_orderstatus"], "load_date", ["-o_orderkey"])
    shape = lambda df, name, hk2, d: df.select(F.lit(name).alias("entity"), "hk", hk2.cast("string").alias("hk2"), d.cast("date").alias("load_date"))
    return (
        shape(vault.hub, "hub_customer", F.lit(None), F.lit(None))
        .unionByName(shape(vault.link, "link_customer_order", F.col("hk2"), F.lit(None)))
        .unionByName(shape(vault.satellite, "sat_customer", F.col("hashdiff"), F.col("load_date")))
    )


@query("union_all", f"SELECT 'orders' AS report, COUNT(*) AS rows, {dsum('o_totalprice')} AS total FROM orders UNION ALL SELECT 'lines', COUNT(*), {dsum('l_extendedprice')} FROM lineitem")
def union_all(t):
    one = t.orders.agg(F.count("*").alias("rows"), money_sum("o_totalprice").alias("total")).withColumn("report", F.lit("orders"))
    two = t.lineitem.agg(F.count("*").alias("rows"), money_sum("l_extendedprice").alias("total")).withColumn("report", F.lit("lines"))
    return one.unionByName(two)


@query("lambda_serving", f"""SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, {dsum('o_totalprice')} AS daily_total, COUNT(*) AS txn_count, 'batch' AS layer FROM orders WHERE o_orderdate < DATE '2001-01-01' GROUP BY 1, 2
 UNION ALL SELECT CAST(o_orderdate AS DATE), o_orderpriority, {dsum('o_totalprice')}, COUNT(*), 'realtime' FROM orders WHERE o_orderdate >= DATE '2001-01-01' GROUP BY 1, 2""")
def lambda_serving(t):
    metrics = lambda df, layer: df.groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(
        money_sum("o_totalprice").alias("daily_total"), F.count("*").alias("txn_count")).withColumn("layer", F.lit(layer))
    return rel.batch_and_realtime(metrics(t.orders, "batch"), metrics(t.orders, "realtime"), "day", "2001-01-01")


@query("partition_diff", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS part_date FROM orders EXCEPT SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders WHERE month(o_orderdate) <> 7""")
def partition_diff(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("part_date"))
    return rel.missing_partitions(days, days.filter(F.month("part_date") != 7), "part_date")


@query("top_k", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("latest_n", "SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def latest_n(t):
    return t.events.select("event_id", "ts", "user_id", "event_type").orderBy(F.desc("ts"), F.desc("event_id")).limit(100)


@query("sorted_report", f"SELECT o_orderpriority, o_orderstatus, COUNT(*) AS orders, {dsum('o_totalprice')} AS total FROM orders GROUP BY 1, 2 ORDER BY 1, 4 DESC")
def sorted_report(t):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("orders"), money_sum("o_totalprice").alias("total")).orderBy("o_orderpriority", F.desc("total"))


@query("mode_per_group", """SELECT o_custkey, o_orderpriority AS mode_priority, n AS mode_count FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS rn
 FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1""")
def mode_per_group(t):
    return rel.mode_per_group(t.orders, ["o_custkey"], "o_orderpriority", "mode_priority", "mode_count")


@query("preview", None)
def preview(t):
    """First rows of two columns; which rows those are is not defined."""
    return t.orders.select("o_orderkey", "o_orderdate").limit(5)


@query("full_outer_recon", """SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'RIGHT_ONLY' WHEN b.o_orderkey IS NULL THEN 'LEFT_ONLY' ELSE 'BOTH' END AS side
 FROM (SELECT * FROM orders WHERE o_orderkey % 10 <> 0) a FULL OUTER JOIN (SELECT * FROM orders WHERE o_orderkey % 7 <> 0) b ON a.o_orderkey = b.o_orderkey""")
def full_outer_recon(t):
    left = t.orders.filter("o_orderkey % 10 <> 0").select("o_orderkey", F.lit(1).alias("l"))
    right = t.orders.filter("o_orderkey % 7 <> 0").select("o_orderkey", F.lit(1).alias("r"))
    side = F.when(F.col("l").isNull(), "RIGHT_ONLY").when(F.col("r").isNull(), "LEFT_ONLY").otherwise("BOTH")
    return left.join(right, "o_orderkey", "full_outer").select("o_orderkey", side.alias("side"))


@query("co_located_join", "SELECT l_orderkey, l_linenumber, l_extendedprice, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def co_located_join(t):
    """Two tables bucketed alike on the order key; the join shuffles nothing."""
    import uuid

    from weirflow.sources import tables

    big, small = (f"{x}_{uuid.uuid4().hex}" for x in ("wf_lines", "wf_orders"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_extendedprice")
    tables.write_co_located(lines, t.orders.select(F.col("o_orderkey").alias("k"), "o_custkey"), "k", big, small, buckets=16)
    return tables.join_co_located(t.spark, big, small, "k").withColumnRenamed("k", "l_orderkey")
