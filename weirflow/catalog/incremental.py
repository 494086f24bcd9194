"""Incremental loads, change data capture, slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.numbers import money
from weirflow.plans import merge
from weirflow.registry import query
from weirflow.sources import tables

D0, D1 = "2024-01-01", "2024-02-01"


def _day(text):
    return F.lit(text).cast("date")


@query("cdc_merge", f"""WITH target AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS email, DATE '{D0}' AS created_at, DATE '{D0}' AS updated_at, false AS is_deleted FROM customer),
 feed AS (SELECT c_custkey AS id, concat(c_name, '*') AS name, 'x' AS email, CASE WHEN c_custkey % 5 = 0 THEN 'UPDATE' ELSE 'DELETE' END AS op_type, DATE '{D1}' AS event_time FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0
 UNION ALL SELECT c_custkey + 1000000, c_name, 'new', CASE WHEN c_custkey % 3 = 0 THEN 'INSERT' ELSE 'UPDATE' END, DATE '{D1}' FROM customer)
 SELECT coalesce(t.id, f.id) AS id, CASE WHEN t.id IS NULL OR f.op_type = 'UPDATE' THEN f.name ELSE t.name END AS name, CASE WHEN t.id IS NULL OR f.op_type = 'UPDATE' THEN f.email ELSE t.email END AS email,
 coalesce(t.created_at, f.event_time) AS created_at, CASE WHEN f.op_type IN ('UPDATE', 'DELETE', 'INSERT') THEN f.event_time ELSE t.updated_at END AS updated_at,
 CASE WHEN t.id IS NULL THEN false WHEN f.op_type = 'DELETE' THEN true ELSE t.is_deleted END AS is_deleted
 FROM target t FULL OUTER JOIN feed f ON t.id = f.id WHERE t.id IS NOT NULL OR f.op_type = 'INSERT'""")
def cdc_merge(t):
    key = F.col("c_custkey")
    target = t.customer.select(key.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("email"),
                               _day(D0).alias("created_at"), _day(D0).alias("updated_at"), F.lit(False).alias("is_deleted"))
    changes = t.customer.filter("c_custkey % 5 = 0 or c_custkey % 7 = 0").select(
        key.alias("id"), F.concat("c_name", F.lit("*")).alias("name"), F.lit("x").alias("email"),
        F.when(key % 5 == 0, "UPDATE").otherwise("DELETE").alias("op_type"), _day(D1).alias("event_time"))
    others = t.customer.select(
        (key + 1000000).alias("id"), F.col("c_name").alias("name"), F.lit("new").alias("email"),
        F.when(key % 3 == 0, "INSERT").otherwise("UPDATE").alias("op_type"), _day(D1).alias("event_time"))
    return merge.apply_changes(target, changes.unionByName(others), "id", ["name", "email"])


ORDERS_SQL = "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders"
OLD_SQL = f"old AS ({ORDERS_SQL} WHERE o_orderkey % 10 <> 0)"
NEW_SQL = f"new AS (SELECT o_orderkey, 'X' AS o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 4 = 0)"


def _orders(t):
    return t.orders.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")


def _old_new(t):
    old = _orders(t).filter("o_orderkey % 10 <> 0")
    new = _orders(t).filter("o_orderkey % 4 = 0").withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    return old, new


@query("upsert", f"WITH {OLD_SQL}, {NEW_SQL} SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)")
def upsert(t):
    return merge.upsert(*_old_new(t), ["o_orderkey"])


@query("insert_absent", f"WITH {OLD_SQL}, {NEW_SQL} SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)")
def insert_absent(t):
    return merge.insert_absent(*_old_new(t), ["o_orderkey"])


@query("scd1", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def scd1(t):
    base = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    fixes = base.filter("c_custkey % 5 = 0").withColumn("c_mktsegment", F.lit("MOVED"))
    return merge.upsert(base, fixes, ["c_custkey"], update=["c_mktsegment"])


@query("scd2_merge", f"""WITH dim AS (SELECT c_custkey, c_mktsegment AS segment, DATE '{D0}' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current FROM customer
 UNION ALL SELECT c_custkey, 'OLD', DATE '2023-01-01', DATE '{D0}', false FROM customer WHERE c_custkey % 2 = 0), delta AS (SELECT c_custkey, 'MOVED' AS segment FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT c_custkey + 1000000, 'NEW' FROM customer WHERE c_custkey % 9 = 0)
 SELECT c_custkey, segment, start_date, CASE WHEN is_current AND c_custkey IN (SELECT c_custkey FROM delta) THEN DATE '{D1}' ELSE end_date END AS end_date, is_current AND c_custkey NOT IN (SELECT c_custkey FROM delta) AS is_current FROM dim
 UNION ALL SELECT c_custkey, segment, DATE '{D1}', NULL, true FROM delta""")
def scd2_merge(t):
    current = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), _day(D0).alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))
    past = t.customer.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("OLD").alias("segment"), _day("2023-01-01").alias("start_date"), _day(D0).alias("end_date"), F.lit(False).alias("is_current"))
    delta = t.customer.filter("c_custkey % 5 = 0").select("c_custkey", F.lit("MOVED").alias("segment")).unionByName(
        t.customer.filter("c_custkey % 9 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), F.lit("NEW").alias("segment")))
    return merge.scd2_merge(current.unionByName(past), delta, "c_custkey", _day(D1))


@query("scd3", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS previous_segment FROM customer")
def scd3(t):
    base = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return merge.scd3(base, base.filter("c_custkey % 5 = 0").withColumn("segment", F.lit("MOVED")), "c_custkey", "segment")


SNAP_ID = "md5(concat_ws('|', CAST(c_custkey AS VARCHAR), CAST({d} AS VARCHAR)))"
HISTORY_SQL = f"""hist AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_nationkey AS nation, DATE '{D0}' AS updated_at, {SNAP_ID.format(d=f"DATE '{D0}'")} AS scd_id, DATE '{D0}' AS valid_from, CAST(NULL AS DATE) AS valid_to FROM customer WHERE c_custkey % 11 <> 0),
 src AS (SELECT c_custkey, c_mktsegment AS segment, c_nationkey AS nation, CASE WHEN c_custkey % 4 = 0 THEN DATE '{D1}' ELSE DATE '{D0}' END AS updated_at FROM customer WHERE c_custkey % 13 <> 0)"""


def history_source(t):
    customer = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    before = customer.filter("c_custkey % 11 <> 0").withColumns({
        "segment": F.when(F.col("c_custkey") % 6 != 0, F.col("segment")), "updated_at": _day(D0)})
    now = customer.filter("c_custkey % 13 <> 0").withColumn("updated_at", F.when(F.col("c_custkey") % 4 == 0, _day(D1)).otherwise(_day(D0)))
    return merge.open_snapshot(before, "c_custkey", _day(D0)), now


CHECKED = f"""WITH {HISTORY_SQL}, j AS (SELECT s.*, h.c_custkey AS hk, h.segment AS hs, h.nation AS hn, h.updated_at AS hu FROM src s LEFT JOIN hist h ON s.c_custkey = h.c_custkey),
 fresh AS (SELECT c_custkey, segment, nation, updated_at FROM j WHERE hk IS NULL OR segment IS DISTINCT FROM hs OR nation IS DISTINCT FROM hn)
 SELECT h.c_custkey, h.segment, h.nation, h.updated_at, scd_id, valid_from, CASE WHEN h.c_custkey NOT IN (SELECT c_custkey FROM src) OR h.c_custkey IN (SELECT c_custkey FROM fresh) THEN DATE '{D1}' END AS valid_to FROM hist h
 UNION ALL SELECT *, {SNAP_ID.format(d=f"DATE '{D1}'")}, DATE '{D1}', NULL FROM fresh"""


def _checked(t):
    return merge.snapshot(*history_source(t), "c_custkey", _day(D1), check=["segment", "nation"])


@query("snapshot_check", CHECKED)
def snapshot_check(t):
    return _checked(t)


@query("snapshot_timestamp", f"""WITH {HISTORY_SQL}, j AS (SELECT s.*, h.c_custkey AS hk, h.updated_at AS hu FROM src s LEFT JOIN hist h ON s.c_custkey = h.c_custkey),
 fresh AS (SELECT c_custkey, segment, nation, updated_at FROM j WHERE hk IS NULL OR updated_at > hu)
 SELECT h.c_custkey, h.segment, h.nation, h.updated_at, scd_id, valid_from, CASE WHEN h.c_custkey NOT IN (SELECT c_custkey FROM src) THEN DATE '{D1}' ELSE (SELECT f.updated_at FROM fresh f WHERE f.c_custkey = h.c_custkey) END AS valid_to FROM hist h
 UNION ALL SELECT *, {SNAP_ID.format(d='updated_at')}, updated_at, NULL FROM fresh""")
def snapshot_timestamp(t):
    return merge.snapshot(*history_source(t), "c_custkey", _day(D1), updated_at="updated_at")


@query("snapshot_current", f"SELECT * EXCLUDE (scd_id) FROM ({CHECKED}) WHERE valid_to IS NULL")
def snapshot_current(t):
    return _checked(t).filter("valid_to is null").drop("scd_id")


@query("snapshot_asof", f"SELECT * EXCLUDE (scd_id) FROM ({CHECKED}) WHERE DATE '2024-01-15' BETWEEN valid_from AND coalesce(valid_to, DATE '9999-12-31')")
def snapshot_asof(t):
    return merge.snapshot_asof(_checked(t), _day("2024-01-15")).drop("scd_id")


@query("incremental_append", f"{ORDERS_SQL}")
def incremental_append(t):
    rows = _orders(t)
    return merge.incremental_append(rows.filter("order_date < date '2000-01-01'"), rows, "order_date")


BALANCE_SQL = "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey AS version, o_totalprice AS balance FROM orders"


@query("incremental_lookback", f"""WITH b AS ({BALANCE_SQL}), dd AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, day ORDER BY version DESC) AS rn FROM b),
 old AS (SELECT o_custkey, day, version, balance - 1 AS balance FROM dd WHERE rn = 1 AND day < DATE '2000-01-01'), cut AS (SELECT max(day) - 3 AS d FROM old),
 new AS (SELECT o_custkey, day, version, balance FROM dd, cut WHERE rn = 1 AND day >= cut.d)
 SELECT * FROM new UNION ALL SELECT * FROM old WHERE (o_custkey, day) NOT IN (SELECT (o_custkey, day) FROM new)""")
def incremental_lookback(t):
    from weirflow.plans.dedup import latest_per_key

    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("balance"))
    stored = latest_per_key(rows.filter("day < date '2000-01-01'"), ["o_custkey", "day"], ["-version"]).withColumn("balance", F.col("balance") - 1)
    return merge.incremental_lookback(stored, rows, ["o_custkey", "day"], "day", ["-version"])


@query("delete_insert", f"WITH {OLD_SQL}, {NEW_SQL} SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)")
def delete_insert(t):
    return merge.delete_insert(*_old_new(t), ["o_orderkey"])


@query("insert_overwrite", f"WITH {OLD_SQL}, {NEW_SQL} SELECT * FROM new UNION ALL SELECT * FROM old WHERE order_date NOT IN (SELECT order_date FROM new)")
def insert_overwrite(t):
    return merge.insert_overwrite(*_old_new(t), "order_date")


@query("watermark_sync", f"""WITH old AS ({ORDERS_SQL} WHERE o_orderdate < DATE '2000-01-01'), cut AS (SELECT max(order_date) AS d FROM old), new AS (SELECT o_orderkey, o_orderstatus, order_date, o_totalprice FROM ({ORDERS_SQL}), cut WHERE order_date > d)
 SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""")
def watermark_sync(t):
    rows = _orders(t)
    stored = rows.filter("order_date < date '2000-01-01'")
    return merge.upsert(stored, merge.rows_after_max(rows, stored, "order_date"), ["o_orderkey"])


@query("partition_sync", f"{ORDERS_SQL} WHERE month(o_orderdate) = 7")
def partition_sync(t):
    from weirflow.operators.relational import missing_partitions

    rows = _orders(t)
    loaded = rows.filter(F.month("order_date") != 7)
    return rows.join(missing_partitions(rows, loaded, "order_date"), "order_date", "left_semi").select(*rows.columns)


@query("mv_refresh", """SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, COUNT(*) AS txn_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
 CAST(ROUND(CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS DECIMAL(20,6)), 2) AS DOUBLE) AS avg_amount FROM orders GROUP BY 1, 2""")
def mv_refresh(t):
    from weirflow.functions.numbers import rounded

    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderpriority", "o_totalprice")
    stored = rows.filter("day < date '2000-01-01'").groupBy("day", "o_orderpriority").agg(
        F.count("*").alias("txn_count"), F.sum(money("o_totalprice")).alias("total_amount"))
    fresh = merge.refresh_aggregate(stored, rows.filter("day >= date '2000-01-01'"), ["day", "o_orderpriority"], "o_totalprice")
    total = F.col("total_amount").cast("double")
    return fresh.withColumns({"avg_amount": rounded(total / F.col("txn_count")), "total_amount": total})


@query("int_range_buckets", "SELECT CAST((c_custkey // 100) * 100 AS BIGINT) AS bucket, COUNT(*) AS customers FROM customer GROUP BY 1")
def int_range_buckets(t):
    return t.customer.groupBy(tables.range_bucket("c_custkey", 100).alias("bucket")).agg(F.count("*").alias("customers"))


@query("erase_customer", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey % 50 <> 0 AND CAST(o_orderdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_custkey % 50 = 0)")
def erase_customer(t):
    """The rewritten content of the partitions that hold an erased customer; all others stay untouched."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("part_date"))
    gone = t.customer.filter("c_custkey % 50 = 0").select(F.col("c_custkey").alias("o_custkey"))
    touched = tables.affected_partitions(rows, "o_custkey", gone, "part_date")
    return tables.erase_keys(rows.join(touched, "part_date", "left_semi"), "o_custkey", gone).drop("part_date")


@query("erase_verify", "SELECT 'orders' AS table_name, COUNT(*) AS remaining_rows FROM orders WHERE o_custkey % 50 = 0 AND o_orderkey % 9 = 0 UNION ALL SELECT 'customer', COUNT(*) FROM customer WHERE c_custkey % 50 = 0")
def erase_verify(t):
    """Proof over two tables: one incompletely erased, one not at all."""
    gone = t.customer.filter("c_custkey % 50 = 0").select("c_custkey")
    half = t.orders.filter("o_custkey % 50 <> 0 or o_orderkey % 9 = 0")
    return tables.erasure_proof({"orders": half, "customer": t.customer}, {"orders": "o_custkey", "customer": "c_custkey"}, gone, "c_custkey")
