"""Inputs shaped like loans, payments, snapshots and so on, derived from the driver tables.

Each has a Spark form and the same formula as SQL text for the oracle side. Dirty values are made by
key arithmetic, since the driver tables are clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.plans.joins import join_dimension
from weirflow.plans.spread import spread
from weirflow.registry import Tables

AS_OF = "1999-06-30"


def r2(x: str, places: int = 2) -> str:
    """SQL text of the rounding used on both sides."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(20,6)),{places}) AS DOUBLE)"


def dsum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def davg(x: str) -> str:
    return r2(f"{dsum(x)} / NULLIF(COUNT({x}),0)")


LOAN_ID_SQL = "concat('LN-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"


def loan_id():
    return F.concat(
        F.lit("LN-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
        F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"),
    )


def loans(t: Tables) -> DataFrame:
    """Typed loans: one per line item."""
    types = F.array(*[F.lit(x) for x in (
        "PERSONAL", "AUTO", "MORTGAGE", "CREDIT_CARD", "STUDENT", "HOME_EQUITY", "PAYDAY")])
    return t.lineitem.select(
        loan_id().alias("loan_id"),
        F.concat(F.lit("CUST-"), F.col("l_suppkey").cast("string")).alias("customer_id"),
        F.get(types, (F.col("l_partkey") % 7).cast("int")).alias("loan_type"),
        F.col("l_extendedprice").alias("amount"),
        F.round(F.col("l_discount").cast("decimal(10,4)") * 100, 2).cast("double").alias("interest_rate"),
        F.col("l_quantity").cast("int").alias("term_months"),
        F.col("l_linestatus").alias("status"),
        F.col("l_returnflag").alias("region"),
        F.to_date("l_shipdate").alias("application_date"),
        (300 + (F.col("l_partkey") * 7) % 551).cast("int").alias("credit_score"),
    )


LOANS_SQL = f"""loans AS (SELECT {LOAN_ID_SQL} AS loan_id, concat('CUST-', l_suppkey) AS customer_id,
 (['PERSONAL','AUTO','MORTGAGE','CREDIT_CARD','STUDENT','HOME_EQUITY','PAYDAY'])[1 + l_partkey % 7] AS loan_type,
 l_extendedprice AS amount,
 CAST(ROUND(CAST(l_discount AS DECIMAL(10,4)) * 100, 2) AS DOUBLE) AS interest_rate,
 CAST(l_quantity AS INTEGER) AS term_months, l_linestatus AS status, l_returnflag AS region,
 CAST(l_shipdate AS DATE) AS application_date, CAST(300 + (l_partkey * 7) % 551 AS INTEGER) AS credit_score
 FROM lineitem)"""


def raw_loans(t: Tables) -> DataFrame:
    """Loans as dirty text: blanks, markers, five date formats, commas, odd characters."""
    key, part, order = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_orderkey")
    when = F.col("l_shipdate")
    types = F.array(*[F.lit(x) for x in (
        "personal", "Auto", "MORTGAGE", "credit card", "student", " home equity ", "payday")])
    dates = [F.date_format(when, f) for f in ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy", "dd/MM/yyyy", "yyyyMMdd")]
    date_text = F.lit("junk")
    for i, d in enumerate(dates):
        date_text = F.when(order % 6 == i, d).otherwise(date_text)
    lines = spread(t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate"))
    return lines.select(
        F.when(part % 11 == 0, "").otherwise(F.concat(F.lit(" "), loan_id(), F.lit("# "))).alias("loan_id"),
        F.concat(F.lit("CUST-"), F.col("l_suppkey").cast("string"), F.lit("!")).alias("customer_id"),
        F.when(part % 17 == 0, " N/A ").otherwise(F.get(types, (part % 7).cast("int"))).alias("loan_type"),
        F.when(part % 13 == 0, "abc").when(part % 23 == 0, "-5")
        .otherwise(F.concat(F.lit("1,"), F.lpad(F.pmod(part, F.lit(1000)).cast("string"), 3, "0"), F.lit("."),
                            F.lpad(F.pmod(order, F.lit(100)).cast("string"), 2, "0"))).alias("amount"),
        (F.col("l_discount").cast("decimal(10,2)") * 100).cast("decimal(10,2)").cast("string").alias("interest_rate"),
        F.col("l_quantity").cast("int").cast("string").alias("term_months"),
        F.when(key % 2 == 0, " approved ").otherwise("Pending").alias("status"),
        F.when(F.col("l_returnflag") == "A", "north-east").when(F.col("l_returnflag") == "N", "us west")
        .otherwise("EU").alias("region"),
        date_text.alias("application_date"),
        F.when(part % 19 == 0, "900").otherwise((300 + (part * 7) % 551).cast("string")).alias("credit_score"),
    )


RAW_LOANS_SQL = f"""raw_loans AS (SELECT
 CASE WHEN l_partkey % 11 = 0 THEN '' ELSE concat(' ', {LOAN_ID_SQL}, '# ') END AS loan_id,
 concat('CUST-', l_suppkey, '!') AS customer_id,
 CASE WHEN l_partkey % 17 = 0 THEN ' N/A ' ELSE
  (['personal','Auto','MORTGAGE','credit card','student',' home equity ','payday'])[1 + l_partkey % 7] END AS loan_type,
 CASE WHEN l_partkey % 13 = 0 THEN 'abc' WHEN l_partkey % 23 = 0 THEN '-5'
  ELSE concat('1,', lpad(CAST(l_partkey % 1000 AS VARCHAR),3,'0'), '.', lpad(CAST(l_orderkey % 100 AS VARCHAR),2,'0')) END AS amount,
 CAST(CAST(CAST(l_discount AS DECIMAL(10,2)) * 100 AS DECIMAL(10,2)) AS VARCHAR) AS interest_rate,
 CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS term_months,
 CASE WHEN l_linenumber % 2 = 0 THEN ' approved ' ELSE 'Pending' END AS status,
 CASE l_returnflag WHEN 'A' THEN 'north-east' WHEN 'N' THEN 'us west' ELSE 'EU' END AS region,
 CASE l_orderkey % 6 WHEN 0 THEN strftime(l_shipdate,'%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate,'%m/%d/%Y')
  WHEN 2 THEN strftime(l_shipdate,'%d-%b-%Y') WHEN 3 THEN strftime(l_shipdate,'%d/%m/%Y')
  WHEN 4 THEN strftime(l_shipdate,'%Y%m%d') ELSE 'junk' END AS application_date,
 CASE WHEN l_partkey % 19 = 0 THEN '900' ELSE CAST(300 + (l_partkey * 7) % 551 AS VARCHAR) END AS credit_score
 FROM lineitem)"""

DATE_SQL = """CAST(coalesce(try_strptime({c},'%Y-%m-%d'), try_strptime({c},'%m/%d/%Y'), try_strptime({c},'%d-%b-%Y'),
 try_strptime({c},'%d/%m/%Y'), try_strptime({c},'%Y%m%d')) AS DATE)"""


def _marker(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('','null','none','n/a','na','nil','-') THEN NULL ELSE trim({c}) END"


def _category(c: str) -> str:
    return f"translate(upper(trim({c})), ' -', '__')"


CLEAN_LOANS_SQL = f"""marked AS (SELECT {', '.join(f'{_marker(c)} AS {c}' for c in (
    'loan_id', 'customer_id', 'loan_type', 'amount', 'interest_rate', 'term_months', 'status', 'region',
    'application_date', 'credit_score'))} FROM raw_loans),
cleaned AS (SELECT regexp_replace(loan_id,'[^A-Za-z0-9-]','','g') AS loan_id,
 regexp_replace(customer_id,'[^A-Za-z0-9-]','','g') AS customer_id, {_category('loan_type')} AS loan_type,
 {r2("TRY_CAST(replace(amount,',','') AS DOUBLE)")} AS amount,
 {r2("TRY_CAST(replace(interest_rate,',','') AS DOUBLE)")} AS interest_rate,
 TRY_CAST(term_months AS INTEGER) AS term_months, upper(status) AS status, {_category('region')} AS region,
 {DATE_SQL.format(c='application_date')} AS application_date, TRY_CAST(credit_score AS INTEGER) AS credit_score
 FROM marked)"""


def sales(t: Tables) -> DataFrame:
    """Sales transactions with the region of the customer."""
    places = join_dimension(t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, ["r_regionkey"])
    people = join_dimension(
        t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), places.select("n_nationkey", "r_name"), ["n_nationkey"])
    buyers = people.select(F.col("c_custkey").alias("o_custkey"), "r_name")
    return (
        join_dimension(t.orders, buyers, ["o_custkey"], size_of=t.customer)
        .select(
            F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("txn_date"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("category"),
            F.col("r_name").alias("region"),
        )
    )


SALES_SQL = """sales AS (SELECT o_orderkey AS txn_id, o_custkey AS customer_id, o_totalprice AS amount,
 CAST(o_orderdate AS DATE) AS txn_date, o_orderstatus AS status, o_orderpriority AS category, r_name AS region
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey)"""


def events_utc(t: Tables) -> DataFrame:
    """Events with a zoned timestamp, as event-time operators need it."""
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Zone-free timestamps for the comparison with SQL."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})
