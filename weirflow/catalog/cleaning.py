"""Parse, clean, validate and enrich."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.catalog.standins import (
    AS_OF, CLEAN_LOANS_SQL, DATE_SQL, LOANS_SQL, RAW_LOANS_SQL, dsum, loans, r2, raw_loans,
)
from weirflow.functions import keys, scales, text
from weirflow.functions.fixed import RISK_4, RISK_5, RISK_NAMED, SIZE_3, SIZE_4, VALUE_TIERS
from weirflow.functions.numbers import rounded
from weirflow.operators import clean, enrich, parse, validate
from weirflow.plans.dedup import latest_per_key, top_per_key
from weirflow.plans.spread import spread
from weirflow.registry import Tables, query
from weirflow.session import shared_dir
from weirflow.sources import tables

PROPS = T.StructType([T.StructField("k", T.LongType())])
BROKEN_SQL = "CASE WHEN event_id % 11 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END"


def broken_props(t: Tables) -> DataFrame:
    """Events whose JSON lost its closing brace in every eleventh row."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    return t.events.select(
        "event_id", F.when(F.col("event_id") % 11 == 0, cut).otherwise(F.col("props")).alias("props")
    )


@query("parse_json", f"""SELECT event_id, CAST(json_extract(j, '$.k') AS BIGINT) AS k
 FROM (SELECT event_id, {BROKEN_SQL} AS j FROM events) WHERE json_valid(j)""")
def parse_json(t):
    return parse.parse_json(broken_props(t), "props", PROPS)


@query("parse_json_split", f"""SELECT event_id, CASE WHEN json_valid(j) THEN NULL ELSE j END AS raw,
 CASE WHEN json_valid(j) THEN CAST(json_extract(j, '$.k') AS BIGINT) END AS k,
 CASE WHEN json_valid(j) THEN NULL ELSE 'not valid JSON' END AS parse_error
 FROM (SELECT event_id, {BROKEN_SQL} AS j FROM events)""")
def parse_json_split(t):
    split = parse.split_json(broken_props(t), "props", PROPS)
    return split.select(
        "event_id", F.when(F.col("parse_error").isNotNull(), F.col("props")).alias("raw"),
        F.col("record.k").alias("k"), "parse_error",
    )


LINE_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False), T.StructField("line", T.IntegerType(), False),
    T.StructField("price", T.DoubleType(), False), T.StructField("flag", T.StringType(), False),
])
CSV_SQL = """concat_ws(',', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
 CASE WHEN l_partkey % 13 = 0 THEN 'abc' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END,
 CASE WHEN l_partkey % 17 = 0 THEN 'x,y' ELSE l_returnflag END)"""


@query("parse_csv_typed", f"""WITH lines AS (SELECT {CSV_SQL} AS line FROM lineitem),
 parts AS (SELECT line, string_split(line, ',') AS p FROM lines)
 SELECT CASE WHEN len(p) = 4 AND TRY_CAST(p[3] AS DOUBLE) IS NOT NULL THEN TRY_CAST(p[1] AS BIGINT) END AS order_id,
 CASE WHEN len(p) = 4 AND TRY_CAST(p[3] AS DOUBLE) IS NOT NULL THEN TRY_CAST(p[2] AS INTEGER) END AS line_no,
 CASE WHEN len(p) = 4 THEN TRY_CAST(p[3] AS DOUBLE) END AS price,
 CASE WHEN len(p) = 4 AND TRY_CAST(p[3] AS DOUBLE) IS NOT NULL THEN p[4] END AS flag,
 CASE WHEN len(p) <> 4 THEN 'wrong number of fields' WHEN TRY_CAST(p[3] AS DOUBLE) IS NULL THEN 'bad price' END AS parse_error
 FROM parts""")
def parse_csv_typed(t):
    lines = t.lineitem.select(F.concat_ws(
        ",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.when(F.col("l_partkey") % 13 == 0, "abc").otherwise(
            F.col("l_extendedprice").cast("decimal(18,2)").cast("string")),
        F.when(F.col("l_partkey") % 17 == 0, "x,y").otherwise(F.col("l_returnflag")),
    ).alias("text"))
    split = parse.split_delimited(lines, "text", LINE_SCHEMA)
    return split.select(
        F.col("record.order_id").alias("order_id"), F.col("record.line").alias("line_no"),
        F.col("record.price").alias("price"), F.col("record.flag").alias("flag"), "parse_error",
    )


@query("clean_strings", "SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS c_name, trim(concat(c_mktsegment, '   ')) AS c_mktsegment FROM customer")
def clean_strings(t):
    padded = t.customer.select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
    )
    return clean.trim_strings(padded)


@query("standard_categories", "SELECT p_partkey, translate(upper(trim(p_type)), ' -', '__') AS p_type, translate(upper(trim(p_brand)), ' -', '__') AS p_brand FROM part")
def standard_categories(t):
    return clean.standardize_categories(t.part.select("p_partkey", "p_type", "p_brand"), ["p_type", "p_brand"])


@query("null_indicators", """SELECT event_id, CASE WHEN lower(trim(raw)) IN ('','null','none','n/a','na','nil','-') THEN NULL ELSE raw END AS event_type
 FROM (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN ' N/A ' WHEN event_id % 13 = 0 THEN 'None' WHEN event_id % 11 = 0 THEN '' ELSE event_type END AS raw FROM events)""")
def null_indicators(t):
    key = F.col("event_id")
    raw = F.when(key % 17 == 0, " N/A ").when(key % 13 == 0, "None").when(key % 11 == 0, "").otherwise(F.col("event_type"))
    return clean.blank_markers(t.events.select("event_id", raw.alias("event_type")))


ORDER_DATE_SQL = """CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate,'%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate,'%m/%d/%Y')
 WHEN 2 THEN strftime(o_orderdate,'%d-%b-%Y') WHEN 3 THEN strftime(o_orderdate,'%d/%m/%Y')
 WHEN 4 THEN strftime(o_orderdate,'%Y%m%d') ELSE 'junk' END"""


@query("parse_dates_multi", f"SELECT o_orderkey, d AS raw, {DATE_SQL.format(c='d')} AS order_date FROM (SELECT o_orderkey, {ORDER_DATE_SQL} AS d FROM orders)")
def parse_dates_multi(t):
    raw = F.lit("junk")
    for i, f in enumerate(("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy", "dd/MM/yyyy", "yyyyMMdd")):
        raw = F.when(F.col("o_orderkey") % 6 == i, F.date_format("o_orderdate", f)).otherwise(raw)
    staged = t.orders.select("o_orderkey", raw.alias("raw"))
    return staged.withColumn("order_date", text.parse_date("raw"))


@query("numeric_precision", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r2('l_extendedprice * 1.000001')} AS price FROM lineitem")
def numeric_precision(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        rounded(F.col("l_extendedprice") * 1.000001).alias("price"),
    )


@query("sanitize_ids", "SELECT c_custkey, regexp_replace(concat('CU ST_', c_custkey, '#-', c_nationkey), '[^A-Za-z0-9-]', '', 'g') AS customer_id FROM customer")
def sanitize_ids(t):
    dirty = F.concat(F.lit("CU ST_"), F.col("c_custkey").cast("string"), F.lit("#-"), F.col("c_nationkey").cast("string"))
    return t.customer.select("c_custkey", text.identifier(dirty).alias("customer_id"))


@query("clean_layer", f"WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL} SELECT * FROM cleaned WHERE loan_id IS NOT NULL")
def clean_layer(t):
    return clean.clean_loans(raw_loans(t)).filter(F.col("loan_id").isNotNull())


@query("clean_amount", """SELECT o_orderkey, raw_amount, TRY_CAST(replace(raw_amount, ',', '') AS DOUBLE) AS amount,
 CASE WHEN TRY_CAST(replace(raw_amount, ',', '') AS DOUBLE) IS NULL THEN 'not a number' END AS amount_error,
 coalesce(regexp_matches(cust, '^CUST-[0-9]+$'), false) AS valid_customer
 FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'abc' ELSE concat('1,', lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), '.50') END AS raw_amount,
  CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('CUST-', o_custkey) END AS cust FROM orders)""")
def clean_amount(t):
    key = F.col("o_orderkey")
    staged = t.orders.select(
        "o_orderkey",
        F.when(key % 13 == 0, "abc").otherwise(
            F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(".50"))).alias("raw_amount"),
        F.when(key % 11 == 0, "").when(key % 17 == 0, None)
        .otherwise(F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string"))).alias("cust"),
    )
    amount = text.number("raw_amount")
    return staged.select(
        "o_orderkey", "raw_amount", amount.alias("amount"),
        F.when(amount.isNull(), "not a number").alias("amount_error"),
        F.coalesce(F.col("cust").rlike("^CUST-[0-9]+$"), F.lit(False)).alias("valid_customer"),
    )


@query("staging_model", """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS order_amount,
 upper(trim(concat(' ', lower(o_orderstatus)))) AS status, upper(trim(o_orderpriority)) AS priority, CAST(o_orderdate AS DATE) AS order_date
 FROM orders WHERE o_orderkey IS NOT NULL""")
def staging_model(t):
    date_text = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.filter(F.col("o_orderkey").isNotNull()).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("order_amount"),
        F.upper(F.trim(F.concat(F.lit(" "), F.lower("o_orderstatus")))).alias("status"),
        F.upper(F.trim("o_orderpriority")).alias("priority"),
        F.to_date(date_text, "yyyyMMdd").alias("order_date"),
    )


@query("utc_to_local", """SELECT o_orderkey, timezone('America/New_York', timezone('UTC', o_orderdate)) AS local_time FROM orders""")
def utc_to_local(t):
    local = F.from_utc_timestamp(F.col("o_orderdate").cast("timestamp"), "America/New_York")
    return t.orders.select("o_orderkey", local.cast("timestamp_ntz").alias("local_time"))


@query("normalize_text", r"""SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s]', '', 'g') AS clean_text FROM documents WHERE trim(text) <> ''""")
def normalize_text(t):
    return spread(t.documents.select("doc_id", "text")).filter(F.trim("text") != "").select("doc_id", text.normalized("text").alias("clean_text"))


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}"


@query("extract_contacts", f"""SELECT doc_id, array_to_string(regexp_extract_all(text, '{EMAIL}'), ';') AS emails,
 array_to_string(regexp_extract_all(text, '{PHONE}'), ';') AS phones FROM documents""")
def extract_contacts(t):
    found = lambda p: F.concat_ws(";", F.regexp_extract_all("text", F.lit(p), F.lit(0)))
    return spread(t.documents.select("doc_id", "text")).select("doc_id", found(EMAIL).alias("emails"), found(PHONE).alias("phones"))


@query("json_flatten", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def json_flatten(t):
    return parse.json_fields(t.events.select("event_id", "props"), "props", {"k": "$.k", "absent": "$.absent"}).drop("props")


DIRTY_EVENTS_SQL = """dirty AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '' ELSE event_type END AS event_type,
 CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value FROM events)"""


def dirty_events(t: Tables) -> DataFrame:
    key = F.col("event_id")
    return t.events.select(
        "event_id", F.when(key % 11 == 0, "").otherwise(F.col("event_type")).alias("event_type"),
        F.when(key % 13 == 0, None).when(key % 17 == 0, "n/a")
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("value"),
    )


@query("validate_required", f"WITH {DIRTY_EVENTS_SQL} SELECT * FROM dirty WHERE trim(event_type) <> '' AND TRY_CAST(value AS DOUBLE) IS NOT NULL")
def validate_required(t):
    return validate.required(dirty_events(t), ["event_id", "event_type", "value"], numeric=["value"])


@query("schema_filter", f"WITH {DIRTY_EVENTS_SQL} SELECT * FROM dirty WHERE event_type IS NOT NULL AND (value IS NULL OR TRY_CAST(value AS DOUBLE) IS NOT NULL)")
def schema_filter(t):
    return validate.matches_schema(dirty_events(t), ["event_id", "event_type"], {"value": "double"})


@query("field_filter", "SELECT event_id, event_type, value FROM events WHERE value BETWEEN 10 AND 50 AND event_type = 'click'")
def field_filter(t):
    ranged = validate.field_filter(t.events.select("event_id", "event_type", "value"), "value", low=10, high=50)
    return validate.field_filter(ranged, "event_type", equals="click")


@query("required_event_fields", f"WITH {DIRTY_EVENTS_SQL} SELECT * FROM dirty WHERE trim(event_type) <> '' AND value IS NOT NULL")
def required_event_fields(t):
    return validate.required(dirty_events(t), ["event_type", "value"])


RULES_SQL = f"""[x FOR x IN [
 CASE WHEN loan_id IS NULL THEN 'Missing required field: loan_id' END,
 CASE WHEN customer_id IS NULL THEN 'Missing required field: customer_id' END,
 CASE WHEN amount IS NULL THEN 'Missing required field: amount' END,
 CASE WHEN application_date IS NULL THEN 'Missing required field: application_date' END,
 CASE WHEN amount <= 0 THEN 'Invalid amount' END,
 CASE WHEN amount > 10000000 THEN 'Amount exceeds max' END,
 CASE WHEN credit_score < 300 OR credit_score > 850 THEN 'Invalid credit score' END,
 CASE WHEN interest_rate < 0 OR interest_rate > 30 THEN 'Invalid rate' END,
 CASE WHEN loan_type NOT IN ('PERSONAL','AUTO','MORTGAGE','CREDIT_CARD','STUDENT','HOME_EQUITY') THEN 'Unknown loan type' END,
 CASE WHEN application_date > DATE '{AS_OF}' THEN 'Future date' END] IF x IS NOT NULL]"""


@query("rules_split", f"""WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL}, judged AS (SELECT *, {RULES_SQL} AS errors FROM cleaned)
 SELECT loan_id, amount, loan_type, credit_score, application_date, CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'invalid' END AS route,
 array_to_string(errors, '; ') AS errors FROM judged""")
def rules_split(t):
    judged = validate.with_errors(clean.clean_loans(raw_loans(t)), validate.loan_rules(AS_OF))
    return judged.select(
        "loan_id", "amount", "loan_type", "credit_score", "application_date",
        F.when(F.size("errors") == 0, "valid").otherwise("invalid").alias("route"),
        F.concat_ws("; ", "errors").alias("errors"),
    )


@query("basic_rules", f"""WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL} SELECT loan_id, amount, credit_score, array_to_string([x FOR x IN [
 CASE WHEN loan_id IS NULL OR loan_id = '' THEN 'Missing loan_id' END, CASE WHEN amount IS NULL OR amount <= 0 THEN 'Invalid amount' END,
 CASE WHEN credit_score < 300 OR credit_score > 850 THEN 'Invalid credit score' END] IF x IS NOT NULL], '; ') AS errors FROM cleaned""")
def basic_rules(t):
    judged = validate.with_errors(clean.clean_loans(raw_loans(t)), validate.basic_loan_rules())
    return judged.select("loan_id", "amount", "credit_score", F.concat_ws("; ", "errors").alias("errors"))


@query("validation_errors", f"""WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL}, judged AS (SELECT *, {RULES_SQL} AS errors FROM cleaned)
 SELECT e AS error, COUNT(*) AS rows FROM (SELECT unnest(errors) AS e FROM judged) GROUP BY e""")
def validation_errors(t):
    judged = validate.with_errors(clean.clean_loans(raw_loans(t)), validate.loan_rules(AS_OF))
    return judged.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("rows"))


@query("cast_failure_rate", f"""WITH {DIRTY_EVENTS_SQL} SELECT 'value' AS column_name, COUNT(*) AS total_rows,
 COUNT(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) AS failures FROM dirty
 UNION ALL SELECT 'event_type', COUNT(*), COUNT(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS DOUBLE) IS NULL) FROM dirty""")
def cast_failure_rate(t):
    return validate.cast_failures(dirty_events(t), {"value": "double", "event_type": "double"})


@query("good_bad_split", f"""WITH {RAW_LOANS_SQL} SELECT CASE WHEN TRY_CAST(replace(amount, ',', '') AS DOUBLE) IS NOT NULL THEN 'good' ELSE 'bad' END AS part,
 COUNT(*) AS rows, {dsum("TRY_CAST(replace(amount, ',', '') AS DOUBLE)")} AS total FROM raw_loans GROUP BY 1""")
def good_bad_split(t):
    from weirflow.functions.numbers import money_sum

    typed = raw_loans(t).withColumn("number", text.number("amount"))
    part = F.when(F.col("number").isNotNull(), "good").otherwise("bad")
    return typed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), money_sum("number").alias("total"))


@query("schema_evolve", """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS channel FROM orders WHERE o_orderdate < DATE '1998-01-01'
 UNION ALL SELECT o_orderkey, o_totalprice, 'web' AS channel FROM orders WHERE o_orderdate >= DATE '1998-01-01'""")
def schema_evolve(t):
    old = t.orders.filter("o_orderdate < timestamp_ntz '1998-01-01'").select("o_orderkey", "o_totalprice")
    new = t.orders.filter("o_orderdate >= timestamp_ntz '1998-01-01'").select(
        "o_orderkey", "o_totalprice", F.lit("web").alias("channel"))
    return old.unionByName(new, allowMissingColumns=True)


@query("derive_metrics", f"SELECT event_id, {r2('value * 1.1')} AS adjusted_value, CAST(0.95 AS DOUBLE) AS quality_score, CAST(ts AS DATE) AS processing_date FROM events")
def derive_metrics(t):
    return enrich.derive_metrics(t.events, "value", "ts").select("event_id", "adjusted_value", "quality_score", "processing_date")


EMI_SQL = """CASE WHEN term_months <= 0 THEN NULL WHEN interest_rate / 1200 > 0 THEN
 amount * (interest_rate / 1200) * pow(1 + interest_rate / 1200, term_months) / (pow(1 + interest_rate / 1200, term_months) - 1)
 ELSE amount / term_months END"""


@query("loan_emi", f"""WITH {LOANS_SQL}, paid AS (SELECT *, {EMI_SQL} AS p FROM loans)
 SELECT loan_id, {r2('p')} AS monthly_payment, {r2('p * term_months - amount')} AS total_interest, {r2('p * term_months')} AS total_cost FROM paid""")
def loan_emi(t):
    return enrich.loan_economics(loans(t)).select("loan_id", "monthly_payment", "total_interest", "total_cost")


@query("risk_bucket", f"""WITH {LOANS_SQL} SELECT loan_id, {scales.sql_case('credit_score', RISK_4, '>=')} AS risk_4,
 {scales.sql_case('credit_score', RISK_5, '>=')} AS risk_5, {scales.sql_case('credit_score', RISK_NAMED, '>=')} AS risk_named,
 CAST(CASE WHEN credit_score >= 750 THEN 1 WHEN credit_score >= 700 THEN 2 WHEN credit_score >= 650 THEN 3 WHEN credit_score >= 550 THEN 4 ELSE 5 END AS INTEGER) AS risk_score FROM loans""")
def risk_bucket(t):
    return loans(t).select(
        "loan_id", scales.at_least("credit_score", RISK_4).alias("risk_4"),
        scales.at_least("credit_score", RISK_5).alias("risk_5"),
        scales.at_least("credit_score", RISK_NAMED).alias("risk_named"),
        scales.rank_in("credit_score", RISK_5).alias("risk_score"),
    )


@query("size_bucket", f"""SELECT o_orderkey, {scales.sql_case('o_totalprice', SIZE_4, '>')} AS size_4,
 {scales.sql_case('o_totalprice', SIZE_3, '>')} AS size_3, {scales.sql_case('o_totalprice', VALUE_TIERS, '>')} AS value_tier FROM orders""")
def size_bucket(t):
    return t.orders.select(
        "o_orderkey", scales.above("o_totalprice", SIZE_4).alias("size_4"),
        scales.above("o_totalprice", SIZE_3).alias("size_3"), scales.above("o_totalprice", VALUE_TIERS).alias("value_tier"),
    )


@query("date_parts", f"""SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since,
 CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter FROM orders""")
def date_parts(t):
    return t.orders.select(
        "o_orderkey", F.datediff(F.lit(AS_OF).cast("date"), F.to_date("o_orderdate")).alias("days_since"),
        F.year("o_orderdate").alias("order_year"), F.quarter("o_orderdate").alias("order_quarter"),
    )


@query("cents_to_dollars", "SELECT o_orderkey, CAST(ROUND(CAST(CAST(o_totalprice * 100 AS BIGINT) AS DECIMAL(18,2)) / 100, 2) AS DOUBLE) AS amount_dollars FROM orders")
def cents_to_dollars(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.select("o_orderkey", F.round(cents.cast("decimal(18,2)") / 100, 2).cast("double").alias("amount_dollars"))


@query("surrogate_key", "SELECT c_custkey, md5(concat_ws('|', coalesce(CAST(c_custkey AS VARCHAR), '_null_'), coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, '_null_'))) AS customer_key FROM customer")
def surrogate_key(t):
    staged = t.customer.withColumn("segment", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")))
    return staged.select("c_custkey", keys.surrogate_key(["c_custkey", "segment"]).alias("customer_key"))


@query("date_dimension", """WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
 days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
 SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
 CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, monthname(d) AS month_name,
 isodow(d) >= 6 AS is_weekend, CAST(year(d + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_year, CAST(quarter(d + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_quarter FROM days""")
def date_dimension(t):
    span = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return enrich.calendar_columns(span.select(F.explode(F.sequence("a", "b")).alias("full_date")), "full_date")


@query("lookup_enrich", """SELECT o_orderkey, o_custkey, coalesce(c_mktsegment, 'Unknown') AS c_mktsegment FROM orders
 LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) ON o_custkey = c_custkey""")
def lookup_enrich(t):
    table = t.customer.filter("c_custkey % 7 <> 0").withColumnRenamed("c_custkey", "o_custkey")
    return enrich.lookup(t.orders.select("o_orderkey", "o_custkey"), table, "o_custkey", "c_mktsegment")


def loan_etl_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Curated loans and dead letters from dirty text: clean, validate, keep the latest, derive."""
    judged = validate.with_errors(clean.clean_loans(raw_loans(t)), validate.loan_rules(AS_OF))
    good, bad = validate.split_by_errors(judged)
    latest = latest_per_key(good, ["loan_id"], ["-application_date", "-amount", "customer_id", "status"])
    curated = enrich.loan_classes(enrich.loan_economics(latest))
    return curated, bad


@query("loan_etl", f"""WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL}, judged AS (SELECT *, {RULES_SQL} AS errors FROM cleaned),
 latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY application_date DESC, amount DESC, customer_id, status) AS rn FROM judged WHERE len(errors) = 0) WHERE rn = 1),
 paid AS (SELECT *, {EMI_SQL} AS p FROM latest)
 SELECT loan_id, customer_id, loan_type, amount, interest_rate, term_months, status, region, application_date, credit_score,
 {r2('p')} AS monthly_payment, {r2('p * term_months - amount')} AS total_interest, {r2('p * term_months')} AS total_cost,
 {scales.sql_case('credit_score', RISK_5, '>=')} AS risk_category,
 CAST(CASE WHEN credit_score >= 750 THEN 1 WHEN credit_score >= 700 THEN 2 WHEN credit_score >= 650 THEN 3 WHEN credit_score >= 550 THEN 4 ELSE 5 END AS INTEGER) AS risk_score,
 {scales.sql_case('amount', SIZE_4, '>')} AS loan_size_bucket FROM paid""")
def loan_etl(t):
    return loan_etl_parts(t)[0]


@query("loan_dead_letter", f"""WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL}, judged AS (SELECT *, {RULES_SQL} AS errors FROM cleaned)
 SELECT loan_id, customer_id, loan_type, amount, interest_rate, term_months, status, region, application_date, credit_score,
 array_to_string(errors, '; ') AS errors FROM judged WHERE len(errors) > 0""")
def loan_dead_letter(t):
    return loan_etl_parts(t)[1].withColumn("errors", F.concat_ws("; ", "errors"))


def loan_run(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Curated loans, dead letters and superseded rows, all from one cleaning of the text."""
    judged = validate.with_errors(clean.clean_loans(raw_loans(t)), validate.loan_rules(AS_OF))
    good, bad = tables.split_once(judged, F.size("errors") == 0, f"{shared_dir(t.spark)}/loans-{uuid.uuid4().hex}")
    ranked = top_per_key(good.drop("errors"), ["loan_id"], ["-application_date", "-amount", "customer_id", "status"], 1)
    return enrich.loan_classes(enrich.loan_economics(ranked)), bad, good


@query("loan_run", f"""WITH {RAW_LOANS_SQL}, {CLEAN_LOANS_SQL}, judged AS (SELECT *, {RULES_SQL} AS errors FROM cleaned),
 latest AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY application_date DESC, amount DESC, customer_id, status) AS rn FROM judged WHERE len(errors) = 0)
 SELECT 'curated' AS output, COUNT(*) AS rows, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM latest WHERE rn = 1 UNION ALL SELECT 'accepted', COUNT(*), CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FROM latest
 UNION ALL SELECT 'dead_letter', COUNT(*), CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FROM judged WHERE len(errors) > 0""")
def loan_run_totals(t):
    """One run with all its outputs: the text is cleaned and judged once."""
    curated, bad, good = loan_run(t)
    total = lambda name, df: df.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"))
    return total("curated", curated).unionByName(total("accepted", good)).unionByName(total("dead_letter", bad))
