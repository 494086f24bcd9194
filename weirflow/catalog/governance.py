"""Governance, learning, and skew reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from weirflow.catalog.standins import r2
from weirflow.functions import scales
from weirflow.functions.fixed import PII_PATTERNS, RISK_4
from weirflow.operators import governance as gov
from weirflow.operators import learning, skew
from weirflow.plans.spread import spread
from weirflow.registry import query
from weirflow.session import cut_lineage, shared_dir


def _pii_sql() -> str:
    parts = []
    for kind, p in PII_PATTERNS.items():
        hits = f"len(regexp_extract_all(text, '{p}'))"
        parts.append(f"SELECT 'text' AS column_name, '{kind}' AS info_type, CAST(SUM({hits}) AS BIGINT) AS matches, COUNT(*) FILTER (WHERE {hits} > 0) AS rows_with_match FROM documents")
    return " UNION ALL ".join(parts)


@query("pii_scan", _pii_sql())
def pii_scan(t):
    return gov.pii_scan(spread(t.documents.select("text")), ["text"])


@query("mask_column", "SELECT c_custkey, concat(repeat('*', least(length(c_name), 5)), substr(c_name, 6)) AS c_name FROM customer")
def mask_column(t):
    return gov.mask_columns(t.customer.select("c_custkey", "c_name"), ["c_name"])


@query("tokenize", "SELECT c_custkey, sha256(concat('s1', c_name)) AS c_name FROM customer")
def tokenize(t):
    return gov.tokenize(t.customer.select("c_custkey", "c_name"), ["c_name"], "s1")


@query("row_policy", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')")
def row_policy(t):
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    grants = t.nation.join(regions, "n_regionkey").select(F.col("r_name").alias("group_name"), F.col("n_nationkey").alias("c_nationkey"))
    return gov.row_policy(t.customer.select("c_custkey", "c_name", "c_nationkey"), "c_nationkey", grants, "ASIA")


@query("column_policy", "SELECT c_custkey, concat(repeat('*', least(length(c_name), 5)), substr(c_name, 6)) AS c_name, c_mktsegment FROM customer")
def column_policy(t):
    tags = {"c_name": "pii", "c_acctbal": "financial"}
    return gov.column_policy(t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), tags, cleared=[], masked=["pii"])


@query("crypto_shred", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS c_name FROM customer")
def crypto_shred(t):
    """Encrypt names with random keys, destroy every fifth key, read back what is left. Owners that get a new key cannot read old values."""
    vault = gov.KeyVault(t.spark, f"{shared_dir(t.spark)}/keys-{uuid.uuid4().hex}", "c_custkey")
    vault.ensure(t.customer)
    sealed = cut_lineage(gov.encrypt_with_keys(t.customer.select("c_custkey", "c_name"), vault.keys(), "c_custkey", ["c_name"]))
    vault.destroy(t.customer.filter("c_custkey % 5 = 0"))
    vault.ensure(t.customer.filter("c_custkey % 10 = 0"))
    return gov.decrypt_with_keys(sealed, vault.keys(), "c_custkey", ["c_name"])


@query("access_audit", "SELECT event_id, user_id, event_type, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-20' ORDER BY ts DESC")
def access_audit(t):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return gov.recent_access(rows, "ts", F.lit("2024-01-20").cast("timestamp_ntz"))


def measured(t):
    """Every document with its features, and its label where it has one."""
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
                                                               F.size(F.split("text", " ")).cast("double").alias("n_words"), F.col("quality").cast("int").alias("quality"))


def labelled(t):
    return measured(t).filter("quality is not null")


HELD_OUT = "pmod(xxhash64(doc_id), 5) = 0"


def _model(rows):
    return learning.train_classifier(rows, "quality", ["n_chars", "n_words"], ["lang", "source"])


@query("ml_train")
def ml_train(t):
    """Coefficients of the fitted model: one row per feature."""
    model = learning.train_classifier(labelled(t), "quality", ["n_chars", "n_words"], ["lang"])
    fitted = model.stages[-1]
    rows = [(i, float(c)) for i, c in enumerate(fitted.coefficients.toArray())] + [(-1, float(fitted.intercept))]
    return t.spark.createDataFrame(rows, "feature_no int, weight double")


@query("ml_predict")
def ml_predict(t):
    """Fitted on the labels, applied to all documents."""
    return learning.predict(_model(labelled(t)), measured(t), ["doc_id", "quality"])


@query("ml_evaluate")
def ml_evaluate(t):
    """Fitted on four fifths of the labels, measured on the rest."""
    model = _model(labelled(t).filter(f"not ({HELD_OUT})"))
    scored = learning.predict(model, labelled(t).filter(HELD_OUT), ["doc_id", "quality"])
    return learning.evaluate(scored, "quality").select("*", learning.area_under_roc(scored, "quality").scalar().alias("roc_auc"))


@query("partition_report")
def partition_report(t):
    return skew.partition_sizes(t.lineitem)


@query("key_skew", f"""WITH c AS (SELECT l_partkey, COUNT(*) AS rows FROM lineitem GROUP BY 1) SELECT l_partkey, rows, {r2('CAST(rows AS DOUBLE) / (SELECT CAST(SUM(rows) AS DOUBLE) / COUNT(*) FROM c)')} AS times_mean FROM c ORDER BY rows DESC, l_partkey LIMIT 20""")
def key_skew(t):
    return skew.key_skew(t.lineitem, "l_partkey")


RISK_SQL = f"SELECT CAST(300 + (l_partkey * 7) % 551 AS INTEGER) AS credit_score, COUNT(*) AS n, MIN({scales.sql_case('300 + (l_partkey * 7) % 551', RISK_4, '>=')}) AS risk FROM lineitem GROUP BY 1"


@query("risk_udf_vs_builtin", RISK_SQL)
def risk_udf_vs_builtin(t):
    """Built-in ``when`` is the form to use; ``risk_pandas_udf`` gives the same rows through Arrow batches."""
    score = (300 + (F.col("l_partkey") * 7) % 551).cast("int")
    rows = t.lineitem.select(score.alias("credit_score"))
    return rows.withColumn("risk", scales.at_least("credit_score", RISK_4)).groupBy("credit_score").agg(F.count("*").alias("n"), F.min("risk").alias("risk"))


@query("risk_pandas_udf", RISK_SQL)
def risk_pandas_udf(t):
    from weirflow.functions.vectorized import risk_class

    score = (300 + (F.col("l_partkey") * 7) % 551).cast("int")
    rows = t.lineitem.select(score.alias("credit_score"))
    return rows.withColumn("risk", risk_class("credit_score")).groupBy("credit_score").agg(F.count("*").alias("n"), F.min("risk").alias("risk"))
