"""Edge cases of the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions import text
from weirflow.functions.finance import monthly_payment
from weirflow.operators import clean, enrich, governance, learning, parse, quality, skew, validate, windows
from weirflow.plans import checks, merge


def one(df):
    return [tuple(r) for r in df.collect()]


def test_dates(spark):
    texts = ["2024-01-15", "01/15/2024", "15-Jan-2024", "15-JAN-2024", "15/01/2024", "20240115", "1/5/2024", "2024-13-45", "soon", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "d string").select(text.parse_date("d")).collect()]
    day = dt.date(2024, 1, 15)
    assert got == [day] * 6 + [dt.date(2024, 1, 5), None, None, None]


def test_amounts_and_ids(spark):
    df = spark.createDataFrame([("1,234.56", "CUST-12345"), ("-100.00", ""), ("abc", None)], "a string, c string")
    got = df.select(text.number("a"), F.coalesce(F.col("c").rlike("^CUST-[0-9]+$"), F.lit(False)))
    assert one(got) == [(1234.56, True), (-100.0, False), (None, False)]


def test_words_keep_letters_of_all_scripts(spark):
    df = spark.createDataFrame([("  Café, déjà-vu!  naïve\n\n",)], "t string")
    assert one(df.select(text.words(text.normalized("t")))) == [(["café", "déjàvu", "naïve"],)]


def test_payment(spark):
    df = spark.createDataFrame([(12000.0, 0.0, 12), (1000.0, 12.0, 1), (500.0, 5.0, 0)], "p double, r double, n int")
    got = [r[0] for r in df.select(monthly_payment("p", "r", "n")).collect()]
    assert got[0] == 1000.0 and got[1] == pytest.approx(1010.0) and got[2] is None


def test_mask_short_text(spark):
    assert one(spark.createDataFrame([("ab",), ("abcdefg",), ("",)], "c string").select(text.masked("c"))) == [("**",), ("*****fg",), ("",)]


def test_split_json(spark):
    schema = T.StructType([T.StructField("k", T.LongType())])
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": 1',), (None,), ("[]",)], "m string")
    rows = parse.split_json(df, "m", schema).collect()
    assert [r.parse_error is None for r in rows][:3] == [True, False, False]
    assert all((r.record is None) != (r.parse_error is None) for r in rows)
    assert parse.parse_json(df, "m", schema).filter("k = 1").count() == 1


def test_event_time(spark):
    df = spark.createDataFrame([("2024-06-12T09:15:32Z",), ("2024-06-12T11:15:32+02:00",), (None,), ("bad",)], "t string")
    kept = parse.with_event_time(df, "t", None)
    assert {r.event_time for r in kept.collect()} == {dt.datetime(2024, 6, 12, 9, 15, 32)} or kept.count() == 2
    now = F.lit("2024-01-01").cast("timestamp")
    assert parse.with_event_time(df, "t", now).filter(F.col("event_time") == now).count() == 2


def test_delimited_lines(spark):
    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.DoubleType(), True)])
    df = spark.createDataFrame([("1|2.5",), ("1|",), ("x|2",), ("1|2|3",)], "l string")
    rows = parse.split_delimited(df, "l", schema, "|").collect()
    assert [r.parse_error for r in rows] == [None, None, "bad a", "wrong number of fields"]
    assert spark.createDataFrame([("a,b,3,d,e",), ("a,b,c,d,e",), ("a,3",)], "l string").filter(parse.well_shaped("l", 5, 2)).count() == 1


def test_field_filter_needs_both_ends(spark):
    df = spark.range(10)
    assert validate.field_filter(df, "id", low=3).count() == 0
    assert validate.field_filter(df, "id", low=3, high=5).count() == 3
    assert validate.field_filter(df, "id", equals=4).count() == 1


def test_null_text_and_metadata(spark):
    df = spark.createDataFrame([("\\N", 1), ("x", 2)], "s string, n int")
    assert one(clean.replace_null_text(df)) == [(None, 1), ("x", 2)]
    stamped = enrich.run_metadata(df, F.lit("2024-01-01").cast("timestamp"), "b1", "src")
    assert stamped.first().batch_id == "b1"
    assert enrich.ingestion_metadata(enrich.constants(df, {"c": 1}), F.lit(1)).first().pipeline_version == "1.0"
    assert enrich.wrap_value(df, "n").first().record.value == 1


def test_contract(spark):
    want = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    report = validate.check_contract(spark.createDataFrame([(1, 2)], "a int, c int"), want)
    assert (report.missing, report.extra, report.ok) == (["b"], ["c"], False)
    with pytest.raises(ValueError):
        validate.enforce_contract(spark.createDataFrame([("1", "2")], "a string, b string"), want)
    nullable = T.StructType([*want.fields, T.StructField("c", T.StringType(), True)])
    strict = T.StructType([*want.fields, T.StructField("c", T.StringType(), False)])
    assert validate.compatibility(want, nullable) == "FULL"
    assert validate.compatibility(want, strict) == "FORWARD"
    assert validate.compatibility(strict, want) == "BACKWARD"


def test_guards(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    with pytest.raises(ValueError):
        validate.require_cast_rate(df, {"v": "double"})
    validate.require_cast_rate(df, {"v": "double"}, limit_pct=40)
    with pytest.raises(ValueError):
        validate.require_row_count(df, low=10, high=100)
    assert validate.require_row_count(df, low=1, high=5) == 3


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "k int, v string")
    suite = [checks.not_null("k"), checks.unique("k"), checks.in_set("v", ["a", "b"]), checks.unique("k", "v"), checks.row_count(1, 5)]
    assert {r.check_name: (r.check_value, r.passed) for r in checks.run(df, suite).collect()} == {
        "not_null:k": (1, False), "unique:k": (1, False), "in_set:v": (1, False), "unique:k,v": (0, True), "row_count": (3, True)}
    with pytest.raises(ValueError, match="not_null:k"):
        checks.require(df, suite)
    assert checks.route(df, suite) == "failed" and checks.route(df, [checks.row_count(1, 5)]) == "passed"


def test_merge_is_idempotent_and_wants_unique_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = merge.upsert(target, source, ["k"])
    assert sorted(one(once)) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(one(merge.upsert(once, source, ["k"]))) == sorted(one(once))
    added = merge.insert_absent(target, source, ["k"])
    assert sorted(one(merge.insert_absent(added, source, ["k"]))) == sorted(one(added)) == [(1, "a"), (2, "b"), (3, "C")]
    with pytest.raises(ValueError):
        merge.require_unique_keys(source.union(source), ["k"])


def test_update_to_null_wins(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    assert one(merge.upsert(target, spark.createDataFrame([(1, None)], "k int, v string"), ["k"])) == [(1, None)]


def test_incremental_on_empty_target(spark):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "k int, d date")
    assert merge.incremental_append(rows.limit(0), rows, "d").count() == 1
    assert merge.incremental_append(rows, rows, "d").count() == 1


def test_scd2_only_changed_and_snapshot_idempotent(spark):
    day = F.lit("2024-02-01").cast("date")
    dim = spark.createDataFrame([(1, None, dt.date(2024, 1, 1), None, True), (2, "b", dt.date(2024, 1, 1), None, True)],
                                "k int, v string, start_date date, end_date date, is_current boolean")
    delta = spark.createDataFrame([(1, None), (2, "c")], "k int, v string")
    got = merge.scd2_merge(dim, delta, "k", day, only_changed=["v"])
    assert got.count() == 3 and got.filter("k = 1").count() == 1
    source = spark.createDataFrame([(1, "x")], "k int, v string")
    first = merge.open_snapshot(source, "k", F.lit("2024-01-01").cast("date"))
    again = merge.snapshot(first, source, "k", day, check=["v"])
    assert sorted(map(repr, one(again))) == sorted(map(repr, one(first)))


def test_scd2_null_change_literal_and_safe(spark):
    rows = [(1, dt.date(2024, 1, d), v) for d, v in ((1, "a"), (2, None), (3, "b"))]
    df = spark.createDataFrame(rows, "k int, day date, v string")
    assert windows.scd2_versions(df, "k", "day", ["v"]).count() == 1
    assert windows.scd2_versions(df, "k", "day", ["v"], null_safe=True).count() == 3


def test_balance_equals_step_loop(spark):
    import random

    rng = random.Random(3)
    rows = [(k, i, rng.randrange(-50, 50)) for k in ("a", "b") for i in range(200)]
    got = windows.balance_with_floor(spark.createDataFrame(rows, "k string, i int, x int"), "k", ["i"], "x")
    want = {}
    for k, i, x in rows:
        want[(k, i)] = max(want.get((k, i - 1), 0) + x, 0)
    assert {(r.k, r.i): r.running_balance for r in got.collect()} == want


def test_reconciliation_and_orphans(spark):
    left = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "k int, a int, acc string")
    right = spark.createDataFrame([(2, 21, "y"), (3, 5, "z")], "k int, a int, acc string")
    status = {r.k: r.reconciliation_status for r in quality.reconcile(left, right, "k", "a", "acc").collect()}
    assert status == {1: "MISSING_IN_TARGET", 2: "AMOUNT_MISMATCH", 3: "MISSING_IN_SOURCE"}
    assert one(quality.orphans(left.select("k"), "k", right, "k")) == [(1,)]


def test_crypto_and_policies(spark):
    df = spark.createDataFrame([(1, "ann", 5.0), (2, "bob", 6.0)], "k int, name string, pay double")
    keys = spark.createDataFrame([(1, "0123456789abcdef"), (2, "fedcba9876543210")], "k int, secret string")
    sealed = governance.encrypt_with_keys(df, keys, "k", ["name"])
    assert not {r.name for r in sealed.collect()} & {"ann", "bob"}
    opened = governance.decrypt_with_keys(sealed, keys.filter("k = 1"), "k", ["name"])
    assert {r.k: r.name for r in opened.collect()} == {1: "ann", 2: None}
    hidden = governance.column_policy(df, {"name": "pii", "pay": "money"}, cleared=[], masked=["pii"])
    assert hidden.columns == ["k", "name"] and hidden.first().name == "***"


def test_learning(spark):
    rows = [(i, float(i % 10), "a" if i % 3 else "b", int(i % 10 > 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x double, c string, y int")
    scored = learning.predict(learning.train_classifier(df, "y", ["x"], ["c"]), df, ["id", "y"])
    assert learning.evaluate(scored, "y").first().accuracy > 0.95
    assert learning.area_under_roc(scored, "y").first().roc_auc == pytest.approx(1.0)


def test_sizes(spark):
    df = spark.range(1000)
    assert skew.partition_sizes(df.repartition(4)).count() == 4
    assert skew.resize(df.repartition(8), 2).rdd.getNumPartitions() == 2
    assert skew.suggested_partitions(df) == 1
    with skew.reused(df) as kept:
        assert kept.is_cached
    assert not df.is_cached
