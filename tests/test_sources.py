"""Readers, writers and table maintenance on small files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators import governance
from weirflow.sources import files, tables

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DoubleType())])


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,amount\n1,2.5\nx,3\n3,4\n")
    return str(path)


@pytest.fixture
def sales(spark):
    rows = [(i, i % 5, dt.date(2024, 1, 1 + i % 3)) for i in range(60)]
    return spark.createDataFrame(rows, "id int, customer int, day date")


def fresh(spark, name):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return name


def test_csv_modes(spark, csv):
    rows = files.csv_typed(spark, csv, SCHEMA).cache()
    assert rows.filter(F.col(files.CORRUPT).isNotNull()).count() == 1
    assert len(files.csv_typed(spark, csv, SCHEMA, mode="DROPMALFORMED").collect()) == 2
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        files.csv_typed(spark, csv, SCHEMA, mode="FAILFAST").collect()
    assert files.csv_inferred(spark, csv).schema["amount"].dataType == T.DoubleType()


def test_text_glob_and_source_file(spark, tmp_path):
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("one\ntwo\n")
    lines = files.text_lines(spark, f"{tmp_path}/*.txt")
    assert lines.count() == 4
    assert {os.path.basename(r.source_file) for r in files.with_source_file(lines).collect()} == {"a.txt", "b.txt"}
    assert files.exists(spark, str(tmp_path)) and not files.exists(spark, str(tmp_path / "none"))


def test_bulk_load_orc_external_and_merged_schema(spark, csv, tmp_path):
    table = fresh(spark, "raw_sales")
    files.load_csv_table(spark, csv, SCHEMA, table)
    assert spark.table(table).count() == 3
    spark.range(5).write.orc(str(tmp_path / "orc"))
    files.orc_to_parquet(spark, str(tmp_path / "orc"), str(tmp_path / "pq"))
    ext = fresh(spark, "ext_ids")
    assert files.external_table(spark, ext, str(tmp_path / "pq")).count() == 5
    spark.range(2).withColumn("extra", F.lit(1)).write.mode("append").parquet(str(tmp_path / "pq"))
    assert files.parquet_merged(spark, str(tmp_path / "pq")).columns == ["id", "extra"]


def test_partition_pruning(spark, sales, tmp_path):
    path = str(tmp_path / "by_day")
    tables.write_partitioned(sales, path, ["day"], spread=2)
    read = files.partition_range(spark, path, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert read.count() == 20 and spark.read.parquet(path).count() == 60


def test_clustered_files_are_sorted(spark, sales, tmp_path):
    path = str(tmp_path / "clustered")
    tables.write_clustered(sales, path, ["day"], ["customer"])
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.collect_list("customer").alias("c")).collect()
    assert all(r.c == sorted(r.c) for r in per_file)
    with pytest.raises(ValueError):
        tables.write_clustered(sales, path, ["day"], list("abcde"))


def test_bucketed_join_has_no_exchange(spark, sales):
    a, b = fresh(spark, "bucket_a"), fresh(spark, "bucket_b")
    tables.write_bucketed(sales, a, 4, "id")
    tables.write_bucketed(sales.select("id", "day"), b, 4, "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(a).join(spark.table(b), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_load_is_idempotent(spark, sales):
    table = fresh(spark, "daily_load")
    day = dt.date(2024, 1, 2)
    assert tables.load_partition(sales, table, "day", day) == 20
    assert tables.load_partition(sales, table, "day", day) == 20
    tables.backfill(sales, table, "day", [dt.date(2024, 1, 1), dt.date(2024, 1, 3)])
    assert spark.table(table).count() == 60
    with pytest.raises(ValueError):
        tables.load_partition(sales, table, "day", dt.date(2030, 1, 1))
    assert tables.partition_values(spark, table).count() == 3
    assert tables.expire_partitions(spark, table, "day", "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert spark.table(table).count() == 20
    with pytest.raises(ValueError):
        tables.read_with_filter(spark, table, None)
    assert tables.read_with_filter(spark, table, F.col("day") == dt.date(2024, 1, 3)).count() == 20


def test_erasure_drops_emptied_partitions(spark, tmp_path):
    table = fresh(spark, "erasable")
    rows = [(1, 1, "a"), (2, 2, "a"), (3, 1, "b"), (4, 2, "c")]
    spark.createDataFrame(rows, "id int, customer int, part string").write.partitionBy("part").saveAsTable(table)
    gone = spark.createDataFrame([(1,)], "customer int")
    assert sorted(tables.erase_from_table(spark, table, "customer", gone, "part", str(tmp_path / "aside"))) == ["a", "b"]
    assert sorted(r.id for r in spark.table(table).collect()) == [2, 4]
    assert {r.partition for r in tables.partition_values(spark, table).collect()} == {"part=a", "part=c"}
    proof = tables.erasure_proof({"erasable": spark.table(table)}, {"erasable": "customer"}, gone, "customer")
    assert proof.first().remaining_rows == 0


def test_compaction(spark, tmp_path):
    spark.range(1000).repartition(20).write.parquet(str(tmp_path / "small"))
    assert tables.compact(spark, str(tmp_path / "small"), str(tmp_path / "big")) == 1
    assert spark.read.parquet(str(tmp_path / "big")).count() == 1000
    assert len([f for f in os.listdir(tmp_path / "big") if f.endswith(".parquet")]) == 1


def test_schema_change_views_layers_and_map(spark, sales):
    table = fresh(spark, "evolving")
    tables.replace(sales, table)
    assert tables.add_columns(spark, table, sales.withColumn("note", F.lit("x"))) == ["note"]
    assert "note" in spark.table(table).columns
    tables.append(sales.withColumn("note", F.lit("x")), table)
    assert spark.table(table).count() == 120
    tables.ensure_table(spark, "lake.empty", SCHEMA)
    tables.ensure_table(spark, "lake.empty", SCHEMA)
    assert spark.table("lake.empty").count() == 0
    out = tables.run_layers(sales, {"raw": lambda d: d, "curated": lambda d: d.filter("customer > 0"), "serving": lambda d: d.groupBy("day").count()}, "lake")
    assert out.agg(F.sum("count")).first()[0] == 48
    assert tables.materialize(sales, "v_sales", "view").count() == 60
    assert tables.materialize(sales, "e", "ephemeral") is sales
    assert "curated" in {r.table_name for r in governance.data_map(spark, "lake", "customer").collect()}


def test_dead_letter(spark, tmp_path):
    bad = spark.createDataFrame([(1, ["a", "b"])], "id int, errors array<string>")
    tables.dead_letter(bad, F.lit("2024-01-01").cast("timestamp"), str(tmp_path / "dl"))
    row = spark.read.parquet(str(tmp_path / "dl")).first()
    assert (row.record, row.errors) == ('{"id":1}', '["a","b"]')


def test_co_located_tables_join_without_exchange(spark):
    from weirflow.sources import tables

    big = spark.range(4000).selectExpr("case when id % 3 = 0 then 7 else id % 500 end as k", "id as x")  # a third of the rows on one key
    small = spark.range(400).selectExpr("id as k", "id * 10 as y").unionByName(spark.createDataFrame([(7, -1)], "k long, y long"))
    tables.write_co_located(big, small, "k", "co_big", "co_small", buckets=8, salts=4)
    for how in ("inner", "left"):
        joined = tables.join_co_located(spark, "co_big", "co_small", "k", how)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, joined.collect())) == sorted(map(str, big.join(small, "k", how).select("k", "x", "y").collect()))
    hot = spark.table("co_big").filter("k = 7").groupBy(tables.SALT).count().collect()
    assert len(hot) == 4 and max(r["count"] for r in hot) < 500


def test_destroyed_keys_cannot_be_made_again(spark, tmp_path):
    from weirflow.operators import governance as gov

    people = spark.createDataFrame([(i, f"name {i}") for i in range(20)], "id long, name string")
    vault = gov.KeyVault(spark, str(tmp_path / "keys"), "id", buckets=4)
    vault.ensure(people)
    drawn = {r.id: bytes(r.secret) for r in vault.keys().collect()}
    vault.ensure(people)
    assert {r.id: bytes(r.secret) for r in vault.keys().collect()} == drawn and len(set(drawn.values())) == 20
    sealed = spark.createDataFrame(gov.encrypt_with_keys(people, vault.keys(), "id", ["name"]).collect())
    vault.destroy(people.filter("id % 2 = 0"))
    files = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "keys" / "data"))
    assert {r.id for r in files.select("id").collect()} == set(range(1, 20, 2))  # not even in older versions
    vault.ensure(people)
    back = {r.id: r.name for r in gov.decrypt_with_keys(sealed, vault.keys(), "id", ["name"]).collect()}
    assert back == {i: f"name {i}" if i % 2 else None for i in range(20)}


def test_outbox_sends_each_message_once(spark, tmp_path):
    from weirflow.streaming import sinks

    folder, sent, topic = (str(tmp_path / x) for x in ("outbox", "sent", "topic"))
    alerts = lambda ids: spark.createDataFrame([(i, "LARGE") for i in ids], "loan_id long, alert_type string")
    calls = []
    send = lambda df, n: calls.append(n) or sinks.to_topic_folder(topic)(df, n)
    for number, ids in ((0, [1, 2, 2]), (0, [1, 2, 2]), (1, [2, 3]), (1, [2, 3])):
        sinks.outbox_batch(alerts(ids), number, folder)
        sinks.relay_outbox(spark, folder, sent, send)
    assert calls == [0, 1]
    assert sorted(r.value for r in spark.read.json(topic).select("value").collect()) == [f'{{"loan_id":{i},"alert_type":"LARGE"}}' for i in (1, 2, 3)]
