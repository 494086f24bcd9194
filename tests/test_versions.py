"""Versioned tables: what a merge reads, what readers see, loads that resume."""

import pytest
from pyspark.sql import functions as F

from weirflow.plans import merge
from weirflow.sources.versions import VersionedTable, materialise

UPSERT = lambda part, delta: merge.upsert(part, delta, ["k"])


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v string")


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"))
    made.create(rows(spark, [(i, "old") for i in range(200)]), ["k"], buckets=32)
    return made


def content(table, version=None):
    return {r.k: r.v for r in table.read(version).collect()}


def test_a_merge_reads_and_rewrites_the_touched_buckets_only(spark, table):
    before = table.manifest()
    delta = rows(spark, [(7, "new"), (1000, "added")])
    touched = table.touched(delta)
    assert len(touched) <= 2
    scan = table.read(buckets=touched)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and {int(p.split("wf_bucket=")[1].split("/")[0]) for p in scan.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} <= set(touched)
    after = table.change(delta, UPSERT)
    assert {b for b in after.held if after.held[b] != before.held.get(b)} == set(touched)
    assert content(table) == {**{i: "old" for i in range(200)}, 7: "new", 1000: "added"}
    assert content(table, 0) == {i: "old" for i in range(200)}  # the version before is still whole


def test_repeated_source_keys_raise(spark, table):
    twice = rows(spark, [(7, "a"), (7, "b")])
    with pytest.raises(ValueError, match="more than one source row"):
        table.change(twice, UPSERT)
    for run in (lambda: merge.upsert(table.read(), twice, ["k"]), lambda: merge.snapshot(
            merge.open_snapshot(table.read(), "k", F.lit("2024-01-01").cast("date")), twice, "k", F.lit("2024-02-01").cast("date"), check=["v"])):
        with pytest.raises(Exception, match="more than one source row"):
            run().collect()
    assert table.manifest().version == 0


def test_readers_never_see_half_a_change(spark, table):
    def fails(part, delta):
        return merge.upsert(part, delta, ["k"]).withColumn("v", F.when(F.col("k") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))

    with pytest.raises(Exception, match="lost"):
        table.change(rows(spark, [(7, "new"), (8, "new")]), fails)
    assert content(table) == {i: "old" for i in range(200)}
    seen = []
    steps = [lambda now: (rows(spark, [(1, "first")]), UPSERT), lambda now: (seen.append(content(table)[1]) or now.filter("v = 'first'").withColumn("v", F.lit("second")), UPSERT)]
    assert table.run(steps).version == 1
    assert seen == ["old"] and content(table)[1] == "second"


def test_another_writer_is_noticed(spark, table):
    def meanwhile(part, delta):
        if table.manifest().version == 0:
            table.change(rows(spark, [(3, "other")]), UPSERT)
        return merge.upsert(part, delta, ["k"])

    with pytest.raises(RuntimeError, match="another writer"):
        table.change(rows(spark, [(3, "mine")]), meanwhile)
    assert content(table)[3] == "other"


def test_loads_resume_and_are_verified(spark, table):
    first = table.load("a", rows(spark, [(300, "a"), (301, "a")]), UPSERT)
    assert table.load("a", rows(spark, [(302, "ignored")]), UPSERT) == first and 302 not in content(table)
    with pytest.raises(ValueError, match="1 rows offered, 0 found"):
        table.load("b", rows(spark, [(400, "b")]), lambda part, delta: part)
    assert 400 not in content(table) and [tuple(r) for r in table.ledger().collect()] == [("a", 2, 2, 1)]


def test_incremental_model(spark, tmp_path):
    model = VersionedTable(spark, str(tmp_path / "m"))
    source = spark.createDataFrame([(1, 1), (2, 2)], "k long, day int")
    materialise(model, source, ["k"], "day", UPSERT)
    materialise(model, source.unionByName(spark.createDataFrame([(2, 3), (5, 3)], "k long, day int")).filter("not (k = 2 and day = 2)"), ["k"], "day", UPSERT)
    assert sorted(map(tuple, model.read().collect())) == [(1, 1), (2, 3), (5, 3)]
