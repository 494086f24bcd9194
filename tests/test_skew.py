"""A key with a third of the rows: same results, and no group that holds them all."""

import pytest
from pyspark.sql import functions as F

from weirflow.operators import sessions
from weirflow.plans import asof, graph, joins
from weirflow.plans.segments import SEGMENT, plan_cuts, running_window, with_segments


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 events; user 0 has a third of them, and half of those fall on one day."""
    n = 60_000
    i = F.col("id")
    user = F.when(i % 3 == 0, F.lit(0)).otherwise(i % 997)
    minute = F.when(i % 6 == 0, i % 1440).otherwise((i * 7919) % (1440 * 60))
    return spark.range(n).select(i.alias("event_id"), user.alias("user_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), minute.cast("int"))).alias("ts")).cache()


def test_no_group_holds_the_hot_key(hot):
    cuts = plan_cuts(hot, "ts", 40, keys=["user_id"], hot_rows=1500)
    assert [r.user_id for r in cuts.hot.collect()] == [0]
    sizes = with_segments(hot, "ts", cuts).groupBy("user_id", SEGMENT).count()
    # 20,000 rows of one user; two segments' worth is the bound with approximate cuts and ties.
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 60_000 / 40


def test_sessions_of_a_hot_key(hot):
    gap = sessions.gap_exceeds_seconds(1800)
    plain = sessions.mark_sessions(hot, "user_id", "ts", "event_id", gap, cuts=plan_cuts(hot, "ts", 1))
    cut = sessions.mark_sessions(hot, "user_id", "ts", "event_id", gap, cuts=plan_cuts(hot, "ts", 40, keys=["user_id"], hot_rows=1500))
    assert plain.exceptAll(cut).isEmpty() and cut.count() == 60_000


def test_running_sum_of_a_hot_key(hot):
    rows = hot.withColumn("x", (F.col("event_id") % 11).cast("bigint"))
    args = (["user_id"], ["ts", "event_id"], {"s": ("sum", "x"), "n": ("total_count", None)})
    assert running_window(rows, *args, segments=1).exceptAll(running_window(rows, *args, segments=40)).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, hot, how):
    small = spark.range(0, 500).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("x"))
    want = hot.join(small, "user_id", how)
    assert joins.salted_join(hot, small, "user_id", ["event_id"], 7, how).exceptAll(want).isEmpty()
    assert want.exceptAll(joins.salted_join(hot, small, "user_id", ["event_id"], 7, how)).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_never_broadcasts_the_repeated_side(spark, hot, how):
    small = spark.range(0, 500).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("x"))
    got = joins.salted_join(hot, small, "user_id", ["event_id"], 7, how)
    assert got.count() == hot.join(small, "user_id", how).count()
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_hot_key_join_finds_the_hot_key(spark, hot):
    assert [r.user_id for r in joins.hot_keys(hot, "user_id", 0.1).collect()] == [0]
    small = spark.range(0, 500).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("x"))
    want = hot.join(small, "user_id")
    got = joins.hot_key_join(hot, small, "user_id", ["event_id"], 0.1)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_asof_equals_range_join(spark, hot):
    facts = hot.select("event_id", "user_id", F.to_date("ts").alias("d")).filter("event_id < 6000")
    v = spark.range(0, 200).select((F.col("id") % 20).alias("user_id"), F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("id") / 20).cast("int") * 6)).alias("f"), F.col("id").alias("a"))
    v = v.withColumn("t", F.date_add("f", 3))
    want = facts.join(v, "user_id").filter("d between f and t").select("event_id", "a")
    got = asof.asof_lookup(facts, v, "user_id", "d", "f", "t", ["a"], segments=9)
    assert got.count() == facts.count()
    assert sorted(map(tuple, got.filter("a is not null").select("event_id", "a").collect())) == sorted(map(tuple, want.collect()))


def test_range_pairs_equal_brute_force(hot):
    rows = hot.filter("event_id % 20 = 0").select("event_id", "user_id", "ts")
    got = joins.range_join_pairs(rows, ["user_id"], "ts", "event_id", 5, ["event_id"]).select("first_event_id", "second_event_id")
    a, b = rows.alias("a"), rows.alias("b")
    minutes = F.timestamp_diff("MINUTE", F.col("a.ts"), F.col("b.ts"))
    want = a.join(b, F.expr("a.user_id = b.user_id and b.ts > a.ts")).filter(minutes <= 5).select(F.col("a.event_id"), F.col("b.event_id"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def _all_paths(edges, start, limit):
    found, stack = [], [[start]]
    while stack:
        path = stack.pop()
        for s, t, kind in edges:
            if s == path[-1] and (t not in path or (len(path) == 1 and t == s)):
                found.append((t, len(path), kind))
                if len(path) < limit and t not in path:
                    stack.append([*path, t])
    return found


@pytest.mark.parametrize("seed", range(4))
def test_lineage_equals_listing_all_paths(spark, seed):
    import random

    rng = random.Random(seed)
    edges = sorted({(rng.randrange(7), rng.randrange(7), rng.choice("xyz")) for _ in range(13)} | {(0, 1, "x")})
    hops, kinds = {}, {}
    for t, depth, kind in _all_paths(edges, 0, 4):
        hops[t] = min(hops.get(t, 99), depth)
        kinds.setdefault(t, set()).add(kind)
    df = spark.createDataFrame(edges, "s int, t int, kind string")
    got = {r.affected: (r.hops_from_source, r.transform_types) for r in graph.downstream_impact(df, "s", "t", "kind", 0, max_depth=4).collect()}
    assert got == {t: (hops[t], ",".join(sorted(kinds[t]))) for t in hops}
