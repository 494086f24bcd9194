"""Segmented windows and quantiles give what plain windows and brute force give."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weirflow.plans.quantiles import exact_percentiles, ntile_of
from weirflow.plans.segments import SEGMENT_BYTES_CONF, frame_window, plan_cuts, running_window


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        ts = None if i % 97 == 0 else rng.randrange(200)
        rows.append((i, key, ts, rng.choice([None, *range(-50, 50)])))
    return spark.createDataFrame(rows, "id int, k string, t int, v int").cache()


RUNNING = {
    "s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"),
    "rn": ("row_number", None), "tot": ("total_sum", "v"), "n": ("total_count", None),
}


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "id"]])
@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("segments", [2, 7])
def test_running_equals_plain(skewed, order, keys, segments):
    plain = running_window(skewed, keys, order, RUNNING, segments=1)
    cut = running_window(skewed, keys, order, RUNNING, segments=segments)
    assert plain.schema.simpleString() == cut.schema.simpleString()
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "id"]])
def test_only_hot_keys_are_cut(skewed, order):
    ranks = {"r": ("rank", None), "d": ("dense_rank", None)}
    framed = {"p2": lambda w: F.lag("id", 2).over(w), "n1": lambda w: F.lead("v").over(w)}
    cuts = plan_cuts(skewed, order[0], 9, keys=["k"], hot_rows=250)
    assert [r.k for r in cuts.hot.collect()] == ["hot"] and cuts.values
    for make in (
        lambda **kw: running_window(skewed, ["k"], order, {**RUNNING, **ranks}, **kw),
        lambda **kw: frame_window(skewed, ["k"], order, framed, before=2, after=1, **kw),
    ):
        plain, cut = make(segments=1), make(cuts=cuts)
        assert plain.schema.simpleString() == cut.schema.simpleString()
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))
    assert plan_cuts(skewed, order[0], 9, keys=["k"], hot_rows=5000).values == ()


def test_null_can_be_the_hot_key(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 2 == 0, F.lit("a")).when(F.col("id") % 10 == 1, F.col("id").cast("string")).alias("k"), (F.col("id") % 50).alias("t"))
    cuts = plan_cuts(df, "t", 5, keys=["k"], hot_rows=100)
    assert {r.k for r in cuts.hot.collect()} == {"a", None}
    args = (["k"], ["t", "id"], {"s": ("sum", "id"), "n": ("total_count", None)})
    assert running_window(df, *args, segments=1).exceptAll(running_window(df, *args, cuts=cuts)).isEmpty()


def test_ranks_with_ties(skewed):
    ranks = {"r": ("rank", None), "d": ("dense_rank", None)}
    plain = running_window(skewed, ["k"], ["-t"], ranks, segments=1)
    cut = running_window(skewed, ["k"], ["-t"], ranks, segments=6)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


@pytest.mark.parametrize("order", [["t", "id"], ["-t", "id"]])
def test_frames_equal_plain(skewed, order):
    made = {
        "p1": lambda w: F.lag("v").over(w),
        "p3": lambda w: F.lag("id", 3).over(w),
        "n2": lambda w: F.lead("id", 2).over(w),
        "avg": lambda w: F.sum("v").over(w.rowsBetween(-4, 2)),
        "med": lambda w: F.percentile("v", 0.5).over(w.rowsBetween(-4, 0)),
    }
    plain = frame_window(skewed, ["k"], order, made, before=4, after=2, segments=1)
    # Segments of a few rows: the neighbours of a row span several of them.
    cut = frame_window(skewed, ["k"], order, made, before=4, after=2, segments=120)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


def test_size_decides(spark, skewed):
    spark.conf.set(SEGMENT_BYTES_CONF, "100")
    try:
        df = running_window(skewed, ["k"], ["t", "id"], {"s": ("sum", "v")})
        assert "__segment" in df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(SEGMENT_BYTES_CONF)
    df = running_window(skewed, ["k"], ["t", "id"], {"s": ("sum", "v")})
    assert "__segment" not in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("segments", [1, 9])
def test_exact_percentiles(skewed, segments):
    got = exact_percentiles(skewed, ["k"], "v", {"p5": 0.05, "med": 0.5, "p95": 0.95}, segments=segments)
    want = skewed.groupBy("k").agg(
        F.percentile("v", 0.05).alias("p5"), F.percentile("v", 0.5).alias("med"),
        F.percentile("v", 0.95).alias("p95"),
    )
    got = {r.k: r for r in got.collect()}
    for row in want.collect():
        for name in ("p5", "med", "p95"):
            assert got[row.k][name] == pytest.approx(row[name])


def test_ntile(skewed):
    w = Window.partitionBy("k").orderBy("id")
    rows = skewed.select(
        F.ntile(7).over(w).alias("want"),
        ntile_of(F.row_number().over(w), F.count("*").over(Window.partitionBy("k")), 7).alias("got"),
    ).collect()
    assert all(r.want == r.got for r in rows)


@pytest.fixture(scope="module")
def crowded(spark):
    """One key holds most rows, one day most of its rows, and one text half of those."""
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        key = "hot" if i % 5 else rng.choice("abc")
        day = 7 if i % 4 else rng.choice([None, *range(30)])
        text = "same start, another end " + str(i % 3) if i % 2 else rng.choice([None, "", "b", "bb", "é", "z"])
        rows.append((i, key, day, text, rng.choice([1.5, -2.0, float("nan"), None]), bool(i % 2), rng.randrange(100)))
    return spark.createDataFrame(rows, "id int, k string, day int, name string, d double, b boolean, v int").cache()


@pytest.mark.parametrize("order", [["day", "id"], ["-day", "id"], ["day", "-id"], ["name", "id"], ["-name", "-id"], ["d", "name", "id"], ["-d", "-name", "id"], ["b", "day", "name", "id"]])
def test_cuts_on_the_whole_order(crowded, order):
    from weirflow.plans.segments import SEGMENT, with_segments

    cuts = plan_cuts(crowded, order, 25, keys=["k"], hot_rows=150)
    assert cuts.finer
    sizes = [r["count"] for r in with_segments(crowded, order, cuts).filter("k = 'hot'").groupBy(SEGMENT).count().collect()]
    # 1,200 rows of the key, 900 of them on one day; one text of 200 rows is equal in its first 24 bytes.
    assert max(sizes) < 700 and len(sizes) >= 4
    framed = {"p2": lambda w: F.lag("id", 2).over(w), "n1": lambda w: F.lead("v").over(w)}
    for make in (lambda **kw: running_window(crowded, ["k"], order, RUNNING, **kw), lambda **kw: frame_window(crowded, ["k"], order, framed, before=2, after=1, **kw)):
        assert sorted(map(repr, make(segments=1).collect())) == sorted(map(repr, make(cuts=cuts).collect()))


def test_ranks_on_text_with_ties(crowded):
    ranks = {"rk": ("rank", None), "dk": ("dense_rank", None)}
    for order in (["name"], ["-name", "day"]):
        plain, cut = running_window(crowded, ["k"], order, ranks, segments=1), running_window(crowded, ["k"], order, ranks, segments=9)
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))
