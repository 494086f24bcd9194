"""Ordered window functions that do not put a whole key into one task.

``Window.partitionBy(key)`` sends every row of a key to one task, so a key holding a third of the
table stalls the job. Here hot keys are cut: their rows are split at quantiles of the order columns,
and the window runs over (key, segment). Where one value of the leading column holds more than a
segment (a key that is hot on one day), its rows are cut again by the next column, and so on. A group is then about as large as a normal partition,
whatever the key. What a row needs from earlier segments is small and is handed over as *seed rows* that
are unioned into the segment:

* running functions: one seed per hot key and segment with the totals of all earlier segments;
* frame functions: the last (or next) few rows of the neighbouring segments.

Keys that are not hot have one segment and no seeds. Below a size limit (``spark.weirflow.segment.bytes``,
default 64 MiB by Spark's own size estimate) one task can hold the table, and without hot keys nothing
needs cutting: both take a plain window. Hot keys and cuts only steer the work: results do not depend on
them, and they enter the plan as constants, so a retried task sees the same ones.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = "__segment"
SEED = "__seed"
HOT = "__hot"
SEGMENT_BYTES_CONF = "spark.weirflow.segment.bytes"
DEFAULT_SEGMENT_BYTES = 64 << 20
MAX_SEGMENTS = 200_000  # 12 TB of 64 MiB segments; beyond, segments grow

RUNNING_KINDS = (
    "sum", "count", "min", "max", "row_number", "rank", "dense_rank", "total_sum", "total_count",
)


def order_terms(order: Sequence[str]) -> list[tuple[str, bool]]:
    """``["-amount", "id"]`` -> ``[("amount", True), ("id", False)]`` (True = descending)."""
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def sort_columns(order: Sequence[str], reverse: bool = False) -> list[Column]:
    """Sort expressions; reversing also swaps the null placement, so the order is exactly mirrored."""
    out = []
    for name, desc in order_terms(order):
        if desc != reverse:
            out.append(F.col(name).desc_nulls_last())
        else:
            out.append(F.col(name).asc_nulls_first())
    return out


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a frame (file sizes scaled by the columns read)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def segment_count(df: DataFrame) -> int:
    """How many segments the frame needs; 1 means a single task can hold all of it."""
    limit = int(df.sparkSession.conf.get(SEGMENT_BYTES_CONF, str(DEFAULT_SEGMENT_BYTES)))
    size = estimated_bytes(df)
    if limit <= 0:
        return 8
    return 1 if size <= limit else min(MAX_SEGMENTS, max(2, math.ceil(size / limit)))


TEXT_PARTS, PART_BYTES = 4, 6


def _as_numbers(df: DataFrame, order: str | Sequence[str]) -> list[tuple[Column, bool, float]]:
    """(number, descending, limit) for each order column: numbers that never fall where the column rises, nulls lowest, NaN highest.

    Below the limit equal numbers are equal values, so the next column may cut inside them. Texts are cut by their first 24 bytes, six at
    a time, and end the list.
    """
    out: list[tuple[Column, bool, float]] = []
    for name, desc in order_terms([order] if isinstance(order, str) else order):
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, (T.StringType, T.BinaryType)):
            part = lambda i: F.rpad(F.hex(F.substring(value.cast("binary"), i * PART_BYTES + 1, PART_BYTES)), 2 * PART_BYTES, "0")  # noqa: E731, B023
            return out + [(_bounded(F.conv(part(i), 16, 10).cast("double")), desc, math.inf if i < TEXT_PARTS - 1 else 0.0) for i in range(TEXT_PARTS)]
        if isinstance(kind, T.DateType):
            number, limit = F.unix_date(value), 2.0**53
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            number, limit = value.cast("timestamp"), 2.0**32
        elif isinstance(kind, T.BooleanType):
            number, limit = value.cast("int"), 2.0**53
        elif isinstance(kind, T.DecimalType):
            number, limit = value, 2.0**53 / 10**kind.scale
        elif isinstance(kind, T.NumericType):
            number, limit = value, sys.float_info.max if isinstance(kind, (T.FloatType, T.DoubleType)) else 2.0**53
        else:
            raise TypeError(f"the order column {name} must be a number, date, timestamp, boolean or text, not {kind}")
        out.append((_bounded(number.cast("double")), desc, limit))
    return out


def _bounded(number: Column) -> Column:
    most = F.lit(sys.float_info.max)
    return F.when(number.isNull(), F.lit(-math.inf)).otherwise(F.greatest(-most, F.least(number, most)))  # least takes NaN for the largest


@dataclass(frozen=True)
class Cuts:
    """Where the order columns are cut, as numbers, and for which keys.

    ``values`` cut the leading column. Each of ``finer`` has (the numbers of the columns before, cuts of the next column), for the values
    that hold more than a segment; ``pieces`` is one more than its largest number of cuts. No values mean a plain window; no hot keys
    with values mean that every key is cut.
    """

    values: tuple[float, ...] = ()
    keys: tuple[str, ...] = ()
    hot: DataFrame | None = None
    finer: tuple[DataFrame, ...] = ()
    pieces: tuple[int, ...] = ()


def _repeated(values: Sequence[float]) -> dict[float, int]:
    """The values that stand more than once among the quantiles: each holds so many segments' worth of rows."""
    return {v: n for v, n in Counter(values).items() if n > 1}


def _distinct(quantiles: Sequence[float]) -> list[float]:
    """The cuts. A value that is cut again must be alone in its part: a cut follows right after it."""
    after = {math.nextafter(v, math.inf) for v in _repeated(quantiles)}
    return sorted(v for v in {*quantiles, *after} if math.isfinite(v))


def plan_cuts(
    df: DataFrame, order: str | Sequence[str], segments: int | None = None, *, keys: Sequence[str] = (), hot_rows: float | None = None
) -> Cuts:
    """Cuts for a frame by its leading order column or columns: none when it is small or has no hot key.

    A key is hot when it has more rows than one of the segments the table would need, so there are fewer
    hot keys than segments. Counting rows per key and the quantiles of the hot rows cost a pass each over
    the key and order columns, and one more for each further column that is needed; the driver gets the hot
    keys and one number per segment. Make the cuts once, on the plain input, and hand them to every window of
    an operator. With ``segments`` given every key is cut, unless ``hot_rows`` says from how many rows on.
    """
    limit = int(df.sparkSession.conf.get(SEGMENT_BYTES_CONF, str(DEFAULT_SEGMENT_BYTES)))
    every_key = not keys or (hot_rows is None and (segments is not None or limit <= 0))
    wanted = segments if segments is not None else segment_count(df)
    if wanted <= 1:
        return Cuts()
    numbers = _as_numbers(df, order)
    source, hot = df, None
    if not every_key:
        rows = hot_rows if hot_rows is not None else df.count() / wanted
        heavy = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > rows)
        found = heavy.collect()
        if not found:
            return Cuts()
        fields = T.StructType([df.schema[k] for k in keys])
        hot = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], fields)
        source = _mark_hot(df, Cuts((), tuple(keys), hot)).filter(HOT)
        wanted = max(2, math.ceil(sum(r["__rows"] for r in found) / max(rows, 1)))
    source = source.select(*[number.alias(f"__n{i}") for i, (number, *_) in enumerate(numbers)])
    quantiles = source.approxQuantile("__n0", [i / wanted for i in range(1, wanted)], 1.0 / (4 * wanted))
    finer, pieces = _finer_cuts(source, {(v,): n for v, n in _repeated(quantiles).items()}, [limit for *_, limit in numbers])
    return Cuts(tuple(_distinct(quantiles)), tuple(keys), hot, finer, pieces)


def _finer_cuts(source: DataFrame, heavy: dict[tuple[float, ...], int], limits: list[float]) -> tuple[tuple[DataFrame, ...], tuple[int, ...]]:
    """Cuts of the further columns inside values that hold several segments' worth of rows, one pass for each column."""
    finer, pieces = [], []
    for level in range(1, len(limits)):
        heavy = {k: n for k, n in heavy.items() if k[-1] == -math.inf or abs(k[-1]) < limits[level - 1]}
        if not heavy:
            break
        before = [f"__n{i}" for i in range(level)]
        marks = source.sparkSession.createDataFrame(list(heavy), ", ".join(f"{b} double" for b in before))
        parts = max(heavy.values()) + 1
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        inside = source.join(F.broadcast(marks), before).groupBy(*before).agg(F.percentile_approx(f"__n{level}", shares, 4 * parts).alias("q")).collect()
        heavy = {(*(r[b] for b in before), v): n for r in inside for v, n in _repeated(r["q"]).items()}
        cuts = [(*(r[b] for b in before), _distinct(r["q"])) for r in inside]
        finer.append(source.sparkSession.createDataFrame(cuts, ", ".join([*(f"{b} double" for b in before), f"__cuts{level} array<double>"])))
        pieces.append(max(len(c[-1]) for c in cuts) + 1)
    return tuple(finer), tuple(pieces)


def _mark_hot(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add whether the row's key is hot. The hot keys are fewer than the segments, so they are broadcast."""
    if cuts.hot is None:
        return df.withColumn(HOT, F.lit(True))
    names = {k: f"__hot_{i}" for i, k in enumerate(cuts.keys)}
    marks = cuts.hot.select(*[F.col(k).alias(n) for k, n in names.items()], F.lit(True).alias("__is_hot"))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(n)) for k, n in names.items()])
    joined = df.join(F.broadcast(marks), same, "left")
    return joined.withColumn(HOT, F.coalesce("__is_hot", F.lit(False))).drop("__is_hot", *names.values())


def with_segments(df: DataFrame, order: str | Sequence[str], cuts: Cuts) -> DataFrame:
    """Add the segment number, rising in the direction of the order; 0 for keys that are not hot."""
    from pyspark.ml.feature import Bucketizer

    # A window over fewer columns than were cut keeps its equal rows together.
    terms = _as_numbers(df, order)[: len(cuts.finer) + 1]
    marked = _mark_hot(df, cuts).withColumns({f"__n{i}": number for i, (number, *_) in enumerate(terms)})
    bucketed = Bucketizer(splits=[-math.inf, *cuts.values, math.inf], inputCol="__n0", outputCol="__bucket").transform(marked)
    directed = lambda place, desc: -place if desc else place
    segment = directed(F.col("__bucket").cast("long"), terms[0][1])
    for level, (table, size) in enumerate(zip(cuts.finer[: len(terms) - 1], cuts.pieces), 1):
        # Numbers of the values that are cut again, fewer than the segments.
        bucketed = bucketed.join(F.broadcast(table), [f"__n{i}" for i in range(level)], "left")
        number = F.col(f"__n{level}")
        place = F.when(F.col(f"__cuts{level}").isNull(), 0).otherwise(F.size(F.filter(f"__cuts{level}", lambda c: c <= number)))
        segment = segment * size + directed(place, terms[level][1])
    segmented = bucketed.withColumn(SEGMENT, F.when(F.col(HOT), segment).otherwise(0))
    return segmented.select(*df.columns, HOT, SEGMENT)


def _cut(df, keys, order, segments, cuts):
    cuts = cuts if cuts is not None else plan_cuts(df, order, segments, keys=keys)
    return with_segments(df, order, cuts) if cuts.values else None


def running_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, tuple[str, str | None]],
    *,
    segments: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Functions over all rows from the start of the key up to the current one.

    ``columns`` maps an output name to ``(kind, source column)``; the kinds are in RUNNING_KINDS.
    ``total_*`` give the value for the whole key. ``order`` must be unique within a key, apart from
    rank and dense_rank, where equal order values share a rank.
    """
    for kind, _ in columns.values():
        if kind not in RUNNING_KINDS:
            raise ValueError(f"unknown running function {kind}")
    cut = _cut(df, keys, order, segments, cuts)
    if cut is None:
        return _plain_running(df, keys, order, columns)
    return _segmented_running(cut, df.columns, keys, order, columns)


def _plain_running(df, keys, order, columns):
    ordered = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    made = {
        "sum": lambda c: F.sum(c).over(upto),
        "count": lambda c: F.count(c or F.lit(1)).over(upto),
        "min": lambda c: F.min(c).over(upto),
        "max": lambda c: F.max(c).over(upto),
        "row_number": lambda c: F.row_number().over(ordered).cast("bigint"),
        "rank": lambda c: F.rank().over(ordered).cast("bigint"),
        "dense_rank": lambda c: F.dense_rank().over(ordered).cast("bigint"),
        "total_sum": lambda c: F.sum(c).over(whole),
        "total_count": lambda c: F.count(c or F.lit(1)).over(whole),
    }
    return df.select("*", *[made[kind](src).alias(out) for out, (kind, src) in columns.items()])


def _segmented_running(cut, names, keys, order, columns):
    order_names = [name for name, _ in order_terms(order)]
    one = F.lit(1).cast("bigint")

    def row_value(kind, src):
        if kind in ("row_number", "rank", "dense_rank"):
            return one
        if kind in ("count", "total_count"):
            return F.when(F.col(src).isNotNull(), one).otherwise(0) if src else one
        return F.col(src)

    valued = cut.select("*", *[row_value(k, s).alias(f"__v_{o}") for o, (k, s) in columns.items()])

    def per_segment(out, kind):
        if kind == "dense_rank":
            return F.count_distinct(F.struct(*order_names))
        return {"min": F.min, "max": F.max}.get(kind, F.sum)(f"__v_{out}")

    totals = valued.filter(HOT).groupBy(*keys, SEGMENT).agg(
        *[per_segment(out, kind).alias(f"__v_{out}") for out, (kind, _) in columns.items()]
    )
    by_segment = Window.partitionBy(*keys).orderBy(SEGMENT)
    earlier = by_segment.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)

    def handed_over(out, kind):
        value = f"__v_{out}"
        if kind in ("min", "max"):
            return {"min": F.min, "max": F.max}[kind](value).over(earlier)
        if kind.startswith("total_"):
            return F.sum(value).over(whole)
        carried = F.sum(value).over(earlier)
        return carried if kind == "sum" else F.coalesce(carried, F.lit(0))

    seeds = totals.select(
        *keys,
        SEGMENT,
        *[handed_over(out, kind).alias(f"__v_{out}") for out, (kind, _) in columns.items()],
        F.lit(0).alias(SEED),
        F.lit(True).alias(HOT),
    )
    merged = valued.withColumn(SEED, F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    ordered = Window.partitionBy(*keys, SEGMENT).orderBy(SEED, *sort_columns(order))
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy(*keys, SEGMENT)

    def finished(out, kind):
        value = F.col(f"__v_{out}")
        if kind in ("min", "max"):
            return {"min": F.min, "max": F.max}[kind](value).over(upto)
        if kind in ("rank", "dense_rank"):
            local = (F.rank() if kind == "rank" else F.dense_rank()).over(ordered)
            return F.when(F.col(HOT), F.first(value).over(upto) + local - 1).otherwise(local).cast("bigint")
        if kind.startswith("total_"):
            return F.when(F.col(HOT), F.first(value).over(upto)).otherwise(F.sum(value).over(group))
        return F.sum(value).over(upto)

    return (
        merged.select("*", *[finished(out, kind).alias(out) for out, (kind, _) in columns.items()])
        .filter(F.col(SEED) == 1)
        .select(*names, *columns)
    )


def frame_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Callable],
    *,
    before: int = 0,
    after: int = 0,
    segments: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Functions over a bounded row frame: lag, lead, moving averages, rolling medians.

    ``columns`` maps an output name to a function from the ordered window to a column. It may look at
    most ``before`` rows back and ``after`` rows ahead. ``order`` must be unique within a key.
    """
    cut = _cut(df, keys, order, segments, cuts)
    if cut is None:
        window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        return df.select("*", *[make(window).alias(out) for out, make in columns.items()])

    names = df.columns
    merged = cut.drop(HOT).withColumn(SEED, F.lit(1))
    if before:
        merged = merged.unionByName(_neighbour_rows(cut, names, keys, order, before, ahead=False))
    if after:
        merged = merged.unionByName(_neighbour_rows(cut, names, keys, order, after, ahead=True))
    window = Window.partitionBy(*keys, SEGMENT).orderBy(*sort_columns(order))
    return (
        merged.select("*", *[make(window).alias(out) for out, make in columns.items()])
        .filter(F.col(SEED) == 1)
        .select(*names, *columns)
    )


def _neighbour_rows(cut, names, keys, order, count, ahead):
    """Copies of the ``count`` rows next to each (key, segment), labelled with that segment."""
    nearest_first = Window.partitionBy(*keys, SEGMENT).orderBy(*sort_columns(order, reverse=not ahead))
    edge = (
        cut.filter(HOT).withColumn("__nth", F.row_number().over(nearest_first))
        .filter(F.col("__nth") <= count)
        .groupBy(*keys, SEGMENT)
        .agg(
            F.collect_list(
                F.struct(
                    (F.col(SEGMENT) if ahead else -F.col(SEGMENT)).alias("far"),
                    F.col("__nth").alias("nth"),
                    F.struct(*names).alias("row"),
                )
            ).alias("__edge")
        )
    )
    by_segment = Window.partitionBy(*keys).orderBy(SEGMENT)
    # A non-empty segment adds at least one row, so `count` neighbours are enough.
    near = by_segment.rowsBetween(1, count) if ahead else by_segment.rowsBetween(-count, -1)
    picked = F.slice(F.array_sort(F.flatten(F.collect_list("__edge").over(near))), 1, count)
    return (
        edge.select(*keys, SEGMENT, picked.alias("__near"))
        .select(SEGMENT, F.explode("__near").alias("__one"))
        .select("__one.row.*", SEGMENT, F.lit(0).alias(SEED))
        .select(*names, SEGMENT, SEED)
    )
