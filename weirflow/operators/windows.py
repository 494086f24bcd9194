"""Window analytics. Row-level windows go through ``plans.segments``, so a hot key is spread over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.numbers import rounded
from weirflow.plans.dedup import dense_top_per_key
from weirflow.plans.quantiles import exact_percentiles, ntile_of
from weirflow.plans.segments import frame_window, plan_cuts, running_window


def nth_highest(df: DataFrame, key: str, amount: str, n: int = 2) -> DataFrame:
    """Rows whose amount is the n-th largest distinct one of their key.

    Spark turns the rank limit into a limit inside every map task, so only candidates are shuffled.
    """
    return dense_top_per_key(df, [key], [f"-{amount}"], n, "__rank").filter(F.col("__rank") == n).drop("__rank")


def streaks(df: DataFrame, key: str, day: str) -> DataFrame:
    """Runs of consecutive days per key. Days are made distinct first, so a key has at most one row per day."""
    days = df.select(key, day).distinct()
    numbered = running_window(days, [key], [day], {"__n": ("row_number", None)}, cuts=plan_cuts(df, day, keys=[key]))
    anchored = numbered.withColumn("__anchor", F.date_sub(day, F.col("__n").cast("int")))
    return anchored.groupBy(key, "__anchor").agg(
        F.min(day).alias("streak_start"), F.max(day).alias("streak_end"), F.count(F.lit(1)).alias("consecutive_days")
    ).drop("__anchor")


def balance_with_floor(df: DataFrame, key: str, order: Sequence[str], amount: str, out: str = "running_balance") -> DataFrame:
    """Running balance that is set back to zero whenever it would fall below.

    With S the plain running sum, the balance is S minus the lowest S so far (zero included): two running
    functions in place of a row-by-row recursion.
    """
    cuts = plan_cuts(df, order, keys=[key])
    summed = running_window(df, [key], order, {"__s": ("sum", amount)}, cuts=cuts)
    lowest = running_window(summed, [key], order, {"__m": ("min", "__s")}, cuts=cuts)
    return lowest.withColumn(out, F.col("__s") - F.least(F.col("__m"), F.lit(0))).drop("__s", "__m")


def outliers(df: DataFrame, key: str, value: str, row_id: str, above: float = 0.95) -> DataFrame:
    """Rows ranked above a share of their group, flagged against the group's exact percentile."""
    cuts = plan_cuts(df, value, keys=[key])
    ranked = running_window(df, [key], [value], {"__rank": ("rank", None), "__n": ("total_count", None)}, cuts=cuts)
    share = F.try_divide((F.col("__rank") - 1).cast("double"), (F.col("__n") - 1).cast("double"))
    top = ranked.withColumn("__share", F.coalesce(share, F.lit(0.0))).filter(F.col("__share") > above)
    limits = exact_percentiles(df, [key], value, {"limit_value": above}, cuts=cuts)
    flag = F.when(F.col(value) > F.col("limit_value"), "OUTLIER").otherwise("NORMAL")
    return top.join(limits, key).select(row_id, key, value, "limit_value", flag.alias("flag"))


def step_transitions(df: DataFrame, user: str, order: Sequence[str], event: str, steps: Sequence[str]) -> DataFrame:
    """How many users went from one step directly to which next event."""
    paired = frame_window(df, [user], order, {"next_step": lambda w: F.lead(event).over(w)}, after=1)
    return (
        paired.filter(F.col(event).isin(*steps)).groupBy(F.col(event).alias("current_step"), "next_step")
        .agg(F.count_distinct(user).alias("users"))
    )


def missing_ranges(loads: DataFrame, source: str, day: str, first: Column, last: Column) -> DataFrame:
    """Ranges of days without a load per source, over a calendar."""
    have = loads.select(source, day).distinct()
    calendar = have.select(source).distinct().withColumn(day, F.explode(F.sequence(first, last)))
    gaps = calendar.join(have, [source, day], "left_anti")
    # At most one row per source and calendar day.
    numbered = running_window(gaps, [source], [day], {"__n": ("row_number", None)}, segments=1)
    return numbered.groupBy(source, F.date_sub(day, F.col("__n").cast("int")).alias("__anchor")).agg(
        F.min(day).alias("gap_start"), F.max(day).alias("gap_end"), F.count(F.lit(1)).alias("days_missing")
    ).drop("__anchor")


def scd2_versions(
    snapshots: DataFrame, key: str, day: str, attributes: Sequence[str], *, null_safe: bool = False
) -> DataFrame:
    """Versions with validity from daily snapshots (one row per key and day).

    The literal comparison overlooks a change from or to NULL; ``null_safe`` sees it.
    """
    before = {f"__p_{a}": (lambda w, a=a: F.lag(a).over(w)) for a in attributes}
    before["__first"] = lambda w: F.lag(F.lit(False), 1, True).over(w)
    cuts = plan_cuts(snapshots, day, keys=[key])
    seen = frame_window(snapshots, [key], [day], before, before=1, cuts=cuts)
    changed = F.col("__first")
    for a in attributes:
        now, prev = F.col(a), F.col(f"__p_{a}")
        changed = changed | (~now.eqNullSafe(prev) if null_safe else F.coalesce(now != prev, F.lit(False)))
    starts = seen.filter(changed).select(key, *attributes, F.col(day).alias("effective_from"))
    closed = frame_window(
        starts, [key], ["effective_from"], {"__next": lambda w: F.lead("effective_from").over(w)}, after=1, cuts=cuts
    )
    return closed.select(
        key, *attributes, "effective_from",
        F.coalesce(F.date_sub("__next", 1), F.lit("9999-12-31").cast("date")).alias("effective_to"),
        F.col("__next").isNull().alias("is_current"),
    )


def moving_statistics(df: DataFrame, key: str, day: str, value: str, short: int = 7, long: int = 30) -> DataFrame:
    """Moving mean, rolling median, deviation and z-score over the last rows of each series."""
    near = lambda w: w.rowsBetween(-(short - 1), 0)
    far = lambda w: w.rowsBetween(-(long - 1), 0)
    made = frame_window(df, [key], [day], {
        "__avg": lambda w: F.avg(value).over(near(w)),
        "__med": lambda w: F.percentile(value, 0.5).over(far(w)),
        "__avg_long": lambda w: F.avg(value).over(far(w)),
        "__sd": lambda w: F.stddev_samp(value).over(far(w)),
    }, before=long - 1)
    return made.select(
        key, day, value, rounded("__avg").alias("moving_avg"), rounded("__med").alias("rolling_median"),
        rounded(F.col(value) - F.col("__avg")).alias("deviation"),
        rounded(F.try_divide(F.col(value) - F.col("__avg_long"), F.col("__sd"))).alias("z_score"),
    )


def sequence_matches(
    df: DataFrame, user: str, ts: str, row_id: str, event: str, steps: tuple[str, str, str], minutes: int
) -> DataFrame:
    """Users whose events, among the three kinds, follow the given order within the time."""
    of_kind = df.filter(F.col(event).isin(*steps))
    looked = frame_window(of_kind, [user], [ts, row_id], {
        "__e2": lambda w: F.lead(event, 1).over(w), "__e3": lambda w: F.lead(event, 2).over(w),
        "__t3": lambda w: F.lead(ts, 2).over(w),
    }, after=2)
    taken = F.timestamp_diff("MINUTE", F.col(ts), F.col("__t3"))
    hit = (F.col(event) == steps[0]) & (F.col("__e2") == steps[1]) & (F.col("__e3") == steps[2]) & (taken <= minutes)
    return looked.filter(hit).select(
        user, F.col(ts).alias("first_time"), F.col("__t3").alias("last_time"), taken.alias("minutes_to_convert")
    ).distinct()


def change_from_previous(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    seen = frame_window(df, [key], order, {"previous": lambda w: F.lag(value).over(w)}, before=1)
    return seen.withColumn("change", F.col(value) - F.col("previous"))


def falling_streak(monthly: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """Months whose value is below the month before, which was itself below the one before that."""
    seen = frame_window(monthly, [key], [month], {
        "previous_month": lambda w: F.lag(value, 1).over(w), "two_months_ago": lambda w: F.lag(value, 2).over(w)}, before=2)
    return seen.filter((F.col(value) < F.col("previous_month")) & (F.col("previous_month") < F.col("two_months_ago")))


def trailing_alert(daily: DataFrame, key: str, day: str, value: str, factor: float = 2.0, rows: int = 7) -> DataFrame:
    """Days above a multiple of the mean of the rows before them."""
    seen = frame_window(daily, [key], [day], {"__avg": lambda w: F.avg(value).over(w.rowsBetween(-rows, -1))}, before=rows)
    return seen.filter(F.col(value) > factor * F.col("__avg")).withColumn("trailing_avg", rounded("__avg")).drop("__avg")


def sigma_alert(daily: DataFrame, key: str, day: str, value: str, sigmas: float = 3.0, rows: int = 30) -> DataFrame:
    """Days further from the mean of the rows before them than so many standard deviations."""
    past = lambda w: w.rowsBetween(-rows, -1)
    seen = frame_window(daily, [key], [day], {
        "__avg": lambda w: F.avg(value).over(past(w)), "__sd": lambda w: F.stddev_samp(value).over(past(w))}, before=rows)
    far = F.abs(F.col(value) - F.col("__avg")) > sigmas * F.col("__sd")
    return seen.filter(far).select(key, day, value, rounded("__avg").alias("rolling_avg"), rounded("__sd").alias("rolling_sd"))


def ntile_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str], tiles: int, out: str = "bucket") -> DataFrame:
    """NTILE from a running row number and the group size; also without keys, over the whole table."""
    placed = running_window(df, keys, order, {"__rn": ("row_number", None), "__n": ("total_count", None)})
    return placed.withColumn(out, ntile_of(F.col("__rn"), F.col("__n"), tiles)).drop("__rn", "__n")
