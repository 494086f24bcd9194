"""Aggregations that take more than one step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions import text
from weirflow.functions.numbers import money_sum, pct, ratio, rounded
from weirflow.plans.segments import frame_window


def word_count(df: DataFrame, column: str, min_length: int = 3) -> DataFrame:
    """Words of all texts with their counts; short words are dropped before the shuffle."""
    split = df.select(F.explode(text.words(text.normalized(column))).alias("word"))
    return (
        split.filter(F.length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("count"))
        .withColumn("word_length", F.length("word"))
    )


def metric_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum, mean, count and extremes of the values that read as numbers; keys without any vanish."""
    number = df.select(key, F.col(value).cast("string").try_cast("double").alias("number")).filter(F.col("number").isNotNull())
    return number.groupBy(key).agg(
        money_sum("number").alias("total"), rounded(ratio(money_sum("number"), F.count("number"))).alias("average"),
        F.count("number").alias("n"), F.min("number").alias("lowest"), F.max("number").alias("highest"),
    )


def salted_sum(df: DataFrame, key: str, value: str, spread_by: Sequence[str], salts: int = 16) -> DataFrame:
    """Two-phase sum and count: first per key and salt, then per key.

    Spark combines sums on the map side already; the two phases matter where a first phase has to see
    rows in one place, and they show the shape.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).alias("salt")
    first = df.groupBy(key, salt).agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("s"), F.count(value).alias("n"))
    return first.groupBy(key).agg(F.sum("s").cast("double").alias("total"), F.sum("n").alias("n"))


def funnel(df: DataFrame, user: str, event: str, steps: Sequence[str]) -> DataFrame:
    """Users that reached each step (in any order), and conversion from the step before and overall."""
    flags = [F.max((F.col(event) == s).cast("int")).alias(f"f{i}") for i, s in enumerate(steps)]
    sums = [F.sum(f"f{i}").alias(s) for i, s in enumerate(steps)]
    totals = df.groupBy(user).agg(*flags).agg(F.count(F.lit(1)).alias("total_users"), *sums)
    rates = [pct(b, a, 1).alias(f"{a}_to_{b}_pct") for a, b in zip(steps, steps[1:])]
    return totals.select("*", *rates, pct(steps[-1], steps[0], 1).alias("overall_pct"))


def time_weighted_average(df: DataFrame, key: str, rate: str, effective: str, first: str, last: str) -> DataFrame:
    """Mean rate over a period, weighted by the days each rate was in force; the last one runs to the end."""
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    upcoming = frame_window(df, [key], [effective], {"__next": lambda w: F.lead(effective).over(w)}, after=1)
    until = F.coalesce(F.date_sub("__next", 1), end)
    days = F.datediff(F.least(until, end), F.greatest(F.col(effective), start)) + 1
    active = upcoming.filter((until >= start) & (F.col(effective) <= end)).withColumn("__days", days)
    return active.groupBy(key).agg(
        rounded(F.try_divide(
            F.sum(F.col(rate).cast("decimal(18,6)") * F.col("__days")).cast("double"), F.sum("__days").cast("double")
        ), 4).alias("time_weighted_avg_rate"),
        F.sum("__days").alias("total_days"),
    )


def cumulative_distinct(df: DataFrame, key: str, day: str) -> DataFrame:
    """New keys per day of first appearance, and how many there have been so far."""
    from weirflow.plans.segments import running_window

    first_seen = df.groupBy(key).agg(F.min(day).alias("day"))
    daily = first_seen.groupBy("day").agg(F.count(F.lit(1)).alias("new_keys"))
    # One row per day: small whatever the input, so a single window task is enough.
    return running_window(daily, [], ["day"], {"cumulative_keys": ("sum", "new_keys")}, segments=1)


def delinquency(df: DataFrame, loan: str, due: str, paid: str, amount_due: str, amount_paid: str, as_of: str) -> DataFrame:
    """Loans with open amounts: what is outstanding and how many days since the last paid instalment."""
    today = F.lit(as_of).cast("date")
    status = df.filter(F.col(due) <= today).groupBy(loan).agg(
        F.max(F.when(F.col(paid).isNotNull(), F.col(due))).alias("last_paid"),
        F.sum(F.col(amount_due).cast("decimal(18,2)")).alias("total_due"),
        F.sum(F.coalesce(F.col(amount_paid).cast("decimal(18,2)"), F.lit(0))).alias("total_paid"),
    ).filter(F.col("total_paid") < F.col("total_due"))
    return status.select(
        loan, (F.col("total_due") - F.col("total_paid")).cast("double").alias("outstanding"),
        F.datediff(today, "last_paid").alias("days_past_due"),
    )


