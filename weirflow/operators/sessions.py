"""Gap sessions on batch frames, without putting a user's whole history into one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.plans.lists import ordered_lists
from weirflow.plans.segments import Cuts, frame_window, plan_cuts, running_window


def gap_exceeds_minutes(minutes: int) -> Callable[[Column, Column], Column]:
    """Whole minutes between two events are more than the limit (30 min 59 s counts as 30)."""
    return lambda before, now: F.timestamp_diff("MINUTE", before, now) > minutes


def gap_exceeds_seconds(seconds: int) -> Callable[[Column, Column], Column]:
    """The exact gap is longer than the limit; exactly the limit stays in the session."""
    return lambda before, now: (
        F.unix_micros(now.cast("timestamp")) - F.unix_micros(before.cast("timestamp")) > seconds * 1_000_000
    )


def mark_sessions(
    df: DataFrame, key: str, ts: str, row_id: str, splits: Callable[[Column, Column], Column], out: str = "session_no",
    cuts: Cuts | None = None,
) -> DataFrame:
    """Number the sessions of each key from 1; a row starts one when it has no predecessor or the gap splits."""
    order = [ts, row_id]
    cuts = cuts if cuts is not None else plan_cuts(df, [ts, row_id], keys=[key])
    seen = frame_window(df, [key], order, {"__before": lambda w: F.lag(ts).over(w)}, before=1, cuts=cuts)
    starts = F.col("__before").isNull() | splits(F.col("__before"), F.col(ts))
    flagged = seen.withColumn("__new", F.when(starts, 1).otherwise(0))
    return running_window(flagged, [key], order, {out: ("sum", "__new")}, cuts=cuts).drop("__before", "__new")


def session_summary(
    df: DataFrame, key: str, ts: str, row_id: str, splits, aggregates: Sequence[Column],
) -> DataFrame:
    """One row per session with its bounds, its length and any further aggregates."""
    marked = mark_sessions(df, key, ts, row_id, splits)
    return marked.groupBy(key, "session_no").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("event_count"), *aggregates
    )


def session_paths(df: DataFrame, key: str, ts: str, row_id: str, splits, item: str, out: str) -> DataFrame:
    """The items of each session in order, in parts of bounded length (see ``plans.lists``)."""
    cuts = plan_cuts(df, [ts, row_id], keys=[key])
    marked = mark_sessions(df, key, ts, row_id, splits, cuts=cuts)
    return ordered_lists(marked, [key, "session_no"], [ts, row_id], {out: [item]}, cuts=cuts)


def type_counts(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """Per key: JSON object of item counts in name order, and the most frequent item (smallest on a tie).

    The counts are made first, so a key gathers one entry per distinct item and not one per row.
    """
    counts = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(item).alias("key"), F.col("n").alias("value"))))
    best = F.min(F.struct(-F.col("n"), F.col(item).alias("item")))
    return counts.groupBy(*keys).agg(
        F.sum("n").alias("total_events"), F.to_json(F.map_from_entries(entries)).alias("event_summary"),
        best["item"].alias("most_common_event"),
    )
