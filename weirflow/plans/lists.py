"""Ordered lists per key, in parts of bounded length.

A key with an unbounded number of items would need one row (and one task) holding them all. Lists are
therefore cut every ``part_rows`` items: keys with fewer items give exactly one row, larger ones give
numbered parts that together hold every item in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.plans.segments import running_window

PART_ROWS = 10_000


def numbered_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], part_rows: int = PART_ROWS, **window
) -> DataFrame:
    """Add ``item_no`` (from 1) and ``part_no`` (from 0) per key."""
    numbered = running_window(df, keys, order, {"item_no": ("row_number", None)}, **window)
    return numbered.withColumn("part_no", F.floor((F.col("item_no") - 1) / part_rows).cast("int"))


def ordered_lists(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], items: dict[str, Sequence[str]],
    part_rows: int = PART_ROWS, **window,
) -> DataFrame:
    """One row per key and part with each list of ``items``; one source column gives plain values, more give structs."""
    parts = numbered_parts(df, keys, order, part_rows, **window)
    lists = []
    for name, columns in items.items():
        value = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
        gathered = F.array_sort(F.collect_list(F.struct(F.col("item_no"), value.alias("value"))))
        lists.append(F.transform(gathered, lambda s: s["value"]).alias(name))
    return parts.groupBy(*keys, "part_no").agg(F.count(F.lit(1)).alias("item_count"), *lists)
