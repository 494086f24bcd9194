"""Keep one row per key. The filter on the row number lets Spark drop rows before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.plans.segments import sort_columns


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each key. Every map task forwards at most ``n`` rows per key."""
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    out = rank or "__nth"
    kept = df.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= n)
    return kept if rank else kept.drop(out)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, e.g. ``["-updated_at", "-id"]``."""
    return top_per_key(df, keys, order, 1)


def dense_top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, rank: str) -> DataFrame:
    """Rows whose order value is among the first ``n`` distinct ones of the key."""
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(rank, F.dense_rank().over(window)).filter(F.col(rank) <= n)
