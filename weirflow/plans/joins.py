"""Joins that hold under skew: broadcast only after a size check, salting and hot-key isolation otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.plans.segments import estimated_bytes

BROADCAST_BYTES_CONF = "spark.weirflow.broadcast.bytes"
DEFAULT_BROADCAST_BYTES = 32 << 20


def small_enough(df: DataFrame) -> bool:
    """Whether Spark's size estimate allows a broadcast."""
    limit = int(df.sparkSession.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))
    return estimated_bytes(df) <= limit


def join_dimension(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", *, size_of: DataFrame | None = None
) -> DataFrame:
    """Fact to dimension: broadcast when the dimension is small, else a shuffle join whose hot partitions AQE splits.

    ``size_of`` is a frame at least as large as the dimension, for dimensions that are themselves joins
    (Spark's estimate of a join is the product of its sides).
    """
    small = small_enough(dim if size_of is None else size_of)
    return fact.join(F.broadcast(dim) if small else dim, list(on), how)


def salted_join(
    big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str], salts: int = 10, how: str = "inner"
) -> DataFrame:
    """Split every key of the big side over ``salts`` tasks and repeat the other side once per salt.

    The salt is a hash of the row's own columns, so that a retried task puts a row in the same place.
    Works for inner and left joins: each big row meets each matching small row exactly once.
    Spark's estimate leaves the repeats out, so it would broadcast a side ``salts`` times as large as it takes it to be: the
    repeated side is always shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join keeps the big side: inner or left")
    left = big.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [key, "__salt"], how).drop("__salt")


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys holding at least ``share`` of all rows: at most 1/share of them, whatever the data."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.filter(F.col("rows") >= total.scalar() * share).select(key, "rows")


def hot_key_join(
    big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str], share: float = 0.01, salts: int = 32
) -> DataFrame:
    """Inner join with the hot keys taken out and salted; all other keys take a plain join.

    The list of hot keys has at most 1/share rows, so broadcasting it is safe at any size.
    """
    hot = F.broadcast(hot_keys(big, key, share).select(key))
    cold_part = big.join(hot, key, "left_anti").join(small, key, "inner")
    hot_part = salted_join(
        big.join(hot, key, "left_semi"), small.join(hot, key, "left_semi"), key, spread_by, salts
    )
    return cold_part.unionByName(hot_part)


def range_join_pairs(
    df: DataFrame, keys: Sequence[str], ts: str, row_id: str, minutes: int, keep: Sequence[str]
) -> DataFrame:
    """Pairs of rows with equal keys where the second is later by at most ``minutes`` whole minutes.

    Rows meet only inside a time bucket of that width or in the next one, so work follows the rows
    near each other in time, not the square of a key. AQE splits a bucket that is still hot.
    """
    limit = (minutes + 1) * 60_000_000  # whole minutes: 5 min 59 s still counts as 5
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    staged = df.withColumn("__us", micros).withColumn("__b", F.floor(F.col("__us") / limit))
    first = staged.select(
        *keys, *[F.col(c).alias(f"first_{c}") for c in keep], F.col("__us").alias("__us1"),
        F.explode(F.array(F.col("__b"), F.col("__b") + 1)).alias("__b"),
    )
    second = staged.select(
        *keys, *[F.col(c).alias(f"second_{c}") for c in keep], F.col("__us").alias("__us2"), "__b"
    )
    gap = F.col("__us2") - F.col("__us1")
    return (
        first.join(second, [*keys, "__b"])
        .filter((gap > 0) & (gap < limit))
        .filter(F.col(f"first_{row_id}") != F.col(f"second_{row_id}"))
        .withColumn("seconds_apart", F.floor(gap / 1_000_000).cast("bigint"))
        .drop("__b", "__us1", "__us2")
    )
