"""Reports on how rows spread, and choices of partition counts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions.numbers import rounded
from weirflow.plans.segments import estimated_bytes


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition as Spark runs the frame now."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def key_skew(df: DataFrame, key: str, top: int = 20) -> DataFrame:
    """The heaviest keys and how many times the mean they hold."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    mean = df.agg(F.try_divide(F.count(F.lit(1)).cast("double"), F.count_distinct(key).cast("double")).alias("mean"))
    return (
        counts.orderBy(F.desc("rows"), F.asc(key)).limit(top)
        .withColumn("times_mean", rounded(F.try_divide(F.col("rows").cast("double"), mean.scalar())))
    )


def suggested_partitions(df: DataFrame, target_bytes: int = 128 << 20) -> int:
    """Partitions of about the target size, by Spark's estimate."""
    return max(1, math.ceil(estimated_bytes(df) / target_bytes))


def resize(df: DataFrame, partitions: int, current: int | None = None) -> DataFrame:
    """Fewer partitions without a shuffle, more with one."""
    have = current if current is not None else df.rdd.getNumPartitions()
    return df.coalesce(partitions) if partitions < have else df.repartition(partitions)


class reused:
    """``with reused(df) as d:`` keeps a frame that is read several times, and lets go of it afterwards."""

    def __init__(self, df: DataFrame):
        from pyspark import StorageLevel

        self.df, self.level = df, StorageLevel.MEMORY_AND_DISK

    def __enter__(self) -> DataFrame:
        return self.df.persist(self.level)

    def __exit__(self, *exc) -> None:
        self.df.unpersist()
