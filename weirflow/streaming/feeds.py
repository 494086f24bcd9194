"""A table replayed as a feed: micro-batches in the order of arrival, with late rows where arrival is later than event time."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.session import shared_dir
from weirflow.streaming.sinks import work_folder
from weirflow.streaming.sources import parquet_stream

SLICES = 6
SLICE_ROWS = 5_000_000  # a micro-batch is one file: more rows make more of them
CLOSING_DAYS = 400
GROUP_BYTES = 2 << 20  # row groups: one file is read by several tasks


def replay(rows: DataFrame, arrived: str, name: str, *, closing: tuple[str, ...] = (), slices: int = SLICES) -> DataFrame:
    """A stream of the rows in equal slices of their arrival time, one file and one micro-batch each.

    ``closing`` names time columns: a last micro-batch then holds one row with these 400 days past the last arrival and nulls
    elsewhere, so that every window before it ends.
    """
    spark = rows.sparkSession
    shared_dir(spark)
    folder = work_folder(spark, f"feed-{name}")
    us = F.unix_micros(F.col(arrived))
    low, high, n = rows.agg(F.min(us), F.max(us), F.count(F.lit(1))).first()
    slices = max(slices, n // SLICE_ROWS)
    low, high = low or 0, high or 0
    dealt = rows.withColumn("batch", F.least(F.lit(slices - 1), F.expr(f"(unix_micros(`{arrived}`) - {low}) * {slices} div {max(high - low, 1)}")).cast("int"))
    if closing:
        late = F.timestamp_micros(F.lit(high + CLOSING_DAYS * 86_400_000_000))
        end = spark.range(1).select(*(late.alias(f.name) if f.name in closing else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields), F.lit(slices).alias("batch"))
        dealt = dealt.unionByName(end)
    # One task and one file for each micro-batch, named by its number: no task holds several, and none sorts what it writes.
    dealt.repartitionById(slices + len(closing[:1]), "batch").select(*rows.columns).write.option("parquet.block.size", GROUP_BYTES).parquet(folder)
    _order_files(spark, folder)
    return parquet_stream(spark, folder, rows.schema, files_per_trigger=1)


def _order_files(spark, folder: str) -> None:
    """Give the files the order of their batches as modification times, which is the order in which a stream reads them."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    pattern = path(f"{folder}/part-*.parquet")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(int(re.match(r"part-(\d+)", s.getPath().getName())[1]), s.getPath()) for s in fs.globStatus(pattern)]
    start = int(time.time() * 1000) - 1000 * (max((b for b, _ in found), default=0) + 1)
    for batch, file in found:
        fs.setTimes(file, start + 1000 * batch, -1)
