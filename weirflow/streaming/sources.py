"""Streaming sources. A topic is read from Kafka on a cluster and from a folder of files elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.operators.parse import parse_json, with_event_time


def kafka_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic: ``value`` as text, the broker's ``timestamp`` beside it."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().select(F.decode("value", "UTF-8").alias("value"), "timestamp")


def text_topic(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages as lines of the files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Rows of the parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def parsed_events(messages: DataFrame, schema: T.StructType, time_field: str, late_after: str, *, keep_undated: bool = True) -> DataFrame:
    """JSON messages as rows with a watermarked ``event_time``.

    Messages that are not JSON are left out. Those without a readable time take the time of processing,
    or are left out too.
    """
    rows = parse_json(messages.select("value"), "value", schema)
    fallback = F.current_timestamp() if keep_undated else None
    return with_event_time(rows, time_field, fallback).withWatermark("event_time", late_after)
