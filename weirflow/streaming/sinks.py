"""Streaming sinks whose retries do not duplicate rows.

Results go to files in the shared folder, never to the driver. A ``foreachBatch`` write lands in a folder
named after the batch and overwrites it, so a batch that is run again replaces its own output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.plans.dedup import latest_per_key
from weirflow.session import shared_dir


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of a job, in the folder all executors share."""
    return f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"


def _finish(writer, timeout: float | None) -> None:
    query = writer.start()
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError(f"the stream did not finish within {timeout} seconds")
    finally:
        query.stop()


def drain_to_files(stream: DataFrame, name: str, *, timeout: float | None = None) -> DataFrame:
    """Process what is there (append mode), write parquet, and return the written rows."""
    spark = stream.sparkSession
    base = work_folder(spark, name)
    writer = (
        stream.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    )
    _finish(writer, timeout)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def drain_batches(
    stream: DataFrame, name: str, each: Callable[[DataFrame, int, str], None], *, mode: str = "update", timeout: float | None = None
) -> str:
    """Process what is there, giving every micro-batch with its number to ``each``; returns the work folder."""
    base = work_folder(stream.sparkSession, name)
    writer = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state")
        .foreachBatch(lambda df, no: each(df, no, base)).trigger(availableNow=True)
    )
    _finish(writer, timeout)
    return base


def write_batch(df: DataFrame, batch: int, folder: str) -> None:
    """One micro-batch into its own folder, replaced when the batch is repeated."""
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch}")


def drain_updates(stream: DataFrame, name: str, keys: Sequence[str], *, timeout: float | None = None) -> DataFrame:
    """Update mode: every batch logs the changed rows, and the latest row of each key is the result."""
    spark = stream.sparkSession
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    base = drain_batches(stream, name, lambda df, no, b: write_batch(df, no, f"{b}/out"), timeout=timeout)
    log = spark.read.schema(schema).option("basePath", f"{base}/out").parquet(f"{base}/out")
    return latest_per_key(log, keys, ["-batch_id"]).drop("batch_id")


def start_table(stream: DataFrame, table: str, checkpoint: str, *, every: str | None = None):
    """Append a stream to a table, in micro-batches of an interval or as one pass over what is there."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger).toTable(table)


def insert_if_absent(batch: DataFrame, number: int, folder: str, key: str) -> None:
    """Add the rows whose key no earlier batch wrote; the batch's own repeats are removed first."""
    from weirflow.sources.files import exists

    spark = batch.sparkSession
    rows = batch.dropDuplicates([key])
    if exists(spark, folder):
        written = spark.read.parquet(folder).filter(F.col("batch_id") != number).select(key)
        rows = rows.join(written, key, "left_anti")
    write_batch(rows, number, folder)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON messages for a topic."""
    return alerts.select(F.to_json(F.struct(*alerts.columns)).alias("value"))


MESSAGE = "message_id string, value string"


def outbox_batch(alerts: DataFrame, number: int, folder: str, *, look_back: int = 100) -> None:
    """The alerts of a micro-batch as messages that wait to be sent. A message's id is the hash of its content, so a batch that is run
    again writes the same messages in the same place; those of the last ``look_back`` batches are not written twice."""
    from weirflow.sources.files import exists

    value = F.to_json(F.struct(*alerts.columns))
    rows = alerts.select(F.sha2(value.cast("binary"), 256).alias("message_id"), value.alias("value")).dropDuplicates(["message_id"])
    if exists(alerts.sparkSession, folder):
        before = alerts.sparkSession.read.schema(f"{MESSAGE}, batch_id long").parquet(folder)
        rows = rows.join(before.filter((F.col("batch_id") < number) & (F.col("batch_id") >= number - look_back)), "message_id", "left_anti")
    write_batch(rows, number, folder)


def relay_outbox(spark: SparkSession, folder: str, sent: str, send: Callable[[DataFrame, int], None]) -> list[int]:
    """Hand every batch that waits to ``send``, oldest first, and mark it; returns the batches sent. A batch that is marked is not sent
    again. One that was sent but not marked goes out again with the same ids: ``send`` replaces (``to_topic_folder``), or consumers drop
    by id."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = lambda where: {int(s.getPath().getName().split("=")[1]) for s in fs.globStatus(path(f"{where}/batch_id=*")) or []}
    waiting = sorted(numbers(folder) - numbers(sent))
    for number in waiting:
        send(spark.read.schema(MESSAGE).parquet(f"{folder}/batch_id={number}"), number)
        fs.create(path(f"{sent}/batch_id={number}"), True).close()
    return waiting


def to_topic_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """A topic of files: one folder of JSON lines per batch, replaced when the batch is sent again."""
    return lambda messages, number: messages.write.mode("overwrite").json(f"{folder}/batch_id={number}")


def to_kafka(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """A Kafka topic, with the message id as key."""
    return lambda messages, number: messages.select(F.col("message_id").alias("key"), "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def audit_rows(alerts: DataFrame, at) -> DataFrame:
    """Alerts in the columns of the audit table."""
    return alerts.select(
        F.col("alert_type"), F.col("loan_id"), F.col("customer_id"), F.col("amount").cast("double").alias("amount"), "credit_score",
        "risk_category", "region", at.alias("alerted_at"), F.lit("OPEN").alias("status"))
