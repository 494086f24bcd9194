"""Streaming jobs: the batch aggregations on watermarked streams, deduplication, joins and fan-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.numbers import rounded
from weirflow.operators import timewindows
from weirflow.streaming import sinks

LOCAL_MERGE_CONF = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
STATE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """State on local disk with a changelog in the checkpoint folder: larger than memory, and recoverable."""
    spark.conf.set(STATE_CONF, ROCKSDB)


def watermarked(events: DataFrame, ts: str, delay: str) -> DataFrame:
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def session_stream(events: DataFrame, user: str, ts: str, event: str, gap: str = "30 minutes", most_types: int = 10_000) -> DataFrame:
    """Sessions with their bounds, number of events, count of every type as JSON in name order, and most frequent type (the smallest
    name on a tie).

    Sessions are merged inside each partition before the shuffle, so a busy user does not send every event to one task. State is a
    count per type, not the list of events; the counts are exact up to ``most_types`` different types in one session. Events without
    a type count as ``unknown``, those without a user as ``anonymous``.
    """
    events.sparkSession.conf.set(LOCAL_MERGE_CONF, "true")
    kind = F.coalesce(F.col(event).cast("string"), F.lit("unknown"))
    counts = F.expr(f"approx_top_k(__kind, {most_types}, {most_types * 4 // 3 + 1})")
    grouped = events.withColumn("__kind", kind).groupBy(F.session_window(ts, gap), F.coalesce(F.col(user).cast("string"), F.lit("anonymous")).alias("user_id")).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("last_event"), F.count(F.lit(1)).alias("total_events"), counts.alias("counts"))
    entry = lambda x: F.struct(x["item"].alias("key"), x["count"].alias("value"))
    common = F.array_min(F.transform("counts", lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("item"))))
    return grouped.select(
        "user_id", F.col("session_window.start").alias("window_start"), F.col("session_window.end").alias("window_end"), "session_start", "last_event", "total_events",
        F.to_json(F.map_from_entries(F.array_sort(F.transform("counts", entry)))).alias("event_types"), common["item"].alias("most_common_event"),
        F.timestamp_diff("SECOND", F.col("session_window.start"), F.col("session_window.end")).alias("session_duration_seconds"))


def deduplicated(events: DataFrame, key: str, ts: str, within: str) -> DataFrame:
    """Each key once; state is kept only as long as a repeat may arrive."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def enriched(events: DataFrame, static: DataFrame, key: str, column: str, default: str = "Unknown") -> DataFrame:
    """Stream with a lookup table; Spark rereads the table for every batch, so changes are seen."""
    return events.join(static.select(key, column), key, "left").withColumn(column, F.coalesce(column, F.lit(default)))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str) -> DataFrame:
    """Two streams joined on a key and a time distance; both are watermarked, so state is bounded."""
    r = right.withColumnsRenamed({key: "__key"})
    near = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {within}"))
    return left.join(r, (F.col(key) == F.col("__key")) & near).drop("__key")


def fan_out(stream: DataFrame, name: str, outputs: dict, *, timeout: float | None = None) -> str:
    """One pass over a stream with several outputs per batch, each ``batch -> frame``, in its own folder.

    The batch is kept while it is written several times.
    """
    def each(batch: DataFrame, number: int, base: str) -> None:
        batch.persist()
        try:
            for part, make in outputs.items():
                sinks.write_batch(make(batch), number, f"{base}/{part}")
        finally:
            batch.unpersist()

    return sinks.drain_batches(stream, name, each, mode="append", timeout=timeout)


def loan_outputs(risk: Column, high_limit: float, high_risk_below: int = 550) -> dict:
    """Raw rows, alerts and five-minute partial metrics of a loan stream."""
    return {
        "raw": lambda b: b,
        "alerts": lambda b: timewindows.high_risk_alerts(b.withColumn("risk_category", risk), "risk_category", "amount", high_limit),
        "metrics": lambda b: b.groupBy(F.window("ts", "5 minutes").alias("w"), "region", "loan_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("s"), F.sum(F.col("credit_score").cast("long")).alias("score"),
            F.count("credit_score").alias("scored"), F.count_if(F.col("credit_score") < high_risk_below).alias("high_risk")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "region", "loan_type", "n", "s", "score", "scored", "high_risk"),
    }


def merged_metrics(partials: DataFrame) -> DataFrame:
    """The five-minute metrics over all batches. Every batch has its own partials under its number, and a repeated batch replaces them,
    so each row counts once however often its batch was run."""
    total = partials.groupBy("window_start", "window_end", "region", "loan_type").agg(*[F.sum(c).alias(c) for c in ("n", "s", "score", "scored", "high_risk")])
    return total.select(
        "window_start", "window_end", "region", "loan_type", F.col("n").alias("application_count"), F.col("s").cast("double").alias("total_amount"),
        rounded(F.try_divide(F.col("score").cast("double"), F.col("scored").cast("double")), 1).alias("avg_credit_score"), F.col("high_risk").alias("high_risk_count"))


def compare_with_batch(streamed: DataFrame, batch: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Every key of the stream's output and of a batch run over the same rows, and whether the values agree."""
    s = streamed.select(*keys, F.col(value).alias("stream_value"))
    b = batch.select(*keys, F.col(value).alias("batch_value"))
    agrees = F.col("stream_value").eqNullSafe(F.col("batch_value"))
    return s.join(b, list(keys), "full_outer").withColumn("agrees", agrees)
