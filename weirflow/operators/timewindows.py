"""Event-time window aggregates. Each works on a batch frame and, unchanged, on a watermarked stream.

All aggregates are algebraic, so Spark combines on the map side and a hot key or window reaches the
final aggregation as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.numbers import exact_avg, money, money_avg, money_sum, rounded


def _bounds(df: DataFrame, *rest) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def sales_by_window(df: DataFrame, ts: str, region: str, amount: str, category: str, length: str = "1 hour") -> DataFrame:
    """Total, count, mean and most frequent category per region and window (smallest name on a tie).

    On batch frames the categories are counted in a first hash aggregation. A stream aggregates once,
    with a map of category counts as state, which is small as long as the categories are few.
    """
    window, where = F.window(ts, length), F.col(region).alias("region")
    if df.isStreaming:
        grouped = df.groupBy(window, where).agg(
            F.sum(money(amount)).alias("s"), F.count(amount).alias("m"), F.count(F.lit(1)).alias("n"),
            F.mode(category, True).alias("top_category"))
    else:
        per_category = df.groupBy(window, where, F.col(category).alias("c")).agg(
            F.sum(money(amount)).alias("s"), F.count(amount).alias("m"), F.count(F.lit(1)).alias("n"))
        known = F.when(F.col("c").isNotNull(), F.struct(-F.col("n"), F.col("c").alias("c")))
        grouped = per_category.groupBy("window", "region").agg(
            F.sum("s").alias("s"), F.sum("m").alias("m"), F.sum("n").alias("n"), F.min(known)["c"].alias("top_category"))
    total = F.col("s").cast("double")
    return _bounds(
        grouped, "region", total.alias("total_sales"), F.col("n").alias("transaction_count"),
        rounded(F.try_divide(total, F.col("m").cast("double"))).alias("avg_transaction_value"), "top_category")


def sales_range_by_window(df: DataFrame, ts: str, region: str, amount: str, length: str = "1 hour") -> DataFrame:
    """The other report form: mean, largest and smallest amount; a missing region counts as UNKNOWN."""
    grouped = df.groupBy(F.window(ts, length), F.coalesce(F.col(region), F.lit("UNKNOWN")).alias("region")).agg(
        money_sum(amount).alias("total_sales"), F.count(F.lit(1)).alias("transaction_count"),
        money_avg(amount).alias("average_transaction"), F.max(amount).alias("max_transaction"),
        F.min(amount).alias("min_transaction"),
    )
    return _bounds(grouped, "region", "total_sales", "transaction_count", "average_transaction",
                   "max_transaction", "min_transaction")


def sensor_by_window(
    df: DataFrame, ts: str, sensor: str, device: str, location: str, temperature: str, humidity: str,
    length: str = "10 minutes", slide: str = "5 minutes", row_id: str | None = None,
) -> DataFrame:
    """Sliding means and extremes per sensor; device and location are those of its first reading, the one of the smallest ``row_id``
    among equal times."""
    first = F.struct(ts, row_id) if row_id else F.col(ts)
    grouped = df.groupBy(F.window(ts, length, slide), F.col(sensor).alias("sensor_id")).agg(
        F.min_by(device, first).alias("device_id"), F.min_by(location, first).alias("location"),
        exact_avg(temperature).alias("avg_temperature"), exact_avg(humidity).alias("avg_humidity"),
        rounded(F.max(temperature)).alias("max_temperature"), rounded(F.min(temperature)).alias("min_temperature"),
        F.count(F.lit(1)).alias("reading_count"),
    )
    return _bounds(grouped, "sensor_id", "device_id", "location", "avg_temperature", "avg_humidity",
                   "max_temperature", "min_temperature", "reading_count")


def event_stats(df: DataFrame, ts: str, key: str, value: str, length: str = "60 seconds", slide: str | None = None) -> DataFrame:
    """Count, total, mean and extremes per key and window; a missing key counts as 'unknown'."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = df.groupBy(window, F.coalesce(F.col(key), F.lit("unknown")).alias("key")).agg(
        F.count(value).alias("event_count"), money_sum(value).alias("total_value"), money_avg(value).alias("avg_value"),
        F.max(value).alias("max_value"), F.min(value).alias("min_value"),
    )
    return _bounds(grouped, "key", "event_count", "total_value", "avg_value", "max_value", "min_value")


def counts_by_window(df: DataFrame, ts: str, keys: list[str], length: str, slide: str | None = None, out: str = "event_count") -> DataFrame:
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    return _bounds(df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias(out)), *keys, out)


def velocity_alerts(df: DataFrame, ts: str, key: str, more_than: int = 10, length: str = "60 seconds", slide: str = "10 seconds") -> DataFrame:
    """Keys with more events in a sliding window than allowed."""
    return counts_by_window(df, ts, [key], length, slide, "txn_count").filter(F.col("txn_count") > more_than)


def sums_by_window(df: DataFrame, ts: str, key: str, value: str, length: str) -> DataFrame:
    grouped = df.groupBy(F.window(ts, length), key).agg(F.count(F.lit(1)).alias("n"), money_sum(value).alias("total"))
    return _bounds(grouped, key, "n", "total")


def loan_metrics_by_window(
    df: DataFrame, ts: str, region: str, loan_type: str, amount: str, score: str, high_risk: Column, length: str = "5 minutes"
) -> DataFrame:
    grouped = df.groupBy(F.window(ts, length), region, loan_type).agg(
        F.count(F.lit(1)).alias("application_count"), money_sum(amount).alias("total_amount"),
        rounded(F.try_divide(F.sum(score).cast("double"), F.count(score).cast("double")), 1).alias("avg_credit_score"),
        F.count_if(high_risk).alias("high_risk_count"),
    )
    return _bounds(grouped, region, loan_type, "application_count", "total_amount", "avg_credit_score", "high_risk_count")


def with_window_bounds(df: DataFrame, ts: str, length: str) -> DataFrame:
    """The bounds of the window each row falls in, as columns."""
    return (
        df.withColumn("__w", F.window(ts, length))
        .withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")}).drop("__w")
    )


def lateness(df: DataFrame, event_time: str, arrival: str, late_after_seconds: int = 300) -> DataFrame:
    """Seconds between event and arrival, with a flag for late rows."""
    seconds = F.timestamp_diff("SECOND", F.col(event_time), F.col(arrival))
    return df.withColumns({"lateness_seconds": seconds, "is_late": seconds > late_after_seconds})


def high_risk_alerts(df: DataFrame, risk: str, amount: str, limit: float = 400_000) -> DataFrame:
    """Rows that need an alert, with its reason."""
    very_high = F.col(risk) == "VERY_HIGH"
    large = F.col(amount) > limit
    reason = F.concat_ws("; ", F.when(very_high, "very high risk"), F.when(large, "large amount"))
    return df.filter(very_high | large).withColumn("alert_reason", reason)
