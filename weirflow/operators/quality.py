"""Quality reports and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.numbers import pct, rounded
from weirflow.plans.dedup import latest_per_key
from weirflow.plans.segments import frame_window


def completeness(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows, missing values per column, and the share missing of the first one."""
    missing = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    return df.agg(
        F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("total_rows"), *missing,
        pct(F.count_if(F.col(columns[0]).isNull()), F.count(F.lit(1))).alias("null_pct"),
    )


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(key).alias("distinct_keys"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates"))


def freshness(df: DataFrame, ts: str, as_of: Column, stale_after_minutes: int = 120) -> DataFrame:
    age = F.timestamp_diff("MINUTE", F.col("last_load"), as_of)
    return df.agg(F.max(ts).alias("last_load")).select(
        "last_load", age.alias("minutes_since_load"),
        F.when(age > stale_after_minutes, "STALE").otherwise("FRESH").alias("freshness_status"))


def source_freshness(df: DataFrame, source: str, ts: str, as_of: Column, warn_hours: int, error_hours: int) -> DataFrame:
    age = F.timestamp_diff("MINUTE", F.col("last_load"), as_of)
    status = F.when(age > error_hours * 60, "error").when(age > warn_hours * 60, "warn").otherwise("pass")
    return df.groupBy(source).agg(F.max(ts).alias("last_load")).select(source, "last_load", age.alias("age_minutes"), status.alias("status"))


def _side_by_side(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two one-row frames as one row, without a join."""
    left = source.select([F.col(c).alias(f"source_{c}") for c in source.columns])
    return left.select("*", *[target.select(c).scalar().alias(f"target_{c}") for c in target.columns])


def count_match(source: DataFrame, target: DataFrame) -> DataFrame:
    one = lambda df: df.agg(F.count(F.lit(1)).alias("count"))
    pair = _side_by_side(one(source), one(target))
    same = F.col("source_count") == F.col("target_count")
    return pair.select("source_count", "target_count", (F.col("source_count") - F.col("target_count")).alias("difference"),
                       F.when(same, "PASS").otherwise("FAIL").alias("status"))


def totals_within(source: DataFrame, target: DataFrame, amount: str, count_share: float = 0.001, sum_limit: float = 0.01) -> DataFrame:
    """Row count within a share of the source, amount sum within an absolute limit."""
    one = lambda df: df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(amount).cast("decimal(18,2)")).alias("total"))
    pair = _side_by_side(one(source), one(target))
    counts = F.struct(
        F.lit("row_count").alias("check_type"), F.col("source_rows").cast("double").alias("source_value"),
        F.col("target_rows").cast("double").alias("target_value"), F.abs(F.col("source_rows") - F.col("target_rows")).cast("double").alias("difference"),
        (F.abs(F.col("source_rows") - F.col("target_rows")) <= F.col("source_rows") * count_share).alias("ok"))
    gap = F.abs(F.col("source_total") - F.col("target_total")).cast("double")
    sums = F.struct(
        F.lit("amount_sum").alias("check_type"), F.col("source_total").cast("double").alias("source_value"),
        F.col("target_total").cast("double").alias("target_value"), gap.alias("difference"), (gap < sum_limit).alias("ok"))
    return pair.select(F.inline(F.array(counts, sums))).withColumn("status", F.when(F.col("ok"), "PASS").otherwise("FAIL")).drop("ok")


def reconcile(source: DataFrame, target: DataFrame, key: str, amount: str, account: str) -> DataFrame:
    """Status of every key of two ledgers (both unique by key)."""
    s = source.select(key, F.col(amount).alias("source_amount"), F.col(account).alias("source_account"), F.lit(True).alias("in_s"))
    t = target.select(key, F.col(amount).alias("target_amount"), F.col(account).alias("target_account"), F.lit(True).alias("in_t"))
    status = (
        F.when(F.col("in_s").isNull(), "MISSING_IN_SOURCE").when(F.col("in_t").isNull(), "MISSING_IN_TARGET")
        .when(F.col("source_amount") != F.col("target_amount"), "AMOUNT_MISMATCH")
        .when(F.col("source_account") != F.col("target_account"), "ACCOUNT_MISMATCH").otherwise("MATCHED"))
    return s.join(t, key, "full_outer").withColumn("reconciliation_status", status).drop("in_s", "in_t")


def reconciliation_report(reconciled: DataFrame) -> DataFrame:
    """Counts and absolute variance per status, and a summary row with the number of mismatches.

    The summary is computed from the small per-status result, so the join runs once.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    gap = F.abs(F.coalesce("source_amount", zero) - F.coalesce("target_amount", zero))
    per_status = reconciled.groupBy("reconciliation_status").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(gap).cast("double").alias("total_variance"))
    shown = F.array(
        F.struct(F.col("reconciliation_status").alias("status"), "record_count", "total_variance"),
        F.struct(F.lit("SUMMARY").alias("status"), "record_count",
                 F.when(F.col("reconciliation_status") != "MATCHED", F.col("record_count")).otherwise(0).cast("double").alias("total_variance")))
    rows = per_status.select(F.inline(shown))
    return rows.groupBy(F.col("status").alias("reconciliation_status")).agg(
        F.sum("record_count").alias("record_count"), F.sum("total_variance").alias("total_variance"))


def layer_chain(layers: dict[str, DataFrame], amount: str) -> DataFrame:
    """Counts and sums of the layers in order, each compared with the layer before."""
    parts = [
        df.agg(F.lit(i).alias("__at"), F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"),
               F.sum(F.col(amount).cast("decimal(18,2)")).alias("total"))
        for i, (name, df) in enumerate(layers.items())
    ]
    totals = reduce(DataFrame.unionByName, parts)
    # One row per layer.
    seen = frame_window(totals, [], ["__at"], {"__c": lambda w: F.lag("row_count").over(w), "__t": lambda w: F.lag("total").over(w)}, before=1, segments=1)
    rows = F.col("row_count") - F.coalesce("__c", "row_count")
    money = F.col("total") - F.coalesce("__t", "total")
    status = (
        F.when(F.col("row_count") == 0, "CRITICAL: No data").when(F.abs(rows) > 0, "WARNING: Row count mismatch")
        .when(F.abs(money) > 0.01, "WARNING: Amount mismatch").otherwise("PASS"))
    return seen.select("layer", "row_count", F.col("total").cast("double").alias("total_amount"), rows.alias("row_diff"),
                       money.cast("double").alias("amount_diff"), status.alias("status"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows without a parent (NULL references do not count)."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, with multiplicity."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def keyed_diff(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key and differing column, with both values as text."""
    a = left.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("a"))
    b = right.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("b"))
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"a.{c}").alias("left_value"), F.col(f"b.{c}").alias("right_value")) for c in columns])
    return a.join(b, key, "full_outer").select(key, F.inline(entries)).filter(~F.col("left_value").eqNullSafe(F.col("right_value")))


def metric_rows(results: DataFrame, day: Column, table: str, run_id: str) -> DataFrame:
    """Check results in the shape of the metrics table."""
    return results.select(
        day.alias("check_date"), F.lit(table).alias("table_name"), "check_name", F.col("check_value").cast("double").alias("check_value"),
        F.lit(0.0).alias("threshold"), F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"), F.lit(run_id).alias("run_id"))


def daily_alerts(daily: DataFrame, day: str, rows: str, nulls: str, null_pct: float = 5.0, drop_pct: float = 20.0) -> DataFrame:
    """Days whose share of missing values is too high or whose rows fell against the day before."""
    # One row per day.
    seen = frame_window(daily, [], [day], {"__before": lambda w: F.lag(rows).over(w)}, before=1, segments=1)
    share = pct(nulls, rows)
    fall = pct(F.col("__before") - F.col(rows), "__before")
    alerts = F.array_compact(F.array(F.when(share > null_pct, "null_pct"), F.when(fall > drop_pct, "row_drop")))
    return seen.select(day, F.col(rows).alias("rows"), share.alias("null_pct"), fall.alias("drop_pct"), F.concat_ws(",", alerts).alias("alerts")).filter("alerts <> ''")


def silent_sources(expected: DataFrame, rows: DataFrame, source: str, valid: Column) -> DataFrame:
    """Expected sources without a single valid row."""
    return expected.join(rows.filter(valid).select(source).distinct(), source, "left_anti")


def misfiled(df: DataFrame, partition: str, ts: str) -> DataFrame:
    """Partitions whose rows do not all carry the date of the partition."""
    spans = df.groupBy(partition).agg(F.to_date(F.min(ts)).alias("min_date"), F.to_date(F.max(ts)).alias("max_date"))
    return spans.filter((F.col("min_date") != F.col(partition)) | (F.col("max_date") != F.col(partition)))


def rescale_above(df: DataFrame, value: str, limit: Column, divide_by: float) -> DataFrame:
    """Values above a limit were entered in the wrong unit: divide them."""
    fixed = F.when(F.col(value) > limit, F.col(value) / divide_by).otherwise(F.col(value))
    return df.withColumns({f"fixed_{value}": rounded(fixed), "was_rescaled": F.col(value) > limit})


def duration_alerts(runs: DataFrame, job: str, day: str, duration: str, factor: float = 1.5, rows: int = 7) -> DataFrame:
    """Per job: the latest run against the mean of the runs before it."""
    seen = frame_window(runs, [job], [day], {"__avg": lambda w: F.avg(duration).over(w.rowsBetween(-rows, -1))}, before=rows)
    return latest_per_key(seen, [job], [f"-{day}"]).select(job, day, F.col(duration).alias("latest"), rounded("__avg").alias("rolling_avg"), (F.col(duration) > factor * F.col("__avg")).alias("is_slow"))


def stale_jobs(runs: DataFrame, job: str, at: str, succeeded: Column, now: Column, interval_seconds: int, intervals: int = 2) -> DataFrame:
    """Per job: its last success, and whether that is more than so many intervals ago; a job without any success is stale."""
    last = runs.groupBy(job).agg(F.max(F.when(succeeded, F.col(at))).alias("last_success"), F.count(F.lit(1)).alias("runs"))
    age = F.timestamp_diff("SECOND", F.col("last_success"), now)
    return last.withColumns({"age_seconds": age, "is_stale": F.coalesce(age > intervals * interval_seconds, F.lit(True))})


def result_age(results: DataFrame, window_end: str, now: Column, keys: Sequence[str] = ()) -> DataFrame:
    """How old the newest result is, in whole minutes, over all or per key."""
    newest = results.groupBy(*keys).agg(F.max(window_end).alias("latest_data"))
    return newest.withColumn("age_minutes", F.timestamp_diff("MINUTE", F.col("latest_data"), now))
