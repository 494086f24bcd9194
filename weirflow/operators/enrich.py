"""Derived columns and lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions import scales
from weirflow.functions.finance import monthly_payment
from weirflow.functions.fixed import RISK_5, SIZE_4
from weirflow.functions.numbers import rounded
from weirflow.plans.joins import join_dimension


def derive_metrics(df: DataFrame, value: str, ts: str) -> DataFrame:
    """Adjusted value, a fixed quality score and the date of the record."""
    return df.withColumns({
        "adjusted_value": rounded(F.col(value) * 1.1),
        "quality_score": F.lit(0.95),
        "processing_date": F.to_date(ts),
    })


def run_metadata(df: DataFrame, run_ts: Column, batch_id: str, source_system: str) -> DataFrame:
    return df.withColumns({
        "batch_id": F.lit(batch_id), "source_system": F.lit(source_system), "processed_at": run_ts,
    })


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def ingestion_metadata(df: DataFrame, run_ts: Column, version: str = "1.0") -> DataFrame:
    return df.withColumns({"ingestion_time": run_ts, "pipeline_version": F.lit(version)})


def wrap_value(df: DataFrame, column: str) -> DataFrame:
    """A scalar column as a one-field record."""
    return df.select(F.struct(F.col(column).alias("value")).alias("record"))


def loan_economics(df: DataFrame) -> DataFrame:
    """Monthly payment, total interest and total cost of each loan."""
    payment = monthly_payment("amount", "interest_rate", "term_months")
    return df.withColumn("__pay", payment).withColumns({
        "monthly_payment": rounded("__pay"),
        "total_interest": rounded(F.col("__pay") * F.col("term_months") - F.col("amount")),
        "total_cost": rounded(F.col("__pay") * F.col("term_months")),
    }).drop("__pay")


def loan_classes(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "risk_category": scales.at_least("credit_score", RISK_5),
        "risk_score": scales.rank_in("credit_score", RISK_5),
        "loan_size_bucket": scales.above("amount", SIZE_4),
    })


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default: str = "Unknown") -> DataFrame:
    """Add a looked-up value, with a default where the key is unknown; ``table`` is unique by key."""
    small = table.select(F.col(key), F.col(value))
    return join_dimension(df, small, [key], "left").withColumn(value, F.coalesce(value, F.lit(default)))


def date_dimension(spark: SparkSession, first: Column | str, last: Column | str, fiscal_start: int = 4) -> DataFrame:
    """One row per calendar day with key, parts, weekend flag and fiscal year and quarter."""
    as_date = lambda d: F.lit(d).cast("date") if isinstance(d, str) else d
    days = spark.range(1).select(F.explode(F.sequence(as_date(first), as_date(last))).alias("full_date"))
    return calendar_columns(days, "full_date", fiscal_start)


def calendar_columns(days: DataFrame, d: str, fiscal_start: int = 4) -> DataFrame:
    fiscal = F.add_months(F.col(d), 12 - (fiscal_start - 1))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.col(d).alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
    )
