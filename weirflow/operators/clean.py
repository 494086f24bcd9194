"""Cleaning over whole frames; each is a projection and adds no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions import text
from weirflow.functions.numbers import rounded


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in (columns or string_columns(df))})


def standardize_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text.category(c) for c in columns})


def blank_markers(df: DataFrame, columns: Sequence[str] | None = None, markers=None) -> DataFrame:
    from weirflow.functions.fixed import NULL_MARKERS

    use = NULL_MARKERS if markers is None else markers
    return df.withColumns({c: text.null_if_marker(c, use) for c in (columns or string_columns(df))})


def replace_null_text(df: DataFrame, marker: str = "\\N") -> DataFrame:
    """The export marker for NULL in text files becomes NULL."""
    return df.na.replace(marker, None, string_columns(df))


def clean_loans(raw: DataFrame) -> DataFrame:
    """All cleaning steps on text loan records: typed, trimmed, standardised, one row per input row."""
    trimmed = trim_strings(raw)
    staged = trimmed.withColumns({c: text.null_if_marker(c, trimmed=True) for c in string_columns(trimmed)})
    return staged.select(
        text.identifier("loan_id").alias("loan_id"),
        text.identifier("customer_id").alias("customer_id"),
        text.category("loan_type").alias("loan_type"),
        rounded(text.number("amount")).alias("amount"),
        rounded(text.number("interest_rate")).alias("interest_rate"),
        F.col("term_months").try_cast("int").alias("term_months"),
        F.upper("status").alias("status"),
        text.category("region").alias("region"),
        text.parse_date("application_date").alias("application_date"),
        F.col("credit_score").try_cast("int").alias("credit_score"),
    )
