"""Text records to typed columns, with or without an error output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def decode(df: DataFrame, column: str, charset: str = "UTF-8") -> DataFrame:
    """Bytes of a topic message to text."""
    return df.withColumn(column, F.decode(F.col(column), charset))


def split_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Add ``record`` and ``parse_error``: exactly one of them is set in every row."""
    parsed = F.from_json(
        F.col(column), _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    staged = df.withColumn("__parsed", parsed)
    bad = F.col("__parsed").isNull() | F.col(f"__parsed.{CORRUPT}").isNotNull()
    record = F.struct(*[F.col(f"__parsed.{f.name}").alias(f.name) for f in schema.fields])
    error = F.when(bad, F.when(F.col(column).isNull(), "empty message").otherwise("not valid JSON"))
    return staged.select(
        *[F.col(c) for c in df.columns], F.when(~bad, record).alias("record"), error.alias("parse_error")
    )


def parse_json(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Valid records only, their fields as columns beside the others."""
    split = split_json(df, column, schema).filter(F.col("parse_error").isNull())
    return split.select(*[c for c in df.columns if c != column], "record.*")


def with_event_time(
    df: DataFrame, time_field: str, fallback: Column | None, out: str = "event_time"
) -> DataFrame:
    """Event time from an ISO text field. Rows without one get the fallback, or are dropped if it is None."""
    ts = F.try_to_timestamp(F.col(time_field))
    if fallback is not None:
        return df.withColumn(out, F.coalesce(ts, fallback))
    return df.withColumn(out, ts).filter(F.col(out).isNotNull())


def split_delimited(df: DataFrame, column: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Add ``record`` and ``parse_error`` for lines of positional fields."""
    pattern = "\\Q" + sep + "\\E"
    parts = F.split(F.col(column), pattern, -1)
    staged = df.withColumn("__parts", parts)
    raw = [F.trim(F.get(F.col("__parts"), F.lit(i))) for i in range(len(schema.fields))]
    typed = [r.try_cast(f.dataType) for r, f in zip(raw, schema.fields)]
    failed = [
        F.when(t.isNull() & (r != "") if f.nullable else t.isNull(), F.lit(f"bad {f.name}"))
        for r, t, f in zip(raw, typed, schema.fields)
    ]
    error = F.when(F.size("__parts") != len(schema.fields), F.lit("wrong number of fields")).otherwise(
        F.concat_ws("; ", *failed)
    )
    return (
        staged.withColumn("parse_error", F.nullif(error, F.lit("")))
        .withColumn(
            "record",
            F.when(
                F.col("parse_error").isNull(),
                F.struct(*[t.alias(f.name) for t, f in zip(typed, schema.fields)]),
            ),
        )
        .drop("__parts")
    )


def well_shaped(column: str, fields: int, numeric_at: int, sep: str = ",") -> Column:
    """True for lines with the right number of fields and a number in one place."""
    parts = F.split(F.col(column), "\\Q" + sep + "\\E", -1)
    return (F.size(parts) == fields) & F.get(parts, F.lit(numeric_at)).try_cast("double").isNotNull()


def json_fields(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Scalar JSON fields as columns: ``{"k": "$.k"}``."""
    return df.withColumns({name: F.get_json_object(F.col(column), path) for name, path in fields.items()})
