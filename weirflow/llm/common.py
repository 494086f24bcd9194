"""Shared helpers: projections free of name clashes, written intermediate tables, text slices and hashing for Arrow tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.session import shared_dir

SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Only id and text, under the names ``doc_id`` and ``text``; a null text counts as empty. Other columns cannot clash:
    with ``carry`` they come along inside one struct ``row``. ``extra`` names further columns to keep as strings."""
    row = [F.struct(*(df[f"`{c}`"] for c in df.columns)).alias("row")] if carry else []
    return df.select(df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"), *(df[c].cast("string").alias(c) for c in extra), *row)


def held_above(df: DataFrame, condition: str) -> DataFrame:
    """Filter on costly columns where they stand. A plain filter moves below the projections and computes them again inside itself;
    one that reads the partition number as well cannot."""
    return df.withColumn("_part", F.spark_partition_id()).where(f"({condition}) and _part >= 0").drop("_part")


def words(text: Column) -> Column:
    """The runs of non-space characters of a text, in order."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def text_bytes(df: DataFrame) -> int:
    """Bytes of all texts (one pass over that column)."""
    return df.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: its work is done once and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows, so that a Python worker holds little text at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterator[pa.RecordBatch], limit: int = 2 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) of (doc_id, text) batches, with about ``limit`` bytes of text at a time and one text at least."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        start = size = 0
        for i, text in enumerate(texts):
            if size and size + len(text) > limit:
                yield ids[start:i], texts[start:i]
                start, size = i, 0
            size += len(text)
        if texts:
            yield ids[start:], texts[start:]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def planes(values: np.ndarray) -> bytes:
    """The values byte plane by byte plane: equal high bytes stand together and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)
