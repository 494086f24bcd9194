"""File readers: text, CSV, Parquet, ORC, tables and catalog views of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything can be read at a path, on any file system Spark knows."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").limit(1).count()
        return True
    except AnalysisException:
        return False


def text_lines(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of all files a pattern matches."""
    return spark.read.text(glob)


def csv_typed(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE", header: bool = True, **options) -> DataFrame:
    """CSV with an enforced schema: PERMISSIVE keeps bad rows with their text, DROPMALFORMED drops them, FAILFAST raises."""
    reader = spark.read.option("header", header).option("mode", mode).options(**options)
    if mode == "PERMISSIVE":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose types are read from the data: an extra pass, for exploration."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_csv_table(spark: SparkSession, path: str, schema: T.StructType, table: str, mode: str = "append") -> None:
    """Bulk load of CSV files with one header row into a raw table."""
    spark.read.schema(schema).option("header", True).csv(path).write.mode(mode).saveAsTable(table)


def parquet_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of several schema versions as one frame."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def partition_range(spark: SparkSession, path: str, column: str, first, last) -> DataFrame:
    """The folders of a partitioned layout between two values, and no others."""
    return spark.read.parquet(path).filter(F.col(column).between(first, last))


def with_source_file(df: DataFrame, out: str = "source_file") -> DataFrame:
    return df.withColumn(out, F.col("_metadata.file_path"))


def orc_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    spark.read.orc(source).write.option("compression", "snappy").parquet(target)


def external_table(spark: SparkSession, table: str, path: str, file_format: str = "parquet") -> DataFrame:
    """A table over files that stay where they are."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {file_format} LOCATION '{path}'")
    return spark.table(table)


def table_with_partitions(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """A catalog table and the list of its partitions."""
    return spark.table(table), spark.sql(f"SHOW PARTITIONS {table}")
