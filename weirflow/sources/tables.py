"""Table writers and maintenance: partitioned, bucketed and clustered layouts, idempotent loads,
compaction, expiry, erasure. Nothing here overwrites a path it is reading from."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append(df: DataFrame, table: str) -> None:
    """Append to a table, creating it on first use."""
    df.write.mode("append").saveAsTable(table)


def replace(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create the database and the table if they are absent."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(table):
        writer = spark.createDataFrame([], schema).write.format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", spread: int = 8) -> None:
    """Hive-style folders with few files each.

    Rows are shuffled by the partition columns; ``spread`` puts a partition in up to that many tasks, so
    that a folder holding a large share of the rows is not written by a single one.
    """
    keys = [F.col(c) for c in by]
    if spread > 1:
        keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(spread)))
    df.repartition(*keys).write.mode(mode).partitionBy(*by).parquet(path)


def write_clustered(df: DataFrame, path: str, partition_by: Sequence[str], cluster_by: Sequence[str], mode: str = "overwrite") -> None:
    """Date-partitioned files sorted by up to four columns, so that row-group statistics skip blocks.

    Range partitioning by partition and cluster columns also splits a hot partition over several tasks.
    """
    if len(cluster_by) > 4:
        raise ValueError("at most four cluster columns")
    order = [*partition_by, *cluster_by]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, key: str) -> None:
    """Bucketed and sorted table: joins of two such tables on the key need no shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


SALT = "wf_salt"


def write_co_located(big: DataFrame, small: DataFrame, key: str, big_table: str, small_table: str, *, buckets: int = 64, share: float = 0.01, salts: int = 16) -> None:
    """Two tables laid out alike for joins on a key: same buckets, sorted, so that the join needs no shuffle.

    A key with more than ``share`` of the big table's rows would fill one bucket. Its rows are dealt over ``salts`` values of a second
    bucket column, and the small table holds its rows once for each of them. Join with ``join_co_located``.
    """
    from weirflow.plans.joins import hot_keys

    hot = hot_keys(big, key, share).select(F.col(key).alias("__hot"))  # at most 1 / share keys
    salt = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    dealt = big.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").withColumn(SALT, salt).drop("__hot")
    each = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = small.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left").withColumn(SALT, F.explode(each)).drop("__hot")
    for rows, table in ((dealt, big_table), (repeated, small_table)):
        rows.repartition(buckets, key, SALT).write.mode("overwrite").bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(table)


def join_co_located(spark: SparkSession, big_table: str, small_table: str, key: str, how: str = "inner") -> DataFrame:
    """Each row of the big table with its rows of the small one; inner or left."""
    if how not in ("inner", "left"):
        raise ValueError("the big side is kept: inner or left")
    return spark.table(big_table).join(spark.table(small_table).hint("merge"), [key, SALT], how).drop(SALT)


def range_bucket(column: str, width: int) -> Column:
    """Lower end of the integer range a value falls in; usable as a partition column."""
    return (F.floor(F.col(column) / width) * width).cast("bigint")


OVERWRITE_CONF = "spark.sql.sources.partitionOverwriteMode"


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that occur in the rows; all others stay.

    ``insertInto`` takes the mode from the session and ignores it as an option, and the default mode
    would empty the whole table, so the session setting is changed for the one write.
    """
    spark = df.sparkSession
    before = spark.conf.get(OVERWRITE_CONF)
    spark.conf.set(OVERWRITE_CONF, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_CONF, before)


def load_partition(df: DataFrame, table: str, column: str, value) -> int:
    """Replace one partition; running it again gives the same table. Raises when there is nothing to load."""
    spark = df.sparkSession
    part = df.filter(F.col(column) == F.lit(value))
    if part.isEmpty():
        raise ValueError(f"no rows for {column} = {value}")
    if not spark.catalog.tableExists(table):
        part.write.partitionBy(column).saveAsTable(table)
    else:
        overwrite_partitions(part, table)
    return spark.table(table).filter(F.col(column) == F.lit(value)).count()


def backfill(df: DataFrame, table: str, column: str, values: Sequence) -> None:
    """Replace several partitions in one job."""
    part = df.filter(F.col(column).isin(*values))
    if not df.sparkSession.catalog.tableExists(table):
        part.write.partitionBy(column).saveAsTable(table)
        return
    overwrite_partitions(part, table)


def partition_values(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def expire_partitions(spark: SparkSession, table: str, column: str, before: str) -> list[str]:
    """Drop the partitions with a value before a date; only the partition list reaches the driver."""
    dropped = []
    for row in partition_values(spark, table).filter(F.col("partition").startswith(f"{column}=")).collect():
        value = row.partition.split("/")[0].split("=", 1)[1]
        if value < before and value not in dropped:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column}='{value}')")
            dropped.append(value)
    return dropped


def read_with_filter(spark: SparkSession, table: str, condition: Column | None) -> DataFrame:
    """Read of a table that must not be scanned whole."""
    if condition is None:
        raise ValueError(f"{table} needs a partition filter")
    return spark.table(table).filter(condition)


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 128 << 20) -> int:
    """Rewrite many small files as few large ones into a new folder; returns the number of files planned."""
    size = sum(f["length"] for f in _files(spark, path))
    files = max(1, math.ceil(size / target_bytes))
    spark.read.parquet(path).repartition(files).write.mode("errorifexists").parquet(out)
    return files


def _files(spark: SparkSession, path: str) -> list[dict]:
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    )
    return [listing.agg(F.sum("length").alias("length")).first().asDict()]


def affected_partitions(df: DataFrame, key: str, values: DataFrame, partition: str) -> DataFrame:
    """Partitions that hold at least one row of the keys to erase."""
    return df.join(values, key, "left_semi").select(partition).distinct()


def erase_keys(df: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """All rows but those of the keys."""
    return df.join(values, key, "left_anti")


def erase_from_table(spark: SparkSession, table: str, key: str, values: DataFrame, partition: str, staging: str) -> list:
    """Erase keys from a partitioned table, rewriting only the partitions that hold them.

    The kept rows are written aside first. Partitions left empty are dropped: an overwrite with no rows
    for them would leave the old ones in place.
    """
    source = spark.table(table)
    names = [r[0] for r in affected_partitions(source, key, values, partition).collect()]
    if not names:
        return []
    kept = erase_keys(source.filter(F.col(partition).isin(*names)), key, values)
    kept.write.mode("errorifexists").parquet(staging)
    aside = spark.read.parquet(staging)
    filled = {r[0] for r in aside.select(partition).distinct().collect()}
    overwrite_partitions(aside, table)
    for name in names:
        if name not in filled:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition}='{name}')")
    return names


def erasure_proof(tables: dict[str, DataFrame], key: dict[str, str], values: DataFrame, value_column: str) -> DataFrame:
    """Rows that still hold one of the keys, per table."""
    parts = []
    for name, df in tables.items():
        wanted = values.select(F.col(value_column).alias(key[name]))
        parts.append(
            df.join(wanted, key[name], "left_semi").agg(F.count(F.lit(1)).alias("remaining_rows"))
            .select(F.lit(name).alias("table_name"), "remaining_rows")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def public_view(df: DataFrame, hidden: Sequence[str], condition: Column | None = None) -> DataFrame:
    """The publishable columns and rows of a table."""
    return (df if condition is None else df.filter(condition)).drop(*hidden)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def add_columns(spark: SparkSession, table: str, incoming: DataFrame) -> list[str]:
    """Additive schema change: columns the table lacks are added; nothing is dropped or retyped."""
    have = set(spark.table(table).columns)
    new = [f for f in incoming.schema.fields if f.name not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def run_layers(df: DataFrame, layers: dict[str, Callable[[DataFrame], DataFrame]], database: str) -> DataFrame:
    """Layered lake: each layer is written as a table and read back as the input of the next."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, step in layers.items():
        replace(step(df), f"{database}.{name}")
        df = spark.table(f"{database}.{name}")
    return df


def materialize(df: DataFrame, name: str, how: str) -> DataFrame:
    """As a view, a table, or not at all (ephemeral)."""
    if how == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if how == "table":
        replace(df, name)
        return df.sparkSession.table(name)
    if how == "ephemeral":
        return df
    raise ValueError(f"unknown materialization {how}")


def split_once(judged: DataFrame, ok: Column, path: str) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows of one run: the judged rows are written once, and each side reads its own folder. What judges is so evaluated
    once, however many outputs follow, and a lost executor costs files and not the run."""
    spark = judged.sparkSession
    judged.withColumn("wf_ok", ok).write.mode("overwrite").partitionBy("wf_ok").parquet(path)
    rows = spark.read.schema(T.StructType([*judged.schema.fields, T.StructField("wf_ok", T.BooleanType())])).parquet(path)
    return rows.filter("wf_ok").drop("wf_ok"), rows.filter("not wf_ok").drop("wf_ok")


def dead_letter(bad: DataFrame, run_ts: Column, path: str, mode: str = "append") -> None:
    """Rejected rows as JSON text with their errors and the time."""
    data = [c for c in bad.columns if c != "errors"]
    bad.select(
        F.to_json(F.struct(*data)).alias("record"), F.to_json("errors").alias("errors"), run_ts.alias("error_timestamp")
    ).write.mode(mode).parquet(path)
