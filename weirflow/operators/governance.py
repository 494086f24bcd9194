"""Personal data: finding, masking, tokens, row and column policies, key-based erasure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions import text
from weirflow.functions.fixed import PII_PATTERNS
from weirflow.functions.keys import token
from weirflow.plans.joins import join_dimension


def pii_scan(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """Matches and rows with a match per column and kind, in one pass over whole texts."""
    measures, rows = [], []
    for c in columns:
        for kind, pattern in patterns.items():
            hits = F.coalesce(F.regexp_count(F.col(c), F.lit(pattern)), F.lit(0))
            name = f"{c}__{kind}"
            measures += [F.sum(hits).cast("bigint").alias(f"{name}_m"), F.count_if(hits > 0).alias(f"{name}_r")]
            rows.append(F.struct(
                F.lit(c).alias("column_name"), F.lit(kind).alias("info_type"),
                F.coalesce(F.col(f"{name}_m"), F.lit(0).cast("bigint")).alias("matches"), F.col(f"{name}_r").alias("rows_with_match")))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def mask_columns(df: DataFrame, columns: Sequence[str], first: int = 5) -> DataFrame:
    return df.withColumns({c: text.masked(c, first) for c in columns})


def tokenize(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace values by irreversible tokens; equal values keep equal tokens, so joins still work."""
    return df.withColumns({c: token(c, salt) for c in columns})


def row_policy(df: DataFrame, column: str, grants: DataFrame, group: str) -> DataFrame:
    """The rows whose value a group may see; ``grants`` has columns ``group_name`` and the filtered one."""
    allowed = grants.filter(F.col("group_name") == group).select(column).distinct()
    return join_dimension(df, allowed, [column], "left_semi")


def column_policy(df: DataFrame, tags: Mapping[str, str], cleared: Sequence[str], masked: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose tag the reader is not cleared for, or mask them where the tag says so."""
    out = df
    for c, tag in tags.items():
        if tag in cleared:
            continue
        out = out.withColumn(c, text.masked(F.col(c).cast("string"))) if tag in masked else out.drop(c)
    return out


class KeyVault:
    """A stored table of one random key per owner. Keys are drawn once, from the system's random source, and cannot be made again: a key
    that is destroyed takes all values sealed with it along, in whatever copies they stand."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 16):
        from weirflow.sources.versions import VersionedTable

        self.table, self.key, self.buckets = VersionedTable(spark, path), key, buckets

    def ensure(self, owners: DataFrame) -> None:
        """Draw keys for the owners that have none. What a failed or repeated task drew is not in the table, so a key is drawn once."""
        wanted = owners.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        drawn = wanted.mapInArrow(_draw, f"{self.key} {owners.schema[self.key].dataType.simpleString()}, secret binary")
        if not self.table._versions():
            self.table.create(drawn.limit(0), [self.key], self.buckets)
        self.table.change(wanted, lambda part, new: part.unionByName(new.join(part, self.key, "left_anti").mapInArrow(_draw, drawn.schema)))

    def destroy(self, owners: DataFrame) -> None:
        """Remove the owners' keys from the newest version and delete all others. No other writer may be at work."""
        gone = owners.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        self.table.change(gone, lambda part, delta: part.join(delta, self.key, "left_anti"))
        self.table.forget()

    def keys(self) -> DataFrame:
        return self.table.read()


def _draw(batches):
    import secrets

    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([secrets.token_bytes(32) for _ in range(len(batch))], pa.binary())], [batch.schema.names[0], "secret"])


def encrypt_with_keys(df: DataFrame, keys: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Encrypt columns with the key of their owner; destroying a key makes its rows unreadable."""
    joined = df.join(keys.select(key, "secret"), key, "left")
    sealed = {c: F.base64(F.aes_encrypt(F.col(c).cast("string").cast("binary"), F.col("secret"))) for c in columns}
    return joined.withColumns(sealed).drop("secret")


def decrypt_with_keys(df: DataFrame, keys: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Decrypt what still has a key; the rest becomes NULL."""
    joined = df.join(keys.select(key, "secret"), key, "left")
    opened = {c: F.try_aes_decrypt(F.unbase64(F.col(c)), F.col("secret")).cast("string") for c in columns}
    return joined.withColumns(opened).drop("secret")


def recent_access(df: DataFrame, ts: str, as_of: Column, days: int = 7) -> DataFrame:
    """Accesses of the last days, newest first."""
    since = as_of - F.make_dt_interval(F.lit(days))
    return df.filter((F.col(ts) >= since) & (F.col(ts) <= as_of)).orderBy(F.desc(ts))


def data_map(spark: SparkSession, database: str, column: str) -> DataFrame:
    """Tables of a database that have a column: where to look when a key must be erased."""
    found = [
        (t.name,) for t in spark.catalog.listTables(database)
        if not t.isTemporary and column in spark.table(f"{database}.{t.name}").columns
    ]
    return spark.createDataFrame(found, "table_name string")
