"""Relational helpers that are more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.keys import joined_fields
from weirflow.plans.dedup import latest_per_key
from weirflow.plans.segments import frame_window


def with_calendar(df: DataFrame, keys: Sequence[str], days: Column, out: str) -> DataFrame:
    """Every distinct key with every day of an array."""
    return df.select(*keys).distinct().withColumn(out, F.explode(days))


def map_lookup(column: str, mapping: Mapping, default: str = "Unknown") -> Column:
    """Look a value up in a short constant map."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.col(column)), F.lit(default))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, out: str, count_out: str) -> DataFrame:
    """Most frequent value per key; the smallest one on a tie."""
    counts = df.groupBy(*keys, F.col(value).alias(out)).agg(F.count(F.lit(1)).alias(count_out))
    return latest_per_key(counts, keys, [f"-{count_out}", out])


def batch_and_realtime(batch: DataFrame, realtime: DataFrame, day: str, today: str) -> DataFrame:
    """Serving view: finished days from the batch layer, today from the realtime layer."""
    cut = F.lit(today).cast("date")
    return batch.filter(F.col(day) < cut).unionByName(realtime.filter(F.col(day) >= cut))


def missing_partitions(source: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """Partition values of the source that the target does not have yet."""
    return source.select(column).distinct().join(loaded.select(column).distinct(), column, "left_anti")


@dataclass(frozen=True)
class Vault:
    hub: DataFrame
    link: DataFrame
    satellite: DataFrame


def _hash(*columns: str) -> Column:
    return F.md5(joined_fields(columns).cast("binary"))


def vault_split(
    df: DataFrame, business_key: str, related_key: str, attributes: Sequence[str], load_date: str,
    pick: Sequence[str],
) -> Vault:
    """Hub of keys, link to the related keys, and a satellite with one row per change of the attributes.

    Of several rows of a key on one load date the first in the ``pick`` order counts.
    """
    hub = df.select(_hash(business_key).alias("hk"), business_key).distinct()
    link = df.select(_hash(business_key).alias("hk"), _hash(related_key).alias("hk2")).distinct()
    daily = latest_per_key(df, [business_key, load_date], pick).select(
        business_key, load_date, _hash(*attributes).alias("hashdiff"), *attributes
    )
    seen = frame_window(daily, [business_key], [load_date], {"__prev": lambda w: F.lag("hashdiff").over(w)}, before=1)
    satellite = seen.filter(F.col("__prev").isNull() | (F.col("__prev") != F.col("hashdiff"))).select(
        _hash(business_key).alias("hk"), "hashdiff", load_date, *attributes
    )
    return Vault(hub, link, satellite)
