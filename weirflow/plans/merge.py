"""MERGE as joins: each function returns the new content of the target.

Parquet tables have no MERGE, so a caller writes the result to a new place, over the affected partitions (``sources.tables``), or as a
new version in which only the buckets of the delta are read and rewritten (``sources.versions``). The source must have one row per key
(``plans.dedup.latest_per_key`` makes it so); ``checked`` adds that check to the plan, and a repeated key fails the query instead of
multiplying rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def require_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when a key occurs twice: a merge would not know which row wins."""
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise ValueError(f"more than one source row per key {list(keys)}")
    return df


def checked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of a merge source; a key that occurs twice raises when the query runs. The window shuffles by the key that the merge
    joins on, so nothing is shuffled twice."""
    again = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))) > 1
    message = F.concat(F.lit(f"more than one source row per key {list(keys)}: "), F.to_json(F.struct(*keys)))
    ok = df.withColumn("__again", F.when(again, F.raise_error(message)).otherwise(F.lit(True)))
    return ok.filter("__again").drop("__again")


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with the rows of both sides as structs ``t`` and ``s``."""
    source = checked(source, keys)
    left = target.select(*keys, F.struct(*target.columns).alias("t"))
    right = source.select(*keys, F.struct(*source.columns).alias("s"))
    return left.join(right, list(keys), "full_outer")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None) -> DataFrame:
    """Matched rows take the source's values (of ``update``, by default of all columns), new rows are added."""
    replaced = set(update if update is not None else target.columns)
    in_source = F.col("s").isNotNull()
    in_target = F.col("t").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in replaced:
            out.append(F.when(in_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return _sides(target, source, keys).select(*out)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add source rows whose key the target does not have."""
    return target.unionByName(source.join(target.select(*keys), list(keys), "left_anti"))


def apply_changes(
    target: DataFrame, feed: DataFrame, key: str, attributes: Sequence[str], op: str = "op_type", at: str = "event_time"
) -> DataFrame:
    """Change feed with INSERT, UPDATE and DELETE: deletes only mark the row; unmatched UPDATEs and DELETEs do nothing.

    The target has the attributes and created_at, updated_at, is_deleted.
    """
    joined = _sides(target, feed, [key])
    kind = F.col(f"s.{op}")
    matched = F.col("t").isNotNull()
    updated, deleted = matched & (kind == "UPDATE"), matched & (kind == "DELETE")
    inserted = ~matched & (kind == "INSERT")
    values = [
        F.when(updated | inserted, F.col(f"s.{a}")).otherwise(F.col(f"t.{a}")).alias(a) for a in attributes
    ]
    return joined.filter(matched | inserted).select(
        key, *values,
        F.when(inserted, F.col(f"s.{at}")).otherwise(F.col("t.created_at")).alias("created_at"),
        F.when(updated | deleted | inserted, F.col(f"s.{at}")).otherwise(F.col("t.updated_at")).alias("updated_at"),
        F.when(inserted, F.lit(False)).when(deleted, F.lit(True)).otherwise(F.col("t.is_deleted")).alias("is_deleted"),
    )


def scd2_merge(
    dimension: DataFrame, delta: DataFrame, key: str, as_of: Column, start: str = "start_date", end: str = "end_date",
    flag: str = "is_current", only_changed: Sequence[str] | None = None,
) -> DataFrame:
    """Close the current row of every key in the delta and add the delta's row as the new current one.

    With ``only_changed`` keys whose columns are all equal (NULL equal to NULL) stay as they are.
    """
    if only_changed is not None:
        current = dimension.filter(F.col(flag)).select(key, F.struct(*only_changed).alias("__now"))
        delta = (
            delta.join(current, key, "left")
            .filter(F.col("__now").isNull() | ~F.col("__now").eqNullSafe(F.struct(*only_changed)))
            .drop("__now")
        )
    touched = delta.select(key, F.lit(True).alias("__touched"))
    closing = F.col(flag) & F.col("__touched").isNotNull()
    kept = dimension.join(touched, key, "left").withColumns({
        end: F.when(closing, as_of).otherwise(F.col(end)),
        flag: F.when(closing, F.lit(False)).otherwise(F.col(flag)),
    }).drop("__touched")
    end_type = dimension.schema[end].dataType
    added = delta.withColumns({start: as_of, end: F.lit(None).cast(end_type), flag: F.lit(True)})
    return kept.unionByName(added.select(*kept.columns))


def scd3(dimension: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """Current and previous value side by side."""
    new = changes.select(key, F.col(column).alias("__new"))
    changed = F.col("__new").isNotNull()
    return dimension.join(new, key, "left").withColumns({
        f"previous_{column}": F.when(changed, F.col(column)),
        column: F.coalesce(F.col("__new"), F.col(column)),
    }).drop("__new")


def snapshot(
    history: DataFrame, source: DataFrame, key: str, as_of: Column, *, check: Sequence[str] | None = None,
    updated_at: str | None = None, close_deleted: bool = True,
) -> DataFrame:
    """Next state of a versioned snapshot with ``scd_id, valid_from, valid_to`` (NULL = open).

    A row is new when a checked column differs (NULL-safe), or when its ``updated_at`` is later than that
    of the open version. Keys gone from the source are closed.
    """
    if (check is None) == (updated_at is None):
        raise ValueError("give either the columns to check or the update time column")
    old = history.filter(F.col("valid_to").isNotNull())
    live = history.filter(F.col("valid_to").isNull())
    joined = _sides(live, source, [key])
    has_t, has_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    if check is not None:
        differs = ~F.struct(*[F.col(f"t.{c}") for c in check]).eqNullSafe(F.struct(*[F.col(f"s.{c}") for c in check]))
    else:
        differs = F.col(f"s.{updated_at}") > F.col(f"t.{updated_at}")
    fresh = has_s & (~has_t | differs)
    ends = has_t & ((has_s & differs) | (~has_s if close_deleted else F.lit(False)))
    begins = F.col(f"s.{updated_at}") if updated_at else as_of
    data = list(source.columns)
    staged = joined.select("t", "s", fresh.alias("__fresh"), ends.alias("__ends"), begins.alias("__begins"), key)
    kept = staged.filter(F.col("t").isNotNull()).select(
        *[F.col(f"t.{c}").alias(c) for c in data], F.col("t.scd_id").alias("scd_id"), F.col("t.valid_from").alias("valid_from"),
        F.when(F.col("__ends"), F.coalesce("__begins", as_of)).alias("valid_to"),
    )
    added = staged.filter("__fresh").select(
        *[F.col(f"s.{c}").alias(c) for c in data],
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("__begins").cast("string")).cast("binary")).alias("scd_id"),
        F.col("__begins").alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"),
    )
    order = [*data, "scd_id", "valid_from", "valid_to"]
    return old.select(*order).unionByName(kept.select(*order)).unionByName(added.select(*order))


def open_snapshot(source: DataFrame, key: str, valid_from: Column) -> DataFrame:
    """First state of a snapshot: every row open."""
    return source.withColumns({
        "scd_id": F.md5(F.concat_ws("|", F.col(key).cast("string"), valid_from.cast("string")).cast("binary")),
        "valid_from": valid_from, "valid_to": F.lit(None).cast("date"),
    })


def snapshot_asof(history: DataFrame, day: Column) -> DataFrame:
    """The rows valid on a day; the first and the last day of a version both count."""
    return history.filter((F.col("valid_from") <= day) & (day <= F.coalesce("valid_to", F.lit(OPEN_END).cast("date"))))


def rows_after_max(source: DataFrame, target: DataFrame, column: str, lookback_days: int = 0) -> DataFrame:
    """Source rows later than the target's latest value; all rows when the target is empty.

    The maximum is a scalar subquery: it is computed in the same job and becomes a plain comparison.
    """
    latest = target.agg(F.max(column)).scalar()
    if lookback_days:
        return source.filter(latest.isNull() | (F.col(column) >= F.date_sub(latest, lookback_days)))
    return source.filter(latest.isNull() | (F.col(column) > latest))


def incremental_append(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    return target.unionByName(rows_after_max(source, target, column))


def incremental_lookback(
    target: DataFrame, source: DataFrame, keys: Sequence[str], day: str, order: Sequence[str], days: int = 3
) -> DataFrame:
    """Reprocess the last days (late rows), keep the latest row per key, merge."""
    from weirflow.plans.dedup import latest_per_key

    recent = rows_after_max(source, target, day, days)
    return upsert(target, latest_per_key(recent, keys, order), keys)


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove all target rows with a key of the source, then add the source (which may repeat keys)."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").unionByName(source)


def insert_overwrite(target: DataFrame, source: DataFrame, partition: str) -> DataFrame:
    """Replace whole partitions that occur in the source."""
    return delete_insert(target, source, [partition])


def refresh_aggregate(stored: DataFrame, new_rows: DataFrame, keys: Sequence[str], value: str, day: Mapping[str, Column] | None = None) -> DataFrame:
    """Bring a stored aggregate up to date from new rows only; the mean is kept as sum and count."""
    prepared = new_rows.withColumns(dict(day)) if day else new_rows
    partial = prepared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum(F.col(value).cast("decimal(18,2)")).cast("decimal(28,2)").alias("total_amount"))
    merged = stored.select(*keys, "txn_count", "total_amount").unionByName(partial)
    return merged.groupBy(*keys).agg(
        F.sum("txn_count").alias("txn_count"), F.sum("total_amount").cast("decimal(28,2)").alias("total_amount"))
