"""Exact percentiles by counting, without gathering a group's values in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.plans.segments import Cuts, plan_cuts, running_window


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: Mapping[str, float],
    *,
    segments: int | None = None,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Linear-interpolated percentiles per key, one output column per entry of ``percentiles``.

    Equal values are counted before the shuffle; a segmented running count then finds the values at
    the two neighbouring ranks, which plain aggregates pick out. NULL values are ignored.
    """
    present = df.select(*keys, value).filter(F.col(value).isNotNull())
    counted = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_window(
        counted, keys, [value], {"__upto": ("sum", "__n"), "__total": ("total_sum", "__n")},
        cuts=cuts if cuts is not None else plan_cuts(present, value, segments, keys=keys),
    )
    number = F.col(value).cast("double")
    picks = []
    for name, p in percentiles.items():
        place = F.lit(float(p)) * (F.col("__total") - 1)
        picks.append(F.min(F.when(F.col("__upto") > F.floor(place), number)).alias(f"__lo_{name}"))
        picks.append(F.min(F.when(F.col("__upto") > F.ceil(place), number)).alias(f"__hi_{name}"))
    found = ranked.groupBy(*keys).agg(F.max("__total").alias("__total"), *picks)
    out = []
    for name, p in percentiles.items():
        place = F.lit(float(p)) * (F.col("__total") - 1)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, *out)


def ntile_of(row_number, total, tiles: int):
    """NTILE from a row number and a group size: the first ``total % tiles`` tiles get one row more."""
    base = F.floor(total / tiles)
    extra = total - base * tiles
    big_rows = extra * (base + 1)
    in_big = F.ceil(row_number / (base + 1))
    in_small = extra + F.ceil((row_number - big_rows) / F.greatest(base, F.lit(1)))
    return F.when(row_number <= big_rows, in_big).otherwise(in_small).cast("bigint")


__all__ = ["exact_percentiles", "ntile_of"]
