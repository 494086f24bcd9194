"""Data checks compiled to one aggregation: row checks share one scan, each uniqueness check adds one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named aggregate and the test its value has to pass."""

    name: str
    value: Column
    limit: float | None = None
    low: float | None = None
    distinct_of: tuple[str, ...] = ()

    def passed(self, value: Column) -> Column:
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.limit is not None:
            ok = ok & (value <= self.limit)
        return ok


def not_null(column: str) -> Check:
    return Check(f"not_null:{column}", F.count_if(F.col(column).isNull()), limit=0)


def between(column: str, low, high) -> Check:
    return Check(f"between:{column}", F.count_if(~F.col(column).between(low, high)), limit=0)


def in_set(column: str, values: Sequence) -> Check:
    return Check(f"in_set:{column}", F.count_if(~F.col(column).isin(*values)), limit=0)


def not_in_set(column: str, values: Sequence) -> Check:
    return Check(f"not_in_set:{column}", F.count_if(F.col(column).isin(*values)), limit=0)


def unique(*columns: str) -> Check:
    """Rows beyond the first of each key (keys with a NULL do not count).

    The distinct keys are counted in a subquery of its own: inside the shared aggregation all other
    checks would be carried along per key. It shuffles by the key values, so no group is hot.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return Check(f"unique:{','.join(columns)}", F.count_if(present), limit=0, distinct_of=columns)


def row_count(low: int, high: int) -> Check:
    return Check("row_count", F.count(F.lit(1)), low=low, limit=high)


def condition(name: str, holds: str | Column) -> Check:
    """Rows for which a condition does not hold."""
    holds = F.expr(holds) if isinstance(holds, str) else holds
    return Check(name, F.count_if(~F.coalesce(holds, F.lit(False))), limit=0)


def run(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, value, passed."""
    values = df.agg(*[c.value.cast("bigint").alias(f"c{i}") for i, c in enumerate(checks)])
    for i, c in enumerate(checks):
        if c.distinct_of:
            keys = df.select(*c.distinct_of).dropna().distinct().agg(F.count(F.lit(1)))
            values = values.withColumn(f"c{i}", F.col(f"c{i}") - keys.scalar())
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("check_value"), c.passed(F.col(f"c{i}")).alias("passed"))
        for i, c in enumerate(checks)
    ])
    return values.select(F.inline(rows))


def require(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run the checks and raise with the failed ones; returns the results."""
    results = run(df, checks)
    failed = [r.check_name for r in results.filter(~F.col("passed")).collect()]  # one row per check
    if failed:
        raise ValueError(f"failed checks: {', '.join(failed)}")
    return results


def route(df: DataFrame, checks: Sequence[Check]) -> str:
    """'passed' or 'failed', for a caller that branches on quality."""
    return "failed" if run(df, checks).filter(~F.col("passed")).limit(1).count() else "passed"
