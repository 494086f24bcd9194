"""Class scales: a value mapped to a name by ordered limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Scale = Sequence[tuple[float | None, str]]


def _chain(column, scale: Scale, test, values=None) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    out = None
    for i, (limit, name) in enumerate(scale):
        value = F.lit(name if values is None else values[i])
        if limit is None:
            return out.otherwise(value) if out is not None else value
        out = (F if out is None else out).when(test(c, limit), value)
    return out


def at_least(column, scale: Scale) -> Column:
    return _chain(column, scale, lambda c, limit: c >= limit)


def above(column, scale: Scale) -> Column:
    return _chain(column, scale, lambda c, limit: c > limit)


def up_to(column, scale: Scale) -> Column:
    return _chain(column, scale, lambda c, limit: c <= limit)


def below(column, scale: Scale) -> Column:
    return _chain(column, scale, lambda c, limit: c < limit)


def rank_in(column, scale: Scale) -> Column:
    """1 for the first class of an ``at_least`` scale, 2 for the next, and so on."""
    return _chain(column, scale, lambda c, limit: c >= limit, list(range(1, len(scale) + 1)))


def sql_case(column: str, scale: Scale, op: str) -> str:
    """The same scale as SQL text."""
    arms = " ".join(f"WHEN {column} {op} {limit} THEN '{name}'" for limit, name in scale if limit is not None)
    rest = [name for limit, name in scale if limit is None]
    return f"CASE {arms} ELSE '{rest[0]}' END" if rest else f"CASE {arms} END"
