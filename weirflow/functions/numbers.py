"""Numeric helpers that give the same text of digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact amount with two decimals."""
    return _col(c).cast("decimal(18,2)")


def money_sum(c) -> Column:
    """Sum of amounts in exact decimals, as a double: the result does not depend on row order."""
    return F.sum(money(c)).cast("double")


def money_avg(c) -> Column:
    """Exact sum over count, rounded to two decimals; NULL for an empty group."""
    return rounded(F.try_divide(F.sum(money(c)).cast("double"), F.count(money(c)).cast("double")))


def exact_avg(c) -> Column:
    """Mean of measurements with up to six decimals, summed exactly, rounded to two."""
    c = _col(c)
    return rounded(F.try_divide(F.sum(c.cast("decimal(18,6)")).cast("double"), F.count(c).cast("double")))


def rounded(c, places: int = 2) -> Column:
    """Half-up rounding through a decimal, since doubles round differently from engine to engine."""
    return F.round(_col(c).cast("decimal(20,6)"), places).cast("double")


def ratio(top, bottom) -> Column:
    """Double division with NULL for a zero divisor."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def pct(top, bottom, places: int = 2) -> Column:
    return rounded(ratio(top, bottom) * 100, places)
