"""Loan arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def monthly_payment(amount, annual_rate_pct, months) -> Column:
    """Amortised payment; without interest the amount spread evenly; NULL without a term."""
    p, r, n = _col(amount), _col(annual_rate_pct) / 1200, _col(months)
    growth = F.pow(1 + r, n)
    return F.when(n <= 0, None).when(r > 0, F.try_divide(p * r * growth, growth - 1)).otherwise(
        F.try_divide(p, n.cast("double"))
    )
