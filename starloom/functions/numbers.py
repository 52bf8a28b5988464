"""Rounding, safe ratios and exact money arithmetic.

Money is summed as DECIMAL, so the total does not depend on the order in which
partitions are merged, and turned into DOUBLE only at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
_ROUNDING = "decimal(28,6)"


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value, digits: int) -> Column:
    """Round a number through DECIMAL, so ties never depend on binary representation."""
    return F.round(as_column(value).cast(_ROUNDING), digits).cast("double")


def money(value) -> Column:
    """A DOUBLE amount as DECIMAL(12,2), rounded half up."""
    return F.round(as_column(value).cast(_ROUNDING), 2).cast(MONEY)


def sum_money(value) -> Column:
    """Exact sum of a DECIMAL column, as DOUBLE."""
    return F.sum(as_column(value)).cast("double")


def avg_exact(value, scale: int = 6) -> Column:
    """Mean from an exact DECIMAL sum; independent of the merge order of partial sums."""
    col = as_column(value)
    return F.sum(col.cast(f"decimal(28,{scale})")).cast("double") / F.count(col)


def safe_ratio(numerator, denominator, scale: float = 1.0) -> Column:
    """numerator / denominator * scale in DOUBLE, NULL where the denominator is 0."""
    num = as_column(numerator).cast("double")
    den = as_column(denominator).cast("double")
    return num / F.nullif(den, F.lit(0.0)) * F.lit(float(scale))


def percent(numerator, denominator, digits: int = 2) -> Column:
    return round_half_up(safe_ratio(numerator, denominator, 100.0), digits)


def clamp(value, low: float | None = None, high: float | None = None) -> Column:
    col = as_column(value)
    if low is not None:
        col = F.greatest(F.lit(float(low)), col)
    if high is not None:
        col = F.least(F.lit(float(high)), col)
    return col


def truncate_to_int(value) -> Column:
    return as_column(value).cast("bigint")
