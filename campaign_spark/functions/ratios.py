"""Efficiency ratios: always a ratio of sums, zero denominator -> NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from campaign_spark.fixed import RATIOS  # output -> (numerator, denominator)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE; NULL when ``den`` is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def to_units(c: str | Column, scale: int) -> Column:
    """A money-like DOUBLE as an exact integer count of 10^-scale units.

    Raises on a value with more decimals: nothing is rounded away. NaN is missing."""
    value = F.when(~F.isnan(_col(c)), _col(c))
    units = F.round(value * F.lit(10.0 ** scale)).cast("long")
    fits = value.isNull() | (from_units(units, scale) == value)
    return F.when(fits, units).otherwise(
        F.raise_error(F.concat(F.lit(f"not a multiple of 10^-{scale}: "), value.cast("string"))).cast("long"))


def from_units(units: str | Column, scale: int) -> Column:
    """Integer units back to a DOUBLE amount (correctly rounded quotient)."""
    return _col(units).cast("double") / F.lit(10.0 ** scale)


def exact_sum(c: str | Column, scale: int) -> Column:
    """Sum a money-like DOUBLE exactly and independently of row order: the
    values are added as integer units (BIGINT; ANSI mode raises on overflow
    instead of wrapping), then returned as DOUBLE. Same result as summing
    DECIMAL(18, scale) values, at the cost of a long sum. 0.0 if all NULL."""
    return F.coalesce(from_units(F.sum(to_units(c, scale)), scale), F.lit(0.0))
