"""Numeric column functions: money output, percentages, tolerant coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column, scale: int = 2) -> Column:
    """ROUND on the exact (decimal) value, then DOUBLE for output."""
    return F.round(c, scale).cast("double")


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """ROUND(100 * part / whole, scale) in double; NULL when whole is 0.

    ``try_divide`` keeps ANSI mode on while matching SQL's NULL on a zero divisor.
    """
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), scale)


def finite_double(c: Column) -> Column:
    """Text or number to DOUBLE; unparseable, NaN and +-inf become NULL."""
    d = c.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(d)


def coerce_long(c: Column, default: int | None = None) -> Column:
    """``pd.to_numeric(errors='coerce').fillna(default).astype(int64)`` (F5):
    parse as a number, truncate toward zero, NULL -> ``default``."""
    v = finite_double(c).try_cast("bigint")
    return v if default is None else F.coalesce(v, F.lit(default).cast("bigint"))


def integral_long(c: Column) -> Column:
    """A numeric text that is a whole number ('42', '42.0') as BIGINT, else NULL."""
    d = finite_double(c)
    return F.when(d == F.floor(d), d.try_cast("bigint"))
