"""Numeric and calendar column helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Doubles are rounded through this type, so that 1.005 rounds to 1.01 and a last-bit
# difference between two summation orders does not flip a half case.
ROUNDING_TYPE = "decimal(28,8)"


def round_half_up(x: Column, digits: int) -> Column:
    """Round half away from zero; values too large for the decimal fall back to double rounding."""
    return F.coalesce(
        F.round(x.try_cast(ROUNDING_TYPE), digits).cast("double"), F.round(x, digits)
    )


def percent_change(value: Column, base: Column, digits: int = 2) -> Column:
    """``(value - base) / base`` in percent; NULL where the base is zero."""
    ratio = (value - base) / F.nullif(base, F.lit(0.0))
    return round_half_up(ratio * 100, digits)


def day_of_week(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    """True on Saturday and Sunday, false otherwise (also for a NULL date)."""
    return F.coalesce(day_of_week(d).isin(0, 6), F.lit(False))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, both read as wall-clock time (no time zone)."""
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return F.floor(span.cast("interval second").cast("decimal(20,6)")).cast("long")


def wall_clock(moment: dt.datetime | Column) -> Column:
    """A moment without time zone. A plain literal would go through the session's zone."""
    if isinstance(moment, dt.datetime):
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(moment).cast("timestamp_ntz")
