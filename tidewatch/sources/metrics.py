"""Daily metric series from event-grain tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL_SEGMENT = "all"


@dataclass(frozen=True)
class Measure:
    """A daily metric: the sum of an amount, the number of rows, or the mean of an amount.

    Amounts are summed as they are, decimals as decimals and doubles as doubles. With a ``scale`` they
    are rounded to that many decimal places first and summed exactly, so the result does not depend on
    the order of summation; NaN, infinite and very large amounts are then added as doubles.
    """

    kind: str
    column: str | None = None
    scale: int | None = None


def total(column: str, scale: int | None = None) -> Measure:
    return Measure("total", column, scale)


def rows() -> Measure:
    return Measure("rows")


def mean(column: str, scale: int | None = None) -> Measure:
    return Measure("mean", column, scale)


def daily_metrics(
    df: DataFrame,
    date: str,
    segment: str,
    measures: Mapping[str, Measure],
    total_segment: str | None = TOTAL_SEGMENT,
) -> DataFrame:
    """Aggregate rows to the long metric layout: ``metric_date, metric_name, metric_value, segment``.

    Rows are reduced to one per (date, segment) first, with map-side partial aggregation, so a busy
    date or segment costs no more shuffle than a quiet one. The total segment is rolled up from that
    small result, not from the rows. A segment of the data that is named like the total is an error.
    """
    parts = _partial_columns(measures.values())
    name = F.col(segment).cast("string")
    if total_segment is not None:
        clash = f"a segment is named {total_segment!r} like the total; give total_segment another name"
        name = F.when(name == total_segment, F.raise_error(F.lit(clash)).cast("string")).otherwise(name)
    by_segment = df.groupBy(F.col(date).cast("date").alias("metric_date"), name.alias("segment")).agg(*(column.alias(name) for name, column in parts.items()))
    if total_segment is not None:
        merged = [F.sum(name).alias(name) for name in parts]  # counts and whole-number sums
        by_segment = (
            by_segment.select(
                "metric_date", F.explode(F.array("segment", F.lit(total_segment))).alias("segment"),
                *parts,
            )
            .groupBy("metric_date", "segment")
            .agg(*merged)
        )
    wide = by_segment.select(
        "metric_date", "segment", *(_finish(m).alias(name) for name, m in measures.items())
    )
    return wide.unpivot(
        ["metric_date", "segment"], list(measures), "metric_name", "metric_value"
    ).select("metric_date", "metric_name", "metric_value", "segment")


# Sums are kept as whole numbers of the smallest decimal place, in a high and a low part, because
# adding longs is several times faster than adding decimals and the parts cannot overflow.
LOW_BITS = 24


def _units(m: Measure) -> tuple[Column, Column]:
    """The amount in units of the smallest decimal place, rounded half away from zero, null if a
    long can't hold it; and the amount itself where that is so."""
    amount = F.col(m.column).cast("double")
    scaled = F.abs(amount) * 10**m.scale + 0.5
    fits = ~F.isnan(amount) & (scaled < 2.0**63)
    size = F.when(fits, scaled).cast("long")
    return F.when(amount < 0, -size).otherwise(size), F.when(~fits, amount)


def _names(m: Measure) -> tuple[str, ...]:
    parts = ("sum", "n") if m.scale is None else ("high", "low", "rest", "n")
    return tuple(f"__{part}_{m.column}_{m.scale}" for part in parts)


def _partial_columns(measures: Iterable[Measure]) -> dict[str, Column]:
    parts: dict[str, Column] = {}
    for m in measures:
        if m.kind == "rows":
            parts["__rows"] = F.count(F.lit(1))
        elif m.kind in ("total", "mean"):
            if m.scale is None:
                sums, n = _names(m)
                parts[sums] = F.sum(m.column)
                if m.kind == "mean":
                    parts[n] = F.count(m.column)
                continue
            high, low, rest, n = _names(m)
            units, other = _units(m)
            parts[rest] = F.sum(other)
            parts[high] = F.sum(F.shiftright(units, LOW_BITS))
            parts[low] = F.sum(units.bitwiseAND(F.lit(2**LOW_BITS - 1).cast("long")))
            if m.kind == "mean":
                parts[n] = F.count(m.column)
        else:
            raise ValueError(f"unknown measure {m.kind!r}")
    return parts


def _finish(m: Measure) -> Column:
    if m.kind == "rows":
        return F.col("__rows").cast("double")
    if m.scale is None:
        sums, n = _names(m)
        amount = F.col(sums).cast("double")
    else:
        high, low, rest, n = _names(m)
        units = F.col(high).cast("decimal(20,0)") * 2**LOW_BITS + F.col(low)
        exact = (units.cast("decimal(28,0)") / 10**m.scale).cast("double")
        amount = F.when(F.col(rest).isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + F.col(rest))
    if m.kind == "total":
        return amount
    return amount / F.nullif(F.col(n).cast("double"), F.lit(0.0))
