"""Staging and rolling statistics of metric series (one row per date, metric and segment)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.numeric import day_of_week, is_weekend
from tidewatch.operators.frames import (
    drop_carried,
    split_copies,
    with_carried_rows,
)

SERIES = ("metric_name", "segment")


def stage_metrics(
    df: DataFrame,
    date: str = "metric_date",
    name: str = "metric_name",
    value: str = "metric_value",
    segment: str = "segment",
) -> DataFrame:
    """Cast raw observations to the metric layout and add weekday attributes."""
    day = F.col(date).cast("date")
    return df.select(
        day.alias("metric_date"),
        F.col(name).cast("string").alias("metric_name"),
        F.col(value).cast("double").alias("metric_value"),
        F.col(segment).cast("string").alias("segment"),
        day_of_week(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
    )


def rolling_stats(
    df: DataFrame,
    value: str = "metric_value",
    order: str = "metric_date",
    keys: Sequence[str] = SERIES,
    window: int = 14,
    min_rows: int = 7,
    baseline: str = "inclusive",
    chunk: str | None = None,
    chunk_rows: int | None = None,
    copies: str = "separate",
) -> DataFrame:
    """Mean, standard deviation, row count and z-score over the last ``window`` rows of a series.

    The frame counts rows, not days, so it reaches further back over missing dates.

    ``baseline="inclusive"``: the frame ends at the current row and uses the sample deviation; z is
    NULL without variation or with fewer than ``min_rows`` rows. ``baseline="prior"``: the frame is
    the ``window`` rows before the current one and uses the population deviation; z is 0 without
    variation, and rows with a shorter history are left out.

    A series at daily grain is small (ten years are 3,650 rows), so one window group per series is
    what you want; ``daily_metrics`` gives that grain. For other tables there are two ways to keep
    the groups small, with the same result: ``chunk`` ("month", "year", ...) cuts each series into
    calendar chunks that are windowed in parallel, with ``chunk_rows`` also single dates with more
    rows than that; and ``copies="merged"`` counts equal rows before the shuffle instead of sending
    each of them to the task of its series.
    """
    avg, std, n = (f"rolling_{window}d_{s}" for s in ("avg", "stddev", "count"))
    if baseline not in ("inclusive", "prior"):
        raise ValueError(f"unknown baseline {baseline!r}")
    if copies not in ("separate", "merged"):
        raise ValueError(f"unknown treatment of copies {copies!r}")
    prior = baseline == "prior"
    reach = window if prior else window - 1

    if copies == "merged":
        df, further = split_copies(df, reach)
    groups = list(keys)
    if chunk:
        df, chunk_column = with_carried_rows(
            df, keys, order, value, chunk, reach, chunk_rows
        )
        groups.append(chunk_column)
    # the value breaks ties, so that repeated dates give the same frames on every run
    series = Window.partitionBy(*groups).orderBy(order, value)
    v = F.col(value)

    if prior:
        frame = series.rowsBetween(-window, -1)
        rolled = df.withColumns(
            {avg: F.avg(v).over(frame), std: F.stddev_pop(v).over(frame),
             n: F.count(F.lit(1)).over(frame)}
        ).where(F.col(n) == window)
        z = F.when(F.col(std) > 0, (v - F.col(avg)) / F.col(std)).otherwise(F.lit(0.0))
    else:
        frame = series.rowsBetween(-(window - 1), 0)
        rolled = df.withColumns(
            {avg: F.avg(v).over(frame), std: F.stddev_samp(v).over(frame),
             n: F.count(F.lit(1)).over(frame)}
        )
        z = F.when((F.col(std) > 0) & (F.col(n) >= min_rows), (v - F.col(avg)) / F.col(std))

    if chunk:
        rolled = drop_carried(rolled)
    if copies == "merged":
        # a frame of equal values: their mean, no deviation
        known = {avg: v, std: F.when(v.isNotNull(), F.lit(0.0)), n: F.lit(window).cast("long")}
        rolled = rolled.unionByName(further.withColumns(known))
    return rolled.withColumn("z_score", z)
