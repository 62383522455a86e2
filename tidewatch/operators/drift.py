"""Drift classification and alerts with context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.numeric import percent_change, round_half_up
from tidewatch.operators.frames import drop_carried, with_carried_rows
from tidewatch.operators.rolling import SERIES

# fixed values: smallest |z| of each severity, strongest first
SEVERITY_THRESHOLDS = ((3.0, "critical"), (2.0, "warning"), (1.5, "watch"))
SEVERITIES = tuple(name for _, name in SEVERITY_THRESHOLDS)

DRIFT_COLUMNS = (
    "metric_date", "metric_name", "segment", "metric_value", "rolling_14d_avg",
    "rolling_14d_stddev", "z_score", "is_weekend", "drift_severity", "drift_direction",
    "pct_deviation", "is_drift_alert",
)
ALERT_COLUMNS = (
    "metric_date", "metric_name", "segment", "metric_value", "rolling_14d_avg", "z_score",
    "drift_severity", "drift_direction", "pct_deviation", "is_weekend", "prev_day_value",
    "consecutive_alert_window", "day_over_day_pct_change",
)


def severity_of(z: Column, thresholds: Sequence[tuple[float, str]] = SEVERITY_THRESHOLDS) -> Column:
    """Name of the highest threshold that |z| reaches; ``normal`` below the lowest."""
    level = F.lit("normal")
    for bound, name in sorted(thresholds):
        level = F.when(F.abs(z) >= bound, F.lit(name)).otherwise(level)
    return level


def severity_rank(severity: Column, order: Sequence[str] = SEVERITIES) -> Column:
    """Position in ``order``; NULL for a name that is not in it."""
    rank = F.lit(None).cast("int")
    for position, name in enumerate(order):
        rank = F.when(severity == name, F.lit(position)).otherwise(rank)
    return rank


def classify_drift(
    df: DataFrame,
    thresholds: Sequence[tuple[float, str]] = SEVERITY_THRESHOLDS,
    average: str = "rolling_14d_avg",
    deviation: str = "rolling_14d_stddev",
) -> DataFrame:
    """Severity, direction and percent deviation of every row that has a z-score."""
    z = F.col("z_score")
    value = F.col("metric_value")
    return (
        df.where(z.isNotNull())
        .select(
            "metric_date", "metric_name", "segment", "metric_value", average, deviation,
            "z_score", "is_weekend",
            severity_of(z, thresholds).alias("drift_severity"),
            F.when(z > 0, "above").when(z < 0, "below").otherwise("on_target")
            .alias("drift_direction"),
            percent_change(value, F.col(average)).alias("pct_deviation"),
        )
        .withColumn("is_drift_alert", F.col("drift_severity") != "normal")
    )


def drift_alerts(
    drift: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "metric_date",
    context_rows: int = 3,
    context: str = "trailing",
    chunk: str | None = None,
    chunk_rows: int | None = None,
    average: str = "rolling_14d_avg",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Alert rows with the value of the previous *alert* of the series and the change against it.

    ``context="trailing"``: ``consecutive_alert_window`` is the number of alerts among the last
    ``context_rows`` alerts (at most ``context_rows``) and the change divides by the previous value.
    ``context="running"``: it is the number of the alert in its series, not capped, and the change
    divides by the absolute previous value. ``chunk`` and ``chunk_rows`` cut long series as in
    ``rolling_stats`` (trailing context only). ``keep`` names further columns to carry along.
    """
    alerts = drift.where("is_drift_alert").select(
        "metric_date", "metric_name", "segment", "metric_value", average, "z_score",
        "drift_severity", "drift_direction", "pct_deviation", "is_weekend", *keep,
    )
    if context not in ("trailing", "running"):
        raise ValueError(f"unknown context {context!r}")
    if chunk and context == "running":
        raise ValueError("a running alert number needs the whole series; leave chunk out")

    groups = list(keys)
    if chunk:
        reach = max(1, context_rows - 1)
        alerts, chunk_column = with_carried_rows(
            alerts, keys, order, "metric_value", chunk, reach, chunk_rows
        )
        groups.append(chunk_column)
    series = Window.partitionBy(*groups).orderBy(order, "metric_value")
    if context == "running":
        numbering = F.row_number().over(series).cast("long")
    else:
        numbering = F.sum(F.lit(1)).over(series.rowsBetween(-(context_rows - 1), 0))

    alerts = alerts.withColumns(
        {
            "prev_day_value": F.lag("metric_value").over(series),
            "consecutive_alert_window": numbering,
        }
    )
    if chunk:
        alerts = drop_carried(alerts)

    value, previous = F.col("metric_value"), F.col("prev_day_value")
    if context == "running":
        change = round_half_up((value - previous) / F.nullif(F.abs(previous), F.lit(0.0)) * 100, 2)
    else:
        change = percent_change(value, previous)
    return alerts.withColumn("day_over_day_pct_change", change)
