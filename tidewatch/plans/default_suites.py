"""The default checks of a raw metric table and of the drift table made from it."""

from __future__ import annotations

import datetime as dt

from tidewatch.operators import checks as c
from tidewatch.operators.drift import SEVERITIES
from tidewatch.operators.suite import Suite


def raw_suite(
    as_of: dt.datetime | None = None,
    database: str = "METRICS",
    schema: str = "SEEDS",
    table: str = "RAW_DAILY_METRICS",
) -> Suite:
    """Ten checks of raw observations; the age is taken at ``as_of`` or, by default, when measured."""
    named = ("metric_name", "metric_value")
    return Suite(
        database,
        schema,
        table,
        (
            c.null_count.on("metric_value"),
            c.row_count.on(),
            c.freshness.on("metric_date", **({} if as_of is None else {"as_of": as_of})),
            c.minimum.on("metric_value"),
            c.maximum.on("metric_value"),
            c.cardinality.on("metric_name", name="CARDINALITY_METRIC_NAME"),
            c.value_range.on(*named, name="CONVERSION_RATE_VALID",
                             metric="conversion_rate", low=0, high=1),
            c.non_negative.on(*named, name="REVENUE_NON_NEGATIVE", metric="revenue"),
            c.positive.on(*named, name="ACTIVE_USERS_POSITIVE", metric="active_users"),
            c.date_gaps.on("metric_date"),
        ),
    )


def drift_suite(
    database: str = "METRICS", schema: str = "MARTS", table: str = "DRIFT"
) -> Suite:
    """Nine checks of the classified table."""
    return Suite(
        database,
        schema,
        table,
        (
            c.null_count.on("z_score"),
            c.null_count.on("drift_severity"),
            c.duplicate_count.on("metric_date", "metric_name", "segment"),
            c.volume_anomaly.on("metric_date"),
            c.mean_drift.on("metric_date", "metric_value"),
            c.accepted_values.on("drift_severity", name="SEVERITY_VALID",
                                 accepted=(*SEVERITIES, "normal")),
            c.abs_bound.on("z_score", name="ZSCORE_PLAUSIBLE"),
            c.readiness.on("z_score", name="Z_SCORE_READINESS"),
            c.date_gaps.on("metric_date"),
        ),
    )


def rolling_suite(
    database: str = "METRICS", schema: str = "INTERMEDIATE", table: str = "ROLLING_STATS"
) -> Suite:
    """Readiness where it can fire: the drift table has no rows without a z-score."""
    return Suite(
        database, schema, table, (c.readiness.on("z_score", name="Z_SCORE_READINESS"),)
    )


# expected columns: table -> (columns without NULLs, column -> accepted values)
EXPECTATIONS = {
    "staged": (
        ("metric_date", "metric_name", "metric_value"),
        {"metric_name": ("revenue", "conversion_rate", "active_users", "sessions")},
    ),
    "drift": (("is_drift_alert",), {"drift_severity": (*SEVERITIES, "normal")}),
    "alerts": (("metric_date",), {"drift_severity": SEVERITIES}),
    "insights": (("ai_insight",), {}),
    "quality_log": (
        ("measured_at", "table_name", "dmf_name", "dmf_value", "quality_status", "quality_note"),
        {"quality_status": ("fail", "warn", "pass")},
    ),
}
