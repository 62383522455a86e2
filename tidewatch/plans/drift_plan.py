"""The drift tables from raw observations to explanations, as one lazy chain of frames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidewatch.operators.drift import classify_drift, drift_alerts
from tidewatch.operators.insights import Complete, explain_alerts
from tidewatch.operators.rolling import rolling_stats, stage_metrics
from tidewatch.operators.suite import Suite, run_checks
from tidewatch.sources.tables import append_measurements, overwrite_table, read_table


@dataclass(frozen=True)
class DriftTables:
    staged: DataFrame
    rolling: DataFrame
    drift: DataFrame
    alerts: DataFrame
    insights: DataFrame


def drift_tables(
    raw: DataFrame,
    complete: Complete | None = None,
    chunk: str | None = None,
    chunk_rows: int | None = None,
    copies: str = "separate",
) -> DriftTables:
    """Build all tables lazily. Rolling statistics and alert context share one shuffle by series.

    ``chunk``, ``chunk_rows`` and ``copies`` keep tasks even for tables that are not at daily grain, see
    ``rolling_stats``.
    """
    staged = stage_metrics(raw)
    rolling = rolling_stats(staged, chunk=chunk, chunk_rows=chunk_rows, copies=copies)
    drift = classify_drift(rolling)
    alerts = drift_alerts(drift, chunk=chunk, chunk_rows=chunk_rows)
    return DriftTables(staged, rolling, drift, alerts, explain_alerts(alerts, complete))


def rebuild_drift_tables(
    raw: DataFrame,
    folder: str,
    complete: Complete | None = None,
    chunk: str | None = None,
    chunk_rows: int | None = None,
    copies: str = "separate",
    watch: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> DriftTables:
    """Rebuild the three stored tables under ``folder``; each is computed from the stored one before.

    Returns frames that read the stored tables (staging and rolling statistics stay lazy). ``watch``
    (see ``tidewatch.operators.expectations.Watch``) counts violated expectations of all five tables
    as they are written; staged rows are seen where rolling statistics have joined them.
    """
    spark = raw.sparkSession
    lazy = drift_tables(raw, complete, chunk, chunk_rows, copies)
    rolling = watch("rolling", watch("staged", lazy.rolling))
    overwrite_table(watch("drift", classify_drift(rolling)), f"{folder}/drift")
    drift = read_table(spark, f"{folder}/drift")
    alerts = drift_alerts(drift, chunk=chunk, chunk_rows=chunk_rows)
    overwrite_table(watch("alerts", alerts), f"{folder}/alerts")
    alerts = read_table(spark, f"{folder}/alerts")
    overwrite_table(watch("insights", explain_alerts(alerts, complete)), f"{folder}/insights")
    insights = read_table(spark, f"{folder}/insights")
    return DriftTables(lazy.staged, lazy.rolling, drift, alerts, insights)


def measure_rebuild(
    tables: list[tuple[Suite, DataFrame]], history: str, rebuild: int, measured_at: dt.datetime
) -> None:
    """Measure freshly rebuilt tables and append to the history.

    ``rebuild`` numbers the rebuild: measuring it again replaces its measurements, so a repeated job
    counts once. A stream is for tables that only grow; one that is rebuilt is measured as a whole.
    """
    for suite, table in tables:
        append_measurements(
            run_checks(table, suite, measured_at), history, batch_id=rebuild, monitor="rebuild"
        )
