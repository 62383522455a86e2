"""Report tables over the quality log, the drift table and the alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.joins import null_safe_join
from tidewatch.functions.text import short_name
from tidewatch.operators.drift import ALERT_COLUMNS, DRIFT_COLUMNS, SEVERITIES, severity_rank
from tidewatch.operators.health import health_breakdown, health_score
from tidewatch.operators.insights import INSIGHT_COLUMNS
from tidewatch.operators.quality import ALL, STATUSES, status_rank
from tidewatch.operators.quantiles import exact_quantiles

Dates = tuple[dt.date, dt.date]

LOG_COLUMNS = (
    "measured_at", "db_name", "schema_name", "table_name", "dmf_name", "check_type", "dmf_value",
    "quality_status", "quality_note",
)


def filter_dates(df: DataFrame, dates: Dates | None, column: str = "metric_date") -> DataFrame:
    """Keep the rows of an inclusive date range."""
    return df if dates is None else df.where(F.col(column).between(*dates))


def filter_severity(df: DataFrame, severity: str | None) -> DataFrame:
    """Keep the rows of one severity; None or "All" keeps all rows."""
    if not severity or severity == ALL:
        return df
    return df.where(F.col("drift_severity") == severity.lower())


def list_log(log: DataFrame) -> DataFrame:
    """The tagged quality log as reports read it, newest first."""
    return log.select(*LOG_COLUMNS).orderBy(F.desc("measured_at"))


def list_drift(drift: DataFrame) -> DataFrame:
    """The drift table as reports read it, by date."""
    return drift.select(*DRIFT_COLUMNS).orderBy("metric_date")


def list_alerts(alerts: DataFrame) -> DataFrame:
    """The alerts as reports read them, newest first."""
    return alerts.select(*ALERT_COLUMNS).orderBy(F.desc("metric_date"))


def list_insights(insights: DataFrame) -> DataFrame:
    """The explanations as reports read them, newest first."""
    return insights.select(*INSIGHT_COLUMNS).orderBy(F.desc("metric_date"))


def kpi_summary(log: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: checks by outcome, pass rate, alerts, critical alerts, metrics with alerts."""
    checks = health_score(log).select(
        "score", "total_checks", "passing",
        F.bround(F.col("passing") / F.greatest("total_checks", F.lit(1)) * 100).cast("int")
        .alias("pass_rate"),
        "failures", "warnings",
    )
    # counted per metric first: the distinct count then needs no second shuffle of the alerts
    per_metric = alerts.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("drift_severity") == "critical").alias("critical"),
    )
    drift = per_metric.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("drift_alerts"),
        F.coalesce(F.sum("critical"), F.lit(0)).alias("critical_alerts"),
        F.count("metric_name").alias("affected_metrics"),
    )
    return checks.crossJoin(F.broadcast(drift))  # one row on each side


def active_issues(log: DataFrame, limit: int = 6) -> DataFrame:
    """The first checks that do not pass, failing before warning."""
    return (
        health_breakdown(log)
        .where(F.col("quality_status").isin("fail", "warn"))
        .orderBy(status_rank(F.col("quality_status")), "dmf_name", "table_name")
        .limit(limit)
    )


def alerts_by_severity(alerts: DataFrame, domain: Sequence[str] = SEVERITIES) -> DataFrame:
    """Alerts per severity of a fixed domain, zero where there are none, in domain order."""
    counts = alerts.agg(
        *(F.count_if(F.col("drift_severity") == s).alias(f"n{i}") for i, s in enumerate(domain))
    )
    rows = F.array(
        *(
            F.struct(F.lit(s).alias("drift_severity"), F.col(f"n{i}").alias("count"))
            for i, s in enumerate(domain)
        )
    )
    return counts.select(F.inline(rows))


def alerts_by_metric(alerts: DataFrame) -> DataFrame:
    """Alerts per metric, fewest first."""
    return (
        alerts.groupBy("metric_name").agg(F.count(F.lit(1)).alias("count"))
        .orderBy("count", "metric_name")
    )


def daily_pass_rate(log: DataFrame) -> DataFrame:
    """Measurements per day and outcome, with the share that passed in percent."""
    daily = (
        log.groupBy(F.to_date("measured_at").alias("date"))
        .pivot("quality_status", list(STATUSES))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(STATUSES))
    )
    total = F.col("pass") + F.col("warn") + F.col("fail")
    rate = F.bround(F.col("pass") / F.greatest(total, F.lit(1)) * 100, 1)
    return daily.select(
        "date", "pass", "warn", "fail", total.alias("total"), rate.alias("pass_rate")
    ).orderBy("date")


def issue_heatmap(log: DataFrame) -> DataFrame:
    """Failures and warnings per check and day (long form), checks with most issues first."""
    cells = (
        log.where(F.col("quality_status").isin("fail", "warn"))
        .groupBy(short_name(F.col("dmf_name")).alias("check_label"),
                 F.to_date("measured_at").alias("date"))
        .agg(F.count(F.lit(1)).alias("issues"))
    )
    # one row per check and day by now
    total = F.sum("issues").over(Window.partitionBy("check_label"))
    return cells.withColumn("total_issues", total).orderBy(
        F.desc("total_issues"), "check_label", "date"
    )


def weekly_alert_counts(drift: DataFrame, domain: Sequence[str] = SEVERITIES) -> DataFrame:
    """Alerts per week (starting Monday) and metric, one column per severity."""
    return (
        drift.where("is_drift_alert")
        .groupBy(F.date_trunc("week", F.col("metric_date")).cast("date").alias("week"), "metric_name")
        .pivot("drift_severity", list(domain))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(domain))
        .orderBy("week", "metric_name")
    )


def zscore_distribution(drift: DataFrame) -> DataFrame:
    """Count, mean, extremes and exact quartiles of the z-scores of every metric."""
    z = F.col("z_score")
    known = drift.where(z.isNotNull())
    moments = known.groupBy("metric_name").agg(
        F.count(z).alias("n"), F.avg(z).alias("mean_z"), F.min(z).alias("min_z"),
        F.max(z).alias("max_z"),
    )
    quartiles = exact_quantiles(
        known, ["metric_name"], "z_score", {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )
    return null_safe_join(moments, quartiles, ["metric_name"]).select(
        "metric_name", "n", "mean_z", "min_z", "q1", "median", "q3", "max_z"
    )


def alerts_by_metric_severity(drift: DataFrame) -> DataFrame:
    """Alerts per metric and severity."""
    return (
        drift.where("is_drift_alert")
        .groupBy("metric_name", "drift_severity")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def alert_feed(
    alerts: DataFrame,
    severity: str | None = None,
    dates: Dates | None = None,
) -> DataFrame:
    """Filtered alerts, strongest severity first, then newest; the last key orders what else is equal,
    so that pages neither repeat nor skip rows."""
    return filter_dates(filter_severity(alerts, severity), dates).orderBy(
        F.asc_nulls_last(severity_rank(F.col("drift_severity"))), F.desc("metric_date"),
        "metric_name", "segment", F.xxhash64(*alerts.columns),
    )


def alert_feed_page(
    alerts: DataFrame,
    page: int = 1,
    page_size: int = 10,
    severity: str | None = None,
    dates: Dates | None = None,
) -> DataFrame:
    """One page of the alert feed (first page = 1)."""
    return alert_feed(alerts, severity, dates).offset((page - 1) * page_size).limit(page_size)


def alert_feed_size(
    alerts: DataFrame,
    page_size: int = 10,
    severity: str | None = None,
    dates: Dates | None = None,
) -> DataFrame:
    """One row: number of alerts in the feed and of pages (at least one)."""
    n = F.count(F.lit(1))
    pages = F.greatest(F.lit(1), F.ceil(n / page_size))
    return filter_dates(filter_severity(alerts, severity), dates).agg(
        n.alias("total"), pages.cast("long").alias("total_pages")
    )


def alert_insights(
    alerts: DataFrame, insights: DataFrame, newest: str | None = None
) -> DataFrame:
    """Alerts with the explanation for their date, metric and segment, or an empty text.

    If there are several, the one with the greatest ``newest`` counts (without it, the last text in
    alphabetical order, so that the choice is repeatable).
    """
    keys = ["metric_date", "metric_name", "segment"]
    pick = F.max("ai_insight") if newest is None else F.max_by("ai_insight", newest)
    chosen = insights.groupBy(*keys).agg(pick.alias("ai_insight"))
    return null_safe_join(alerts, chosen, keys, "left").withColumn(
        "ai_insight", F.coalesce("ai_insight", F.lit(""))
    )


def _one_series(df: DataFrame, metric: str, segment: str, dates: Dates | None) -> DataFrame:
    chosen = (F.col("metric_name") == metric) & (F.col("segment") == segment)
    return filter_dates(df.where(chosen), dates)


def series_band(
    drift: DataFrame, metric: str, segment: str, dates: Dates | None = None
) -> DataFrame:
    """One series with its rolling mean and the band of one deviation around it."""
    average, deviation = F.col("rolling_14d_avg"), F.col("rolling_14d_stddev")
    return _one_series(drift, metric, segment, dates).select(
        "metric_date", "metric_value", "rolling_14d_avg",
        (average - deviation).alias("band_low"), (average + deviation).alias("band_high"),
    ).orderBy("metric_date")


def alert_markers(
    drift: DataFrame, alerts: DataFrame, metric: str, segment: str, dates: Dates | None = None
) -> DataFrame:
    """Alerts of one series with the series value on their date."""
    series = (
        _one_series(drift, metric, segment, dates).select("metric_date", "metric_value").distinct()
    )
    marked = _one_series(alerts, metric, segment, dates).select(
        "metric_date", "drift_severity", F.col("metric_value").alias("metric_value_a")
    )
    return marked.join(series, "metric_date", "left")


def pick_lists(drift: DataFrame, log: DataFrame) -> DataFrame:
    """The distinct metrics, segments and checks to choose from: ``field, choice``, sorted."""
    series = drift.select("metric_name", "segment").distinct()
    choices = series.select(
        F.inline(
            F.array(
                F.struct(F.lit("metric").alias("field"), F.col("metric_name").alias("choice")),
                F.struct(F.lit("segment").alias("field"), F.col("segment").alias("choice")),
            )
        )
    ).unionByName(log.select(F.lit("check").alias("field"), F.col("dmf_name").alias("choice")))
    return choices.distinct().orderBy("field", "choice")
