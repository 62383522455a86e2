"""The frames that the registered queries start from, derived from the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.numeric import round_half_up
from tidewatch.operators import checks as c
from tidewatch.operators.drift import classify_drift, drift_alerts, severity_of
from tidewatch.operators.quality import quality_log, tag_check_type
from tidewatch.operators.rolling import rolling_stats, stage_metrics
from tidewatch.operators.suite import Suite, run_checks, run_checks_by_date
from tidewatch.sources.metrics import daily_metrics, mean, rows, total

MEASURED_AT = dt.datetime(2024, 2, 1, 8)
DATABASE = "WATCH"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round the doubles of a final result, so that engines with another summation order agree."""
    return df.select(
        *(
            round_half_up(F.col(name), digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        )
    )


# ------------------------------------------------------------------ metric series from orders


def order_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return daily_metrics(
        table(spark, sf, "orders"),
        "o_orderdate",
        "o_orderpriority",
        {
            "revenue": total("o_totalprice", scale=2),
            "order_count": rows(),
            "avg_order_value": mean("o_totalprice", scale=2),
        },
    )


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return stage_metrics(order_metrics(spark, sf))


def rolling(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_stats(staged(spark, sf)).drop("day_of_week")


def rolling_prior(spark: SparkSession, sf: str) -> DataFrame:
    return rolling_stats(staged(spark, sf), baseline="prior").drop("day_of_week")


def drift(spark: SparkSession, sf: str) -> DataFrame:
    return classify_drift(rolling(spark, sf))


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return drift_alerts(drift(spark, sf))


# ------------------------------------------------------------------ checked event tables


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a checked table. Values above 400 count as missing, so that checks can fail."""
    value = F.when(F.col("value") <= 400, F.col("value"))
    return table(spark, sf, "events").select(
        "ts",
        F.col("ts").cast("date").alias("metric_date"),
        F.col("event_type").alias("metric_name"),
        value.alias("metric_value"),
        (value - 0.3).alias("net_value"),
        "user_id",
    )


def event_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return daily_metrics(
        table(spark, sf, "events"),
        "ts",
        "event_type",
        {"event_count": rows(), "value_total": total("value", scale=2)},
    )


def event_rolling(spark: SparkSession, sf: str) -> DataFrame:
    rolled = rolling_stats(stage_metrics(event_metrics(spark, sf)))
    severity = F.when(F.col("z_score").isNotNull(), severity_of(F.col("z_score")))
    return rolled.withColumn("drift_severity", severity)


def _daily_suite() -> Suite:
    named = ("metric_name", "metric_value")
    net = ("metric_name", "net_value")
    return Suite(
        DATABASE, "RAW", "EVENTS",
        (
            c.null_count.on("metric_value"),
            c.row_count.on(),
            c.freshness.on("ts", as_of=F.expr("cast(__date as timestamp_ntz) + interval 1 day")),
            c.minimum.on("metric_value"),
            c.maximum.on("metric_value"),
            c.value_range.on(*named, name="CONVERSION_RATE_VALID",
                             metric="click", low=0, high=250),
            c.non_negative.on(*net, name="REVENUE_NON_NEGATIVE", metric="purchase"),
            c.positive.on(*net, name="ACTIVE_USERS_POSITIVE", metric="view"),
        ),
    )


def _rolling_daily_suite() -> Suite:
    return Suite(
        DATABASE, "MARTS", "EVENT_ROLLING",
        (
            c.null_count.on("z_score"),
            c.null_count.on("drift_severity"),
            c.readiness.on("z_score", name="Z_SCORE_READINESS"),
            c.abs_bound.on("z_score", name="ZSCORE_PLAUSIBLE", bound=2.0),
            c.accepted_values.on("drift_severity", name="SEVERITY_VALID",
                                 accepted=("critical", "warning", "normal")),
        ),
    )


def whole_table_suite() -> Suite:
    return Suite(
        DATABASE, "RAW", "EVENTS",
        (
            c.duplicate_count.on("user_id", "metric_name", "metric_date"),
            c.cardinality.on("metric_name", name="CARDINALITY_METRIC_NAME"),
            c.volume_anomaly.on("metric_date"),
            c.mean_drift.on("metric_date", "metric_value"),
            c.date_gaps.on("metric_date"),
        ),
    )


def measurements(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two histories: daily and whole-table runs on the events, daily runs on their statistics."""
    at = F.expr("cast(__date as timestamp_ntz) + interval 1 day 8 hours")
    events = event_rows(spark, sf)
    raw_history = run_checks_by_date(events, _daily_suite(), "metric_date", at).unionByName(
        run_checks(events, whole_table_suite(), MEASURED_AT)
    )
    mart_history = run_checks_by_date(
        event_rolling(spark, sf), _rolling_daily_suite(), "metric_date", at
    )
    return raw_history, mart_history


def log(spark: SparkSession, sf: str) -> DataFrame:
    return tag_check_type(quality_log(*measurements(spark, sf)))
