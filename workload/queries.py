"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import checks as c
from tidewatch.operators import drift as d
from tidewatch.operators import expectations as e
from tidewatch.operators import health as h
from tidewatch.operators import quality as q
from tidewatch.operators import reports as r
from tidewatch.operators.answers import AnswerStore
from tidewatch.operators.insights import alert_prompts, explain_alerts
from tidewatch.operators.suite import Suite, run_checks
from tidewatch.plans.incremental import append_drift_tables, read_appended
from tidewatch.session import shared_folder
from tidewatch.sources.metrics import daily_metrics, mean, total
from tidewatch.sources.tables import append_measurements, overwrite_table, read_measurements
from tidewatch.streaming.monitor import start_monitor, stream_table
from tidewatch.streaming.table_monitor import TableMonitor
from workload import sql_checks
from workload import tables as t

Query = Callable[[SparkSession, str], DataFrame]

DATES = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))
ALERT_DATES = (dt.date(1996, 1, 1), dt.date(1998, 12, 31))
REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTERED[function.__name__] = function
    return function


def measure(df: DataFrame, *bindings, name: str = "T") -> DataFrame:
    """Table, check columns and value of every binding."""
    suite = Suite(t.DATABASE, "RAW", name, bindings)
    return t.tidy(
        run_checks(df, suite, t.MEASURED_AT).select(
            "table_name", F.col("metric_name").alias("check_name"), "columns", "value"
        )
    )


# ------------------------------------------------------------------ drift


@query
def stg_daily_metrics(spark, sf):
    return t.tidy(t.staged(spark, sf))


@query
def metric_rolling_stats(spark, sf):
    return t.tidy(t.rolling(spark, sf))


@query
def metric_rolling_stats_prior(spark, sf):
    return t.tidy(t.rolling_prior(spark, sf))


@query
def classified_drift(spark, sf):
    return t.tidy(t.drift(spark, sf))


@query
def drift_alerts(spark, sf):
    return t.tidy(t.alerts(spark, sf))


@query
def drift_alerts_running(spark, sf):
    return t.tidy(d.drift_alerts(t.drift(spark, sf), context="running"))


@query
def drift_prompts(spark, sf):
    return alert_prompts(t.alerts(spark, sf)).select(
        "metric_date", "metric_name", "segment", "prompt"
    )


@query
def drift_insights(spark, sf):
    return t.tidy(explain_alerts(t.alerts(spark, sf)))


def shout(prompts):
    return [p.upper() for p in prompts]


def never(prompts):
    raise AssertionError("all of these have been answered")


@query
def drift_insights_stored(spark, sf):
    """Answers kept under their prompts: the second call finds all of them and asks nothing."""
    store = AnswerStore(spark, f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}")
    alerts = t.alerts(spark, sf)
    store.ask(alert_prompts(alerts), shout)
    return t.tidy(explain_alerts(alerts, never, store))


# ------------------------------------------------------------------ checks


@query
def check_null_count(spark, sf):
    events = t.table(spark, sf, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return measure(events, c.null_count.on("event_type"))


@query
def check_row_count(spark, sf):
    return measure(t.table(spark, sf, "lineitem"), c.row_count.on())


@query
def check_freshness(spark, sf):
    return measure(
        t.table(spark, sf, "events"), c.freshness.on("ts", as_of=dt.datetime(2024, 2, 1))
    )


@query
def check_duplicate_count(spark, sf):
    return measure(
        t.table(spark, sf, "lineitem"), c.duplicate_count.on("l_orderkey", "l_linenumber")
    )


@query
def check_min(spark, sf):
    return measure(t.table(spark, sf, "customer"), c.minimum.on("c_acctbal"))


@query
def check_max(spark, sf):
    return measure(t.table(spark, sf, "part"), c.maximum.on("p_retailprice"))


@query
def check_cardinality(spark, sf):
    return measure(t.table(spark, sf, "customer"), c.cardinality.on("c_mktsegment"))


@query
def check_value_range(spark, sf):
    return measure(
        t.table(spark, sf, "lineitem"),
        c.value_range.on("l_returnflag", "l_discount", metric="R", low=0.02, high=0.08),
        c.value_range.on("l_linestatus", "l_tax", metric="O", low=0.0, high=0.08),
    )


@query
def check_non_negative(spark, sf):
    return measure(
        t.table(spark, sf, "customer"),
        c.non_negative.on("c_mktsegment", "c_acctbal", metric="BUILDING"),
    )


@query
def check_positive(spark, sf):
    return measure(
        t.table(spark, sf, "customer"),
        c.positive.on("c_mktsegment", "c_acctbal", metric="MACHINERY"),
    )


def _dated(spark, sf) -> list[tuple[str, DataFrame]]:
    orders = t.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("d"), F.col("o_totalprice").alias("v")
    )
    lineitem = t.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("d"), F.col("l_quantity").alias("v")
    )
    events = t.table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("d"), F.col("value").alias("v")
    )
    return [("ORDERS", orders), ("LINEITEM", lineitem), ("EVENTS", events)]


@query
def check_volume_anomaly(spark, sf):
    return e.failures(
        *(measure(df, c.volume_anomaly.on("d"), name=name) for name, df in _dated(spark, sf))
    )


@query
def check_mean_drift(spark, sf):
    return e.failures(
        *(measure(df, c.mean_drift.on("d", "v"), name=name) for name, df in _dated(spark, sf))
    )


@query
def check_accepted_values(spark, sf):
    return measure(
        t.table(spark, sf, "orders"),
        c.accepted_values.on("o_orderpriority", accepted=("1-URGENT", "2-HIGH", "3-MEDIUM")),
        c.accepted_values.on("o_orderstatus", accepted=("F", "O", "P")),
    )


@query
def check_abs_bound(spark, sf):
    return measure(t.rolling_prior(spark, sf), c.abs_bound.on("z_score", bound=5.0))


@query
def check_readiness(spark, sf):
    return measure(t.rolling(spark, sf), c.readiness.on("z_score"))


@query
def check_date_gaps(spark, sf):
    return e.failures(
        *(measure(df, c.date_gaps.on("d"), name=name) for name, df in _dated(spark, sf))
    )


@query
def check_suite(spark, sf):
    """The default bindings: ten on the raw metrics, nine on the classified table, and readiness."""
    named = ("metric_name", "metric_value")
    raw = measure(
        t.staged(spark, sf),
        c.null_count.on("metric_value"),
        c.row_count.on(),
        c.freshness.on("metric_date", as_of=dt.datetime(2002, 1, 1)),
        c.minimum.on("metric_value"),
        c.maximum.on("metric_value"),
        c.cardinality.on("metric_name", name="CARDINALITY_METRIC_NAME"),
        c.value_range.on(*named, name="CONVERSION_RATE_VALID",
                         metric="avg_order_value", low=50_000, high=400_000),
        c.non_negative.on(*named, name="REVENUE_NON_NEGATIVE", metric="revenue"),
        c.positive.on(*named, name="ACTIVE_USERS_POSITIVE", metric="order_count"),
        c.date_gaps.on("metric_date"),
        name="RAW",
    )
    mart = measure(
        t.drift(spark, sf),
        c.null_count.on("z_score"),
        c.null_count.on("drift_severity"),
        c.duplicate_count.on("metric_date", "metric_name", "segment"),
        c.volume_anomaly.on("metric_date"),
        c.mean_drift.on("metric_date", "metric_value"),
        c.accepted_values.on("drift_severity", name="SEVERITY_VALID",
                             accepted=("critical", "warning", "watch", "normal")),
        c.abs_bound.on("z_score", name="ZSCORE_PLAUSIBLE"),
        c.readiness.on("z_score", name="Z_SCORE_READINESS"),
        c.date_gaps.on("metric_date"),
        name="DRIFT",
    )
    rolling = measure(
        t.rolling(spark, sf), c.readiness.on("z_score", name="Z_SCORE_READINESS"), name="ROLLING"
    )
    return e.failures(raw, mart, rolling)


@query
def check_sql_bodies(spark, sf):
    """Ten checks written as SQL, over staged metrics and the classified table."""
    named = ("metric_name", "metric_value")
    raw = measure(
        t.staged(spark, sf),
        sql_checks.kinds.on("metric_name"),
        sql_checks.in_range.on(*named, metric="avg_order_value", low=50_000, high=400_000),
        sql_checks.at_least.on(*named, metric="revenue", low=0),
        sql_checks.above.on(*named, metric="order_count", low=0),
        sql_checks.gaps.on("metric_date"),
        name="RAW",
    )
    mart = measure(
        t.drift(spark, sf),
        sql_checks.volume.on("metric_date"),
        sql_checks.shift.on("metric_date", "metric_value"),
        sql_checks.listed.on("drift_severity"),
        sql_checks.plausible.on("z_score", bound=10),
        sql_checks.ready.on("z_score"),
        name="DRIFT",
    )
    return raw.unionByName(mart)


@query
def expect_not_null(spark, sf):
    """Counted while the drift table and the quality log are written."""
    watch = e.Watch({
        "staged": (("metric_date", "metric_name", "metric_value"), {}),
        "rolling": (("z_score",), {}),
        "drift": (("is_drift_alert",), {}),
        "quality_log": (
            ("measured_at", "table_name", "dmf_name", "dmf_value", "quality_status", "quality_note"), {},
        ),
    })
    base = f"{shared_folder(spark)}/expected-{uuid.uuid4().hex}"
    rolling = watch("rolling", watch("staged", t.rolling(spark, sf)))
    overwrite_table(watch("drift", d.classify_drift(rolling)), f"{base}/drift")
    overwrite_table(watch("quality_log", t.log(spark, sf)), f"{base}/quality_log")
    return watch.results(spark).select("column_name", "failing_rows")


@query
def expect_accepted_values(spark, sf):
    return e.failures(
        e.expect_accepted_values(t.staged(spark, sf), "metric_name", ("revenue", "order_count")),
        e.expect_accepted_values(
            t.drift(spark, sf), "drift_severity", ("critical", "warning", "watch")
        ),
        e.expect_accepted_values(t.log(spark, sf), "quality_status", ("pass",)),
    )


# ------------------------------------------------------------------ quality log and health


@query
def quality_log(spark, sf):
    return t.tidy(q.quality_log(*t.measurements(spark, sf)))


@query
def check_type_tag(spark, sf):
    return t.log(spark, sf).groupBy("dmf_name", "check_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def log_filter(spark, sf):
    kept = q.filter_log(t.log(spark, sf), status="Fail", check_type="Custom", dates=DATES)
    return t.tidy(
        kept.select("measured_at", "dmf_name", "table_name", "check_type", "dmf_value",
                    "quality_status", "quality_note")
    )


LATEST = ("dmf_name", "table_name", "check_type", "quality_status", "dmf_value", "quality_note",
          "measured_at")


@query
def latest_status(spark, sf):
    return t.tidy(q.order_status(q.latest_status(t.log(spark, sf))).select(*LATEST))


@query
def latest_status_filtered(spark, sf):
    """The latest failing measurement per check within a date range."""
    kept = q.filter_log(t.log(spark, sf), status="Fail", check_type="All", dates=DATES)
    return t.tidy(q.order_status(q.latest_status(kept)).select(*LATEST))


@query
def check_value_trend(spark, sf):
    return t.tidy(q.check_value_trend(t.log(spark, sf), "WATCH.RULES.REVENUE_NON_NEGATIVE"))


@query
def health_breakdown(spark, sf):
    return t.tidy(h.health_breakdown(t.log(spark, sf)))


@query
def health_score(spark, sf):
    return t.tidy(h.health_score(t.log(spark, sf)))


@query
def score_history(spark, sf):
    return t.tidy(h.score_history(t.log(spark, sf)))


# ------------------------------------------------------------------ reports


@query
def kpi_summary(spark, sf):
    return t.tidy(r.kpi_summary(t.log(spark, sf), t.alerts(spark, sf)))


@query
def active_issues(spark, sf):
    return t.tidy(r.active_issues(t.log(spark, sf)))


@query
def alerts_by_severity(spark, sf):
    return r.alerts_by_severity(t.alerts(spark, sf))


@query
def alerts_by_metric(spark, sf):
    return r.alerts_by_metric(t.alerts(spark, sf))


@query
def daily_pass_rate(spark, sf):
    return t.tidy(r.daily_pass_rate(t.log(spark, sf)))


@query
def issue_heatmap(spark, sf):
    return r.issue_heatmap(t.log(spark, sf))


@query
def weekly_alert_counts(spark, sf):
    return r.weekly_alert_counts(t.drift(spark, sf))


@query
def zscore_distribution(spark, sf):
    return t.tidy(r.zscore_distribution(t.drift(spark, sf)))


@query
def alerts_by_metric_severity(spark, sf):
    return r.alerts_by_metric_severity(t.drift(spark, sf))


@query
def alert_feed_page(spark, sf):
    return t.tidy(r.alert_feed_page(t.alerts(spark, sf), page=2, dates=ALERT_DATES))


@query
def alert_feed_size(spark, sf):
    return r.alert_feed_size(t.alerts(spark, sf), severity="Warning", dates=ALERT_DATES)


@query
def alert_insight_join(spark, sf):
    alerts = t.alerts(spark, sf)
    explained = explain_alerts(alerts)
    return t.tidy(
        r.alert_insights(alerts, explained).select(
            "metric_date", "metric_name", "segment", "drift_severity", "metric_value", "ai_insight"
        )
    )


@query
def series_band(spark, sf):
    return t.tidy(r.series_band(t.drift(spark, sf), "revenue", "1-URGENT", ALERT_DATES))


@query
def alert_markers(spark, sf):
    return t.tidy(
        r.alert_markers(t.drift(spark, sf), t.alerts(spark, sf), "revenue", "all")
    )


@query
def pick_lists(spark, sf):
    return r.pick_lists(t.drift(spark, sf), t.log(spark, sf))


# ------------------------------------------------------------------ continuous measurement


@query
def monitor_stream(spark, sf):
    """The events streamed in, measured as a whole when all rows have been worked off."""
    schema = t.table(spark, sf, "events").schema
    # a pattern, as the table may be a single file, which is no source for a stream by its plain name
    stream = stream_table(spark, f"{sf}/events.parque[t]", schema)
    checked = stream.select(
        "user_id", "event_type", "value", F.col("ts").cast("date").alias("d"), "ts"
    )
    monitor = start_monitor(checked, _event_checks()).wait()
    return _measured(monitor.measure(t.MEASURED_AT))


def _event_checks() -> Suite:
    return Suite(
        t.DATABASE, "RAW", "EVENTS",
        (
            c.row_count.on(),
            c.null_count.on("value"),
            c.freshness.on("ts", as_of=dt.datetime(2024, 2, 1)),
            c.minimum.on("value"),
            c.maximum.on("value"),
            c.value_range.on("event_type", "value", metric="click", low=0, high=250),
            c.volume_anomaly.on("d"),
            c.mean_drift.on("d", "value"),
            c.date_gaps.on("d"),
            c.cardinality.on("event_type"),
            c.duplicate_count.on("user_id", "event_type", "d"),
        ),
    )


def _measured(measurements: DataFrame) -> DataFrame:
    return t.tidy(
        measurements.select("table_name", F.col("metric_name").alias("check_name"), "columns", "value")
    )


@query
def monitor_rebuilt(spark, sf):
    """Events in files by type: all are measured, then one type is rebuilt and another appended to."""
    base = f"{shared_folder(spark)}/rebuilt-{uuid.uuid4().hex}"
    events = t.table(spark, sf, "events").select("event_type", "user_id", "ts", "value")

    def write(rows, mode):
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("event_type").parquet(
            f"{base}/table"
        )

    write(events, "append")
    monitor = TableMonitor(
        spark, f"{base}/table", events.schema, _event_checks(), f"{base}/state",
        {"d": F.col("ts").cast("date")}, buckets=16,
    )
    monitor.refresh()
    write(events.where("event_type = 'click'").withColumn("value", F.col("value") + 1), "overwrite")
    write(events.where("event_type = 'purchase'"), "append")
    monitor.refresh()  # reads the new files of two types alone
    return _measured(monitor.measure(t.MEASURED_AT))


@query
def check_suite_two_dates(spark, sf):
    """Series checks of two date columns in one pass, and four keyed checks in one shuffle."""
    shipped = F.col("l_shipdate").cast("date")
    lines = t.table(spark, sf, "lineitem").select(
        shipped.alias("shipped"),
        F.date_add(shipped, F.col("l_linenumber") * F.col("l_linenumber")).alias("due"),
        F.col("l_quantity").alias("quantity"), "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
    )
    return measure(
        lines,
        c.row_count.on(),
        c.date_gaps.on("shipped"),
        c.date_gaps.on("due"),
        c.volume_anomaly.on("due"),
        c.mean_drift.on("shipped", "quantity"),
        c.mean_drift.on("due", "quantity"),
        c.maximum.on("quantity"),
        c.duplicate_count.on("l_orderkey", "l_linenumber"),
        c.duplicate_count.on("l_partkey", "shipped"),
        c.cardinality.on("l_partkey"),
        c.cardinality.on("l_returnflag"),
        name="LINES",
    )


@query
def drift_alerts_appended(spark, sf):
    """The alerts of three batches of order dates, each from its own rows and the tails before it."""
    folder = f"{shared_folder(spark)}/appended-{uuid.uuid4().hex}"
    orders = t.order_metrics(spark, sf)
    day, second, third = F.col("metric_date"), dt.date(1995, 1, 1), dt.date(1997, 6, 1)
    for batch, rows in enumerate((day < second, (day >= second) & (day < third), day >= third)):
        append_drift_tables(orders.where(rows), folder, batch)
    return t.tidy(read_appended(spark, folder, "alerts"))


@query
def exact_daily_means(spark, sf):
    """Rates, which have more decimals than amounts: nothing is rounded before it is summed."""
    lines = t.table(spark, sf, "lineitem")
    measures = {
        "discount_mean": mean("l_discount"), "tax_mean": mean("l_tax"), "tax_total": total("l_tax"),
    }
    return t.tidy(daily_metrics(lines, "l_shipdate", "l_returnflag", measures), 9)


@query
def measurement_history(spark, sf):
    """Two tables in one history with equal batch numbers, one batch repeated after midnight."""
    path = f"{shared_folder(spark)}/history-{uuid.uuid4().hex}"
    bindings = (c.row_count.on(), c.freshness.on("day"))
    orders = t.table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("timestamp_ntz"))
    lines = t.table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("timestamp_ntz"))
    late, later = dt.datetime(2024, 2, 1, 23, 59), dt.datetime(2024, 2, 2, 0, 1)
    for frame, name, at in ((orders, "ORDERS", late), (lines, "LINEITEM", late), (orders, "ORDERS", later)):
        measured = run_checks(frame, Suite(t.DATABASE, "RAW", name, bindings), at)
        append_measurements(measured, path, batch_id=0)
    history = read_measurements(spark, path, dates=(late.date(), late.date()))
    return history.select(
        "table_name", F.col("metric_name").alias("check_name"), "value", "measurement_time",
        "measured_date", "batch_id",
    )
