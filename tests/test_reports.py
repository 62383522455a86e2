import datetime as dt
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import reports as r
from tidewatch.operators.insights import INSIGHT_COLUMNS, alert_prompts, explain_alerts
from tidewatch.operators.quality import quality_log, tag_check_type
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.suite import run_checks
from tidewatch.plans.default_suites import drift_suite, raw_suite

AT = dt.datetime(2026, 4, 18, 8)


@pytest.fixture(scope="module")
def log(tables):
    history = run_checks(tables.staged, raw_suite(AT), AT).unionByName(
        run_checks(tables.drift, drift_suite(), AT)
    )
    return tag_check_type(quality_log(history)).cache()


def test_kpis(log, tables):
    alerts = tables.alerts.collect()
    row = r.kpi_summary(log, tables.alerts).first()
    assert (row.total_checks, row.passing, row.failures, row.warnings) == (18, 12, 6, 0)
    assert row.pass_rate == 67
    assert row.drift_alerts == len(alerts)
    assert row.critical_alerts == sum(a.drift_severity == "critical" for a in alerts)
    assert row.affected_metrics == len({a.metric_name for a in alerts})
    empty = r.kpi_summary(log.limit(0), tables.alerts.limit(0)).first()
    assert (empty.score, empty.pass_rate, empty.drift_alerts) == (100, 0, 0)


def test_active_issues(log):
    assert r.active_issues(log, limit=4).count() == 4
    assert {x.quality_status for x in r.active_issues(log).collect()} == {"fail"}


def test_alert_counts(tables):
    alerts = tables.alerts.collect()
    severities = Counter(a.drift_severity for a in alerts)
    got = [(x.drift_severity, x["count"]) for x in r.alerts_by_severity(tables.alerts).collect()]
    assert got == [(s, severities[s]) for s in ("critical", "warning", "watch")]
    none = r.alerts_by_severity(tables.alerts.limit(0)).collect()
    assert [x["count"] for x in none] == [0, 0, 0]
    metrics = Counter(a.metric_name for a in alerts)
    rows = r.alerts_by_metric(tables.alerts).collect()
    assert {x.metric_name: x["count"] for x in rows} == metrics
    assert [x["count"] for x in rows] == sorted(metrics.values())
    both = Counter((a.metric_name, a.drift_severity) for a in alerts)
    rows = r.alerts_by_metric_severity(tables.drift).collect()
    assert {(x.metric_name, x.drift_severity): x["count"] for x in rows} == both
    weeks = Counter(
        (a.metric_date - dt.timedelta(days=a.metric_date.weekday()), a.metric_name) for a in alerts
    )
    rows = r.weekly_alert_counts(tables.drift).collect()
    assert {(x.week, x.metric_name): x.critical + x.warning + x.watch for x in rows} == weeks


def test_pass_rate_and_heatmap(log):
    row = r.daily_pass_rate(log).first()
    assert (row["pass"], row.warn, row.fail, row.total, row.pass_rate) == (13, 0, 6, 19, 68.4)
    cells = r.issue_heatmap(log).collect()
    assert cells[0].check_label == "date_gaps"
    assert (cells[0].issues, cells[0].total_issues) == (2, 2)
    assert len(cells) == 5


def test_feed(tables):
    alerts = tables.alerts.collect()
    rank = {"critical": 0, "warning": 1, "watch": 2}
    expected = sorted(
        alerts,
        key=lambda a: (rank[a.drift_severity], -a.metric_date.toordinal(), a.metric_name, a.segment),
    )
    paged = [x for p in (1, 2, 3, 4, 5) for x in r.alert_feed_page(tables.alerts, p).collect()]
    assert paged == expected[:50]
    size = r.alert_feed_size(tables.alerts).first()
    assert (size.total, size.total_pages) == (len(alerts), -(-len(alerts) // 10))
    assert r.alert_feed_size(tables.alerts.limit(0)).first().total_pages == 1
    dates = (dt.date(2026, 3, 1), dt.date(2026, 3, 10))
    got = r.alert_feed(tables.alerts, "Watch", dates).collect()
    assert len(got) == sum(
        a.drift_severity == "watch" and dates[0] <= a.metric_date <= dates[1] for a in alerts
    )


def test_far_pages_are_sorted_not_collected(tables):
    def plan(page):
        frame = r.alert_feed_page(tables.alerts, page)
        return frame._jdf.queryExecution().executedPlan().toString()

    assert "TakeOrderedAndProject" in plan(2)
    assert "TakeOrderedAndProject" not in plan(1_000_000)
    assert r.alert_feed_page(tables.alerts, 1_000_000).isEmpty()


def test_insight_join(tables, spark):
    first = tables.alerts.orderBy("metric_date", "metric_name", "segment").first()
    key = (first.metric_date, first.metric_name, first.segment)
    insights = spark.createDataFrame(
        [(*key, "old", 1), (*key, "new", 2)],
        "metric_date date, metric_name string, segment string, ai_insight string, at int",
    )
    rows = r.alert_insights(tables.alerts, insights, newest="at").collect()
    assert len(rows) == tables.alerts.count()
    texts = {(x.metric_date, x.metric_name, x.segment): x.ai_insight for x in rows}
    assert texts.pop(key) == "new" and set(texts.values()) == {""}


def test_series(tables):
    band = r.series_band(tables.drift, "revenue", "all").collect()
    rows = tables.drift.where("metric_name = 'revenue' and segment = 'all'").collect()
    assert len(band) == len(rows) == 84
    by_date = {x.metric_date: x for x in rows}
    for b in band:
        x = by_date[b.metric_date]
        assert b.band_low == x.rolling_14d_avg - x.rolling_14d_stddev
        assert b.band_high == x.rolling_14d_avg + x.rolling_14d_stddev
    markers = r.alert_markers(tables.drift, tables.alerts, "revenue", "all").collect()
    assert {m.metric_date for m in markers} == {x.metric_date for x in rows if x.is_drift_alert}
    assert all(m.metric_value == m.metric_value_a for m in markers)


def test_pick_lists(tables, log):
    rows = r.pick_lists(tables.drift, log).collect()
    assert [(x.field, x.choice) for x in rows] == sorted((x.field, x.choice) for x in rows)
    assert [x.choice for x in rows if x.field == "segment"] == ["all", "product"]


def test_zscore_distribution(tables):
    z = {}
    for x in tables.drift.collect():
        z.setdefault(x.metric_name, []).append(x.z_score)
    rows = r.zscore_distribution(tables.drift).collect()
    assert len(rows) == len(z)
    for row in rows:
        values = z[row.metric_name]
        q1, median, q3 = statistics.quantiles(values, n=4, method="inclusive")
        assert (row.n, row.min_z, row.max_z) == (len(values), min(values), max(values))
        assert row.mean_z == pytest.approx(statistics.mean(values))
        assert (row.q1, row.median, row.q3) == pytest.approx((q1, median, q3))


def test_exact_quantiles_on_awkward_groups(spark):
    rng = random.Random(1)
    groups = {
        "one": [4.0],
        "two": [1.0, 2.0],
        "copies": [7.0] * 5000 + [1.0, 9.0],
        "third": [5.0] * 1000 + [rng.gauss(0, 3) for _ in range(2000)],
        "steps": [float(rng.randrange(4)) for _ in range(999)],
        "wide": [10.0 ** rng.randrange(-9, 9) * rng.choice([-1, 1]) for _ in range(3000)],
        "smooth": [rng.random() for _ in range(20000)],
    }
    rows = [(k, v) for k, values in groups.items() for v in values] + [("one", None), ("no", None)]
    groups[None] = [3.0, 1.0, 2.0]
    rows += [(None, v) for v in groups[None]]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(8)
    wanted = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "high": 1.0}
    for margin in (0.002, 0.1):
        got = {x.k: x for x in exact_quantiles(frame, ["k"], "v", wanted, margin).collect()}
        assert set(got) == set(groups)
        for k, values in groups.items():
            values = sorted(values)
            for name, share in wanted.items():
                position = share * (len(values) - 1)
                below = int(position)
                above = min(below + 1, len(values) - 1)
                expected = values[below] + (values[above] - values[below]) * (position - below)
                assert got[k][name] == pytest.approx(expected, rel=1e-12), (k, name, margin)


def test_prompts(tables):
    row = (
        alert_prompts(tables.alerts)
        .where("metric_name = 'revenue' and segment = 'all' and metric_date = '2026-03-05'")
        .first()
    )
    change = f"{row.day_over_day_pct_change:.2f}".rstrip("0").rstrip(".")
    assert row.prompt == (
        "You are an analytics engineer explaining metric anomalies to a business stakeholder. "
        "Be concise (2-3 sentences). Metric: revenue. Date: 2026-03-05. Value: -500. "
        f"14-day average: {row.rolling_14d_avg:.2f}. Z-score: {row.z_score:.2f}. "
        "Direction: below. Severity: critical. "
        f"Deviation from average: {row.pct_deviation}%. Weekend: no. "
        f"Day-over-day change: {change}%. Explain what happened and suggest a possible cause."
    ).replace(f"{row.rolling_14d_avg:.2f}", f"{row.rolling_14d_avg:.2f}".rstrip("0").rstrip("."))
    first = alert_prompts(tables.alerts.where("prev_day_value is null")).first()
    assert "Day-over-day change: n/a." in first.prompt
    nothing = alert_prompts(tables.alerts.withColumn("pct_deviation", F.lit(None).cast("double")))
    assert nothing.where("prompt is not null").isEmpty()


def test_explanations(tables):
    built_in = explain_alerts(tables.alerts)
    assert tuple(built_in.columns) == INSIGHT_COLUMNS
    assert built_in.where("ai_insight is null").isEmpty()
    assert "MapInPandas" not in built_in._jdf.queryExecution().executedPlan().toString()

    def complete(prompts):
        return [f"{len(p)} letters" for p in prompts]

    asked = tables.alerts.withColumn(
        "pct_deviation", F.when(F.col("drift_severity") != "watch", F.col("pct_deviation"))
    )
    rows = explain_alerts(asked, complete).collect()
    assert len(rows) == asked.count()
    for x in rows:
        assert (x.ai_insight is None) == (x.drift_severity == "watch")
        assert x.ai_insight is None or x.ai_insight.endswith(" letters")


def test_listings(tables, log):
    assert tuple(r.list_log(log).columns) == r.LOG_COLUMNS and r.list_log(log).count() == 19
    for listing, frame, newest_first in (
        (r.list_drift, tables.drift, False),
        (r.list_alerts, tables.alerts, True),
        (r.list_insights, tables.insights, True),
    ):
        dates = [x.metric_date for x in listing(frame).collect()]
        assert dates == sorted((x.metric_date for x in frame.collect()), reverse=newest_first)
