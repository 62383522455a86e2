import datetime as dt
import random

import pytest
import seed
from pyspark.sql import functions as F

from tidewatch.operators.drift import DRIFT_COLUMNS, ALERT_COLUMNS, classify_drift, drift_alerts
from tidewatch.operators.rolling import rolling_stats, stage_metrics
from tidewatch.sources.schemas import RAW_METRICS


def metric_rows(values, metric="m", segment="s", start=dt.date(2024, 1, 1)):
    return [(start + dt.timedelta(days=i), metric, v, segment) for i, v in enumerate(values)]


def rolled(spark, rows, **options):
    return rolling_stats(stage_metrics(spark.createDataFrame(rows, RAW_METRICS)), **options)


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_staging(tables):
    rows = tables.staged.select("metric_date", "day_of_week", "is_weekend").distinct().collect()
    for row in rows:
        assert row.day_of_week == (row.metric_date.weekday() + 1) % 7
        assert row.is_weekend == (row.metric_date.weekday() >= 5)
    assert tables.staged.columns == [
        "metric_date", "metric_name", "metric_value", "segment", "day_of_week", "is_weekend"
    ]


def test_rolling_matches_plain_python(tables):
    expected = {
        (r["metric_date"], r["metric_name"], r["segment"]): r
        for r in seed.drift_by_hand(seed.rows())
    }
    rows = tables.rolling.collect()
    assert len(rows) == len(expected) == 542
    for row in rows:
        e = expected[row.metric_date, row.metric_name, row.segment]
        assert row.rolling_14d_count == e["n"]
        assert row.rolling_14d_avg == pytest.approx(e["avg"])
        assert row.rolling_14d_stddev == pytest.approx(e["std"])
        assert row.z_score == (None if e["z"] is None else pytest.approx(e["z"]))
    assert sum(r.z_score is None for r in rows) == 6 * 6 + 2


def test_classification_matches_plain_python(tables):
    expected = {
        (r["metric_date"], r["metric_name"], r["segment"]): r["severity"]
        for r in seed.drift_by_hand(seed.rows())
        if r["z"] is not None
    }
    rows = tables.drift.collect()
    assert tuple(tables.drift.columns) == DRIFT_COLUMNS
    assert {(r.metric_date, r.metric_name, r.segment): r.drift_severity for r in rows} == expected
    for r in rows:
        assert r.is_drift_alert == (r.drift_severity != "normal")
        direction = "above" if r.z_score > 0 else "below" if r.z_score < 0 else "on_target"
        assert r.drift_direction == direction
        change = (r.metric_value - r.rolling_14d_avg) / r.rolling_14d_avg * 100
        assert r.pct_deviation == pytest.approx(seed.half_up(change, 2))


def test_alert_context_counts_alerts_not_days(tables):
    assert tuple(tables.alerts.columns) == ALERT_COLUMNS
    series = {}
    for r in tables.alerts.orderBy("metric_date").collect():
        series.setdefault((r.metric_name, r.segment), []).append(r)
    assert series
    for alerts in series.values():
        for i, r in enumerate(alerts):
            previous = alerts[i - 1].metric_value if i else None
            assert r.prev_day_value == previous
            assert r.consecutive_alert_window == min(3, i + 1)
            if previous:
                change = (r.metric_value - previous) / previous * 100
                assert r.day_over_day_pct_change == pytest.approx(seed.half_up(change, 2))
            else:
                assert r.day_over_day_pct_change is None


def test_running_context(tables):
    running = drift_alerts(tables.drift, context="running").orderBy("metric_date").collect()
    numbers = {}
    for r in running:
        key = (r.metric_name, r.segment)
        numbers[key] = numbers.get(key, 0) + 1
        assert r.consecutive_alert_window == numbers[key]
        if r.prev_day_value:
            change = (r.metric_value - r.prev_day_value) / abs(r.prev_day_value) * 100
            assert r.day_over_day_pct_change == pytest.approx(seed.half_up(change, 2))


def test_prior_baseline(spark):
    rng = random.Random(3)
    values = [rng.uniform(5, 9) for _ in range(40)] + [4.0] * 20
    rows = rolled(spark, metric_rows(values), baseline="prior").orderBy("metric_date").collect()
    assert len(rows) == 60 - 14
    for i, row in enumerate(rows, start=14):
        frame = values[i - 14 : i]
        average = sum(frame) / 14
        deviation = (sum((v - average) ** 2 for v in frame) / 14) ** 0.5
        assert row.rolling_14d_avg == pytest.approx(average)
        if len(set(frame)) == 1:
            assert row.rolling_14d_stddev == 0.0 and row.z_score == 0.0
        else:
            assert row.z_score == pytest.approx((values[i] - average) / deviation)


def test_small_inputs(spark):
    assert rolled(spark, []).count() == 0
    assert classify_drift(rolled(spark, [])).count() == 0
    one = rolled(spark, metric_rows([3.0])).first()
    assert one.rolling_14d_stddev is None and one.z_score is None
    seven = rolled(spark, metric_rows([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 9.0])).orderBy("metric_date").collect()
    assert [r.z_score is None for r in seven] == [True] * 6 + [False]
    constant = rolled(spark, metric_rows([0.1] * 20)).collect()
    assert {r.rolling_14d_stddev for r in constant} == {None, 0.0}
    assert all(r.z_score is None for r in constant)


def test_zero_average_and_zero_previous(spark):
    swing = [1.0, -1.0] * 7
    row = classify_drift(rolled(spark, metric_rows(swing))).where("metric_date = '2024-01-14'")
    assert row.first().rolling_14d_avg == 0.0 and row.first().pct_deviation is None

    drift = spark.createDataFrame(
        [(dt.date(2024, 1, d), "m", "s", v, 1.0, 2.5, "warning", "above", 1.0, False, True)
         for d, v in ((1, 0.0), (2, 5.0))],
        "metric_date date, metric_name string, segment string, metric_value double, "
        "rolling_14d_avg double, z_score double, drift_severity string, drift_direction string, "
        "pct_deviation double, is_weekend boolean, is_drift_alert boolean",
    )
    second = drift_alerts(drift).where("metric_date = '2024-01-02'").first()
    assert second.prev_day_value == 0.0 and second.day_over_day_pct_change is None


@pytest.mark.parametrize(
    "z, expected", [(1.5, "watch"), (-2.0, "warning"), (3.0, "critical"), (1.4999, "normal")]
)
def test_bounds_are_inclusive(spark, z, expected):
    frame = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "m", "s", 1.0, 1.0, 1.0, z, False)],
        "metric_date date, metric_name string, segment string, metric_value double, "
        "rolling_14d_avg double, rolling_14d_stddev double, z_score double, is_weekend boolean",
    )
    assert classify_drift(frame).first().drift_severity == expected


@pytest.mark.parametrize("chunk", ["day", "month", "year"])
@pytest.mark.parametrize("baseline", ["inclusive", "prior"])
def test_chunked_series_give_the_same_result(spark, chunk, baseline):
    rng = random.Random(11)
    rows = []
    for s in range(6):
        day = 0
        for _ in range(150):
            day += rng.choice([0, 1, 1, 2, 40] if s % 2 else [1])
            value = rng.choice([None, rng.uniform(0, 100)]) if s == 3 else rng.uniform(0, 100)
            rows.append((dt.date(2022, 1, 1) + dt.timedelta(days=day), f"m{s}", value, "s"))
        rows += [(None, f"m{s}", float(n), "s") for n in range(3)]
    staged = stage_metrics(spark.createDataFrame(rows, RAW_METRICS)).cache()
    whole = rolling_stats(staged, baseline=baseline)
    assert same_rows(whole, rolling_stats(staged, baseline=baseline, chunk=chunk))
    drift = classify_drift(whole)
    assert same_rows(drift_alerts(drift), drift_alerts(drift, chunk=chunk))


@pytest.mark.parametrize("chunk_rows", [1, 30])
@pytest.mark.parametrize("baseline", ["inclusive", "prior"])
def test_busy_dates_are_cut_with_the_same_result(spark, baseline, chunk_rows):
    rng = random.Random(31)
    rows = []
    for s in range(4):
        for i in range(60):
            date = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            n = {0: 1, 1: rng.choice([1, 2, 40]), 2: 700 if i == 20 else 1, 3: 25}[s]
            segment = None if s == 3 else "s"
            rows += [(date, f"m{s}", rng.choice([None, rng.gauss(0, 1)]), segment) for _ in range(n)]
    staged = stage_metrics(spark.createDataFrame(rows, RAW_METRICS)).cache()
    whole = rolling_stats(staged, baseline=baseline)
    cut = rolling_stats(staged, baseline=baseline, chunk="month", chunk_rows=chunk_rows)
    assert cut.columns == whole.columns
    assert same_rows(whole, cut)
    drift = classify_drift(whole).cache()
    assert same_rows(
        drift_alerts(drift), drift_alerts(drift, chunk="month", chunk_rows=chunk_rows)
    )


@pytest.mark.parametrize("chunk", [None, "day"])
@pytest.mark.parametrize("baseline", ["inclusive", "prior"])
def test_merged_copies_give_the_same_result(spark, monkeypatch, chunk, baseline):
    from tidewatch.operators import frames

    monkeypatch.setattr(frames, "REPEAT_BLOCK", 50)  # so that long runs are cut
    rng = random.Random(23)
    rows = []
    for s in range(4):
        for i in range(40):
            date = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            value = rng.choice([1.0, 2.0, 7.5, None])
            n = {0: 1, 1: rng.choice([1, 13, 14, 15, 16]), 2: 300 if i == 20 else 1, 3: 2}[s]
            rows += [(date, f"m{s}", value, "s")] * n
            if s == 3:
                rows += [(date, "m3", rng.uniform(0, 9), "s")] * rng.choice([1, 30])
    staged = stage_metrics(spark.createDataFrame(rows, RAW_METRICS)).cache()
    whole = rolling_stats(staged, baseline=baseline)
    merged = rolling_stats(staged, baseline=baseline, chunk=chunk, copies="merged")
    assert merged.columns == whole.columns
    # running sums over equal values may differ in the last bits between frames
    def rounded(df):
        return df.select(
            *(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes)
        )
    assert merged.count() == len(rows) - (0 if baseline == "inclusive" else 4 * 14)
    assert same_rows(rounded(whole), rounded(merged))


def test_rolling_and_context_share_one_shuffle(raw, spark):
    from tidewatch.plans.drift_plan import drift_tables

    fresh = raw.where("segment is not null")  # not the frames that other tests have cached
    plan = drift_tables(fresh).alerts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Window ") == 2
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
