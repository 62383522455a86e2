import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import checks as c
from tidewatch.operators.suite import Suite, run_checks
from tidewatch.plans.drift_plan import drift_tables, measure_rebuild, rebuild_drift_tables
from tidewatch.sources.metrics import daily_metrics, mean, rows, total
from tidewatch.sources.schemas import RAW_METRICS
from tidewatch.sources.tables import append_measurements, read_measurements, read_metrics_csv

AT = dt.datetime(2026, 4, 18, 8)


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_csv(spark, raw, tmp_path):
    raw.coalesce(2).write.option("header", True).csv(str(tmp_path / "raw"))
    loaded = read_metrics_csv(spark, str(tmp_path / "raw"))
    assert loaded.schema == RAW_METRICS
    assert same_rows(loaded, raw)


def test_rebuild(raw, tmp_path):
    lazy = drift_tables(raw)
    for _ in range(2):  # a rebuild replaces the tables
        stored = rebuild_drift_tables(raw, str(tmp_path))
    for name in ("drift", "alerts", "insights"):
        assert same_rows(getattr(stored, name), getattr(lazy, name)), name


def test_history(spark, tables, tmp_path):
    path = str(tmp_path / "history")
    assert read_measurements(spark, path).count() == 0
    suite = Suite("DB", "S", "STAGED", (c.row_count.on(), c.minimum.on("metric_value")))
    run = run_checks(tables.staged, suite, AT)
    append_measurements(run, path)
    append_measurements(run, path)
    assert read_measurements(spark, path).count() == 4
    assert read_measurements(spark, path, "STAGED").count() == 4
    assert read_measurements(spark, path, "OTHER").count() == 0
    for _ in range(2):  # a repeated batch replaces itself
        append_measurements(run, path, batch_id=7)
    append_measurements(run, path, batch_id=8)
    assert read_measurements(spark, path).count() == 8


def test_daily_metrics(spark):
    day = dt.datetime(2024, 1, 1, 12)
    frame = spark.createDataFrame(
        [(day, "a", 0.1), (day, "a", 0.2), (day, "b", 1.0), (day, None, 5.0),
         (day + dt.timedelta(days=1), "a", None)],
        "ts timestamp_ntz, kind string, amount double",
    )
    got = {
        (r.metric_date.day, r.metric_name, r.segment): r.metric_value
        for r in daily_metrics(
            frame, "ts", "kind",
            {"amount": total("amount", 2), "events": rows(), "mean_amount": mean("amount", 2)},
        ).collect()
    }
    assert got == {
        (1, "amount", "a"): 0.3, (1, "events", "a"): 2, (1, "mean_amount", "a"): 0.15,
        (1, "amount", "b"): 1.0, (1, "events", "b"): 1, (1, "mean_amount", "b"): 1.0,
        (1, "amount", None): 5.0, (1, "events", None): 1, (1, "mean_amount", None): 5.0,
        (1, "amount", "all"): 6.3, (1, "events", "all"): 4, (1, "mean_amount", "all"): 1.575,
        (2, "amount", "a"): None, (2, "events", "a"): 1, (2, "mean_amount", "a"): None,
        (2, "amount", "all"): None, (2, "events", "all"): 1, (2, "mean_amount", "all"): None,
    }
    alone = daily_metrics(frame, "ts", "kind", {"events": rows()}, total_segment=None)
    assert alone.count() == 4


def test_sums_are_exact_in_any_order(spark):
    rng = random.Random(9)
    cents = [rng.randrange(-10**12, 10**12) for _ in range(4000)] + [9 * 10**17] * 30
    day = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame([(day, "a", c / 100) for c in cents], "ts timestamp_ntz, k string, v double")
    expected = sum(round(c / 100 * 100) for c in cents) / 100
    for parts in (1, 7):
        got = daily_metrics(frame.repartition(parts), "ts", "k", {"v": total("v", 2)}, None).first()
        assert got.metric_value == expected


def test_amounts_are_not_rounded_unless_asked(spark):
    day = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [(day, "a", 0.019, "0.0000000000001"), (day, "a", 0.021, "99999999999999999.1"), (day, "a", 0.004, None)],
        "ts timestamp_ntz, k string, v double, w string",
    ).withColumn("w", F.col("w").cast("decimal(38,13)"))
    got = {
        r.metric_name: r.metric_value for r in daily_metrics(
            frame, "ts", "k", {"mean": mean("v"), "sum": total("w"), "cents": mean("v", 2)}, None
        ).collect()
    }
    assert abs(got["mean"] - 0.044 / 3) < 1e-15 and got["sum"] == 99999999999999999.1
    assert abs(got["cents"] - 0.04 / 3) < 1e-15


def test_odd_amounts_give_a_result(spark):
    day = dt.datetime(2024, 1, 1)
    rows_ = [(day, "nan", float("nan")), (day, "nan", 1.0), (day, "big", 1e17), (day, "big", 0.5)]
    frame = spark.createDataFrame(rows_, "ts timestamp_ntz, k string, v double")
    for scale in (None, 2):
        got = {r.segment: r.metric_value for r in daily_metrics(
            frame, "ts", "k", {"v": total("v", scale)}, None).collect()}
        assert math.isnan(got["nan"]) and got["big"] == 1e17 + 0.5


def test_a_segment_named_like_the_total_is_refused(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1), "all")], "ts timestamp_ntz, k string")
    with pytest.raises(Exception, match="named 'all' like the total"):
        daily_metrics(frame, "ts", "k", {"n": rows()}).collect()
    assert daily_metrics(frame, "ts", "k", {"n": rows()}, total_segment="sum").count() == 2


def test_batches_replace_only_themselves(spark, tables, tmp_path):
    path = str(tmp_path / "history")
    suites = [Suite("DB", s, t, (c.row_count.on(),)) for s, t in (("S", "A"), ("S", "B"), ("OTHER", "A"))]
    late, later = dt.datetime(2026, 4, 18, 23, 59), dt.datetime(2026, 4, 19, 0, 1)
    for suite in suites:
        append_measurements(run_checks(tables.staged, suite, late), path, batch_id=0)
    append_measurements(run_checks(tables.staged, suites[0], late), path, batch_id=0, monitor="second")
    append_measurements(run_checks(tables.staged, suites[0], later), path, batch_id=0)  # across midnight
    history = read_measurements(spark, path)
    assert history.count() == 4
    one = read_measurements(spark, path, "A", "S", "DB").where("monitor = 'default'").collect()
    assert [(r.measurement_time, r.measured_date) for r in one] == [(later, late.date())]
    assert read_measurements(spark, path, "A", "OTHER", "DB").count() == 1
    pruned = read_measurements(spark, path, dates=(later.date(), later.date()))
    assert pruned.count() == 0
    assert "PartitionFilters: [isnotnull(measured_date" in pruned._jdf.queryExecution().toString()


def test_a_rebuilt_table_is_measured_as_it_is(spark, raw, tmp_path):
    suite = Suite("DB", "MARTS", "DRIFT", (c.row_count.on(), c.duplicate_count.on("metric_date", "metric_name", "segment")))
    history, wanted = str(tmp_path / "history"), None
    for rebuild in (1, 2, 2):
        drift = rebuild_drift_tables(raw, str(tmp_path / "marts")).drift
        measure_rebuild([(suite, drift)], history, rebuild, AT)
        wanted = drift.count()
    got = read_measurements(spark, history).collect()
    assert sorted((r.batch_id, r.metric_name, r.value) for r in got) == [
        (k, name, value) for k in (1, 2) for name, value in (("DUPLICATE_COUNT", 0), ("ROW_COUNT", wanted))
    ]


def test_age_is_taken_when_measured(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 4, 1),)], "ts timestamp_ntz")
    suite = Suite("DB", "S", "T", (c.freshness.on("ts"),))
    ages = [run_checks(frame, suite, AT + dt.timedelta(hours=h)).first().value for h in (0, 1)]
    assert ages[1] - ages[0] == 3600
