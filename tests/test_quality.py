import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import health as h
from tidewatch.operators import quality as q
from tidewatch.operators.suite import run_checks
from tidewatch.plans.default_suites import drift_suite, raw_suite
from tidewatch.sources.schemas import MEASUREMENTS

AT = dt.datetime(2026, 4, 18, 8)
CUSTOM = {"conversion_rate_valid", "revenue_non_negative", "active_users_positive", "date_gaps"}


def measurement(name, value, at=AT, table="T", schema="RULES", columns=""):
    return (at, "DB", "S", table, "DB", schema, name, columns, value)


@pytest.fixture
def log_of(spark):
    def build(*rows, rules=q.DEFAULT_RULES):
        history = spark.createDataFrame(list(rows), MEASUREMENTS)
        return q.tag_check_type(q.quality_log(history, rules=rules))

    return build


@pytest.mark.parametrize(
    "name, value, status, note",
    [
        ("NULL_COUNT", 2.0, "fail", "2 NULL(s) detected in T"),
        ("NULL_COUNT", 0.0, "pass", "OK"),
        ("DUPLICATE_COUNT", 14168.0, "fail", "14168 duplicate row(s) in T"),
        ("ROW_COUNT", 0.0, "fail", "T has 0 rows — table appears empty"),
        ("ROW_COUNT", 5.0, "pass", "OK"),
        ("CONVERSION_RATE_VALID", 1.0, "fail", "1 conversion_rate value(s) outside [0, 1]"),
        ("dmf_revenue_non_negative", 3.0, "fail", "3 negative revenue row(s) detected"),
        ("ACTIVE_USERS_POSITIVE", 1.0, "fail", "1 active_users row(s) with value <= 0"),
        ("SEVERITY_VALID", 1.0, "fail", "OK"),
        ("ZSCORE_PLAUSIBLE", 1.0, "fail", "OK"),
        ("VOLUME_ANOMALY", 1.0, "fail",
         "Latest date row count is statistically anomalous (>2σ from mean)"),
        ("VOLUME_ANOMALY", 2.0, "pass", "OK"),
        ("DATE_GAPS", 12_000_000.0, "fail", "12000000 date gap(s) > 1 day detected in T"),
        ("CARDINALITY_METRIC_NAME", 4.0, "fail", "Expected 3 distinct metric names, found 4"),
        ("CARDINALITY_METRIC_NAME", 3.0, "pass", "OK"),
        ("Z_SCORE_READINESS", 38.0, "warn", "38 row(s) have NULL z_score (< 7 days history)"),
        ("MEAN_DRIFT", -2.5, "warn", "Mean drift z-score = -2.5 (|z| > 2)"),
        ("MEAN_DRIFT", 2.0, "pass", "OK"),
        ("MEAN_DRIFT", None, "pass", "OK"),
        ("CARDINALITY_METRIC_NAME", None, "pass", "OK"),
        ("SOMETHING_ELSE", 9.0, "pass", "OK"),
        ("FRESHNESS", 1e9, "pass", "OK"),
    ],
)
def test_rules(log_of, name, value, status, note):
    row = log_of(measurement(name, value)).first()
    assert (row.quality_status, row.quality_note) == (status, note)


def test_explained_rules(log_of):
    rows = log_of(
        measurement("SEVERITY_VALID", 2.0), measurement("ROW_COUNT", 0.0), rules=q.EXPLAINED_RULES
    ).collect()
    assert rows[0].quality_note == "2 row(s) with an unexpected severity in T"
    assert rows[1].quality_note.startswith("T has 0 rows")


def test_check_types(log_of):
    rows = log_of(
        *(measurement(n, 0.0, schema="CORE") for n in
          ("NULL_COUNT", "DUPLICATE_COUNT", "ROW_COUNT", "FRESHNESS", "MIN", "MAX")),
        measurement("MEAN_DRIFT", 0.0), measurement("MIN_LEVEL", 0.0),
    ).collect()
    assert [r.check_type for r in rows] == ["system"] * 6 + ["custom"] * 2


def test_several_histories_and_order(spark):
    old = spark.createDataFrame([measurement("ROW_COUNT", 1.0)], MEASUREMENTS)
    new = spark.createDataFrame(
        [measurement("ROW_COUNT", 0.0), measurement("Z_SCORE_READINESS", 1.0),
         measurement("ROW_COUNT", 2.0, AT + dt.timedelta(days=1))], MEASUREMENTS
    )
    log = q.order_log(q.quality_log(old, new.drop("columns")))
    assert [(r.quality_status, r.dmf_value) for r in log.collect()] == [
        ("fail", 0.0), ("warn", 1.0), ("pass", 2.0), ("pass", 1.0)
    ]


def test_filters(log_of):
    rows = [measurement("ROW_COUNT", float(n), dt.datetime(2024, 1, n, 23, 59)) for n in (1, 2, 3)]
    log = log_of(*rows, measurement("DATE_GAPS", 1.0, dt.datetime(2024, 1, 2)))
    assert q.filter_log(log).count() == 4
    assert q.filter_log(log, status="All", check_type="All").count() == 4
    assert q.filter_log(log, status="Fail").count() == 1
    assert q.filter_log(log, check_type="System").count() == 3
    days = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert q.filter_log(log, dates=days).count() == 3


def test_latest_takes_a_whole_row_and_the_worst_of_a_tie(log_of):
    log = log_of(
        measurement("NULL_COUNT", 1.0, AT - dt.timedelta(hours=1)),
        measurement("NULL_COUNT", 0.0, columns="a"),
        measurement("NULL_COUNT", 3.0, columns="b"),
        measurement("MEAN_DRIFT", 1.0, AT - dt.timedelta(hours=1)),
        measurement("MEAN_DRIFT", None),
        measurement("NULL_COUNT", 0.0, table="OTHER"),
    )
    latest = {(r.dmf_name, r.table_name): r for r in q.latest_status(log).collect()}
    assert len(latest) == 3
    assert latest["DB.RULES.NULL_COUNT", "T"].dmf_value == 3.0
    assert latest["DB.RULES.NULL_COUNT", "T"].columns == "b"
    assert latest["DB.RULES.MEAN_DRIFT", "T"].dmf_value is None
    by_column = q.latest_status(log, keys=("dmf_name", "table_name", "columns"))
    assert by_column.count() == 5


def test_value_trend(log_of):
    log = log_of(
        measurement("DATE_GAPS", 2.0, AT), measurement("DATE_GAPS", 0.0, AT - dt.timedelta(1)),
        measurement("MEAN_DRIFT", 2.0),
    )
    rows = q.check_value_trend(log, "DB.RULES.DATE_GAPS").collect()
    assert [r.dmf_value for r in rows] == [0.0, 2.0]
    assert {(r.check_label, r.threshold_label, r.threshold_value) for r in rows} == {
        ("date_gaps", "= 0 to pass", 0.0)
    }
    assert q.check_value_trend(log, "DB.RULES.MEAN_DRIFT").first().threshold_label is None


def test_health_of_one_run(tables):
    history = run_checks(tables.staged, raw_suite(AT), AT).unionByName(
        run_checks(tables.drift, drift_suite(), AT)
    )
    log = q.tag_check_type(q.quality_log(history)).cache()
    assert h.health_score(log).first().asDict() == {
        "score": 52, "grade": "D", "status_label": "Degraded", "total_checks": 18,
        "passing": 12, "warnings": 0, "failures": 6, "deduction": 48.0,
    }
    breakdown = h.health_breakdown(log).collect()
    assert [r.deduction for r in breakdown] == [8.0] * 6 + [0.0] * 12
    assert [r.dmf_name for r in breakdown[:6]] == sorted(r.dmf_name for r in breakdown[:6])


def test_health_of_an_empty_log(log_of):
    row = h.health_score(log_of()).first()
    assert (row.score, row.grade, row.status_label, row.total_checks) == (100, "A", "No Data", 0)
    assert h.score_history(log_of()).count() == 0
    assert h.health_breakdown(log_of()).count() == 0


def test_weights_and_clamp(spark):
    def log(*rows):
        return spark.createDataFrame(
            [(AT, f"C{i}", "T", "ct" if t is None else t, s, 0.0, "n")
             for i, (s, t) in enumerate(rows)],
            "measured_at timestamp_ntz, dmf_name string, table_name string, check_type string, "
            "quality_status string, dmf_value double, quality_note string",
        )

    def score(*rows):
        return h.health_score(log(*rows)).first()

    assert score(("fail", "system"), ("warn", "system"), ("warn", "custom")).deduction == 17.0
    assert score(("fail", None), ("odd", "system")).deduction == 8.0
    assert score(*[("fail", "system")] * 20).score == 0
    grades = {0: "A", 1: "B", 2: "C", 4: "D", 7: "F"}
    for failures, grade in grades.items():
        rows = [("fail", "custom")] * failures + [("pass", "custom")]
        assert score(*rows).grade == grade
    half = h.health_score(log(("warn", "custom")), deductions={"warn": 2.5}).first()
    assert half.score == 98  # 97.5 rounds to the even neighbour


def test_own_rules_and_missing_types(spark, log_of):
    rules = (q.Rule("%my_check%", "v < 0 or v > 5", "warn", "{value} in {table}"),)
    log = log_of(measurement("MY_CHECK", 9.0), measurement("OTHER", -1.0), rules=rules)
    assert [(r.quality_status, r.quality_note) for r in log.collect()] == [
        ("warn", "9 in T"), ("pass", "OK")
    ]
    assert h.health_score(log.drop("check_type")).first().deduction == 2.0


def test_score_history_uses_each_day_alone(log_of):
    rows = []
    for n in range(30):
        at = dt.datetime(2026, 3, 20, 8) + dt.timedelta(days=n)
        for name in ("NULL_COUNT", "ROW_COUNT", *sorted(CUSTOM)):
            value = 1.0 if name == "ROW_COUNT" or (name in CUSTOM and n >= 25) else 0.0
            rows.append(measurement(name.upper(), value, at))
    history = h.score_history(log_of(*rows)).collect()
    assert [r.score for r in history] == [100] * 25 + [68] * 5
    assert [r.failures for r in history] == [0] * 25 + [4] * 5
    row = h.health_score(log_of(*rows)).first()
    assert (row.score, row.grade) == (68, "D")


def test_latest_status_needs_no_window(log_of):
    plan = q.latest_status(log_of(measurement("ROW_COUNT", 1.0)))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Window" not in text and "partial_max_by" in text


def test_date_filter_reaches_the_scan(log_of, spark, tmp_path):
    path = str(tmp_path / "log")
    log_of(measurement("ROW_COUNT", 1.0)).write.parquet(path)
    kept = q.filter_log(
        spark.read.parquet(path), status="pass", dates=(dt.date(2026, 1, 1), dt.date(2026, 2, 1))
    )
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(measured_at" in pushed and "EqualTo(quality_status" in pushed
    assert kept.agg(F.count("*")).first()[0] == 0
