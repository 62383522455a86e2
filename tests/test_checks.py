import datetime as dt
import random
import statistics

import pytest
import seed
from pyspark.sql import functions as F

from tidewatch.operators import checks as c
from tidewatch.operators.expectations import expect_accepted_values, expect_not_null
from tidewatch.operators.suite import Suite, run_checks, run_checks_by_date
from tidewatch.plans.default_suites import EXPECTATIONS, drift_suite, raw_suite, rolling_suite

AT = dt.datetime(2026, 4, 18, 8)


def values(df, *bindings):
    suite = Suite("DB", "S", "T", bindings)
    return [r.value for r in run_checks(df, suite, AT).collect()]


def one(df, binding):
    (value,) = values(df, binding)
    return value


def dated(spark, rows):
    return spark.createDataFrame(rows, "d date, v double")


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_default_suites(tables):
    at = AT
    got = {
        (r.metric_name, r.columns): r.value
        for r in run_checks(tables.staged, raw_suite(at), at).collect()
    }
    assert got == {
        ("NULL_COUNT", "metric_value"): 0,
        ("ROW_COUNT", ""): 542,
        ("FRESHNESS", "metric_date"): 13 * 86400 + 8 * 3600,
        ("MIN", "metric_value"): -500,
        ("MAX", "metric_value"): 61000,
        ("CARDINALITY_METRIC_NAME", "metric_name"): 4,
        ("CONVERSION_RATE_VALID", "metric_name,metric_value"): 1,
        ("REVENUE_NON_NEGATIVE", "metric_name,metric_value"): 1,
        ("ACTIVE_USERS_POSITIVE", "metric_name,metric_value"): 1,
        ("DATE_GAPS", "metric_date"): 1,
    }
    got = {
        (r.metric_name, r.columns): r.value
        for r in run_checks(tables.drift, drift_suite(), at).collect()
    }
    rows = tables.drift.select("metric_date", "metric_value").collect()
    newest = max(r.metric_date for r in rows)
    earlier = [r.metric_value for r in rows if r.metric_date < newest]
    latest = [r.metric_value for r in rows if r.metric_date == newest]
    shift = (statistics.mean(latest) - statistics.mean(earlier)) / statistics.stdev(earlier)
    assert got.pop(("MEAN_DRIFT", "metric_date,metric_value")) == pytest.approx(round(shift, 4))
    assert got == {
        ("NULL_COUNT", "z_score"): 0,
        ("NULL_COUNT", "drift_severity"): 0,
        ("DUPLICATE_COUNT", "metric_date,metric_name,segment"): 0,
        ("VOLUME_ANOMALY", "metric_date"): 0,
        ("SEVERITY_VALID", "drift_severity"): 0,
        ("ZSCORE_PLAUSIBLE", "z_score"): 0,
        ("Z_SCORE_READINESS", "z_score"): 0,
        ("DATE_GAPS", "metric_date"): 1,
    }
    assert [r.value for r in run_checks(tables.rolling, rolling_suite(), at).collect()] == [38]


def test_one_scan_for_row_and_series_checks(spark, tmp_path, tables):
    path = str(tmp_path / "drift")
    tables.drift.write.parquet(path)
    suite = drift_suite()
    shared = Suite(
        "DB", "S", "T", tuple(b for b in suite.bindings if not isinstance(b.check, c.KeyedCheck))
    )
    plan = run_checks(spark.read.parquet(path), shared, AT)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1
    assert "pct_deviation" not in plan.toString()


def test_empty_table(spark):
    empty = dated(spark, [])
    assert values(
        empty, c.row_count.on(), c.null_count.on("v"), c.minimum.on("v"), c.volume_anomaly.on("d"),
        c.mean_drift.on("d", "v"), c.date_gaps.on("d"), c.cardinality.on("v"),
        c.duplicate_count.on("d", "v"),
    ) == [0, 0, None, None, None, 0, 0, 0]
    assert one(empty, c.row_count.on()) == 0


def test_one_date(spark):
    frame = dated(spark, [(day(0), 1.0), (day(0), 2.0)])
    assert values(frame, c.volume_anomaly.on("d"), c.mean_drift.on("d", "v"),
                  c.date_gaps.on("d")) == [0, None, 0]


def test_volume_anomaly(spark):
    counts = [10, 11, 9, 10, 12, 8, 10]
    rows = [(day(i), 1.0) for i, n in enumerate(counts) for _ in range(n)]
    usual = [(day(7), 1.0)] * 10
    assert one(dated(spark, rows + usual), c.volume_anomaly.on("d")) == 0
    assert one(dated(spark, rows + usual * 3), c.volume_anomaly.on("d")) == 1
    # without variation there is nothing to compare with
    level = [(day(i), 1.0) for i in range(5)] + [(day(5), 1.0)] * 50
    assert one(dated(spark, level), c.volume_anomaly.on("d")) == 0
    assert one(dated(spark, rows + usual * 3 + [(None, 1.0)] * 99), c.volume_anomaly.on("d")) == 1


def test_mean_drift(spark):
    rng = random.Random(5)
    for level in (0.0, 1e9):  # far from zero, squares must not cancel
        rows = [(day(i), level + rng.gauss(0, 1)) for i in range(20) for _ in range(i % 4)]
        rows += [(day(30), level + 2.0), (day(30), level + 3.0), (day(30), None), (day(3), None)]
        earlier = [v for d, v in rows if d < day(30) and v is not None]
        shift = (level + 2.5 - statistics.mean(earlier)) / statistics.stdev(earlier)
        got = one(dated(spark, rows), c.mean_drift.on("d", "v"))
        assert got == pytest.approx(shift, abs=1e-4)
    constant = [(day(i), 0.1) for i in range(9) for _ in range(3)] + [(day(9), 7.0)]
    assert one(dated(spark, constant), c.mean_drift.on("d", "v")) is None
    no_newest = [(day(0), 1.0), (day(1), 2.0), (day(2), None)]
    assert one(dated(spark, no_newest), c.mean_drift.on("d", "v")) is None


def test_date_gaps(spark):
    rows = [(day(i), 1.0) for i in (0, 0, 1, 1, 4, 5, 9)] + [(None, 1.0)]
    assert one(dated(spark, rows), c.date_gaps.on("d")) == 2


def test_duplicates_and_cardinality(spark):
    frame = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 1), (None, 2), (None, 2), ("b", None)], "k string, n int"
    )
    assert one(frame, c.duplicate_count.on("k", "n")) == 3
    assert one(frame, c.cardinality.on("k")) == 2
    assert one(frame, c.cardinality.on("k", approximate=True)) == 2


def test_keyed_checks_share_a_shuffle(spark):
    frame = spark.createDataFrame(
        [("a", 1, 0.0, None), ("a", 1, -0.0, b"x"), ("a", 1, float("nan"), None), (None, 2, 1.0, b"x"),
         (None, 2, None, b"y"), ("b", None, float("nan"), b"y"), ("1", 1, 1.0, None)],
        "k string, n int, v double, b binary",
    )
    bindings = (
        c.duplicate_count.on("k", "n"), c.duplicate_count.on("n", "k"), c.cardinality.on("k"),
        c.cardinality.on("n"), c.duplicate_count.on("v"), c.cardinality.on("v"), c.cardinality.on("b"),
        c.duplicate_count.on("b", "v"), c.cardinality.on("k", approximate=True),
    )
    together = values(frame, *bindings)
    assert together == [one(frame, b) for b in bindings]
    assert together[:6] == [3, 3, 3, 2, 3, 3]
    assert values(frame.limit(0), *bindings) == [0] * 9
    suite = Suite("DB", "S", "T", bindings[:8])
    plan = run_checks(frame, suite, dt.datetime(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("hashpartitioning(binding") <= 2


def test_several_date_columns(spark):
    rows = [(day(i), day(2 * i) if i % 5 else None, float(i % 3)) for i in range(12) for _ in range(1 + i % 2)]
    frame = spark.createDataFrame(rows, "d date, e date, v double")
    bindings = (
        c.date_gaps.on("d"), c.date_gaps.on("e"), c.volume_anomaly.on("e"), c.volume_anomaly.on("d"),
        c.mean_drift.on("e", "v"), c.mean_drift.on("d", "v"), c.row_count.on(), c.null_count.on("e"),
        c.minimum.on("v"), c.maximum.on("v"), c.freshness.on("e", as_of=dt.datetime(2024, 6, 1)),
    )
    together = values(frame, *bindings)
    assert together == [one(frame, b) for b in bindings]
    assert together[:2] == [0, 8] and together[6:8] == [18, 4]
    assert values(frame.limit(0), *bindings)[:4] == [0, 0, None, None]
    plan = run_checks(frame, Suite("DB", "S", "T", bindings), dt.datetime(2024, 1, 1))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_partials_of_parts_merge(spark):
    rng = random.Random(3)
    rows = [(day(i % 9), 1e6 + rng.gauss(0, 1) if i % 7 else None, day(i % 4), i % 6) for i in range(200)]
    frame = spark.createDataFrame([*rows, (None, 5.0, None, None)], "d date, v double, e date, part int")
    checks = (
        c.row_count.on(), c.null_count.on("v"), c.minimum.on("v"), c.maximum.on("v"), c.volume_anomaly.on("d"),
        c.mean_drift.on("d", "v"), c.date_gaps.on("d"), c.freshness.on("d", as_of=dt.datetime(2024, 6, 1)),
    )
    at = F.lit(dt.datetime(2024, 1, 1))
    for bindings in (checks, (*checks, c.date_gaps.on("e"), c.mean_drift.on("e", "v")), checks[:4]):
        suite = Suite("DB", "S", "T", bindings)
        whole = suite.measure(suite.partials(frame), at).first()
        merged = suite.measure(suite.merged(suite.partials(frame, by=["part"])), at).first()
        assert list(merged) == pytest.approx(list(whole), abs=1e-4)


def test_nulls_are_no_violations(spark):
    frame = spark.createDataFrame([("x",), (None,), ("y",)], "s string")
    assert one(frame, c.accepted_values.on("s", accepted=["x"])) == 1
    numbers = spark.createDataFrame([("m", None), ("m", -1.0), ("n", -1.0)], "k string, v double")
    assert values(
        numbers, c.non_negative.on("k", "v", metric="m"), c.positive.on("k", "v", metric="m"),
        c.value_range.on("k", "v", metric="m", low=0, high=1), c.abs_bound.on("v", bound=0.5),
        c.readiness.on("v"),
    ) == [1, 1, 1, 2, 1]


def test_own_checks(spark):
    frame = dated(spark, [(day(0), 1.0), (day(0), 5.0), (day(1), 9.0)])

    @c.row_check("TEST_OVER", ["value"])
    def over(value, limit):
        return F.count_if(value > limit)

    @c.keyed_check("TEST_BUSIEST_DAY", ["day"])
    def busiest(df):
        return df.groupBy("day").count().agg(F.max("count").alias("value"))

    try:
        bound = (over.on("v", limit=2), over.on("v", limit=6, name="TEST_FAR_OVER"),
                 busiest.on("d"))
        assert values(frame, *bound) == [2, 1, 2]
        with pytest.raises(ValueError):
            c.row_check("TEST_OVER", ["value"])(over.partial)
        with pytest.raises(ValueError):
            over.on("v", "d", limit=2)
    finally:
        del c.REGISTRY["TEST_OVER"], c.REGISTRY["TEST_BUSIEST_DAY"]


def test_checks_with_types_and_sql(spark):
    frame = dated(spark, [(day(0), 1.0), (day(0), 5.0), (day(1), 9.0), (None, None)])
    frame = frame.selectExpr("*", "cast(v as int) as n", "string(v) as s", "cast(v as decimal(9,2)) as e")

    @c.row_check("TEST_OVER", {"value": "double"})
    def over(value, limit):
        return F.count_if(value > limit)

    @c.series_check("TEST_HIGHEST_MEAN", {"date": "date", "value": "double"},
                    finish=lambda p: F.max(p("mean")), merge=lambda p: {"mean": F.max(p("mean"))})
    def highest_mean(value):
        return {"mean": F.avg(value)}

    over_sql = c.sql_check("TEST_SQL", {"value": "double"}, "select count(*) from {arg_t} where value > :limit")
    none = c.sql_check("TEST_NONE", {"value": "decimal(14,3)"}, "select value from {arg_t} where value > 100")
    many = c.sql_check("TEST_MANY", {"value": "bigint"}, "select value from {arg_t}")
    words = c.sql_check("TEST_WORDS", {"value": "string"}, "select max(value) from {arg_t}")
    wide = c.sql_check("TEST_WIDE", {"value": "double"}, "select max(value), min(value) from {arg_t}")
    quoted = c.sql_check("TEST_QUOTED", {"value": "string"}, "select count_if(value = '9.0') from {arg_t}")
    try:
        for column in ("v", "n", "e"):
            assert values(frame, over.on(column, limit=2), over_sql.on(column, limit=2)) == [2, 2]
        together = (highest_mean.on("d", "v"), c.row_count.on(), none.on("n"), over_sql.on("v", limit=6))
        assert values(frame, *together) == [9, 4, None, 1]
        assert one(frame, highest_mean.on("d", "n")) == 9 and one(frame, none.on("e")) is None
        assert one(frame, quoted.on("s")) == 1 and one(frame, over_sql.on("v", limit=6)) == 1
        assert one(frame.limit(0), over_sql.on("v", limit=6)) == 0
        for wrong in (over.on("s", limit=2), over_sql.on("d", limit=2), highest_mean.on("d", "s"),
                      highest_mean.on("v", "v"), many.on("e"), none.on("v"), words.on("s"), words.on("v")):
            with pytest.raises(TypeError):
                values(frame, wrong)
        with pytest.raises(Exception, match="SUBQUERY"):
            values(frame, many.on("n"))
        with pytest.raises(Exception, match="(?i)column"):
            values(frame, wide.on("v"))
    finally:
        for name in [n for n in c.REGISTRY if n.startswith("TEST_")]:
            del c.REGISTRY[name]


def test_by_date(spark):
    frame = dated(spark, [(day(0), 1.0), (day(0), None), (day(1), 9.0)])
    suite = Suite("DB", "S", "T", (c.row_count.on(), c.null_count.on("v")))
    at = F.expr("cast(__date as timestamp_ntz) + interval 8 hours")
    got = {
        (r.measurement_time, r.metric_name): r.value
        for r in run_checks_by_date(frame, suite, "d", at).collect()
    }
    eight = dt.time(8)
    assert got == {
        (dt.datetime.combine(day(0), eight), "ROW_COUNT"): 2,
        (dt.datetime.combine(day(0), eight), "NULL_COUNT"): 1,
        (dt.datetime.combine(day(1), eight), "ROW_COUNT"): 1,
        (dt.datetime.combine(day(1), eight), "NULL_COUNT"): 0,
    }


def test_freshness_ignores_the_session_zone(spark):
    frame = spark.sql("select timestamp_ntz'2024-03-30 12:00:00' as ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # clocks change on the 31st
        assert one(frame, c.freshness.on("ts", as_of=dt.datetime(2024, 4, 1, 12))) == 2 * 86400
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_expectations(tables):
    columns, accepted = EXPECTATIONS["staged"]
    assert [r.failing_rows for r in expect_not_null(tables.staged, *columns).collect()] == [0] * 3
    for column, allowed in accepted.items():
        assert expect_accepted_values(tables.staged, column, allowed).isEmpty()
    wrong = expect_accepted_values(tables.staged, "metric_name", ("revenue", "sessions"))
    assert {r.value_field: r.n_records for r in wrong.collect()} == {
        "conversion_rate": 180, "active_users": 180
    }
    assert expect_not_null(tables.rolling, "z_score").first().failing_rows == 38
    assert len(seed.rows()) == 542
