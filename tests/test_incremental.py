import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.expectations import ExpectationError, Watch
from tidewatch.plans.default_suites import EXPECTATIONS
from tidewatch.plans.drift_plan import drift_tables, rebuild_drift_tables
from tidewatch.plans.incremental import LateRows, append_drift_tables, read_appended
from tidewatch.operators.drift import drift_alerts


def same_rows(a, b):
    assert a.columns == b.columns
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def between(raw, first, end):
    return raw.where((F.col("metric_date") >= first) & (F.col("metric_date") < end))


DAYS = ["2026-01-01", "2026-01-05", "2026-02-14", "2026-02-15", "2026-03-06", "2027-01-01"]


def test_batches_equal_a_rebuild(spark, raw, tables, tmp_path):
    folder = str(tmp_path)
    # a null segment, a repeated date, and a series that begins late
    more = spark.createDataFrame(
        [(dt.date(2026, 1, 1) + dt.timedelta(days=k // 2), "extra", float(k % 11 and k * (-1) ** k), None)
         for k in range(90)] + [(dt.date(2026, 3, 1 + k), "late", float(k), "x") for k in range(25)],
        raw.schema,
    )
    everything = raw.unionByName(more)
    whole = drift_tables(everything)
    for batch, (first, end) in enumerate(zip(DAYS, DAYS[1:])):
        rows = between(everything, first, end)
        append_drift_tables(rows, folder, batch)
        if batch == 2:
            with pytest.raises(LateRows):
                append_drift_tables(rows, folder, batch + 1)
            append_drift_tables(rows, folder, batch)  # the last one again, in place
            with pytest.raises(ValueError, match="only the last"):
                append_drift_tables(rows, folder, batch - 1)
    for name in ("drift", "alerts", "insights"):
        assert same_rows(read_appended(spark, folder, name), getattr(whole, name))
    with pytest.raises(ValueError, match="no table"):
        read_appended(spark, folder, "other")


def test_running_context_and_a_batch_that_was_killed(spark, raw, tables, tmp_path, monkeypatch):
    folder = str(tmp_path)
    append_drift_tables(between(raw, DAYS[0], DAYS[2]), folder, 0, context="running")
    alerts = read_appended(spark, folder, "alerts").count()

    def killed(prompts):
        raise KeyboardInterrupt

    with pytest.raises(Exception):
        append_drift_tables(between(raw, DAYS[2], DAYS[4]), folder, 1, killed, context="running")
    assert read_appended(spark, folder, "alerts").count() == alerts  # not complete, not seen
    append_drift_tables(between(raw, DAYS[2], DAYS[4]), folder, 1, context="running")
    append_drift_tables(between(raw, DAYS[4], DAYS[5]), folder, 2, context="running")
    assert same_rows(read_appended(spark, folder, "alerts"), drift_alerts(tables.drift, context="running"))


def test_only_the_batch_and_the_tails_are_read(spark, raw, tmp_path):
    folder = tmp_path / "marts"
    append_drift_tables(between(raw, DAYS[0], DAYS[3]), str(folder), 0)
    for name in ("drift", "alerts", "insights"):
        for file in folder.glob(f"{name}/batch=0/*.parquet"):
            file.write_bytes(b"unreadable")
    append_drift_tables(between(raw, DAYS[3], DAYS[5]), str(folder), 1)
    tail = spark.read.parquet(str(folder / "tails/batch-1"))
    assert tail.groupBy("metric_name", "segment").count().agg(F.max("count")).first()[0] == 13


def test_expectations_are_counted_as_tables_are_written(spark, raw, tmp_path):
    watch = Watch(EXPECTATIONS | {"rolling": (("z_score",), {})})
    rebuilt = rebuild_drift_tables(raw, str(tmp_path), watch=watch)
    found = {(t, c, kind): n for t, c, kind, n in watch.rows()}
    assert found.pop(("rolling", "z_score", "not_null")) == 38
    assert set(found.values()) == {0} and len(found) == 9
    with pytest.raises(ExpectationError, match="rolling.z_score not_null: 38 rows"):
        watch.require()
    assert watch.results(spark).count() == 10 and rebuilt.drift.count() == 542 - 38
    strict = Watch({"alerts": (("prev_day_value",), {"drift_severity": ("critical",)})})
    rebuild_drift_tables(raw, str(tmp_path / "again"), watch=strict)
    alerts = rebuilt.alerts
    assert {(c, n) for _, c, _, n in strict.rows()} == {
        ("prev_day_value", alerts.where("prev_day_value is null").count()),
        ("drift_severity", alerts.where("drift_severity <> 'critical'").count()),
    }
    fine = Watch({"drift": (("z_score",), {})})
    rebuild_drift_tables(raw, str(tmp_path / "third"), watch=fine)
    fine.require()
