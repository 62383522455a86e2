import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import checks as c
from tidewatch.operators.suite import Suite, run_checks
from tidewatch.plans.default_suites import drift_suite, raw_suite
from tidewatch.sources.tables import read_measurements
from tidewatch.streaming.table_monitor import TableMonitor, keep_measuring_table

AT = dt.datetime(2026, 4, 18, 8)


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def everything(date="metric_date"):
    """Row, series and keyed checks, with keys that files share."""
    return Suite(
        "DB", "S", "T",
        (
            c.row_count.on(), c.minimum.on("metric_value"), c.maximum.on("metric_value"),
            c.volume_anomaly.on(date), c.mean_drift.on(date, "metric_value"), c.date_gaps.on(date),
            c.null_count.on("is_weekend"), c.cardinality.on("segment"), c.duplicate_count.on("segment", "metric_value"),
            c.duplicate_count.on("metric_date", "metric_name"), c.cardinality.on("double_value"),
        ),
    )


def derived():
    return {"double_value": F.col("metric_value") * 2}


def written(frame, path, mode="append", files=2):
    frame.repartition(files).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        "metric_name"
    ).parquet(path)


@pytest.mark.parametrize("compact_after", [50, 0])
def test_any_change_equals_a_batch_run(spark, tables, tmp_path, compact_after):
    path, folder = str(tmp_path / "a table+%"), str(tmp_path / "state")
    staged = tables.staged.withColumn("metric_name", F.concat(F.lit("a b+c%/"), "metric_name"))
    monitor = TableMonitor(
        spark, path, staged.schema, everything(), folder, derived(), buckets=8, compact_after=compact_after
    )
    read = lambda: spark.read.schema(staged.schema).parquet(path).withColumns(derived())

    def grow():
        written(staged.where("metric_date >= '2026-02-20'"), path, files=1)
        written(staged.where("segment = 'all'"), path, files=1)  # copies of rows

    def rebuild():
        revenue = staged.where("metric_name like '%revenue'")
        written(revenue.withColumn("metric_value", F.col("metric_value") + 1), path, "overwrite", 1)
        written(staged.where("metric_name like '%active_users'").limit(1), path, "overwrite", 1)

    steps = [lambda: written(staged.where("metric_date < '2026-02-20'"), path), grow, rebuild]
    if not compact_after:
        steps = steps[:2]  # each refresh writes all state anew
    for version, step in enumerate(steps):
        step()
        assert monitor.refresh() == version
        assert same_rows(monitor.measure(AT), run_checks(read(), everything(), AT))
    assert monitor.refresh() == len(steps) - 1  # nothing changed
    # files that go, and the same state from another process' point of view
    for file in (tmp_path / "a table+%").glob("*conversion*/*.parquet"):
        os.remove(file)
    again = TableMonitor(spark, path, staged.schema, everything(), folder, derived(), buckets=8)
    assert again.refresh() == len(steps)
    assert same_rows(again.measure(AT), run_checks(read(), everything(), AT))


def test_unchanged_files_are_not_read(spark, tables, tmp_path):
    path, folder = tmp_path / "table", str(tmp_path / "state")
    half = "metric_date < '2026-03-01'"
    tables.drift.where(half).repartition(3).write.parquet(str(path))
    monitor = TableMonitor(spark, str(path), tables.drift.schema, drift_suite(), folder)
    monitor.refresh()
    for file in path.glob("*.parquet"):  # as long and as old as before, and unreadable
        stat = file.stat()
        file.write_bytes(b"x" * stat.st_size)
        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    tables.drift.where(f"not ({half})").repartition(2).write.mode("append").parquet(str(path))
    monitor.refresh()
    assert same_rows(monitor.measure(AT), run_checks(tables.drift, drift_suite(), AT))


def test_killed_before_the_commit(spark, tables, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "table"), str(tmp_path / "state")
    tables.drift.where("segment = 'all'").write.parquet(path)
    monitor = TableMonitor(spark, path, tables.drift.schema, drift_suite(), folder)
    monitor.refresh()
    first = monitor.measure(AT).collect()
    tables.drift.where("segment <> 'all'").write.mode("append").parquet(path)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(monitor, "_merge_keys", killed)
    with pytest.raises(KeyboardInterrupt):
        monitor.refresh()
    monkeypatch.undo()
    assert monitor.version() == 0 and monitor.measure(AT).collect() == first
    assert monitor.refresh() == 1
    assert same_rows(monitor.measure(AT), run_checks(tables.drift, drift_suite(), AT))


def test_history_and_empty_table(spark, tables, tmp_path):
    path, folder, log = tmp_path / "table", str(tmp_path / "state"), str(tmp_path / "log")
    path.mkdir()
    suite = raw_suite(AT)
    monitor = TableMonitor(spark, str(path), tables.staged.schema, suite, folder)
    with pytest.raises(RuntimeError, match="refresh"):
        monitor.measure(AT)
    monitor.refresh()
    empty = spark.createDataFrame([], tables.staged.schema)
    assert same_rows(monitor.measure(AT), run_checks(empty, suite, AT))
    looks = []

    def stop():
        looks.append(1)
        if len(looks) == 1:
            tables.staged.write.mode("append").parquet(str(path))
        return len(looks) == 3

    keep_measuring_table(monitor, log, lambda: AT, poll_seconds=0.1, stop=stop)
    rows = read_measurements(spark, log).where("metric_name = 'ROW_COUNT'").collect()
    assert sorted((r.batch_id, r.value) for r in rows) == [(0, 0), (1, 542)]
    keep_measuring_table(monitor, log, lambda: AT, stop=lambda: True)
    assert read_measurements(spark, log).where("metric_name = 'ROW_COUNT'").count() == 2


def test_unsupported_check(spark, tables, tmp_path):
    other = c.KeyedCheck("TEST_OTHER", ("*",), measure=lambda df: df)
    with pytest.raises(ValueError, match="TEST_OTHER"):
        TableMonitor(spark, "x", tables.drift.schema, Suite("DB", "S", "T", (other.on("segment"),)), "y")
