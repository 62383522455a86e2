import datetime as dt
import threading
import time

import pytest

from tidewatch.operators import checks as c
from tidewatch.operators.suite import Suite, run_checks
from tidewatch.plans.default_suites import drift_suite, raw_suite
from tidewatch.session import CLUSTER_SETTINGS
from tidewatch.sources.tables import read_measurements
from tidewatch.streaming.monitor import keep_measuring, start_monitor, stream_table

AT = dt.datetime(2026, 4, 18, 8)


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("name", ["staged", "drift"])
def test_stream_equals_batch_and_resumes(spark, tables, tmp_path, name):
    frame = getattr(tables, name)
    suite = raw_suite(AT) if name == "staged" else drift_suite()
    path, folder = str(tmp_path / "table"), str(tmp_path / "monitor")

    def monitored():
        stream = stream_table(spark, path, frame.schema, files_per_batch=2)
        return start_monitor(stream, suite, folder).wait()

    half = "metric_date < '2026-03-01'"
    frame.where(half).repartition(5).write.parquet(path)
    first = monitored()
    assert len([p for p in first.partials.recentProgress if p["numInputRows"]]) == 3
    assert same_rows(first.measure(AT), run_checks(frame.where(half), suite, AT))

    # nothing new: the kept state answers
    assert same_rows(monitored().measure(AT), run_checks(frame.where(half), suite, AT))

    # the rest, and again some rows that were there already
    frame.where(f"not ({half})").unionByName(frame.where("segment = 'all'")).repartition(
        3
    ).write.mode("append").parquet(path)
    everything = frame.unionByName(frame.where("segment = 'all'"))
    assert same_rows(monitored().measure(AT), run_checks(everything, suite, AT))


def test_killed_before_a_batch_was_committed(spark, tables, tmp_path):
    """The state of the last batch is kept, but the progress doesn't say so: the batch runs again."""
    path, folder = str(tmp_path / "table"), tmp_path / "monitor"
    half = "metric_date < '2026-03-01'"
    tables.drift.where(half).repartition(4).write.parquet(path)

    def monitored():
        stream = stream_table(spark, path, tables.drift.schema, files_per_batch=2)
        return start_monitor(stream, drift_suite(), str(folder)).wait()

    before = monitored()
    assert before.last_batch() == 1
    for name in ("1", ".1.crc"):
        for progress in folder.glob(f"*/commits/{name}"):
            progress.unlink()
    assert len(list(folder.glob("*/commits/0"))) == 2
    again = monitored()
    assert again.last_batch() == 1
    assert same_rows(again.measure(AT), run_checks(tables.drift.where(half), drift_suite(), AT))
    tables.drift.where(f"not ({half})").write.mode("append").parquet(path)
    assert same_rows(monitored().measure(AT), run_checks(tables.drift, drift_suite(), AT))


def test_killed_before_a_batch_was_measured(spark, tables, tmp_path):
    path, folder, log = (str(tmp_path / k) for k in ("table", "monitor", "log"))
    tables.drift.write.parquet(path)
    suite = Suite("DB", "S", "T", (c.row_count.on(), c.cardinality.on("metric_name")))

    def monitor():
        return start_monitor(stream_table(spark, path, tables.drift.schema), suite, folder)

    monitor().wait()  # and no measurement
    for _ in range(2):
        keep_measuring(monitor(), log, lambda: AT, poll_seconds=0.1)
        rows = read_measurements(spark, log).collect()
        assert sorted((r.metric_name, r.value) for r in rows) == [
            ("CARDINALITY", 3), ("ROW_COUNT", tables.drift.count())
        ]


def test_state_on_disk(spark, tables, tmp_path):
    path = str(tmp_path / "table")
    tables.drift.repartition(4).write.parquet(path)
    try:
        for key, value in CLUSTER_SETTINGS.items():
            spark.conf.set(key, value)
        stream = stream_table(spark, path, tables.drift.schema, files_per_batch=2)
        monitor = start_monitor(stream, drift_suite()).wait()
        assert same_rows(monitor.measure(AT), run_checks(tables.drift, drift_suite(), AT))
    finally:
        for key in CLUSTER_SETTINGS:
            spark.conf.unset(key)


def test_nothing_arrived(spark, tables, tmp_path):
    path = tmp_path / "table"
    path.mkdir()
    suite = Suite("DB", "S", "T", (c.row_count.on(), c.volume_anomaly.on("metric_date")))
    stream = stream_table(spark, str(path), tables.drift.schema)
    monitor = start_monitor(stream, suite).wait()
    assert [r.value for r in monitor.measure(AT).collect()] == [0, None]


def test_history_of_a_running_monitor(spark, tables, tmp_path):
    path, log = str(tmp_path / "table"), str(tmp_path / "log")
    tables.drift.repartition(4).write.parquet(path)
    suite = Suite("DB", "S", "T", (c.row_count.on(), c.cardinality.on("metric_name")))
    stream = stream_table(spark, path, tables.drift.schema, files_per_batch=1)
    monitor = start_monitor(stream, suite, str(tmp_path / "monitor"))
    keep_measuring(monitor, log, lambda: AT, poll_seconds=0.1)
    last = read_measurements(spark, log).orderBy("batch_id").collect()[-2:]
    assert {(r.metric_name, r.value) for r in last} == {
        ("ROW_COUNT", tables.drift.count()), ("CARDINALITY", 3)
    }


def test_interval(spark, tables, tmp_path):
    path, log = str(tmp_path / "table"), str(tmp_path / "log")
    half = "metric_date < '2026-03-01'"
    tables.drift.where(half).write.parquet(path)
    suite = Suite(
        "DB", "S", "T",
        (c.row_count.on(), c.duplicate_count.on("metric_date", "metric_name", "segment")),
    )
    monitor = start_monitor(
        stream_table(spark, path, tables.drift.schema), suite, every="1 second"
    )
    keeper = threading.Thread(
        target=keep_measuring, args=(monitor, log, lambda: AT), kwargs={"poll_seconds": 0.2}
    )
    keeper.start()

    def measured():
        rows = read_measurements(spark, log).collect()
        newest = max((r.batch_id for r in rows), default=None)
        return {r.metric_name: r.value for r in rows if r.batch_id == newest}

    def wait_for(expected):
        end = time.time() + 60
        while measured() != expected and time.time() < end:
            time.sleep(0.5)
        assert measured() == expected

    try:
        first = tables.drift.where(half).count()
        wait_for({"ROW_COUNT": first, "DUPLICATE_COUNT": 0})
        tables.drift.write.mode("append").parquet(path)  # the rest, and the first part once more
        wait_for({"ROW_COUNT": first + tables.drift.count(), "DUPLICATE_COUNT": first})
    finally:
        monitor.stop()
        keeper.join(60)
    assert not keeper.is_alive()


def test_unsupported_check(spark, tables, tmp_path):
    path = str(tmp_path / "table")
    tables.drift.limit(3).write.parquet(path)
    other = c.KeyedCheck("TEST_OTHER", ("*",), measure=lambda df: df)
    with pytest.raises(ValueError):
        start_monitor(
            stream_table(spark, path, tables.drift.schema),
            Suite("DB", "S", "T", (other.on("metric_name"),)),
        )
